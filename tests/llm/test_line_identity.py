"""Documents that share an id, or have none, keep the lines that only they have."""

import pytest

from martkit.llm import line_dedup

L = "this third unique line must not be lost at all"


@pytest.mark.parametrize("doc_id", [None, 7])
def test_line_numbers_of_one_document_do_not_touch_another(frame, doc_id):
    one = f"the first line of the first document\n{L} here"
    two = f"{L} here\nanother line that nobody else has in any text\n" + L[::-1]
    got = {(r.doc_id, r.text): r for r in line_dedup.drop_lines(frame([(doc_id, one), (doc_id, two), (doc_id, two)]), short=True).collect()}
    left = [line for _, text in got for line in text.split("\n")]
    # Of the shared line one copy is left; every other line stands once in each of its rows.
    assert sorted(set(left)) == sorted(set((one + "\n" + two).split("\n")))
    report = line_dedup.line_report(frame([(doc_id, one), (doc_id, two)]), short=True).collect()
    assert sum(r.n_removed for r in report) == 1 and len(report) == 2


def test_rows_that_agree_are_one_document(frame):
    text = "a line that stands here and nowhere else\nshort\nshort"
    got = line_dedup.line_report(frame([(None, text)] * 3 + [(5, text)]), short=True).collect()
    assert sorted((r.doc_id is None, list(r.removed_lines)) for r in got) == [(False, [0, 1, 2])] + [(True, [2])] * 3
