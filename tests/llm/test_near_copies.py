"""Near copies: blocks bounded by shingles, and the stage that needs classes alone."""

from conftest_llm import prose
from martkit.llm import jaccard
from test_pairs import near, plain_groups


def test_blocks_are_bounded_by_shingles(spark, frame, monkeypatch):
    made, cell = {}, jaccard._cells

    def kept(rows):
        made["cells"] = cell(rows)
        return made["cells"]
    monkeypatch.setattr(jaccard, "_cells", kept)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 2000, raising=False)
    rows = [(i, near(prose(1, 300), i, i % 6)) for i in range(40)]
    links, _ = plain_groups(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_groups(frame(rows)).collect()}
    assert got == {i: (0, n) for (i, _), n in zip(rows, links)}
    assert made["cells"].select("i", "j").distinct().count() > 1


def test_stage_counts_no_links(spark, frame, monkeypatch):
    def refused(threshold):
        raise AssertionError("links are counted")
    monkeypatch.setattr(jaccard, "_cell", refused)
    rows = [(i, near(prose(1, 100), i, i % 3)) for i in range(20)] + [(30, prose(2)), (31, ""), (32, None)]
    assert sorted(r.doc_id for r in jaccard.drop_near_copies(frame(rows)).collect()) == [0, 30, 31, 32]


def test_sets_of_many_large_buckets_are_compared_once(spark, frame, monkeypatch):
    most, cell = [], jaccard._cells

    def kept(rows):
        most.append(rows.groupBy("rid").count().agg({"count": "max"}).first()[0])
        return cell(rows)
    monkeypatch.setattr(jaccard, "_cells", kept)
    monkeypatch.setattr(jaccard, "SMALL", 4)
    # Variants of one text that are too far apart for links but share many buckets, and two copies of one with a link.
    rows = [(i, near(prose(1, 300), i, 9)) for i in range(40)]
    rows += [(50, near(rows[7][1], 99, 1)), (51, rows[7][1])]
    links, classes = plain_groups(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_groups(frame(rows)).collect()}
    assert {i: n for i, (_, n) in got.items()} == {i: n for (i, _), n in zip(rows, links)}
    assert max(m or 0 for m in most) == 1
