"""Mail addresses with letters beyond ASCII are replaced as a whole."""

from martkit.llm.surrogates import surrogate_report


def test_mails_with_other_letters(spark, frame):
    texts = ["See andré.12@mail.example.com now", "müller@x.de, möller@x.de", "łęż@poczta.pl", "иван.п@почта.рф",
             "用户@例子.公司", "请写信到foo.bar@mail.com谢谢", "(josé@x.es)"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.text, r.n_entities) for r in surrogate_report(frame(rows)).collect()}
    assert [got[i][1] for i in range(len(texts))] == [1, 2, 1, 1, 1, 1, 1]
    for i, gone in enumerate(["andré", "ller", "łęż", "иван", "用户", "foo", "jose"]):
        assert gone not in got[i][0], got[i]
    assert got[0][0].startswith("See ") and got[0][0].endswith(" now")
    a, b = (m.split("@")[0] for m in got[1][0].split(", "))
    assert a != b and "müller" != a and "möller" != b and len(a) == len(b) == 6
    assert got[5][0].startswith("请写信到") and got[5][0].endswith("谢谢")
