"""Lines under a segment that very many share: only near ones come out as pairs, and only lines that can hold it are looked at."""

from pyspark.sql import functions as F

from martkit.llm import line_dedup


def test_lines_far_apart_under_a_common_beginning_make_no_pairs(spark, monkeypatch):
    start, end = "the same beginning of very many lines, which says nothing ", " and the same end of them all"
    middle = "abcdefgh"
    # One piece differs, by the order of its letters: letter counts agree, but four edits lie between any two.
    lines = sorted({start + middle[i:] + middle[:i] + end for i in range(8)} |
                   {start + middle[::-1][i:] + middle[::-1][:i] + end for i in range(8)})
    lines += [f"{start}{i:02d}{i:02d}{i:02d}{end}" for i in range(10, 40)]
    lines += [lines[0][:60] + "x" + lines[0][60:]]
    made = []
    near = line_dedup.near_links
    monkeypatch.setattr(line_dedup, "near_links", lambda a, pairs, t=2: made.append(pairs.count()) or near(a, pairs, t))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    rows = [tuple(r) for r in docs.collect()]
    got = {r.doc_id: r.class_id for r in line_dedup.repeated_lines(docs).collect()}
    pairs = spark.createDataFrame([(a, x, b, y) for a, x in rows for b, y in rows if a < b], "a long, x string, b long, y string")
    linked = {(r.a, r.b) for r in pairs.filter(F.levenshtein("x", "y") <= 2).collect()}
    assert sorted({b for _, b in linked}) == sorted(got)
    assert len(made) == 3 and made[1] + made[2] <= len(linked)


def test_held_lines_are_those_that_hold_a_hot_segment(spark):
    base = "a segment here, then another one, and its end of a line"
    lines = [base, "x" + base, base[1:], base[:20] + base[22:], "yz" + base, "q" * 55, "w" * 30 + base[30:], base[::-1], "v" * 24]
    rows = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "h long, line string, size int")
    hot = line_dedup.index_keys(rows.filter("h = 0"), 2, "i", "size").drop("h").localCheckpoint()
    want = {}
    for keys, held in ((line_dedup.index_keys(rows, 2), True), (line_dedup.probe_keys(rows, 2).withColumnRenamed("other", "h"), False)):
        for r in keys.join(hot, "key", "left_semi").collect():
            want[r.h] = want.get(r.h, False) or held
    got = {r.h: (r.line, r.size, r.indexed) for r in line_dedup.held_lines(rows, hot, 2).collect()}
    assert got == {h: (lines[h], len(lines[h]), held) for h, held in want.items()} and len(got) == 4
