"""One scan marks the matches: the cut texts are those of the whole pattern."""

import re

from pyspark.sql import functions as F

from martkit.llm import surrogates
from martkit.llm.surrogates import replace_entities

TEXTS = ["", "no match", "Maria Lopez", "a Maria Lopez b", "\x01", "\x01Maria Lopez\x01 wrote to a.b@c.de\x01", "x@y.de Maria Lopez",
         "cost $0 \\1 at 10.0.0.1", "key 0123456789abcdef0123456789abcdef and sk-abcdefghij0123456789xyz, gh, sk-", "call (555) 123-4567",
         "a" * 40, "deadbeef" * 4, "+49 30 123456, ghp_" + "a1" * 20, "Мария Иванова и Dr. Öztürk", "x.y.z@w.example.org" * 3]


def test_cut_equals_the_whole_pattern(spark, frame):
    whole = "|".join(surrogates.PATTERNS.values())
    docs = frame(list(enumerate(TEXTS)))
    rows = docs.select(
        surrogates._cut(F.col("text")).alias("cut"), surrogates.mentions_of(F.col("text")).alias("found"),
        F.split("text", whole, -1).alias("pieces"), F.regexp_extract_all("text", F.lit(whole), F.lit(0)).alias("all")).collect()
    for r in rows:
        assert r.cut.pieces == r.pieces and r.cut.found == r.found == r.all
    assert sum(len(r.all) for r in rows) > 12


def test_marks_of_a_text_stay(frame):
    made = replace_entities(frame([(0, "\x01Maria Lopez\x01 a\x01"), (1, "Maria Lopez a")])).orderBy("doc_id").collect()
    name = made[1].text[:-2]
    assert made[0].text == f"\x01{name}\x01 a\x01" and re.fullmatch(r"\w+ \w{5}", name) and name != "Maria Lopez"
