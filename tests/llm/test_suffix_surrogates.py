"""Repeated passages byte for byte, and replacements of personal data."""

import hashlib
import io
import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from conftest_llm import prose
from martkit.llm import surrogates, suffix_dedup
from martkit.llm.induced_sort import sorted_suffixes
from martkit.llm.surrogates import entities, moved_entities, replace_entities, surrogate_report


class Disk(dict):
    def open(self, name, mode):
        disk = self

        class File(io.BytesIO):
            def __exit__(self, *_):
                if mode == "w":
                    disk[name] = self.getvalue()
        return File(b"" if mode == "w" else self[name])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=25), min_size=1, max_size=8), st.sampled_from([30, 10**6]))
def test_order_and_common_prefixes(segments, memory):
    cap = 6
    text = np.array([x for s in segments for x in [*[ord(c) - 96 for c in s], 0]], np.int64)
    starts, common = [], []
    for a, b in reversed(list(sorted_suffixes(text, cap, memory, Disk().open))):
        starts += a.tolist()
        common += b.tolist()
    own = text.tolist()
    full = [i for i, p in enumerate(starts) if 0 not in own[p:p + cap] and own[p] and p + cap <= len(own)]
    assert sorted(p for p in starts if own[p]) == [i for i, x in enumerate(own) if x]
    for i, j in zip(full, full[1:]):
        a, b = own[starts[i]:starts[i] + cap], own[starts[j]:starts[j] + cap]
        assert a <= b
        shared = next((k for k in range(cap) if a[k] != b[k]), cap)
        assert min(common[i + 1:j + 1]) == shared


def plain_removal(rows, length):
    out, seen = {}, set()
    for doc, raw in sorted(rows.items(), key=lambda x: (x[0] is not None, x[0] or 0)):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i:i + length]
            if window in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[doc] = (len(raw), sum(gone), runs, bytes(x for x, g in zip(raw, gone) if not g))
    return out


def test_removal(spark, frame, edge_rows):
    rng = random.Random(5)
    passages = [prose(i, 30) for i in range(6)]
    rows = {100 + i: " ".join(rng.choice([*passages, prose(rng.randrange(10**6), 12), passages[0][:rng.randrange(60, 180)]])
                              for _ in range(5)) for i in range(80)}
    rows |= {500: "é" * 300, 501: "a" * 400, 502: "ab" * 99, 503: prose(9, 40) + "\n" + prose(9, 40)}
    rows |= {r[0]: r[1] for r in edge_rows if r[0] not in (3,)}
    want = plain_removal({d: (t or "").encode() for d, t in rows.items()}, 100)
    docs = frame(list(rows.items()))
    # Shards of one and of several grams, queues on disk, and grams beyond the limit of a shard.
    for sizes in ({}, {"shard_bytes": 4000, "queue_bytes": 2000}, {"shard_group": 3}):
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs, **sizes).collect()}
        assert got == want
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_equal_rows_are_one_document(spark, frame):
    text = prose(1, 80)
    got = suffix_dedup.remove_repeats(frame([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, len(text.encode()))]
    assert {r.kept_sha256 for r in got if r.doc_id == 2} == {hashlib.sha256(b"").hexdigest()}


PRIVATE = ('Write to und.34@mail7.example.com or UND.34@Mail7.example.com, call +1 (017) 555-7713, pay 4012888888881881 or '
           '4012-8888-8888-1881 from 97.51.17.173. token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" of Maria Lopez and '
           'Frau Müller, Мария Петрова; DE89 3704 0044 0532 0130 00, 123-45-6789!!')
FOUND = ["und.34@mail7", "UND.34", "555-7713", "4012888888881881", "4012-8888", "97.51.17.173", "04dbebab", "Lopez", "Maria",
         "Müller", "Мария", "Петрова", "3704", "123-45-6789"]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_surrogates(spark, frame, edge_rows):
    rows = [*edge_rows, (50, PRIVATE), (51, "Again und.34@mail7.example.com and Lopez; Maria Lopez")]
    docs = frame(rows)
    got = {r.doc_id: r for r in surrogate_report(docs).collect()}
    new = got[50].text
    assert not [f for f in FOUND if f in new] and got[50].n_entities == 12
    # Form stays: everything that is no letter or digit, and every letter's case and script.
    assert re.sub(r"[^\W_]", "x", new).replace("x", "") != "" and len(new.split()) == len(PRIVATE.split())
    mails = re.findall(r"\S+@\S+\.com", new)
    assert mails[0].lower() == mails[1].lower().rstrip(",") and mails[1].split("@")[0].isupper()
    assert mails[0] in got[51].text
    card = re.search(r"\d{16}", new).group()
    assert luhn(card) and card[0] == "4" and "-".join(card[i:i + 4] for i in (0, 4, 8, 12)) in new
    assert re.search(r"[А-Я][а-я]+ [А-Я][а-я]+", new) and re.search(r"\b24\d|25\d\.", new)
    assert got[1].text is None and got[2].text == "" and got[1].n_entities == 0
    for doc, text in ((r[0], r[1]) for r in edge_rows):
        assert got[doc].text == text
    out = replace_entities(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert surrogate_report(docs.limit(0)).count() == 0


def test_replacements_stay_distinct(spark, frame, monkeypatch):
    # Two letters for a surname: many collide at first.
    monkeypatch.setattr(surrogates, "ATTEMPTS", 60)
    names = [a + b for a in "BCDFG" for b in "aeiou"]
    docs = frame([(i, f"Maria {n} came.") for i, n in enumerate(names)])
    found = entities(docs)
    assert found.count() == len(names) and moved_entities(found).count() > 0
    texts = [r.text for r in surrogate_report(docs).collect()]
    made = {t.split()[1] for t in texts}
    assert len(made) == len(names)
