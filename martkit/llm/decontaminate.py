"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every item of the benchmark as a sequence of normalised words.
Documents stream through it word by word; at every word it knows the longest run of
words that ends here and occurs in some item.  A run of at least ``window`` words is
contaminated, and so is a whole item shorter than that.  Only the benchmark is held
in memory: items are split by their word count into automata of a fixed size, so
what a task loads has a bound whatever the benchmark's size, and the documents never shuffle.

A null or empty text has no words and is clean; a null or empty item has no windows;
items with equal texts are all reported; repeated document rows are reported each;
only the columns named are read, so others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from martkit.llm.base import Shared, released, stored, texts

WINDOW = 10
#: Words of benchmark text in one automaton: at most twice as many states, about 100 MB.
SHARD_WORDS = 200_000

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of any other character beyond ASCII; A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences; states are rows of parallel lists."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: dict[int, set] = {}
        whole: dict[int, list] = {}
        for item, words in items:
            codes = [self.ids.setdefault(w, len(self.ids)) for w in words]
            last = 0
            for code in codes:
                last = self._extend(last, code)
                ends.setdefault(last, set()).add(item)
        self.items = self._item_sets(ends)
        # Short items are found by the state that spells them, at their own length.
        for item, words in items:
            if 0 < len(words) < window:
                state = 0
                for w in words:
                    state = self.next[state][self.ids[w]]
                whole.setdefault(state, []).append((len(words), item))
        self.whole = whole
        order = np.argsort(self.length, kind="stable")
        #: The nearest state on the suffix path, itself included, that spells a short item.
        self.short = [-1] * len(self.link)
        for s in map(int, order):
            self.short[s] = s if s in whole else self.short[self.link[s]] if s else -1
        #: The state of the last ``window`` words of any match that reaches this state.
        self.base = [-1] * len(self.link)
        for s in map(int, order[1:]):
            if self.length[s] >= window:
                parent = self.link[s]
                self.base[s] = s if self.length[parent] < window else self.base[parent]

    def _extend(self, last: int, code: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if code in nxt[last]:
            to = nxt[last][code]
            return to if length[to] == length[last] + 1 else self._split(last, code, to)
        new = len(link)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and code not in nxt[at]:
            nxt[at][code] = new
            at = link[at]
        if at != -1:
            to = nxt[at][code]
            link[new] = to if length[to] == length[at] + 1 else self._split(at, code, to)
        return new

    def _split(self, at: int, code: int, old: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(link)
        nxt.append(dict(nxt[old]))
        link.append(link[old])
        length.append(length[at] + 1)
        link[old] = clone
        while at != -1 and nxt[at].get(code) == old:
            nxt[at][code] = clone
            at = link[at]
        return clone

    def _item_sets(self, ends: dict[int, set]) -> dict[int, set]:
        """Items in which the strings of a state occur, for states that a window can reach."""
        sets = {s: set(v) for s, v in ends.items()}
        for s in map(int, np.argsort(self.length, kind="stable")[::-1]):
            parent = self.link[s]
            if s in sets and parent > 0 and self.length[parent] >= self.window:
                sets.setdefault(parent, set()).update(sets[s])
        return {s: v for s, v in sets.items() if self.length[s] >= self.window}

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit word ranges, disjoint and in order, and the items whose windows occur."""
        window, nxt, link, length, base, short = (
            self.window, self.next, self.link, self.length, self.base, self.short)
        look, root = self.ids.get, self.next[0]
        spans: list[list[int]] = []
        states, items = set(), set()
        state = matched = 0
        for j, word in enumerate(words):
            code = look(word)
            if code is None:
                state = matched = 0
                continue
            if state:
                while state and code not in nxt[state]:
                    state = link[state]
                    matched = length[state]
            to = nxt[state].get(code) if state else root.get(code)
            if to is None:
                state = matched = 0
                continue
            state, matched = to, matched + 1
            run = 0
            if matched >= window:
                run = matched
                states.add(base[state])
            found = short[state]
            while found != -1:
                for size, item in self.whole[found]:
                    if size <= matched:
                        items.add(item)
                        run = max(run, size)
                found = short[link[found]] if link[found] > 0 else -1
            if run:
                start = j + 1 - run
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, j + 1])
        for s in states:
            items |= self.items[s]
        return [(a, b) for a, b in spans], items


def benchmark_shards(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                     shard_words: int = SHARD_WORDS) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items as word lists, in groups of at most ``shard_words`` words (one item at least).

    The rows are streamed partition by partition, so the driver holds one group.
    """
    group, held = [], 0
    rows = benchmark.select(F.col(f"`{item_id}`"), F.col(f"`{text}`")).filter(F.col(f"`{item_id}`").isNotNull())
    for item, value in rows.toLocalIterator():
        words = words_of(value)
        if not words:
            continue
        if group and held + len(words) > shard_words:
            yield group
            group, held = [], 0
        group.append((item, words))
        held += len(words)
    if group:
        yield group


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))
_FOUND = {"n_words": T.LongType(), "spans": _SPANS, "items": T.ArrayType(T.StringType())}


def find_items(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
               cut: bool = False) -> DataFrame:
    """``rows`` (a column ``text``, never null, and others) with n_words, spans and items.

    With ``cut`` also the text without the spans (null if there are none), by the worker that found them.

    ``spans`` are hit ranges of word numbers, disjoint and ascending; ``items`` the ids found,
    as text.  A benchmark of more than one automaton takes one pass each, written between.
    """
    spark = rows.sparkSession
    new = _FOUND | ({"cut": T.StringType()} if cut else {})
    out = rows.select("*", *[F.lit(None).cast(t).alias(n) for n, t in new.items()])
    schema, first = out.schema, True
    for group in benchmark_shards(benchmark, shard_words=shard_words):
        if not first:
            out = stored(out, "decontaminate")
        out, first = out.mapInArrow(released(_pass(Shared(spark, Automaton(group, window)))), schema), False
    if first:
        out = out.mapInArrow(released(_pass(Shared(spark, Automaton([], window)))), schema)
    return out


def _pass(shared: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            counts, spans, items, cut = [], [], [], []
            earlier = zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(),
                          batch.column("items").to_pylist())
            for text, old_spans, old_items in earlier:
                words = words_of(text)
                hit, ids = automaton.match(words)
                counts.append(len(words))
                spans.append(_merge([*(old_spans or []), *hit]))
                items.append(sorted({str(i) for i in ids}.union(old_items or [])))
                cut.append(cut_words(text, spans[-1]) if spans[-1] else None)
            found = {"n_words": counts, "spans": spans, "items": items, "cut": cut}
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[f.name], f.type) if f.name in found else batch.column(f.name) for f in batch.schema],
                schema=batch.schema)
    return run


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: how many words, how many of them hit, and by which items."""
    found = find_items(texts(docs, "doc_id"), benchmark, window)
    return found.select(
        "doc_id", "n_words", hit_words(F.col("spans")).alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "spans",
    ).withColumn("contaminated", F.col("n_hit") > 0)


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def cut_words(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """Remove contaminated spans; documents of which more than ``max_coverage`` is hit go.

    Other rows keep all their columns; ``n_chars``, where present, follows the shortened text.
    """
    # The text goes to the workers once; the other columns stand apart, whatever their names.
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others or [F.lit(0)]).alias("row"), F.coalesce("text", F.lit("")).alias("text"),
                       F.col("text").isNull().alias("unset"))
    found = find_items(rows, benchmark, window, cut=True).filter(hit_words(F.col("spans")) <= F.col("n_words") * max_coverage)
    touched = F.size("spans") > 0
    new = {"text": F.when(touched, F.col("cut")).when(~F.col("unset"), F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(touched, F.length("cut").cast(kind)).otherwise(F.col("row.n_chars"))
    return found.select([new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])
