"""Periodic runs of words, found on a grammar of the text.

The word ids of many documents are compressed together by Re-Pair: in every round each pair that is
more frequent than the pairs it overlaps becomes one nonterminal everywhere; once little repeats, what
is left is paired in order until every document is one symbol.  A run lies inside some symbol of that
tree and crosses the border of its two parts, so each nonterminal is searched once, at its first place,
for runs that cross its border, whatever the number of its places.  The runs are then moved to all places
where the nonterminal was derived, and of each run the widest interval stays: one that no neighbouring
word extends.

A run has smallest period q, words q apart are equal, and it is at least ``max(LEAST, TIMES * q)`` words long.
Words are runs of anything but ASCII white space, compared exactly; lengths are compared by rolling hashes
first, and every run that is reported is compared word by word (if a hash ever lied, all is compared so).

Every document is read by itself: no shuffle.  A task holds one slice of a batch (``SLICE`` bytes of text, or one longer
document) at a time.  A null text has no words, a null id stays null; repeated rows and rows of one id are
results of their own; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: A run has this many words, and this many times its period, at least.
LEAST, TIMES = 6, 4
#: Bytes of text that share a grammar.
SLICE = 4 << 20
#: Rounds of frequent pairs go on while they shorten the text by this share.
WORTH = 1 / 16

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _values(ids: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Extensions:
    """How far two places of a sequence agree, forwards and backwards; ``exact`` compares word by word."""

    def __init__(self, ids: np.ndarray, exact: bool = False):
        self.ids, self.exact = ids, exact
        if not exact:
            with np.errstate(over="ignore"):
                powers = np.full(len(ids) + 1, _BASE, np.uint64)
                powers[0] = 1
                self.powers = np.multiply.accumulate(powers)
                self.sums = np.zeros(len(ids) + 1, np.uint64)
                np.cumsum(_values(ids) * self.powers[:-1], out=self.sums[1:])

    def _walk(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for k, (a, b, m) in enumerate(zip(x.tolist(), y.tolist(), most.tolist())):
            one, two = (self.ids[a:a + m], self.ids[b:b + m]) if step > 0 else (self.ids[a - m:a][::-1], self.ids[b - m:b][::-1])
            differ = np.flatnonzero(one != two)
            out[k] = differ[0] if len(differ) else m
        return out

    def forward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The longest agreement of what starts at x and at y > x, ``most`` words at most."""
        return self._walk(x, y, most, 1) if self.exact else self._search(x, y, most, 1)

    def backward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same of what ends before x and before y."""
        return self._walk(x, y, most, -1) if self.exact else self._search(x, y, most, -1)

    def _search(self, x, y, most, step):
        out = np.zeros(len(x), np.int64)
        if not len(x):
            return out
        shift = self.powers[y - x]
        bit = 1 << int(most.max()).bit_length()
        with np.errstate(over="ignore"):
            while bit := bit >> 1:
                length = out + bit
                ok = np.flatnonzero(length <= most)
                n, a, b = length[ok], x[ok], y[ok]
                if step < 0:
                    a, b = a - n, b - n
                same = (self.sums[a + n] - self.sums[a]) * shift[ok] == self.sums[b + n] - self.sums[b]
                out[ok[same]] += bit
        return out


def crossing(near: Extensions, first: np.ndarray, border: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(node, start, stop, period): the runs inside each node [first, end) that cross its border, widest inside it.

    A run holds four periods or more, so two of them lie on one side of the border: the words from the border
    agree with those a period later, or the words before it with those a period earlier.
    """
    ids = near.ids
    many = (end - first) // TIMES
    many[end - first < LEAST] = 0
    node = np.repeat(np.arange(len(first)), many)
    period = np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many) + 1
    found = []
    for right in (True, False):
        b = border[node]
        if right:
            at = np.flatnonzero(b + 2 * period <= end[node])
            x = b[at]
        else:
            at = np.flatnonzero(b - 2 * period >= first[node])
            x = b[at] - 2 * period[at]
        for far in (False, True):  # the first and the last pair of words; few places pass both
            k = x + (period[at] - 1) * far
            ok = ids[k] == ids[k + period[at]]
            at, x = at[ok], x[ok]
        o, q, b = node[at], period[at], border[node[at]]
        x = b if right else b - q
        ahead = near.forward(x, x + q, end[o] - x - q)
        back = near.backward(x, x + q, x - first[o])
        start, stop = x - back, x + ahead + q
        ok = (stop - start >= np.maximum(LEAST, TIMES * q)) & (start < b) & (b < stop)
        found.append((o[ok], start[ok], stop[ok], q[ok]))
    o, start, stop, q = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((q, stop, start, o))
    o, start, stop, q = o[order], start[order], stop[order], q[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return o[new], start[new], stop[new], q[new]


def _frequent(symbol: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, rule): the places whose pair repeats and is more frequent than those it overlaps; equal pairs, equal rule."""
    together = doc[:-1] == doc[1:]
    at = np.flatnonzero(together)
    pair, rule, counts = np.unique(symbol[at] * (int(symbol.max()) + 1) + symbol[at + 1], return_inverse=True, return_counts=True)
    rank = np.empty(len(pair), np.int64)
    rank[np.lexsort((pair, counts))] = np.arange(len(pair)) + 1
    rank[counts < 2] = 0
    own = np.zeros(len(symbol) + 1, np.int64)  # of the pair that starts at k, at k + 1
    own[at + 1] = rank[rule]
    # A stretch of one word repeats one pair: every other place of it, from its start.
    change = np.ones(len(own), bool)
    change[1:] = own[1:] != own[:-1]
    begin = np.maximum.accumulate(np.where(change, np.arange(len(own)), 0))
    odd = (np.arange(len(own)) - begin) % 2
    before = np.append(0, own[:-1])[begin]
    ends = np.append(np.flatnonzero(change)[1:], len(own))
    after = np.append(own, 0)[ends][np.cumsum(change) - 1]
    # Both neighbours of the stretch must be less frequent: else they are replaced first.
    take = (own > 0) & (odd == 0) & (before < own) & (after < own)
    places = np.flatnonzero(take) - 1
    return places, rule[np.searchsorted(at, places)]


def _in_order(doc: np.ndarray) -> np.ndarray:
    """Every other place of each document whose neighbour is of the same document."""
    change = np.ones(len(doc), bool)
    change[1:] = doc[1:] != doc[:-1]
    begin = np.maximum.accumulate(np.where(change, np.arange(len(doc)), 0))
    take = (np.arange(len(doc)) - begin) % 2 == 0
    take[-1:] = False
    take[:-1] &= ~change[1:]
    return np.flatnonzero(take)


def find_runs(ids: np.ndarray, bounds: np.ndarray, exact: bool = False) -> tuple[np.ndarray, ...]:
    """(start, stop, period) of all runs of the documents ids[bounds[k]:bounds[k + 1]], in order of start and period."""
    near = Extensions(ids, exact)
    symbol, start = ids.astype(np.int64), np.arange(len(ids))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    low, high = bounds[:-1][owner], bounds[1:][owner]  # of the document of each word
    doc, stop, found, frequent = owner, start + 1, [], True
    while len(doc) > 1:
        if frequent:
            places, rule = _frequent(symbol, doc)
            frequent = len(places) >= WORTH * len(doc)
            if not len(places):
                continue
        else:
            places = _in_order(doc)
            rule = np.arange(len(places))
            if not len(places):
                break
        # Each rule once, at its first place.
        kinds, shown, rule = np.unique(rule, return_index=True, return_inverse=True)
        one = places[shown]
        node, s, e, q = crossing(near, start[one], start[one + 1], stop[one + 1])
        if len(node):
            order = np.argsort(rule, kind="stable")
            first = np.searchsorted(rule[order], np.arange(len(kinds)))
            copies = np.diff(np.append(first, len(order)))[node]
            which = np.repeat(first[node] - np.cumsum(copies) + copies, copies) + np.arange(copies.sum())
            move = start[places[order[which]]] - np.repeat(start[one][node], copies)
            s, e, q = np.repeat(s, copies) + move, np.repeat(e, copies) + move, np.repeat(q, copies)
            wide = ((s == low[s]) | (ids[s - 1] != ids[s - 1 + q])) & ((e == high[s]) | (ids[np.minimum(e, len(ids) - 1)] != ids[e - q]))
            found.append((s[wide], e[wide], q[wide]))
        stop = stop.copy()
        stop[places] = stop[places + 1]
        symbol[places] = int(symbol.max()) + 1 + rule
        kept = np.ones(len(doc), bool)
        kept[places + 1] = False
        symbol, start, stop, doc = symbol[kept], start[kept], stop[kept], doc[kept]
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    s, e, q = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    # Multiples of the smallest period give the same interval.
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[new], e[new], q[new]
    if not exact and not all(np.array_equal(ids[a:c - p], ids[a + p:c]) for a, c, p in zip(s.tolist(), e.tolist(), q.tolist())):
        return find_runs(ids, bounds, exact=True)
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


def repeated_tail(n: int, seed: int) -> np.ndarray:
    """Places of words after the tail of a text was made periodic, as the seed says: a way to plant runs."""
    spread = seed // 10
    first = spread % n
    period = 1 + (n - first) // (3 + spread % 8)
    at = np.arange(n)
    return np.where(at >= first, first + (at - first) % period, at)


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(sizes):
        to, room = at, SLICE
        while to < len(sizes) and (to == at or sizes[to] <= room):
            room -= sizes[to]
            to += 1
        yield at, to
        at = to


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _collapse(values: list[bytes], seeds: list[int | None]) -> list[pa.Array]:
    words, sizes = [], []
    for text, seed in zip(values, seeds):
        own = text.split()  # at space and \x09-\x0D, and nothing else
        if seed is not None and seed % 10 == 0 and own:
            own = [own[k] for k in repeated_tail(len(own), seed).tolist()]
        words += own
        sizes.append(len(own))
    bounds = np.cumsum([0, *sizes])
    ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, stop, period = find_runs(ids, bounds)
    marks = np.zeros(len(ids) + 1, np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, stop, -1)
    drop = np.cumsum(marks)[:-1] > 0
    home = np.searchsorted(bounds, start, "right") - 1
    gone = np.zeros(len(sizes), bool)
    gone[home] = True
    kept = []
    for k, touched in enumerate(gone.tolist()):
        a, b = bounds[k], bounds[k + 1]
        own = words[a:b]
        kept.append(b" ".join([own[i] for i in np.flatnonzero(~drop[a:b]).tolist()] if touched else own))
    runs = pa.StructArray.from_arrays([pa.array(start - bounds[home]), pa.array(stop - start), pa.array(period)], fields=list(_RUN))
    offsets = np.searchsorted(home, np.arange(len(sizes) + 1))
    return [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), runs),
            pa.array(kept, pa.binary()).cast(pa.string())]


def _task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "runs", "collapsed"]
    for batch in batches:
        for a, b in _slices(pc.binary_length(batch.column("text")).to_pylist()):
            part = batch.slice(a, b - a)
            values = part.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *_collapse(values, part.column("seed").to_pylist())], names=names)


def collapse_runs(docs: DataFrame, seed: Column | None = None) -> DataFrame:
    """Per document: ``n_words``, its ``runs`` (start, length, period) and the text ``collapsed``: without the
    words that a run holds after its first period, the others joined by one space.

    ``seed``, a whole number per row, makes the tail of the texts with seed % 10 = 0 periodic first; a null one does not.
    """
    seed = F.lit(None) if seed is None else seed
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), seed.cast("bigint").alias("seed"))
    return rows.mapInArrow(_task, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                                  "collapsed string")


def run_report(docs: DataFrame) -> DataFrame:
    """Digest of the runs of every document, tails of one in ten made periodic by the crc32 of the id's decimal text."""
    out = collapse_runs(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return out.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words").select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * -best.less) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words")
