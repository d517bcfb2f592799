"""Near copies by HyperMinHash.

A document is the set of its shingles (three words).  In each of ``ROUNDS`` rounds a hash of its own deals the
shingles to four buckets; of the smallest value in a bucket, only the number of leading zeros and the next
``MANTISSA`` bits are stored: a register of 16 bits.  The four registers of a round are one band, a bigint.  Documents that
agree in a band are candidates.  A pair of similarity 0.85 agrees in a band with a chance of 0.52, so 20 bands miss one in 2.6 million
such pairs, and fewer of those that are more alike.

Before sets are compared, the share of equal registers estimates the similarity, less what registers of different minima agree by
chance; a pair whose count would come from a link with a chance below ``DOUBT`` goes.  All others are verified on full sets.

Copies are one class.  Classes of a band are compared with its first one, which joins most of a group of near copies; buckets
that hold one group by then are finished.  In the others, pairs of different groups are looked at once, in the first bucket they share:
pair by pair in small buckets, in blocks of bounded size by bit sets in large ones; a block passes on links that join groups, one a class at
most.  Nothing is capped.

A text without words has no shingles and is a document of its own, as is a null text; words are
runs of anything but ASCII white space, A-Z lower-cased; a text of one or two words is one shingle.  Rows of null id take part: their
component is that of the others, null if none has an id.  Repeated rows have one result row each.  Other columns are not read.
Shingles and sets are told apart by 64 bits of hash: two different sets share one with chance 2^-64 per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.llm.base import stored, texts
from martkit.llm.components import components
from martkit.llm.jaccard import CHUNK, _chunk_sets, _mix, _set_ids
from martkit.llm.periodic_runs import _slices

SHINGLE = 3
#: Similarity of linked documents, in hundredths.
PERCENT = 85
ROUNDS = 20
#: Buckets of a round, and bits behind the leading one that a register keeps.
BUCKETS, MANTISSA = 4, 10
#: Chance at which the estimate may turn a link away.
DOUBT = 1e-10
#: Classes in a bucket whose pairs are listed; larger ones are compared in blocks.
SMALL = 24
#: Classes of a block, and shingles of them in all.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20

_FOLD = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_NONE = np.uint16(0xFFFF)


def shingle_sets(values: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingle hashes of text i are hashes[bounds[i]:bounds[i + 1]]."""
    parts, sizes, at = [np.zeros(0, np.uint64)], [0], 0
    while at < len(values):
        raws, room = [], CHUNK
        while at < len(values) and (room > 0 or not raws):
            raws.append(values[at].encode("utf-8", "surrogatepass").translate(_FOLD) + b" ")
            room -= len(raws[-1])
            at += 1
        hashes, counts = _chunk_sets(raws, shingle)
        parts.append(hashes)
        sizes.extend(counts)
    return np.concatenate(parts), np.cumsum(sizes)


def registers(hashes: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Registers (set, round, bucket) of all sets: leading zeros above ``MANTISSA`` bits; 0xFFFF where no shingle fell."""
    out = np.full((len(bounds) - 1, rounds, BUCKETS), _NONE, np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    begin = bounds[:-1][full]
    width = np.uint64(1 << 62)
    for r in range(rounds):
        seeds = _mix(np.array([2 * r, 2 * r + 1], np.uint64), 77)
        with np.errstate(over="ignore"):
            x = (hashes ^ seeds[0]) * (seeds[1] | np.uint64(1))
        for b in range(BUCKETS):
            # The bucket is the top two bits; moved down by it, other buckets' values are larger than any of its own.
            with np.errstate(over="ignore"):
                least = np.minimum.reduceat(x - np.uint64(b) * width, begin)
            zeros = 62 - np.frexp(least.astype(np.float64))[1]
            zeros = np.maximum(np.where(least == 0, 62, zeros), 0).astype(np.uint64)
            # frexp may round a value up to the next power of two: that moves its bit by one.
            zeros += ((least << (zeros + np.uint64(2))) >> np.uint64(63)) ^ np.uint64(1)
            zeros = np.minimum(zeros, np.uint64(62))
            bits = (least << (zeros + np.uint64(3)) % np.uint64(64)) >> np.uint64(64 - MANTISSA)
            code = (zeros << np.uint64(MANTISSA) | bits).astype(np.uint16)
            out[full, r, b] = np.where(least < width, code, _NONE)
    return out


def chance_equal(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The chance that registers of different minima agree, for sets of these sizes."""
    far = np.arange(63)
    inside = lambda n: (1 - 0.5 ** (far + 1)) ** n[:, None] - (1 - 0.5 ** far) ** n[:, None]
    a, b = (np.maximum(n / BUCKETS, 1.0) for n in (one, two))
    return (inside(a) * inside(b)).sum(axis=1) * 2.0 ** -MANTISSA


def least_counts(percent: int, most: int) -> np.ndarray:
    """Of k registers, how many agree at least in a link, but for a chance of ``DOUBT`` (Chernoff)."""
    t, out = percent / 100, [0]
    for k in range(1, most + 1):
        c = 0
        while c < t * k:
            g = c / k
            apart = (g * math.log(g / t) if g else 0) + (1 - g) * math.log((1 - g) / (1 - t))
            if k * apart <= -math.log(DOUBT):
                break
            c += 1
        out.append(c)
    return np.array(out, np.float64)


def likely(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray, percent: int, least: np.ndarray) -> np.ndarray:
    """Which pairs of sketches (bigints) may be links, by sizes and by the corrected count of equal registers."""
    x, y = (np.ascontiguousarray(s).view(np.uint16).reshape(len(s), s.shape[1] * BUCKETS) for s in (one, two))
    used = ~((x == _NONE) & (y == _NONE))
    k, equal = used.sum(axis=1), ((x == y) & used).sum(axis=1)
    c = chance_equal(n_one, n_two)
    corrected = np.maximum(equal - k * c, 0) / (1 - c)
    return (100 * np.minimum(n_one, n_two) >= percent * np.maximum(n_one, n_two)) & (corrected >= least[k] - 1)


def _similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(two) - common)


def _sketches(shingle: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(pc.binary_length(batch.column("text")).to_pylist()):
                part = batch.slice(a, b - a)
                hashes, bounds = shingle_sets(part.column("text").to_pylist(), shingle)
                sizes = np.diff(bounds)
                bands = registers(hashes, bounds, rounds).reshape(len(sizes), -1).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("th"), pa.array(_set_ids(hashes, bounds), pa.int64(), mask=sizes == 0),
                    pa.array(sizes.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * rounds), pa.array(bands.ravel()))],
                    names=["doc_id", "th", "rid", "n", "sketch"])
    return run


def _own_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(pc.binary_length(batch.column("text")).to_pylist()):
                part = batch.slice(a, b - a)
                hashes, bounds = shingle_sets(part.column("text").to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid"), part.column("n"), part.column("sketch"),
                     pa.array([hashes[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])], pa.binary())],
                    names=["rid", "n", "sketch", "own"])
    return run


def _matrix(column: pa.Array, rounds: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), rounds)


def _verify(percent: int, rounds: int):
    least = least_counts(percent, rounds * BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (_matrix(batch.column(c), rounds) for c in ("one", "two"))
            n = [batch.column(c).to_numpy() for c in ("n_one", "n_two")]
            left = batch.take(pa.array(np.flatnonzero(likely(one, two, *n, percent, least))))
            keep = [_similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                    for x, y in zip(left.column("own_one"), left.column("own_two"))]
            yield left.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int, rounds: int) -> DataFrame:
    """The pairs (a, b) that are links; each pair is looked at once."""
    one, two = (sets.select(F.col("rid").alias(name), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(side), F.col("own").alias(f"own_{side}"))
                for name, side in (("a", "one"), ("b", "two")))
    rows = pairs.select("a", "b").distinct().join(one, "a").join(two, "b")
    return rows.select("a", "b", "n_one", "n_two", "one", "two", "own_one", "own_two").mapInArrow(_verify(percent, rounds), "a bigint, b bigint")


def _first_shared(one: np.ndarray, two: np.ndarray, large_one: np.ndarray, large_two: np.ndarray) -> np.ndarray:
    """The band whose bucket a pair is looked at in: the first shared one that is large, else the first shared one."""
    bits = np.uint64(1) << np.arange(one.shape[1], dtype=np.uint64)
    same = one == two
    large = same & ((large_one[:, None] & large_two[:, None] & bits) > 0)
    return np.where(large.any(axis=1), large.argmax(axis=1), same.argmax(axis=1))


def _small_pairs(percent: int, rounds: int):
    """Pairs of different groups in small buckets whose rows come together."""
    least = least_counts(percent, rounds * BUCKETS)

    def pairs(rows: list[tuple]) -> tuple[list, list]:
        band = rows[0][0]
        rid, root, n, large = (np.array([r[k] for r in rows], np.int64) for k in (2, 3, 4, 6))
        sketch = np.array([r[5] for r in rows], np.int64)
        i, j = np.triu_indices(len(rows), 1)
        apart = root[i] != root[j]
        i, j, large = i[apart], j[apart], large.view(np.uint64)
        here = _first_shared(sketch[i], sketch[j], large[i], large[j]) == band
        i, j = i[here], j[here]
        ok = likely(sketch[i], sketch[j], n[i], n[j], percent, least)
        return rid[i[ok]].tolist(), rid[j[ok]].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            a, b = [], []
            for row in zip(*(batch.column(c).to_pylist() for c in ("band", "key", "rid", "root", "n", "sketch", "large"))):
                if rows and row[:2] != rows[0][:2]:
                    if len(rows) > 1:
                        x, y = pairs(rows)
                        a += x
                        b += y
                    rows = []
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        if len(rows) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pairs(rows)], names=["a", "b"])
    return run


def _common(one: list[np.ndarray], two: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of one[i] and two[j], by bit sets over the shingles that both blocks hold."""
    flat = [np.concatenate(block) for block in (one, two)]
    owner = [np.repeat(np.arange(len(b)), [len(s) for s in b]) for b in (one, two)]
    both = np.intersect1d(*flat)
    out = np.zeros(len(i), np.int64)
    for at in range(0, len(both), 1 << 14):
        part, held = both[at:at + (1 << 14)], []
        for f, o, block in zip(flat, owner, (one, two)):
            place = np.searchsorted(part, f)
            place[place == len(part)] = 0
            ok = part[place] == f
            bits = np.zeros((len(block), -(-len(part) // 64) * 64), np.bool_)
            bits[o[ok], place[ok]] = True
            held.append(np.packbits(bits, axis=1).view(np.uint64))
        for k in range(0, len(i), 4096):
            to = slice(k, k + 4096)
            out[to] += np.bitwise_count(held[0][i[to]] & held[1][j[to]]).sum(axis=1, dtype=np.int64)
    return out


def _cell(percent: int, rounds: int):
    """Of one pair of blocks of a bucket: links that join groups, at most one per class."""
    least = least_counts(percent, rounds * BUCKETS)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        band, first, second = (table.column(c)[0].as_py() for c in ("band", "i", "j"))
        block, rid, root, n, large = (table.column(c).to_numpy() for c in ("block", "rid", "root", "n", "large"))
        sketch = _matrix(table.column("sketch").chunk(0), rounds)
        own = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("own")]
        large = large.view(np.uint64)
        rows, columns = np.flatnonzero(block == first), np.flatnonzero(block == second)
        parent = {x: x for x in root.tolist()}

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x
        found_i, found_j = [], []
        for row in range(0, len(rows), 64):
            i, j = (x.ravel() for x in np.meshgrid(rows[row:row + 64], columns, indexing="ij"))
            keep = (root[i] != root[j]) & ((i < j) if first == second else True)
            i, j = i[keep], j[keep]
            keep = _first_shared(sketch[i], sketch[j], large[i], large[j]) == band
            i, j = i[keep], j[keep]
            keep = likely(sketch[i], sketch[j], n[i], n[j], percent, least)
            found_i.append(i[keep])
            found_j.append(j[keep])
        a, b = [], []
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_i, found_j))
        if len(i):
            one, two = np.unique(i), np.unique(j)
            common = _common([own[x] for x in one], [own[x] for x in two], np.searchsorted(one, i), np.searchsorted(two, j))
            linked = 100 * common >= percent * (n[i] + n[j] - common)
            for p, q in zip(i[linked].tolist(), j[linked].tolist()):
                x, y = top(int(root[p])), top(int(root[q]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    a.append(int(rid[p]))
                    b.append(int(rid[q]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Each row of a bucket of ``size`` classes with ``total`` shingles, once for every pair of blocks that its block is in."""
    count = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    blocks = rows.withColumn("count", count).withColumn("block", F.pmod(F.hash("rid"), F.col("count")))
    return blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1))).withColumns({
        "i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "count")


def _class_sets(rows: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(rid, n, sketch, own): the full set of every class wanted, from the text of its first document, once."""
    found = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["rep"]) & (rows["th"] == wanted["rep_th"])).select(
        "rid", "n", "sketch", "copies", "text")
    # Rows that repeat a first document: one stays; the rank filter is a limit in every task before the shuffle.
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.lit(1)))
    again = found.filter("copies > 1").withColumn("rank", rank).filter("rank = 1").drop("rank")
    return found.filter("copies = 1").unionByName(again).select("rid", "n", "sketch", "text").mapInArrow(
        _own_sets(shingle), "rid bigint, n bigint, sketch array<bigint>, own binary")


def _linked(rows: DataFrame, percent: int, rounds: int, shingle: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, groups): documents with their class, classes with their first document, the root of each linked class."""
    members = stored(rows.mapInArrow(
        _sketches(shingle, rounds), "doc_id bigint, th bigint, rid bigint, n bigint, sketch array<bigint>"), "hyper-members")
    classes = stored(members.filter("rid is not null").groupBy("rid", "n", "sketch").agg(
        F.min("doc_id").alias("rep"), F.coalesce(F.min_by("th", "doc_id"), F.min("th")).alias("rep_th"), F.count("*").alias("copies")),
        "hyper-classes")
    banded = classes.select("rid", F.posexplode("sketch").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.min("rid").alias("low"), F.max("rid").alias("high")).filter("low < high")
    live = stored(banded.join(shared.select("band", "key", "low"), ["band", "key"]), "hyper-buckets")
    wanted = live.select("rid").distinct().join(classes, "rid")
    sets = stored(_class_sets(rows, wanted, shingle), "hyper-sets")
    firsts = live.filter("rid <> low").groupBy("rid").agg(F.array_distinct(F.array(F.min("low"), F.max("low"))).alias("low"))
    groups = stored(components(stored(verified(firsts.select(F.explode("low").alias("a"), F.col("rid").alias("b")), sets, percent, rounds),
                                      "hyper-links")), "hyper-groups")
    # Buckets that hold different groups.
    named = live.join(groups, F.col("rid") == F.col("member"), "left").select("band", "key", "rid", F.coalesce("root", "rid").alias("root"))
    per = named.groupBy("band", "key").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = stored(named.join(per.filter("low < high").select("band", "key", "size"), ["band", "key"]), "hyper-mixed")
    large = mixed.groupBy("rid").agg(F.bit_or(F.when(F.col("size") > SMALL, F.expr("shiftleft(1L, band)"))
                                              .otherwise(F.lit(0).cast("bigint"))).alias("large"))
    rest = mixed.join(large, "rid")
    small = rest.filter(F.col("size") <= SMALL).join(classes.select("rid", "n", "sketch"), "rid").repartition(
        "band", "key").sortWithinPartitions("band", "key")
    listed = small.select("band", "key", "rid", "root", "n", "sketch", "large").mapInArrow(
        _small_pairs(percent, rounds), "a bigint, b bigint")
    whole = rest.filter(F.col("size") > SMALL).join(sets, "rid")
    totals = rest.filter(F.col("size") > SMALL).join(classes.select("rid", "n"), "rid").groupBy("band", "key").agg(F.sum("n").alias("total"))
    crossed = _in_blocks(whole.join(totals, ["band", "key"])).select(
        "band", "key", "i", "j", "block", "rid", "root", "n", "large", "sketch", "own").groupBy("band", "key", "i", "j").applyInArrow(
        _cell(percent, rounds), "a bigint, b bigint")
    new = stored(verified(listed, sets, percent, rounds).unionByName(crossed), "hyper-links")
    joined = groups.select(F.col("member").alias("a"), F.col("root").alias("b")).unionByName(new)
    return members, classes, stored(components(joined), "hyper-groups")


def near_copies(docs: DataFrame, percent: int = PERCENT, rounds: int = ROUNDS, shingle: int = SHINGLE) -> DataFrame:
    """Per document: ``n_shingles``, ``component_id`` (the smallest id that links lead to) and ``kept``: whether that is its own."""
    rows = texts(docs, "doc_id").withColumn("th", F.xxhash64("text"))
    members, classes, groups = _linked(rows, percent, rounds, shingle)
    named = classes.select("rid", "rep").join(groups, F.col("rid") == F.col("member"), "left").select(
        "rid", "rep", F.coalesce("root", "rid").alias("root"))
    firsts = named.groupBy("root").agg(F.min("rep").alias("first"))
    per_class = stored(named.join(firsts, "root").select("rid", "first"), "hyper-firsts")
    worded = members.filter("rid is not null").select("doc_id", "n", "rid").join(per_class, "rid").select("doc_id", "n", "first")
    empty = members.filter("rid is null").select("doc_id", "n", F.col("doc_id").alias("first"))

    def columns() -> list[Column]:
        return [F.col("doc_id"), F.col("n").alias("n_shingles"), F.col("first").alias("component_id"),
                F.col("doc_id").eqNullSafe(F.col("first")).alias("kept")]
    return worded.unionByName(empty).select(*columns())
