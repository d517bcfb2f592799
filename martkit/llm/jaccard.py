"""N-gram Jaccard join by chosen paths.

A document is the set of its shingles (five words; a shorter text is one shingle).  In each
run a set keeps few of its shingles: those whose hash lies below 1 / (threshold * size).  Two
sets of similarity ``threshold`` or more keep a common one with a known chance, so buckets of
sets that keep the same ones hold them together.  Two such choices make the first bucket;
buckets that are still large are split by further choices.  Small buckets are compared set by
set; runs repeat until the chance to miss a pair is below ``1 - recall``.

Work is bounded for hot buckets: every set is first compared with two of the sets that lead its
buckets, which already joins most of a group of near copies; a bucket whose members are one group by
then is finished, as pairs inside a group are counted exactly once, at the end, in blocks.
Large buckets that share sets make an area.  Where all its sets together have at most WHOLE times the pairs
of its buckets one by one, as in a large group of near copies whose sets share many buckets, the area is
compared as a whole, each set once, in blocks; other areas are split.
Equal sets are one class with a number of copies and are never expanded.

Before full sets travel, pairs are judged by bit sets that have two to four bits a shingle: bits of one set that the other
lacks are shingles that the other lacks, so the intersection is bounded from above and a pair that may be a link always stays.
Full sets are shuffled only for the pairs left, and for sets of an area that may be linked with a set of another group.

A text without words has no shingles: such a document is a class of its own.  Null ids and
repeated rows are kept, one result row each.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.llm.base import TEXT_ROWS, Shared, released, stored, texts
from martkit.llm.components import components
from martkit.llm.decontaminate import _FOLD
from martkit.llm.suffix_dedup import in_filter, make_filter

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999999
#: Buckets of more sets than this are split further.
SMALL = 24
#: Choices that make up the longest path; buckets that are still large then are compared in blocks.
DEPTH = 4
#: How many times as many shingles are chosen where a large bucket is split: few buckets are, so
#: their sets can afford more of them, and hardly a pair is parted there.
SPLIT = 4
#: An area is compared as a whole if that makes at most so many times the pairs of its buckets: a split deals every set to
#: some SPLIT / threshold buckets for each one it is in, and those are compared again.
WHOLE = 16
#: Sets, and shingles of them in all, that meet another block of sets in one task.
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
#: Bytes of text hashed at once.
CHUNK = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((seed * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def shingle_sets(values: list[str], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingle hashes of text i are hashes[bounds[i]:bounds[i + 1]]."""
    parts, sizes, at = [], [0], 0
    while at < len(values):
        raws, room = [], CHUNK
        while at < len(values) and (room > 0 or not raws):
            raws.append(values[at].encode("utf-8", "surrogatepass").translate(_FOLD) + b" ")
            room -= len(raws[-1])
            at += 1
        hashes, counts = _chunk_sets(raws, shingle)
        parts.append(hashes)
        sizes.extend(counts)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(sizes)


def _chunk_sets(raws: list[bytes], shingle: int) -> tuple[np.ndarray, list[int]]:
    joined = np.frombuffer(b" " + b"".join(raws), np.uint8)
    inside = joined != 32
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    with np.errstate(over="ignore"):
        sums = np.cumsum(joined * _powers(len(joined), _BASE), dtype=np.uint64)
        words = (sums[ends - 1] - sums[starts - 1]) * _powers(len(joined), _BASE_INVERSE)[starts]
        words = _mix(words, 1)
        grams, k = np.zeros(len(words), np.uint64), np.uint64(1)
        for i in range(shingle):
            if i < len(words):
                grams[:len(words) - i] += words[i:] * k
            k = k * _BASE
    bounds = np.cumsum([1, *map(len, raws)])
    firsts = np.searchsorted(starts, bounds)
    out, counts = [], []
    for a, b in zip(firsts[:-1], firsts[1:]):
        if b - a >= shingle:
            own = np.unique(_mix(grams[a:b - shingle + 1], 2))
        elif b > a:
            # Fewer words than a shingle: all of them are one.
            with np.errstate(over="ignore"):
                own = _mix(np.array([np.bitwise_xor.reduce(_mix(words[a:b] + np.arange(b - a, dtype=np.uint64), 3))]), 4)
        else:
            own = grams[:0]
        out.append(own)
        counts.append(len(own))
    return np.concatenate(out), counts


def _limits(sizes: np.ndarray, threshold: float, times: int = 1) -> np.ndarray:
    """Hashes below this are chosen: a share of ``times`` / (threshold * size)."""
    share = np.minimum(1.0, times / (threshold * np.maximum(sizes, 1)))
    return np.minimum(share * 2.0**64, 2.0**64 - 2048).astype(np.uint64)


def runs_for(recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold is missed with chance ``1 - recall`` at most.

    Such a pair keeps one common shingle on average in each of the first two choices, and
    SPLIT of them in every later one, so a run finds it with the product of the chances to keep any.
    """
    found = (1 - math.exp(-1)) ** 2 * (1 - math.exp(-SPLIT)) ** (DEPTH - 3)
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def _first_buckets(threshold: float, runs: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in _sliced(batch):
                hashes, bounds = shingle_sets(small.column("text").to_pylist(), shingle)
                sizes = np.diff(bounds)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                limit = _limits(sizes, threshold)[owner]
                docs, nodes = [], []
                for r in range(runs):
                    first, second = (np.flatnonzero(_mix(hashes, 10 + 2 * r + i) < limit) for i in (0, 1))
                    # Every pair of a first and a second choice of the same set is a bucket.
                    low = np.searchsorted(owner[second], owner[first], "left")
                    many = np.searchsorted(owner[second], owner[first], "right") - low
                    one = np.repeat(first, many)
                    two = second[np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())]
                    docs.append(owner[one])
                    nodes.append(_mix(_mix(hashes[one], 5 + 1000 * r) ^ hashes[two], 6))
                docs, nodes = np.concatenate(docs), np.concatenate(nodes)
                order = np.argsort(docs, kind="stable")
                offsets = np.searchsorted(docs[order], np.arange(len(sizes) + 1))
                yield pa.RecordBatch.from_arrays([
                    small.column("doc_id"), small.column("th"), pa.array(_set_ids(hashes, bounds), pa.int64(), mask=sizes == 0),
                    pa.array(sizes.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(nodes[order].view(np.int64)))],
                    names=["doc_id", "th", "rid", "n", "nodes"])
    return run


def _sliced(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _set_ids(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64 bits that stand for a whole set; sets that differ share them with chance 2**-64."""
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(hashes[a:b].tobytes(), 7) for a, b in zip(bounds[:-1], bounds[1:])],
                    np.uint64).view(np.int64)


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in _sliced(batch):
                hashes, bounds = shingle_sets(small.column("text").to_pylist(), shingle)
                same = np.flatnonzero(_set_ids(hashes, bounds) == small.column("rid").to_numpy())
                own = [hashes[bounds[i]:bounds[i + 1]] for i in same]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(small.column("rid").to_numpy()[same]), pa.array([len(x) for x in own], pa.int64()),
                     pa.array([bit_set(x) for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())],
                    names=["rid", "n", "bits", "own"])
    return run


def bit_set(own: np.ndarray) -> bytes:
    """One bit for the low bits of every hash, in the power of two that is twice the set's size or more."""
    held = np.zeros(max(64, 1 << (2 * len(own) - 1).bit_length()), np.bool_)
    held[(own & np.uint64(len(held) - 1)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little").tobytes()


def _of_size(bits: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Bit sets as matrices of words, by their length: (places in the list, words)."""
    lengths = np.array([len(b) for b in bits], np.int64)
    out = {}
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        out[length] = at, np.frombuffer(b"".join([bits[k] for k in at]), np.uint64).reshape(len(at), length // 8)
    return out


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """The bit sets that sets would have in ``width`` words."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] | words[:, half:]
    return words


def _held(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=-1, dtype=np.int64)


def _within_bound(n_one: np.ndarray, n_two: np.ndarray, lacks_one: np.ndarray, lacks_two: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets may be linked of which so many shingles at least are not in the other one."""
    most = np.minimum(n_one - lacks_one, n_two - lacks_two)
    return most >= threshold * (n_one + n_two - most)


def may_link(one: list[bytes], two: list[bytes], n_one: np.ndarray, n_two: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets may be links, by their bit sets and sizes; a link is never turned away."""
    out = np.zeros(len(one), bool)
    first, second = np.array([len(b) for b in one], np.int64), np.array([len(b) for b in two], np.int64)
    for p, q in {*zip(first.tolist(), second.tolist())}:
        at = np.flatnonzero((first == p) & (second == q))
        x, y = (_folded(np.frombuffer(b"".join([side[k] for k in at]), np.uint64).reshape(len(at), -1), min(p, q) // 8)
                for side in (one, two))
        common = _held(x & y)
        out[at] = _within_bound(n_one[at], n_two[at], _held(x) - common, _held(y) - common, threshold)
    return out


def _similar(one: np.ndarray, two: np.ndarray, threshold: float) -> bool:
    if min(len(one), len(two)) < threshold * max(len(one), len(two)):
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common >= threshold * (len(one) + len(two) - common)


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold)
                    for x, y in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _judge(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = may_link(batch.column("one").to_pylist(), batch.column("two").to_pylist(), batch.column("n_one").to_numpy(),
                          batch.column("n_two").to_numpy(), threshold)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _sides(sets: DataFrame, what: str) -> tuple[DataFrame, DataFrame]:
    one, two = (sets.select(F.col("rid").alias(end), F.col("n").alias(f"n_{side}"), F.col(what).alias(side))
                for end, side in (("a", "one"), ("b", "two")))
    return one, two


def only(sets: DataFrame, wanted: DataFrame, column: str = "rid") -> DataFrame:
    """The sets that may be wanted: others need not be shuffled for a join."""
    return sets.filter(may_be_in(wanted.select(F.col(column).alias("key")), F.col("rid")))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar; each pair is looked at once, full sets only of those that may be."""
    one, two = _sides(sets, "bits")
    sized = pairs.select("a", "b").distinct().join(one, "a").join(two, "b").filter(
        F.least("n_one", "n_two") >= threshold * F.greatest("n_one", "n_two"))
    near = stored(sized.select("a", "b", "n_one", "n_two", "one", "two").mapInArrow(
        released(_judge(threshold)), "a bigint, b bigint").distinct(), "jaccard-near", TEXT_ROWS)
    one, two = _sides(only(sets, near.select(F.explode(F.array("a", "b")).alias("rid"))), "own")
    rows = near.join(one, "a").join(two, "b")
    return rows.select("a", "b", "one", "two").mapInArrow(released(_verify(threshold)), "a bigint, b bigint").distinct()


def _split(threshold: float, level: int):
    """Each bucket of a set becomes one bucket for every shingle chosen there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, roots, children = [], [], []
            for rid, root, own, nodes in zip(*(batch.column(c).to_pylist() for c in ("rid", "root", "own", "nodes"))):
                own = np.frombuffer(own, np.uint64)
                limit = _limits(np.array([len(own)]), threshold, SPLIT)[0]
                for node in nodes:
                    seed = (node ^ level * 0x5851F42D4C957F2D) & (2**64 - 1)
                    chosen = own[_mix(own, seed) < limit]
                    children.append(_mix(chosen, seed ^ 0x14057B7EF767814F))
                    rids.append(np.full(len(chosen), rid, np.int64))
                    roots.append(np.full(len(chosen), root, np.int64))
            if rids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(children).view(np.int64)), pa.array(np.concatenate(rids)),
                     pa.array(np.concatenate(roots))], names=["node", "rid", "root"])
    return run


def _shared(rows: DataFrame) -> DataFrame:
    """The buckets (node, rid) that hold more than one set, with the first of them."""
    rows = rows.repartition("node")  # one shuffle for both
    kept = rows.groupBy("node").agg(F.min("rid").alias("low"), F.max("rid").alias("high")).filter("low < high")
    return rows.join(kept.select("node", "low"), "node")


def _matrix_counts(one: list, two: list, threshold: float, same: bool) -> list[np.ndarray]:
    """Links between two blocks as a 0/1 matrix, by products over the shingles that both hold."""
    sizes = [np.array([len(s) for s in block], np.float64) for block in (one, two)]
    flat = [np.concatenate(block) for block in (one, two)]
    row = [np.repeat(np.arange(len(b)), s.astype(np.int64)) for b, s in zip((one, two), sizes)]
    both = np.intersect1d(flat[0], flat[1])
    common = np.zeros((len(one), len(two)), np.float32)
    for at in range(0, len(both), 4096):
        part, held = both[at:at + 4096], []
        for f, r, block in zip(flat, row, (one, two)):
            place = np.searchsorted(part, f)
            place[place == len(part)] = 0
            ok = part[place] == f
            m = np.zeros((len(block), len(part)), np.float32)
            m[r[ok], place[ok]] = 1
            held.append(m)
        common += held[0] @ held[1].T
    linked = common >= threshold * (sizes[0][:, None] + sizes[1][None, :] - common)
    if same:
        np.fill_diagonal(linked, False)
    return linked


def _cell(threshold: float):
    """Of one pair of blocks of a group: how many documents each set is linked with."""
    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        blocks = {}
        for block, rid, copies, own in zip(*(table.column(c).to_pylist() for c in ("block", "rid", "copies", "own"))):
            blocks.setdefault(block, {})[rid] = (copies, np.frombuffer(own, np.uint64))
        one, two = blocks.get(i, {}), blocks.get(j, {})
        rids, links = [], []
        if one and two:
            linked = _matrix_counts([s for _, s in one.values()], [s for _, s in two.values()], threshold, i == j)
            weight = [np.array([c for c, _ in b.values()], np.int64) for b in (one, two)]
            rids, links = [*one], [*(linked @ weight[1])]
            if i != j:
                rids, links = [*rids, *two], [*links, *(linked.T @ weight[0])]
        return pa.table({"rid": pa.array(rids, pa.int64()), "links": pa.array([int(x) for x in links], pa.int64())})
    return run


def _cross(threshold: float):
    """Of one pair of blocks of a bucket: links that join them into groups, at most one per set."""
    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        blocks = {}
        for block, rid, own in zip(*(table.column(c).to_pylist() for c in ("block", "rid", "own"))):
            blocks.setdefault(block, {})[rid] = np.frombuffer(own, np.uint64)
        one, two = blocks.get(i, {}), blocks.get(j, {})
        a, b = [], []
        if one and two:
            linked = _matrix_counts([*one.values()], [*two.values()], threshold, i == j)
            names, others = [*one], [*two]
            # A spanning forest of the links between the blocks keeps what belongs together.
            parent = {x: x for x in {*names, *others}}

            def root(x):
                while parent[x] != x:
                    parent[x] = x = parent[parent[x]]
                return x
            for p, q in zip(*np.nonzero(linked)):
                x, y = root(names[p]), root(others[q])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    a.append(names[p])
                    b.append(others[q])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _near_cell(key: str, threshold: float):
    """Of one pair of blocks of a group: sets that may be linked with one of another root, by their bit sets."""
    def run(table: pa.Table) -> pa.Table:
        first, second, own = (table.column(c)[0].as_py() for c in ("i", "j", key))
        block, rid, root, n = (table.column(c).to_numpy() for c in ("block", "rid", "root", "n"))
        bits, near = table.column("bits").to_pylist(), np.zeros(len(rid), bool)
        one, two = ([(at[words], part) for words, part in _of_size([bits[k] for k in at]).values()]
                    for at in (np.flatnonzero(block == x) for x in (first, second)))
        for rows, x in one:
            for columns, y in two:
                width = min(x.shape[1], y.shape[1])
                a, b = _folded(x, width), _folded(y, width)
                held_a, held_b = _held(a), _held(b)
                step = max(1, (1 << 20) // (len(columns) * width))
                for k in range(0, len(rows), step):
                    some = rows[k:k + step]
                    common = _held(a[k:k + step, None, :] & b[None, :, :])
                    ok = _within_bound(n[some, None], n[None, columns], held_a[k:k + step, None] - common, held_b[None, :] - common, threshold)
                    ok &= root[some, None] != root[None, columns]
                    near[some] |= ok.any(axis=1)
                    near[columns] |= ok.any(axis=0)
        return pa.table({key: pa.array([own] * int(near.sum()), pa.int64()), "rid": pa.array(rid[near], pa.int64())})
    return run


def _cells(rows: DataFrame) -> DataFrame:
    """Each row of a group of ``size`` sets with ``total`` shingles, once for every pair of blocks that its block is in."""
    count = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    blocks = rows.withColumn("count", count).withColumn("block", F.pmod(F.hash("rid"), F.col("count")))
    return blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1))).withColumns({
        "i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "count")


def whole_areas(large: DataFrame) -> DataFrame:
    """(rid, area, size): sets of large buckets (node, rid, low, size) that are compared as a whole.

    An area is what buckets join, directly or over others; it is taken where that makes at most WHOLE times their pairs.
    """
    ends = large.filter("rid <> low").select(F.col("rid").alias("a"), F.col("low").alias("b"))
    areas = stored(components(ends), "jaccard-areas")
    of_buckets = large.filter("rid = low").select("low", "size").join(areas, F.col("low") == F.col("member")).groupBy("root").agg(
        F.sum(F.col("size").cast("double") * F.col("size")).alias("pairs"))
    sizes = areas.groupBy("root").agg(F.count("*").alias("size"))
    taken = sizes.join(of_buckets, "root").filter(
        F.col("size").cast("double") * F.col("size") <= WHOLE * F.col("pairs"))
    return areas.join(taken.select("root", "size"), "root").select(
        F.col("member").alias("rid"), F.col("root").alias("area"), "size")


def _sized(rows: DataFrame, key: str, classes: DataFrame) -> DataFrame:
    totals = rows.join(classes.select("rid", "n"), "rid").groupBy(key).agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    return rows.join(totals, key)


def _crossed(rows: DataFrame, key: str, classes: DataFrame, sets: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """Links that join all similar sets of each group (``key``, rid) that links have not joined yet (``groups``)."""
    roots = rows.select(key, "rid").join(groups, F.col("rid") == F.col("member"), "left").select(
        key, "rid", F.coalesce("root", "rid").alias("root"))
    grid = _cells(_sized(roots, key, classes).join(sets.select("rid", "n", "bits").dropDuplicates(["rid"]), "rid"))
    near = stored(grid.select(key, "i", "j", "block", "rid", "root", "n", "bits").groupBy(key, "i", "j").applyInArrow(
        _near_cell(key, threshold), f"{key} bigint, rid bigint").distinct(), "jaccard-near", TEXT_ROWS)
    grid = _cells(_sized(near, key, classes).join(only(sets, near).select("rid", "own").dropDuplicates(["rid"]), "rid"))
    return grid.select(key, "i", "j", "block", "rid", "own").groupBy(key, "i", "j").applyInArrow(
        _cross(threshold), "a bigint, b bigint")


def may_be_in(keys: DataFrame, key: Column) -> Column:
    """Whether ``key`` may be among ``keys`` (key bigint): whole texts that are not need not be shuffled for a join.

    All keys are in a filter of fixed size that is sent to the tasks; a wrong hit only costs work.
    """
    shared = Shared(keys.sparkSession, make_filter(keys, "key"))

    def hits(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = shared.value
        for part in parts:
            yield pa.array(in_filter(words, part.to_numpy().view(np.uint64)))
    return F.arrow_udf(hits, "boolean")(key)


def _linked(docs: DataFrame, threshold: float, recall: float, shingle: int) -> tuple[DataFrame, ...]:
    """(members, classes, sets, groups): documents with their set's id, sets with copies and first document,
    shingles of sets that share a bucket, and the root of every set that a link joins to others."""
    rows = texts(docs, "doc_id").withColumn("th", F.xxhash64("text"))
    members = stored(rows.mapInArrow(
        released(_first_buckets(threshold, runs_for(recall), shingle)),
        "doc_id bigint, th bigint, rid bigint, n int, nodes array<bigint>"), "jaccard-members", TEXT_ROWS)
    classes = stored(members.filter("rid is not null").groupBy("rid").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("n").alias("n")), "jaccard-classes")
    live = stored(_shared(members.filter("rid is not null").select(F.explode("nodes").alias("node"), "rid"))
                  .distinct(), "jaccard-buckets")
    wanted = stored(live.select("rid").distinct().join(classes, "rid").select("rid", F.col("rep").alias("doc_id")), "jaccard-wanted")
    near = rows.filter(may_be_in(wanted.select(F.xxhash64("doc_id").alias("key")), F.xxhash64(F.col("doc_id").cast("bigint"))))
    sets = stored(near.join(wanted, near["doc_id"].eqNullSafe(wanted["doc_id"])).select("rid", "text").mapInArrow(
        released(_sets(shingle)), "rid bigint, n bigint, bits binary, own binary"), "jaccard-sets", TEXT_ROWS)
    # Every set against two of the sets that are first in its buckets: that joins most of a group.
    firsts = live.filter("rid <> low").groupBy("rid").agg(F.array_distinct(F.array(F.min("low"), F.max("low"))).alias("low"))
    links = stored(verified(firsts.select(F.explode("low").alias("a"), F.col("rid").alias("b")), sets, threshold),
                   "jaccard-links", TEXT_ROWS)
    for level in range(3, DEPTH + 1):
        groups = stored(components(links), "jaccard-groups")
        named = live.join(groups, F.col("rid") == F.col("member"), "left").select(
            "node", "rid", "low", F.coalesce("root", "rid").alias("root"))
        per_node = named.groupBy("node").agg(
            F.count("*").alias("size"), F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
        mixed = stored(named.join(per_node.select("node", "size"), "node"), "jaccard-mixed")
        small = mixed.filter(F.col("size") <= SMALL)
        other = small.select("node", F.col("rid").alias("b"), F.col("root").alias("other_root"))
        pairs = small.join(other, "node").filter((F.col("rid") < F.col("b")) & (F.col("root") != F.col("other_root")))
        found = [verified(pairs.select(F.col("rid").alias("a"), "b"), sets, threshold)]
        large = mixed.filter(F.col("size") > SMALL)
        last = large.isEmpty()
        if not last:
            areas = stored(whole_areas(large), "jaccard-areas")
            found.append(_crossed(areas, "area", classes, sets, groups, threshold))
            large = large.join(areas.select("rid"), "rid", "left_anti")
            last = level == DEPTH or large.isEmpty()
            if level == DEPTH:
                found.append(_crossed(large, "node", classes, sets, groups, threshold))
        if not last:
            nodes = large.groupBy("rid").agg(F.collect_set("node").alias("nodes"), F.first("root").alias("root")).join(
                only(sets, large), "rid")
            live = stored(_shared(nodes.select("rid", "root", "own", "nodes").mapInArrow(
                _split(threshold, level), "node bigint, rid bigint, root bigint").distinct()), "jaccard-buckets", TEXT_ROWS)
            # Sets of one group need not be compared: a bucket's first set against those of other groups.
            first = live.filter("rid = low").select("node", F.col("root").alias("low_root"))
            star = live.join(first, "node").filter(F.col("root") != F.col("low_root"))
            found.append(verified(star.select(F.col("low").alias("a"), F.col("rid").alias("b")), sets, threshold))
            live = live.drop("root")
        links = stored(reduce(DataFrame.unionByName, [links, *found]).distinct(), "jaccard-links", TEXT_ROWS)
        if last:
            break
    return members, classes, sets, stored(components(links), "jaccard-groups")


def jaccard_groups(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                   shingle: int = SHINGLE) -> DataFrame:
    """Per document: ``class_id``, the smallest id of its group, and ``n_links``, the documents similar to it.

    A group is what links join, directly or over others.  Equal texts count as links.
    """
    members, classes, sets, groups = _linked(docs, threshold, recall, shingle)
    named = groups.withColumnRenamed("member", "rid").join(classes.select("rid", "copies", "n"), "rid")
    sizes = named.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    grouped = named.select("rid", "root", "copies").join(sizes, "root").join(only(sets, groups, "member").drop("n"), "rid")
    counts = _cells(grouped).select("root", "i", "j", "block", "rid", "copies", "own").groupBy(
        "root", "i", "j").applyInArrow(_cell(threshold), "rid bigint, links bigint")
    counts = counts.groupBy("rid").agg(F.sum("links").alias("links"))
    firsts = groups.join(classes, F.col("member") == F.col("rid")).groupBy("root").agg(F.min("rep").alias("first"))
    per_class = classes.join(groups, F.col("rid") == F.col("member"), "left").join(firsts, "root", "left").join(
        counts, "rid", "left").select(
        "rid", F.coalesce("first", "rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = members.select("doc_id", "rid").join(stored(per_class, "jaccard-classes", TEXT_ROWS), "rid", "left")
    return out.select("doc_id", F.when(F.col("rid").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                      .alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each group stays: the one with the smallest id, then text hash.  All columns as they came.

    Null ids come after all others.  Rows that agree in id and text are one document; of those without
    words, rows of null id cannot be told apart and all stay.
    """
    members, _, _, groups = _linked(docs, threshold, RECALL, SHINGLE)
    own = members.groupBy("doc_id", "th", "rid").agg(F.count("*").alias("rows"))
    own = stored(own.join(groups, F.col("rid") == F.col("member"), "left").select(
        "doc_id", "th", "rows", F.coalesce("root", "rid").alias("class")), "jaccard-documents")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th")
    firsts = own.filter("class is not null").groupBy("class").agg(F.min(place).alias("first"))
    stays = F.col("class").isNull() | place.eqNullSafe(F.col("first"))
    again = (F.col("rows") > 1) & (F.col("class").isNotNull() | F.col("doc_id").isNotNull())
    marked = own.join(firsts, "class", "left").select(
        F.col("doc_id").alias("its_doc"), F.col("th").alias("its_th"), stays.alias("stays"), again.alias("again"))
    told = stored(marked.filter("again or not stays"), "jaccard-told")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", "row.doc_id", F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("th"))
    # Only rows that may be told meet the others' table in a join; the rest, most as a rule, stay where they are.
    hit = may_be_in(told.select(F.xxhash64("its_doc", "its_th").alias("key")), F.xxhash64(F.col("doc_id").cast("bigint"), "th"))
    untold, rows = rows.filter(~hit), rows.filter(hit)

    def same(other: DataFrame) -> Column:
        return rows["doc_id"].eqNullSafe(other["its_doc"]) & (rows["th"] == other["its_th"])
    # Of equal documents one row: the rank filter is a limit in every task before the shuffle.
    repeated = told.filter("stays")
    rank = F.row_number().over(Window.partitionBy("doc_id", "th").orderBy(F.xxhash64("row")))
    one = rows.join(repeated, same(repeated), "left_semi").withColumn("rank", rank).filter("rank = 1")
    return untold.select("row.*").unionByName(rows.join(told, same(told), "left_anti").select("row.*")).unionByName(
        one.select("row.*"))
