"""The trie of conversation prefixes, from range minima over sorted common prefixes.

A turn is named by 16 bytes of a SHA-256 of role and text, a conversation by the names of its turns in a row, so
equal prefixes of turns are equal prefixes of bytes.  Different conversations are sorted by these names
over the cluster; each stretch of them (``ROWS``, ``PATH_BYTES``) is a shard.  In a shard, the common prefixes of
neighbours go into a sparse table of range minima; every candidate prefix (what two neighbours share, and every
whole conversation) finds its first and last member by two binary searches on that table, each by itself.  The intervals
nest, so sums over a subtree are differences of running totals.

A prefix may go on in the next shard only if a shard's first or last conversation has it.  Such prefixes, a
path or two a shard, are put together by name: a first turn that a third of all conversations share is one row a shard
there, and all its other work stays in the shards.

Copies of a conversation are one row with their number, their smallest id and the digest of their ids; the ids of
very many copies are cut into pieces and streamed through one hash, as such a digest has to be.  Texts are read once and
never sorted or gathered; of a conversation, 20 bytes a turn are held in one row.

A null role or text is empty; turns are ordered by number, null first, then by name.  Rows without ``conv_id`` belong to no
conversation; repeated rows are turns of their own; other columns are not read; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.llm.base import stored

#: Bytes of a turn's name.
NAME = 16
#: Conversations of a shard, and bytes of their names.
ROWS, PATH_BYTES = 1 << 17, 16 << 20
#: Ids that are joined to one piece of text.
PIECE = 1024
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_lists(turns: DataFrame) -> DataFrame:
    """Per ``conv_id``: ``names`` (hex) and ``sizes`` (bytes of the text) of its turns, in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    name = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * NAME)
    turn = F.struct("turn", name.alias("name"), F.octet_length(text).alias("size"))
    own = turns.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return own.select("conv_id", F.col("turns.name").alias("names"), F.col("turns.size").alias("sizes"))


def branched(lists: DataFrame, width: int, heads: Column, longest: int) -> DataFrame:
    """Every conversation with its first ``heads`` turns (``longest`` at most) taken from conversation
    c - c % width, as it was; none where that one is absent, its own later turns after them."""
    base = lists.filter(F.col("conv_id") % width == 0).select(
        F.col("conv_id").alias("base"), F.slice("names", 1, longest).alias("base_names"), F.slice("sizes", 1, longest).alias("base_sizes"))
    rows = lists.withColumn("heads", heads.cast("int")).join(base, F.col("conv_id") - F.col("conv_id") % width == F.col("base"), "left")

    def joined(name: str, kind: str) -> Column:
        first = F.slice(F.coalesce(f"base_{name}", F.array().cast(f"array<{kind}>")), F.lit(1), F.col("heads"))
        return F.concat(first, F.slice(name, F.col("heads") + 1, F.greatest(F.size(name) - F.col("heads"), F.lit(0))))
    return rows.select("conv_id", joined("names", "string").alias("names"), joined("sizes", "int").alias("sizes"))


# ---- copies ----

_PIECES = "class binary, low bigint, n bigint, ends string, ids string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (class, conv_id): the digest of every class that lies inside the partition and is small, else its ids in pieces."""
    schema = pa.schema([("class", pa.binary()), ("low", pa.int64()), ("n", pa.int64()), ("ends", pa.string()), ("ids", pa.string())])
    out, own, now, whole = [], [], None, False  # ``whole``: nothing of the class came before ``own``

    def close(last: bool) -> None:
        text = ",".join(map(str, own))
        done = whole and not last
        out.append({"class": now, "low": own[0], "n": len(own), "ends": hashlib.sha256(text.encode()).hexdigest() if done else None,
                    "ids": None if done else text})
    for batch in batches:
        for name, conv in zip(batch.column("class").to_pylist(), batch.column("conv_id").to_pylist()):
            if name != now:
                if own:
                    close(last=False)
                # The partition's first class may have begun in the one before.
                own, whole, now = [], now is not None, name
            elif len(own) == PIECE:
                close(last=True)
                own, whole = [], False
            own.append(conv)
        yield pa.RecordBatch.from_pylist(out, schema)
        out.clear()
    if own:
        close(last=True)
        yield pa.RecordBatch.from_pylist(out, schema)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of classes whose pieces come in order, one after the other."""
    out, now, digest, low, n = [], None, None, 0, 0
    schema = pa.schema([("class", pa.binary()), ("low", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
    for batch in batches:
        for name, first, many, ids in zip(*(batch.column(c).to_pylist() for c in ("class", "low", "n", "ids"))):
            if name != now:
                if now is not None:
                    out.append({"class": now, "low": low, "n": n, "ends": digest.hexdigest()})
                now, digest, low, n = name, hashlib.sha256(), first, 0
            else:
                digest.update(b",")
            digest.update(ids.encode())
            n += many
    if now is not None:
        out.append({"class": now, "low": low, "n": n, "ends": digest.hexdigest()})
    yield pa.RecordBatch.from_pylist(out, schema)


def distinct_paths(rows: DataFrame) -> DataFrame:
    """Each path once: its smallest conversation ``low``, their number ``n`` and the digest ``ends`` of their ids."""
    named = rows.select(F.substring(F.unhex(F.sha2("path", 256)), 1, NAME).alias("class"), "conv_id")
    pieces = stored(named.repartitionByRange("class", "conv_id").sortWithinPartitions("class", "conv_id").mapInArrow(_pieces, _PIECES),
                    "trie-pieces")
    rest = pieces.filter("ends is null").select("class", "low", "n", "ids").repartition("class").sortWithinPartitions("class", "low")
    classes = pieces.filter("ends is not null").select("low", "n", "ends").unionByName(
        rest.mapInArrow(_streamed, "class binary, low bigint, n bigint, ends string").select("low", "n", "ends"))
    return rows.join(classes, F.col("conv_id") == F.col("low")).select("path", "sizes", "low", "n", "ends")


# ---- one shard ----

class RangeMinimum:
    """Minima of any range of ``values``, by a table of the ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels, width = [values], 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k, table in enumerate(self.levels):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(table[first[at]], table[last[at] - (1 << k) + 1])
        return out

    def last_with(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place r >= at for which no value of at + 1 .. r is below ``least``."""
        r = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(r + 1 < len(self.levels[k]))
            ok = fits[self.levels[k][r[fits] + 1] >= least[fits]]
            r[ok] += 1 << k
        return r

    def first_with(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place l <= at for which no value of l + 1 .. at is below ``least``."""
        first = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            begin = first - (1 << k) + 1
            fits = np.flatnonzero(begin >= 1)
            ok = fits[self.levels[k][begin[fits]] >= least[fits]]
            first[ok] -= 1 << k
        return first


def common_prefixes(names: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many names each sequence shares with the one before it; -1 for the first."""
    shared = np.zeros(len(begin), np.int64)
    shared[0] = -1
    live, depth = np.arange(1, len(begin)), 0
    while len(live):
        live = live[np.minimum(length[live], length[live - 1]) > depth]
        live = live[(names[begin[live] + depth] == names[begin[live - 1] + depth]).all(axis=1)]
        depth += 1
        shared[live] = depth
    return shared


def shard_nodes(names: np.ndarray, begin: np.ndarray, length: np.ndarray, low: np.ndarray, n: np.ndarray, size: np.ndarray) -> dict:
    """Nodes of sorted sequences, in order of first member and depth.

    names[begin[i]:begin[i] + length[i]] is sequence i, ``size`` the bytes of every name.  Sums over a subtree leave out nodes that
    are ``side`` > 0: those of the first (1) or last (2) sequence, which other shards may have too.
    """
    m = len(begin)
    shared = common_prefixes(names, begin, length)
    table = RangeMinimum(shared)
    at = np.concatenate([np.arange(1, m), np.arange(m)])
    depth = np.concatenate([shared[1:], length])
    first, last = table.first_with(at, depth), table.last_with(at, depth)
    _, one = np.unique(first * m + last, return_index=True)
    first, last, depth = first[one], last[one], depth[one]
    # An interval's prefixes reach from one turn more than its neighbours share with it down to what all members share.
    top = np.maximum(shared[first], np.append(shared, -1)[last + 1]) + 1
    order = np.lexsort((top, first))
    first, last, depth, top = first[order], last[order], depth[order], top[order]
    many = depth - top + 1
    offset = np.cumsum(many) - many
    edge = np.repeat(np.arange(len(first)), many)
    level = np.arange(len(edge)) - offset[edge] + top[edge]
    # The parent of an interval's first node: the last node of the interval that is one turn shorter there.
    inner = np.flatnonzero(top > 0)
    wide = table.first_with(first[inner], top[inner] - 1) * m + table.last_with(first[inner], top[inner] - 1)
    keys = first * m + last
    by_key = np.argsort(keys)
    above = by_key[np.searchsorted(keys[by_key], wide)]
    parent = np.arange(len(edge)) - 1
    parent[offset[top == 0]] = -1
    parent[offset[inner]] = offset[above] + many[above] - 1
    first, last = first[edge], last[edge]
    total = np.append(0, np.cumsum(n))
    members = total[last + 1] - total[first]
    side = (first == 0) + 2 * (last == m - 1)
    closed = side == 0
    up = parent[closed & (parent >= 0)]
    children = np.bincount(up, minlength=len(edge))
    bytes_ = np.where(level > 0, size[np.minimum(begin[first] + level - 1, max(len(size) - 1, 0))] if len(size) else 0, 0)
    after = np.searchsorted(first, last, "right")

    def subtree(weight: np.ndarray) -> np.ndarray:
        run = np.append(0, np.cumsum(np.where(closed, weight, 0)))
        return run[after] - run[np.arange(len(edge))]
    return {"first": first, "depth": level, "parent": parent, "side": side, "n": members, "children": children, "size": bytes_,
            "low": RangeMinimum(low).of(first, last), "leaves": subtree(children == 0), "saved": subtree((members - 1) * bytes_),
            "ending": np.where(length[first] == level, first, -1)}


def _spine(path: bytes) -> list[bytes]:
    """Names of all prefixes of one path, the empty one first."""
    chain, out = hashlib.blake2b(digest_size=NAME), []
    out.append(chain.digest())
    for at in range(0, len(path), NAME):
        chain.update(path[at:at + NAME])
        out.append(chain.digest())
    return out


_NODES = pa.schema([("shard", pa.int64()), ("side", pa.int32()), ("depth", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()),
                    ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("size", pa.int64()),
                    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])


def _shard_table(rows: list[tuple], shard: int) -> pa.RecordBatch:
    paths = [r[0] for r in rows]
    length = np.array([len(p) // NAME for p in paths], np.int64)
    names = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, NAME // 8)
    size = np.array([x for r in rows for x in r[1]], np.int64)
    low, n = (np.array([r[k] for r in rows], np.int64) for k in (2, 3))
    node = shard_nodes(names, np.cumsum(length) - length, length, low, n, size)
    side, depth, parent = node["side"], node["depth"], node["parent"]
    left, right = _spine(paths[0]), _spine(paths[-1])
    keys = [None if not s else left[d] if s & 1 else right[d] for s, d in zip(side.tolist(), depth.tolist())]
    parents = [None if p < 0 else keys[p] for p in parent.tolist()]
    known = (parent >= 0) & (side[parent] == 0)
    ends = [rows[k][4] if k >= 0 else None for k in node["ending"].tolist()]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(side), shard)), pa.array(side.astype(np.int32)), pa.array(depth), pa.array(keys, pa.binary()), pa.array(parents, pa.binary()),
        pa.array(node["low"]), pa.array(node["low"][parent], mask=~known), pa.array(node["n"]), pa.array(node["size"]), pa.array(node["children"]),
        pa.array(node["leaves"]), pa.array(node["saved"]), pa.array(ends, pa.string())], schema=_NODES)


def _shards(most_rows: int, most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, room = TaskContext.get().partitionId() << 32, [], most_bytes
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("path", "sizes", "low", "n", "ends"))):
                if len(rows) == most_rows or rows and room < len(row[0]):
                    yield _shard_table(rows, shard)
                    shard, rows, room = shard + 1, [], most_bytes
                rows.append(row)
                room -= len(row[0])
        if rows:
            yield _shard_table(rows, shard)
    return run


# ---- shards put together ----

def prefix_trie(lists: DataFrame, rows: int = ROWS, path_bytes: int = PATH_BYTES) -> DataFrame:
    """One row per node of the trie of conversations (conv_id, names, sizes), each conv_id once.

    ``conv_id`` (its smallest member) and ``depth`` name a node; ``parent_conv_id`` with depth - 1 its parent, null at the root.
    """
    paths = stored(lists.select("conv_id", F.unhex(F.array_join("names", "")).alias("path"), "sizes"), "trie-paths")
    classes = stored(distinct_paths(paths), "trie-classes")
    local = stored(classes.repartitionByRange("path").sortWithinPartitions("path").mapInArrow(
        _shards(rows, path_bytes), "shard bigint, side int, depth bigint, key binary, parent_key binary, conv_id bigint, parent_conv_id bigint, "
        "n_convs bigint, size bigint, n_children bigint, n_leaves bigint, saved bigint, ends string"), "trie-nodes")
    spine = local.filter("side > 0")
    merged = spine.groupBy("key", "parent_key", "depth", "size").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner"),
        F.max("ends").alias("ends"), F.min("shard").alias("owner"))
    kids = merged.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("open"))
    merged = stored(merged.join(kids, "key", "left").withColumn("n_children", F.col("inner") + F.coalesce("open", F.lit(0))), "trie-spine")
    # A node of several shards counts in the first of them.  Below a node of both paths lies all, else the rest of its own path.
    facts = merged.select("key", F.col("conv_id").alias("own_conv"), "owner", (F.col("n_children") == 0).cast("bigint").alias("leaf"),
                          ((F.col("n_convs") - 1) * F.col("size")).alias("weight"))
    placed = spine.select("shard", "side", "depth", "key", "n_leaves", "saved").join(facts, "key")
    down = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends_only = Window.partitionBy("shard")

    def below(name: str) -> Column:
        own = F.when(F.col("owner") == F.col("shard"), F.col(name)).otherwise(F.lit(0))
        parted = F.sum(F.when(F.col("side") < 3, own).otherwise(F.lit(0))).over(ends_only)
        return F.sum(own).over(down) + F.when(F.col("side") == 3, parted).otherwise(F.lit(0))
    placed = stored(placed.select("shard", "key", "own_conv", (F.col("n_leaves") + below("leaf")).alias("n_leaves"),
                                  (F.col("saved") + below("weight")).alias("saved")), "trie-placed")
    sums = placed.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    parent = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
               F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256")]
    opened = merged.join(sums, "key").join(parent, "parent_key", "left").select(*columns)
    # Parents on a shard's paths are looked up in that shard alone, so a parent of very many is spread as they are.
    near = placed.select("shard", F.col("key").alias("parent_key"), F.col("own_conv").alias("found"))
    closed = local.filter("side = 0")
    hanging = closed.filter("parent_key is not null").drop("parent_conv_id").join(near, ["shard", "parent_key"]).withColumnRenamed(
        "found", "parent_conv_id")
    return opened.unionByName(closed.filter("parent_key is null").select(*columns)).unionByName(hanging.select(*columns))


def branched_trie(turns: DataFrame, rows: int = ROWS, path_bytes: int = PATH_BYTES) -> DataFrame:
    """The trie after every conversation c took its first crc32(c) % 9 turns from conversation c - c % 5."""
    lists = stored(turn_lists(turns), "trie-turns")
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie(branched(lists, 5, heads, 8), rows, path_bytes)
