"""Keyed access to token shards that reads a few bytes a key, however large the shard.

A key is found in the sorted ranges of the shards, hashed to its number by one word of each level of
the minimal perfect hash until one holds it, checked against the stored fingerprint and key, and its ids are read
from the offsets beside them.  Nothing but the head of an index (64 bytes and its level sizes) is kept,
and at most ``opened`` shards are open at a time.

A key that is not there has no documents; documents without a key are reached by no key.  Documents
that share a key are returned in order.  Shards written from an empty table hold no key.
"""

from __future__ import annotations

import bisect
import posixpath
from collections import OrderedDict

import numpy as np
import pyarrow.dataset as ds
import pyarrow.fs as pafs

from martkit.llm.token_shards import MAGIC, _fingerprint, _mix

HEAD = 64
#: Shards kept open; the one used longest ago is closed for another.
OPENED = 64


class _Field:
    """An array in a file, of which single values are read."""

    def __init__(self, file, kind: str, start: int, size: int):
        self._file, self._kind, self._start = file, np.dtype(kind), start
        self.end = start + size * self._kind.itemsize

    def read(self, at: int, count: int = 1) -> np.ndarray:
        raw = self._file.read_at(count * self._kind.itemsize, self._start + at * self._kind.itemsize)
        return np.frombuffer(raw, self._kind)

    def __getitem__(self, at: int) -> int:
        return int(self.read(at)[0])


class KeyedShard:
    """One shard, opened; holds the sizes of the hash's levels and two file handles."""

    def __init__(self, fs: pafs.FileSystem, folder: str, ids: str, index: str):
        self._index = fs.open_input_file(posixpath.join(folder, index))
        head = [int(x) for x in np.frombuffer(self._index.read_at(HEAD, 0), "<u8")]
        if head[0] != MAGIC:
            raise ValueError("not an index of a token shard")
        n, _, width, own, levels, words = head[1:7]
        fields, at = [], HEAD
        for kind, size in (("<i8", n), ("<u8", n + 1), ("<u8", levels), ("<u8", words), ("<u8", words),
                           ("<u8", own), ("<u8", own), ("<u4", own)):
            fields.append(_Field(self._index, kind, at, size))
            at = fields[-1].end
        self._keys, self._offsets, sizes, self._bits, self._ranks, self._firsts, self._counts, self._prints = fields
        self._sizes = [int(x) for x in sizes.read(0, levels)]
        self._ids, self._width = fs.open_input_file(posixpath.join(folder, ids)), width

    def _slot(self, key: np.ndarray) -> int | None:
        start = 0
        for level, size in enumerate(self._sizes):
            bit = int(_mix(key, level)[0]) % size
            word = self._bits[start + bit // 64]
            if word >> bit % 64 & 1:
                return self._ranks[start + bit // 64] + (word & ((1 << bit % 64) - 1)).bit_count()
            start += size // 64
        return None

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of every document with this key, in order."""
        asked = np.array([key], np.int64).view(np.uint64)
        slot = self._slot(asked)
        if slot is None or self._prints[slot] != int(_fingerprint(asked)[0]):
            return []
        first = self._firsts[slot]
        # A fingerprint may agree by chance; the key beside the offset settles it.
        if self._keys[first] != key:
            return []
        cuts = [int(x) for x in self._offsets.read(first, self._counts[slot] + 1)]
        kind = "<u2" if self._width == 2 else "<u4"
        return [np.frombuffer(self._ids.read_at((b - a) * self._width, a * self._width), kind) for a, b in zip(cuts, cuts[1:])]

    def close(self) -> None:
        self._index.close()
        self._ids.close()


class KeyedShards:
    """All shards below a root, for lookups from any process that reaches the folder."""

    def __init__(self, root: str, opened: int = OPENED):
        self._fs, self._folder = pafs.FileSystem.from_uri(f"{root}/data")
        fs, folder = pafs.FileSystem.from_uri(f"{root}/manifest")
        rows = ds.dataset(folder, filesystem=fs, format="parquet").to_table().to_pylist()
        self._rows = sorted((r for r in rows if r["first_key"] is not None), key=lambda r: r["shard"])
        self._lasts = [r["last_key"] for r in self._rows]
        self._limit, self._open = opened, OrderedDict()

    def _shard(self, row: dict) -> KeyedShard:
        shard = self._open.pop(row["shard"], None) or KeyedShard(self._fs, self._folder, row["ids"], row["index"])
        self._open[row["shard"]] = shard
        if len(self._open) > self._limit:
            self._open.popitem(last=False)[1].close()
        return shard

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of every document with this key, in order; [] if there is none."""
        out = []
        for row in self._rows[bisect.bisect_left(self._lasts, key):]:
            if row["first_key"] > key:
                break
            out += self._shard(row).get(key)
        return out

    def close(self) -> None:
        while self._open:
            self._open.popitem()[1].close()
