"""Token ids as binary shards with a minimal perfect hash index.

Documents are dealt by ranges of their key, so shards follow each other in key order and a
key with very many rows is spread over several shards.  Each task encodes its range and
streams two files to the shared folder:

``*.ids``  the ids of its documents one after another, little-endian, 16 bit where the
           vocabulary allows and else 32 bit; every document ends with ``end_id``;
``*.mph``  a header of eight 64-bit numbers, the keys and start offsets of the documents, a
           minimal perfect hash of the distinct keys (levels of bit arrays with ranks), and per
           hash value a fingerprint of its key, the key's first document and number of documents.

File names carry the task attempt; only files named in the manifest, which Spark commits
when all shards are there, belong to the set.  A lost executor thus costs its own shards
and leaves at most files nobody refers to.

A key lookup finds the shard by the manifest's key ranges, evaluates the hash (a constant
number of probes), checks the fingerprint and reads one run of bytes.

Null texts are empty: such documents hold the end id alone.  Rows with a null key come first
and are kept, but only keys that are not null can be looked up.  Rows with equal keys follow
each other in order of their text and all belong to the key.  An empty table gives an empty
manifest.  Keys are whole numbers; other columns are not read.
"""

from __future__ import annotations

import bisect
import json
import os
import posixpath
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from martkit.llm.base import TEXT_ROWS, Shared, batches_of, released, texts
from martkit.session import scratch_path

MAGIC = 0x3153444944524F57
#: Bytes of words and their ids that a task remembers at most, with what Python adds to each; then it starts anew.
MEMORY_BYTES, WORD_BYTES = 144 << 20, 200
#: Texts whose words are looked up together.
TEXTS = 64
#: Bytes of text that one shard aims at: large enough that most words of a shard are known ones.
SHARD_BYTES = 64 << 20
#: Bytes of ids read from a shard at once.
BLOCK = 8 << 20


# --- minimal perfect hash -------------------------------------------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (multiply, shift, xor), one to one for each seed."""
    with np.errstate(over="ignore"):
        x = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 0x51ED) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    """Levels of bits: a key rests on the first level where no other key falls on its bit.

    Its number is the count of bits set before that one, so n keys get 0 .. n-1.
    """

    sizes: np.ndarray   # bits of each level
    words: np.ndarray   # all levels' bits, 64 a word
    ranks: np.ndarray   # bits set before each word

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 2.0) -> PerfectHash:
        """``keys``: distinct 64-bit numbers."""
        sizes, levels, rest = [], [], keys
        while len(rest):
            size = max(64, -(-int(room * len(rest)) // 64) * 64)
            at = (_mix(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, dtype=np.uint8)
            bits[at[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = rest[~alone]
        words = np.concatenate(levels) if levels else np.zeros(0, "<u8")
        counts = np.bitwise_count(words).astype(np.uint64)
        return cls(np.array(sizes, "<u8"), words, (np.cumsum(counts) - counts).astype("<u8"))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some that were never added (a fingerprint finds the others)."""
        out = np.full(len(keys), -1, np.int64)
        rest, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            bit = _mix(keys[rest], level) % size
            word = (bit >> np.uint64(6)).astype(np.int64) + start
            mask = np.uint64(1) << (bit & np.uint64(63))
            hit = (self.words[word] & mask) != 0
            below = np.bitwise_count(self.words[word[hit]] & (mask[hit] - np.uint64(1)))
            out[rest[hit]] = (self.ranks[word[hit]] + below).astype(np.int64)
            rest, start = rest[~hit], start + int(size) // 64
        return out


@dataclass
class ShardIndex:
    """Documents of one shard in key order, and the hash from a key to its documents."""

    nulls: int              # documents without a key; they come first
    width: int              # bytes of an id
    keys: np.ndarray        # of all documents, 0 for those without
    offsets: np.ndarray     # first id of each document, and the end
    hash: PerfectHash
    prints: np.ndarray      # by hash value
    firsts: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, nulls: int, lengths: np.ndarray, width: int) -> ShardIndex:
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
        own, first, count = np.unique(keys[nulls:].astype("<i8"), return_index=True, return_counts=True)
        own = own.view(np.uint64)
        mph = PerfectHash.build(own)
        order = mph.find(own)
        prints, firsts, counts = (np.zeros(len(own), t) for t in ("<u4", "<u8", "<u8"))
        prints[order], firsts[order], counts[order] = _fingerprint(own), first + nulls, count
        return cls(nulls, width, keys.astype("<i8"), offsets, mph, prints, firsts, counts)

    def to_bytes(self) -> bytes:
        head = np.array([MAGIC, len(self.keys), self.nulls, self.width, len(self.prints), len(self.hash.sizes),
                         len(self.hash.words), 0], "<u8")
        return b"".join(a.tobytes() for a in (
            head, self.keys, self.offsets, self.hash.sizes, self.hash.words, self.hash.ranks,
            self.firsts, self.counts, self.prints))

    @classmethod
    def from_bytes(cls, raw: bytes) -> ShardIndex:
        head = [int(x) for x in np.frombuffer(raw, "<u8", 8)]
        if head[0] != MAGIC:
            raise ValueError("not an index of a token shard")
        n, nulls, width, own, levels, words = head[1:7]
        at, out = 64, []
        for kind, size in (("<i8", n), ("<u8", n + 1), ("<u8", levels), ("<u8", words), ("<u8", words),
                           ("<u8", own), ("<u8", own), ("<u4", own)):
            out.append(np.frombuffer(raw, kind, size, at))
            at += out[-1].nbytes
        keys, offsets, sizes, bits, ranks, firsts, counts, prints = out
        return cls(nulls, width, keys, offsets, PerfectHash(sizes, bits, ranks), prints, firsts, counts)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of each key; the number is 0 for a key that is not here."""
        keys = np.asarray(keys, np.int64).view(np.uint64)
        slot = self.hash.find(keys)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        known = (slot >= 0) & (self.prints[slot] == _fingerprint(keys))
        first = np.where(known, self.firsts[slot], 0).astype(np.int64)
        # A fingerprint may agree by chance; the key beside the offset settles it.
        known &= self.keys[first].view(np.uint64) == keys
        return first, np.where(known, self.counts[slot], 0).astype(np.int64)


# A full stop or comma after anything but a plain letter, a digit or a space may be one piece with it.
_MARKS = re.compile(r"[^0-9A-Za-zÀ-ÖØ-öø-ÿ \n][.,]")
# Small letters up to U+00FF, between marks or alone; an apostrophe before them may be one piece with them,
# and marks with <| may name a special token.
_MARKED = re.compile(rb"(?!.*<\|)([!-&(-/:-@[-`{-~]*)((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-/:-@[-`{-~]*)")


# --- encoding -------------------------------------------------------------------------

def _for_letters(definition: str) -> str | None:
    """The definition for words of small letters up to U+00FF alone, without the steps that leave such words as they are
    (some 40 % of the time of a word); None where a tokenizer has other steps or tokens than those known here."""
    whole = json.loads(definition)
    steps = (whole.get("normalizer") or {}).get("normalizers") or []
    pieces = (whole.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split, mapped = pieces if len(pieces) == 2 else ({}, {})
    known = (all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} for x in steps)
             and split.get("pattern") == {"Regex": _LETTERS_WHOLE} and (split["behavior"], split["invert"]) == ("Removed", True) and mapped.get("type") == "ByteLevel"
             and not mapped["add_prefix_space"] and not mapped["use_regex"]
             and all(re.fullmatch(r"<\|\w+\|>", x["content"]) for x in whole.get("added_tokens") or [])
             and whole["model"].get("end_of_word_suffix"))
    apart = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, mapped]}
    return json.dumps({**whole, "normalizer": None, "pre_tokenizer": apart}) if known else None


# A pattern that takes a word of letters as one piece.
_LETTERS_WHOLE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

class Encoder:
    """Texts to bytes of ids.

    ``by_word`` is for tokenizers that never look across white space, drop it, drop letter case and
    take words and marks apart: then every distinct word is encoded once and remembered.
    """

    def __init__(self, tokenizer: str, end_id: int, by_word: bool, memory: int = MEMORY_BYTES):
        # Spark runs a task on every core already; threads of the library's own cost time and hold memory besides.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(tokenizer)
        letters = _for_letters(tokenizer) if by_word else None
        self._letters = Tokenizer.from_str(letters) if letters else None
        if letters:
            suffix = json.loads(letters)["model"]["end_of_word_suffix"]
            self._ends = np.zeros(self._letters.get_vocab_size(), bool)
            self._ends[[i for piece, i in self._letters.get_vocab().items() if piece.endswith(suffix)]] = True
        self.width = 2 if max(self._tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self._code = "H" if self.width == 2 else "I"
        self._end = array(self._code, [end_id]).tobytes()
        self._by_word, self._known, self._memory, self._room = by_word, {}, memory, memory

    def _ids(self, values: list[str]) -> list[bytes]:
        return [array(self._code, e.ids).tobytes() for e in self._tokenizer.encode_batch_fast(values, add_special_tokens=False)]

    def _letter_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters, encoded as one text and cut behind the pieces that end a word."""
        whole = self._letters.encode_batch_fast([b" ".join(words).decode("utf-8")], add_special_tokens=False)[0]
        ids = np.array(whole.ids, f"u{self.width}")
        stops = (self.width * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
        if len(stops) != len(words):  # some letter is not in the vocabulary
            return self._ids([w.decode("utf-8") for w in words])
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def _words(self, value: str) -> list[bytes]:
        """Pieces that the tokenizer, which looks at white space anyway, encodes one by one."""
        # A full stop or comma after a letter or digit is a piece of its own; after another mark it is not.
        apart = not _MARKS.search(value)
        raw = value.encode("utf-8")
        # Letter case is dropped by the tokenizer too, but for the names of its special tokens.
        raw = raw if b"<|" in raw else raw.lower()
        raw = raw.replace(b"\n", b" ")
        if apart:
            raw = raw.replace(b", ", b" , ").replace(b". ", b" . ")
        return raw.split(b" ")

    def _learn(self, new: set[bytes]) -> None:
        """Remember the ids of these words.  Letters and the marks around them are pieces of their own, known ones as a rule."""
        parts = {w: m.groups() for w in new if (m := _MARKED.fullmatch(w))} if self._letters else {}
        letters = [*{p[1] for p in parts.values()}.difference(self._known)]
        rest = [*{x for p in parts.values() for x in (p[0], p[2]) if x}.union(new.difference(parts)).difference(self._known)]
        self._known.update(zip(letters, self._letter_ids(letters)))
        self._known.update(zip(rest, self._ids([w.decode("utf-8") for w in rest])))
        joined = {w: b"".join([self._known[x] for x in p if x]) for w, p in parts.items() if len(p[1]) < len(w)}
        self._known.update(joined)
        self._room -= sum(sum(map(len, x)) * 2 + WORD_BYTES * len(x) for x in (letters, rest, joined))

    def __call__(self, values: list[str]) -> Iterator[bytes]:
        if not self._by_word:
            for v in values:
                yield self._ids([v])[0] + self._end
            return
        for at in range(0, len(values), TEXTS):
            texts_words = [self._words(v) for v in values[at:at + TEXTS]]
            new = set().union(*texts_words).difference(self._known)
            if sum(map(len, new)) * 2 + WORD_BYTES * len(new) > self._room:
                self._known.clear()
                self._room = self._memory
                new = set().union(*texts_words)
            self._learn(new)
            for words in texts_words:
                yield b"".join([*map(self._known.__getitem__, words), self._end])


# --- writing --------------------------------------------------------------------------

MANIFEST = ("shard int, ids string, index string, n_docs bigint, n_tokens bigint, n_bytes bigint, "
            "first_key bigint, last_key bigint")


def _write(shared: Shared, root: str, end_id: int, by_word: bool, memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = out = None
        keys, lengths, nulls = [], [], 0
        shard, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        fs, folder = pafs.FileSystem.from_uri(root)
        names = [f"{shard:06d}-{attempt}.{kind}" for kind in ("ids", "mph")]
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                encoder = Encoder(shared.value, end_id, by_word, memory)
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(posixpath.join(folder, names[0]), compression=None)
            column = batch.column("doc_id")
            nulls += column.null_count
            keys.append(column.fill_null(0).to_numpy(zero_copy_only=False))
            for at in range(0, batch.num_rows, TEXTS):
                for ids in encoder(batch.column("text").slice(at, TEXTS).to_pylist()):
                    lengths.append(len(ids) // encoder.width)
                    out.write(ids)
        if out is None:
            return
        out.close()
        index = ShardIndex.build(np.concatenate(keys), nulls, np.array(lengths, np.int64), encoder.width)
        with fs.open_output_stream(posixpath.join(folder, names[1]), compression=None) as f:
            f.write(index.to_bytes())
        own = index.keys[nulls:]
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "ids": [names[0]], "index": [names[1]],
            "n_docs": [len(index.keys)], "n_tokens": [int(index.offsets[-1])],
            "n_bytes": [int(index.offsets[-1]) * encoder.width],
            "first_key": pa.array([int(own[0]) if len(own) else None], pa.int64()),
            "last_key": pa.array([int(own[-1]) if len(own) else None], pa.int64())})
    return run


def write_shards(docs: DataFrame, root: str, tokenizer: str, end_id: int, by_word: bool = False,
                 key: str = "doc_id", text: str = "text", shards: int | None = None,
                 memory: int = MEMORY_BYTES) -> DataFrame:
    """Write ``docs`` in key order below ``root`` (shared by all executors) and return the manifest.

    ``tokenizer``: a tokenizer definition (the text of its JSON file, a few megabytes, sent to the
    executors once).  Without ``shards`` their number follows from the size of the texts.
    ``memory``: bytes of words and ids that a task remembers; it changes the time taken, not the ids.
    """
    spark = docs.sparkSession
    rows = texts(docs, key, text=text).select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), "text")
    if shards is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(1, -(-size // SHARD_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    manifest = dealt.mapInArrow(released(_write(Shared(spark, tokenizer), f"{root}/data", end_id, by_word, memory)), MANIFEST)
    with batches_of(spark, TEXT_ROWS):
        manifest.write.parquet(f"{root}/manifest")
    return read_manifest(spark, root)


# --- reading --------------------------------------------------------------------------

def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per shard, with ``base``: the ids of all shards before it."""
    # The window holds one small row per shard, not documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest").withColumn(
        "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint"))


class Shard:
    """One shard opened for reading."""

    def __init__(self, root: str, ids: str, index: str):
        fs, folder = pafs.FileSystem.from_uri(f"{root}/data")
        with fs.open_input_file(posixpath.join(folder, index)) as f:
            self.index = ShardIndex.from_bytes(f.read())
        self._file = fs.open_input_file(posixpath.join(folder, ids))
        self._kind = "<u2" if self.index.width == 2 else "<u4"

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of the documents first .. last - 1 of the shard, one after another."""
        a, b = int(self.index.offsets[first]), int(self.index.offsets[last])
        self._file.seek(a * self.index.width)
        return np.frombuffer(self._file.read((b - a) * self.index.width), self._kind)

    def get(self, key: int) -> list[np.ndarray]:
        first, count = (int(x[0]) for x in self.index.find(np.array([key], np.int64)))
        return [self.ids(i, i + 1) for i in range(first, first + count)]

    def close(self) -> None:
        self._file.close()


class ShardSet:
    """Keyed access from any process that reaches the folder; opens the shards it needs."""

    def __init__(self, root: str):
        self._root = root
        fs, folder = pafs.FileSystem.from_uri(f"{root}/manifest")
        rows = ds.dataset(folder, filesystem=fs, format="parquet").to_table().to_pylist()
        self._rows = sorted((r for r in rows if r["first_key"] is not None), key=lambda r: r["shard"])
        self._lasts = [r["last_key"] for r in self._rows]

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of every document with this key, in order; [] if there is none."""
        out = []
        for row in self._rows[bisect.bisect_left(self._lasts, key):]:
            if row["first_key"] > key:
                break
            shard = Shard(self._root, row["ids"], row["index"])
            out += shard.get(key)
            shard.close()
        return out


def _digest(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(root, row["ids"], row["index"])
                index = shard.index
                n, keys, offsets = len(index.keys), index.keys, index.offsets.astype(np.int64)
                # Every document is reached through the hash of its key; those without one lead the shard.
                own = np.unique(keys[index.nulls:])
                first, count = index.find(own)
                if int(count.sum()) != n - index.nulls or (count == 0).any():
                    raise ValueError(f"index of shard {row['shard']} does not cover its keys")
                reached = np.concatenate([np.arange(index.nulls), np.repeat(first - np.concatenate(
                    [[0], np.cumsum(count)[:-1]]), count) + np.arange(n - index.nulls)]).astype(np.int64)
                at = 0
                while at < n:
                    limit = offsets[reached[at]] + BLOCK // index.width
                    to = max(at + 1, int(np.searchsorted(offsets[reached], limit)))
                    docs = reached[at:to]
                    ids = shard.ids(int(docs[0]), int(docs[-1]) + 1).astype("<u4")
                    cuts = offsets[docs] - offsets[docs[0]]
                    ends = offsets[docs + 1] - offsets[docs[0]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[docs], mask=docs < index.nulls), pa.array(offsets[docs] + row["base"]),
                        pa.array(ends - cuts), pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, ends)], pa.int64()),
                        pa.array(np.full(len(docs), row["shard"], np.int32))],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])
                    at = to
                shard.close()
    return run


def read_digests(spark: SparkSession, root: str) -> DataFrame:
    """Per document, read back through the index: where its ids start, how many they are, their checksum."""
    manifest = read_manifest(spark, root).select("shard", "ids", "index", "base")
    shards = manifest.count()
    return manifest.repartition(max(1, shards)).mapInArrow(
        released(_digest(root)), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard int")


def write_and_digest(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2,
                     root: str | None = None, memory: int = MEMORY_BYTES) -> DataFrame:
    """Encode ``docs`` with a public tokenizer, write the shards and return what they hold."""
    import public_tokenizers

    spark = docs.sparkSession
    root = root or scratch_path(spark, "tokens")
    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as f:
        definition = f.read()
    # This tokenizer marks word ends and drops white space, so words can be encoded one by one.
    write_shards(docs, root, definition, end_id, by_word=tokenizer.startswith("word_"), memory=memory)
    return read_digests(spark, root)
