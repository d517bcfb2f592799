"""Removal of long repeated passages, byte for byte, with induced suffix sorting.

A byte goes if it is covered by a string of ``length`` bytes that also starts earlier (in a
document of smaller id, or further up in the same one).

Every window of ``length`` bytes holds an anchor: the last of its smallest grams (by hash) of half
that size.  Equal windows have equal anchors at the same place, so only the surroundings of grams
that occur more than once can hold repeats.  Of a text that stands in many documents the first one alone is
looked through; the others are repeats from end to end.  Equal surroundings are counted, not compared: all but
the first are repeats as a whole.  The different surroundings of a gram, each as its first document
has it and no copy of that, are dealt by it to shards;
each shard is sorted by ``induced_sort`` with its queues on disk, and runs of suffixes with a
common prefix of ``length`` are the repeats.  A gram with very many different surroundings does
not go to one shard: its windows are compared by a partial aggregate over their contents' hash.

Workers get TEXT_ROWS texts at once, as the places of some ten thousand fill hundreds of megabytes.
Texts are read in several passes instead of being stored: what passes on are grams, places and
surroundings of repeated grams, told by a filter that grows with what it holds (a wrong hit only costs work).

Null texts are empty.  Null ids come before all others.  Rows that agree in id and text are one
document and get equal results; with equal ids and different texts the text's hash decides the order.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, functions as F

from martkit.llm.base import TEXT_ROWS, Shared, batches_of, give_back, released, stored, texts
from martkit.llm.induced_sort import sorted_suffixes
from martkit.session import scratch_path

LENGTH = 100
#: Bits of a filter: 8 MB, or as many more as BITS_A_KEY for each of a known number of keys ask for, up to 64 MB.
FILTER_BITS, BITS_A_KEY, MOST_BITS = 1 << 26, 8, 1 << 29
#: Different surroundings of one gram that go to one shard.
SHARD_GROUP = 20_000
#: Bytes of surroundings that one shard aims at, and of its queues before they go to disk.
SHARD_BYTES = 3 << 20
QUEUE_BYTES = 64 << 20

#: Bytes of text that are looked through for anchors at once, and the bits of a hash that hold a place among them.
ANCHOR_BLOCK, _PLACE = 1 << 15, np.uint64((1 << 20) - 1)

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


class Anchors:
    """Finds the anchors of texts, block by block, so that all arrays but the texts' own are small."""

    def __init__(self, length: int):
        self.length, self.gram = length, length // 2
        self._up = self._down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            up, down = np.full(2 * n, _BASE), np.full(2 * n, _INVERSE)
            up[0] = down[0] = 1
            with np.errstate(over="ignore"):
                self._up, self._down = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def hashes(self, raw: np.ndarray, size: int) -> np.ndarray:
        """A hash of every string of ``size`` bytes."""
        self._grow(len(raw) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(raw * self._up[:len(raw)], dtype=np.uint64)])
            return _mix((sums[size:] - sums[:-size]) * self._down[:len(raw) - size + 1])

    def find(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, places) of the anchors of all windows of texts that lie one after another, text i from
        bounds[i] to bounds[i + 1]; a place that is anchor of several windows comes once."""
        long = np.flatnonzero(np.diff(bounds) >= self.length)
        if not len(long):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        # Only windows inside a text count.
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[bounds[long]] = 1
        inside[bounds[long + 1] - self.length + 1] = -1
        inside = np.cumsum(inside, dtype=np.int8).view(bool)
        found = []
        for at in range(0, len(raw) - self.length + 1, ANCHOR_BLOCK):
            windows = np.flatnonzero(inside[at:at + min(ANCHOR_BLOCK, len(raw) - self.length + 1 - at)])
            if not len(windows):
                continue
            grams = self.hashes(raw[at:at + ANCHOR_BLOCK + self.length - 1], self.gram)
            # The smallest gram by the upper bits of its hash, of equal ones the last: the place is below them, backwards.
            least = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
            width, done = self.length - self.gram + 1, 1
            while done < width:
                step = min(done, width - done)
                least = np.minimum(least[:-step], least[step:])
                done += step
            places = (_PLACE - (least[windows] & _PLACE)).astype(np.int64)
            places = places[np.concatenate([[True], places[1:] != places[:-1]])]
            found.append((grams[places], places + at))
        grams, places = (np.concatenate(x) for x in zip(*found))
        new = np.concatenate([[True], places[1:] != places[:-1]])
        return grams[new], places[new]


def _text_hash(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw, 1) - (1 << 63)


def _raws(batch: pa.RecordBatch) -> list[bytes]:
    """The texts' UTF-8 bytes, as Arrow holds them."""
    return batch.column("text").cast(pa.binary()).to_pylist()


class _Places:
    """The anchors of a batch of texts; ``keep`` chooses some of them."""

    def __init__(self, anchors: Anchors, batch: pa.RecordBatch):
        raws = _raws(batch)
        self.joined = b"".join(raws)
        self._bounds = np.cumsum([0, *map(len, raws)])
        self._docs, self._ths = batch.column("doc_id"), np.array([_text_hash(x) for x in raws], np.int64)
        self.grams, self.at = anchors.find(np.frombuffer(self.joined, np.uint8), self._bounds)
        self._length = anchors.length
        self._own()

    def _own(self) -> None:
        self._owner = np.searchsorted(self._bounds, self.at, "right") - 1
        self.th = self._ths[self._owner]
        self.place = self.at - self._bounds[self._owner]

    def keep(self, chosen: np.ndarray) -> None:
        self.grams, self.at = self.grams[chosen], self.at[chosen]
        self._own()

    def doc(self) -> pa.Array:
        return self._docs.take(pa.array(self._owner))

    def surroundings(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) in ``joined``: all windows that can hold an anchor lie between them."""
        reach = self._length - self._length // 2
        return (np.maximum(self._bounds[self._owner], self.at - reach),
                np.minimum(self._bounds[self._owner + 1], self.at + self._length))


_COUNTED = np.uint64((1 << 48) - 1)


def _text_keys(doc: pa.Array, th: np.ndarray) -> np.ndarray:
    """Filter keys of documents; a null id counts as 0, which only costs a wrong hit."""
    return _mix(_mix(doc.fill_null(0).to_numpy().view(np.uint64)) ^ th.view(np.uint64))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document's id, hash and bytes of its text."""
    for batch in batches:
        raws = _raws(batch)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([_text_hash(x) for x in raws], pa.int64()),
            pa.array([len(x) for x in raws], pa.int64())], names=["doc_id", "th", "size"])


def _keys_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _text_keys(batch.column("doc_id"), batch.column("th").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])


def _once(batches: Iterator[pa.RecordBatch], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Without the documents that the filter of (document, text) does not hold."""
    for batch in batches:
        hashes = np.array([_text_hash(x) for x in _raws(batch)], np.int64)
        yield batch.filter(pa.array(in_filter(words, _text_keys(batch.column("doc_id"), hashes))))


def _grams(once: Shared, length: int):
    """Each task's distinct gram hashes, cut to 48 bits, and whether the task has seen them twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for batch in _once(batches, once.value):
            raws = _raws(batch)
            found = anchors.find(np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)]))[0]
            own, count = np.unique(found & _COUNTED, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), pa.array(np.minimum(count, 2).astype(np.int8))],
                                             names=["g", "n"])
    return run


def _bits(g: np.ndarray, size: int) -> list[np.ndarray]:
    """Three places of each key among ``size`` bits, a power of two up to MOST_BITS."""
    mask = np.uint64(size - 1)
    x = _mix(g)
    with np.errstate(over="ignore"):
        return [x & mask, (x >> np.uint64(32)) & mask, ((x * _BASE) >> np.uint64(32)) & mask]


def _filter_words(column: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.concatenate(_bits(batch.column(column).to_numpy().view(np.uint64), size))
            yield pa.RecordBatch.from_arrays([
                pa.array((bits >> np.uint64(6)).astype(np.int64)),
                pa.array((np.uint64(1) << (bits & np.uint64(63))).view(np.int64))], names=["word", "bits"])
    return run


def make_filter(keys: DataFrame, column: str, count: int = 0) -> np.ndarray:
    """A filter that holds all keys: FILTER_BITS bits, or BITS_A_KEY for each of ``count`` keys, so that few others pass.

    It has MOST_BITS at most, so it may be collected and sent.
    """
    size = max(FILTER_BITS, min(MOST_BITS, 1 << (BITS_A_KEY * count - 1).bit_length()))
    words = keys.select(column).mapInArrow(_filter_words(column, size), "word bigint, bits bigint").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def in_filter(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    ok = np.ones(len(keys), bool)
    for bit in _bits(keys, 64 * len(words)):
        ok &= (words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return ok


def _place_keys(doc: np.ndarray, th: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Filter keys of places in documents; a null id counts as 0, which only costs a wrong hit."""
    with np.errstate(over="ignore"):
        return _mix(_mix(_mix(doc.view(np.uint64)) ^ th.view(np.uint64)) + place.view(np.uint64) * _BASE)


OCCURRENCE = "seg bigint, g bigint, doc_id bigint, th bigint, place bigint, size int"


def _occurrences(once: Shared, shared: Shared, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, words = Anchors(length), shared.value
        for batch in _once(batches, once.value):
            found = _Places(anchors, batch)
            found.keep(in_filter(words, found.grams & _COUNTED))
            start, end = found.surroundings()
            joined, before = found.joined, found.at - start
            # The anchor's place in its surroundings belongs to what must be equal.
            segs = [xxhash.xxh3_64_intdigest(joined[a:b], p) for a, b, p in zip(start.tolist(), end.tolist(), before.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array(segs, np.uint64).view(np.int64)), pa.array(found.grams.view(np.int64)), found.doc(),
                pa.array(found.th), pa.array(found.place), pa.array((end - start).astype(np.int32))],
                names=[x.split()[0] for x in OCCURRENCE.split(", ")])
    return run


def _contents(once: Shared, shared: Shared, length: int):
    """The bytes of chosen surroundings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, words = Anchors(length), shared.value
        for batch in _once(batches, once.value):
            found = _Places(anchors, batch)
            # Cheap first: only places that the filter of (document, text, place) may hold are cut out.
            keys = _place_keys(found.doc().fill_null(0).to_numpy(), found.th, found.place)
            found.keep(in_filter(words, keys))
            start, end = found.surroundings()
            own = [found.joined[a:b] for a, b in zip(start.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(found.grams.view(np.int64)), found.doc(), pa.array(found.th),
                pa.array(found.place - (found.at - start)), pa.array(found.place), pa.array(own, pa.binary())],
                names=["g", "doc_id", "th", "start", "place", "own"])
    return run


def _keys_of_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column("doc_id").fill_null(0)
        keys = _place_keys(*(c.to_numpy() for c in (doc, batch.column("th"), batch.column("place"))))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])


def _opener(root: str):
    fs, folder = pafs.FileSystem.from_uri(root)
    fs.create_dir(folder, recursive=True)

    def open_file(name: str, mode: str):
        path = posixpath.join(folder, name)
        return fs.open_output_stream(path, compression=None) if mode == "w" else fs.open_input_stream(path, compression=None)
    return open_file, lambda: fs.delete_dir(folder)


COVERED = "doc_id bigint, th bigint, start bigint, size bigint"


def _covered(doc: np.ndarray, nulls: np.ndarray, th: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Windows that are repeats, joined to runs."""
    order = np.lexsort((start, th, doc, ~nulls))
    doc, nulls, th, start = doc[order], nulls[order], th[order], start[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (nulls[1:] != nulls[:-1]) | (th[1:] != th[:-1]) | (start[1:] > start[:-1] + length)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(doc)) - 1
    return pa.RecordBatch.from_arrays([
        pa.array(doc[at], mask=nulls[at]), pa.array(th[at]), pa.array(start[at]), pa.array(start[last] + length - start[at])],
        names=["doc_id", "th", "start", "size"])


def _sort_shard(root: str, length: int, queue_bytes: int):
    """Repeats of a shard: suffixes that share ``length`` bytes with one that starts earlier."""
    def run(table: pa.Table) -> pa.Table:
        out = repeats_of(table)
        # Only here all arrays of the shard are gone.
        give_back()
        return out

    def repeats_of(table: pa.Table) -> pa.Table:
        doc = table.column("doc_id").combine_chunks()
        nulls = doc.is_null().to_numpy(zero_copy_only=False)
        doc = doc.fill_null(0).to_numpy()
        th, start = table.column("th").to_numpy(), table.column("start").to_numpy()
        own = table.column("own").to_pylist()
        sizes = np.array([len(x) for x in own], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        # Bytes and the ends of segments are small numbers, and a shard's memory goes by their width.
        text = np.zeros(int(ends[-1]) + 1, np.int16)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.frombuffer(b"".join(own), np.uint8).astype(np.int16) + 1
        segment = np.repeat(np.arange(len(own), dtype=np.int32), sizes + 1)
        del own, inside
        # Places in corpus order: by document, then by start.
        rank = np.empty(len(doc), np.int64)
        order = np.lexsort((th, doc, ~nulls))
        changed = np.ones(len(doc), bool)
        a, b = order[1:], order[:-1]
        changed[1:] = (doc[a] != doc[b]) | (th[a] != th[b]) | (nulls[a] != nulls[b])
        rank[order] = np.cumsum(changed)
        open_file, close = _opener(f"{root}/{uuid.uuid4().hex}")
        repeats = []
        try:
            for places, common in sorted_suffixes(text, length, queue_bytes, open_file):
                run_of = np.cumsum(common < length)
                whole = ends[segment[places]] - places >= length
                places, run_of = places[whole], run_of[whole]
                if not len(places):
                    continue
                s = segment[places]
                where = start[s] + places - (ends[s] - sizes[s])
                order = np.lexsort((where, rank[s], run_of))
                run_of, where, s = run_of[order], where[order], s[order]
                head = np.ones(len(order), bool)
                head[1:] = run_of[1:] != run_of[:-1]
                # The first of a run is the earliest; the same place seen from another anchor is no repeat.
                lead = np.flatnonzero(head)[np.cumsum(head) - 1]
                again = (rank[s] != rank[s[lead]]) | (where != where[lead])
                repeats.append((s[again], where[again]))
        finally:
            close()
        s = np.concatenate([np.zeros(0, np.int64), *[x[0] for x in repeats]])
        where = np.concatenate([np.zeros(0, np.int64), *[x[1] for x in repeats]])
        return pa.Table.from_batches([_covered(doc[s], nulls[s], th[s], where, length)])
    return run


def _hot_windows(length: int):
    """Hashes of all windows of a gram's surroundings that hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for batch in batches:
            for doc, th, start, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "start", "own"))):
                if len(own) < length:
                    continue
                raw = np.frombuffer(own, np.uint8)
                one, two = anchors.hashes(raw, length), anchors.hashes(255 - raw[::-1], length)[::-1]
                n = len(one)
                yield pa.RecordBatch.from_arrays([
                    pa.array(one.view(np.int64)), pa.array(np.ascontiguousarray(two).view(np.int64)),
                    pa.array([doc] * n, pa.int64()), pa.array(np.full(n, th, np.int64)), pa.array(np.arange(start, start + n))],
                    names=["one", "two", "doc_id", "th", "start"])
    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES,
                    shard_group: int = SHARD_GROUP, queue_bytes: int = QUEUE_BYTES) -> DataFrame:
    """(doc_id, th, start, size) of ranges to remove; ranges may overlap.  ``docs``: doc_id, text (not null)."""
    spark = docs.sparkSession
    hashes = stored(docs.mapInArrow(released(_hashes), "doc_id bigint, th bigint, size bigint"), "suffix-hashes")
    # A minimum of structs, as null ids come first.
    leading = stored(hashes.groupBy("th").agg(F.min(F.struct("doc_id")).alias("lead"), F.count("*").alias("n")).select(
        "lead.doc_id", "th", "n"), "suffix-leading")
    once = Shared(spark, make_filter(leading.mapInArrow(_keys_of_texts, "key bigint"), "key", leading.count()))
    again = leading.filter("n > 1").select(F.col("doc_id").alias("its_doc"), "th")
    whole = hashes.filter(F.col("size") >= length).join(again, "th").filter(
        ~F.col("doc_id").eqNullSafe(F.col("its_doc"))).select("doc_id", "th", F.lit(0).cast("bigint").alias("start"), "size")
    grams = docs.mapInArrow(released(_grams(once, length)), "g bigint, n tinyint")
    repeated = stored(grams.groupBy("g").agg(F.sum("n").alias("n")).filter("n > 1").select("g"), "suffix-grams")
    told = Shared(spark, make_filter(repeated, "g", repeated.count()))
    occurrences = stored(docs.mapInArrow(released(_occurrences(once, told, length)), OCCURRENCE), "suffix-occurrences")
    classes = stored(occurrences.groupBy("seg", "g").agg(
        F.min(F.struct("doc_id", "th", "place")).alias("first"), F.count("*").alias("n")), "suffix-classes")
    # Members of a class beside its first one are repeats as a whole.
    several = classes.filter("n > 1").select("seg", "first")
    copies = occurrences.filter(F.col("size") >= length).drop("g").join(several, "seg").filter(
        ~F.struct("doc_id", "th", "place").eqNullSafe(F.col("first")))
    reach = length - length // 2
    copies = copies.select("doc_id", "th", F.greatest(F.lit(0).cast("bigint"), F.col("place") - reach).alias("start"),
                           F.col("size").cast("bigint").alias("size"))
    # Grams with different surroundings: their firsts are sorted.
    many = stored(classes.groupBy("g").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "suffix-many")
    firsts = stored(classes.join(many, "g").select("g", "kinds", "first.*"), "suffix-firsts")
    chosen = Shared(spark, make_filter(firsts.mapInArrow(_keys_of_places, "key bigint"), "key", firsts.count()))
    found = docs.mapInArrow(
        released(_contents(once, chosen, length)), "g bigint, doc_id bigint, th bigint, start bigint, place bigint, own binary").filter(
        F.length("own") >= length).groupBy("g", "th", "place").agg(F.min(F.struct("doc_id", "start", "own")).alias("row"))
    # A text's place is the first of one class at most, in the first document of that text, and repeated rows are one
    # document: a gram has ``kinds`` rows.  Both sides are dealt by the same three columns, so contents move once.
    contents = stored(found.join(firsts.drop("doc_id"), ["g", "th", "place"]).select("g", "th", "row.*", "kinds"), "suffix-contents")
    total = contents.filter(F.col("kinds") <= shard_group).agg(F.sum(F.length("own") + 1)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    root = scratch_path(spark, "suffix-queues")
    sorted_out = contents.filter(F.col("kinds") <= shard_group).withColumn(
        "shard", F.pmod(F.xxhash64("g"), F.lit(shards))).select("shard", "doc_id", "th", "start", "own").groupBy(
        "shard").applyInArrow(_sort_shard(root, length, queue_bytes), COVERED)
    windows = contents.filter(F.col("kinds") > shard_group).select("doc_id", "th", "start", "own").mapInArrow(
        _hot_windows(length), "one bigint, two bigint, doc_id bigint, th bigint, start bigint")
    earliest = windows.groupBy("one", "two").agg(F.min(F.struct("doc_id", "th", "start")).alias("first"),
                                                 F.count("*").alias("n")).filter("n > 1")
    hot = windows.join(earliest, ["one", "two"]).filter(
        ~F.struct("doc_id", "th", "start").eqNullSafe(F.col("first"))).select(
        "doc_id", "th", "start", F.lit(length).cast("bigint").alias("size"))
    return whole.unionByName(copies).unionByName(stored(sorted_out, "suffix-sorted")).unionByName(hot)


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _apply(whole: bool):
    """Texts without their ranges; ``whole``: with the bytes that stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = [batch.column(c).to_pylist() for c in ("starts", "sizes")]
            yield _results(batch.column("doc_id"), _raws(batch), *ranges, whole)
    return run


def _results(docs: pa.Array, raws: list[bytes], starts: list, sizes: list, whole: bool) -> pa.RecordBatch:
    out = []
    for text, at, size in zip(raws, starts, sizes):
        if not at:
            out.append((len(text), 0, 0, hashlib.sha256(text).hexdigest(), text if whole else None))
            continue
        raw, gone = np.frombuffer(text, np.uint8), np.zeros(len(text) + 1, np.int64)
        np.add.at(gone, np.array(at), 1)
        np.add.at(gone, np.array(at) + np.array(size), -1)
        covered = np.cumsum(gone)[:len(raw)] > 0
        spans = int(covered[:1].sum() + (covered[1:] & ~covered[:-1]).sum())
        kept = raw[~covered].tobytes()
        out.append((len(raw), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if whole else None))
    kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
    columns = [docs, *[pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)]]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    return pa.RecordBatch.from_arrays(columns if whole else columns[:-1], names=names if whole else names[:-1])


def _touched(shared: Shared):
    """Texts that the filter may hold, with their hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            hashes = np.array([_text_hash(x) for x in _raws(batch)], np.int64)
            rows = pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes)], names=["doc_id", "text", "th"])
            yield rows.filter(pa.array(in_filter(words, hashes.view(np.uint64))))
    return run


def _untouched(shared: Shared, whole: bool):
    """What becomes of the other texts: all of it stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            raws = _raws(batch)
            rest = ~in_filter(words, np.array([_text_hash(x) for x in raws], np.int64).view(np.uint64))
            none = [None] * int(rest.sum())
            yield _results(batch.column("doc_id").filter(pa.array(rest)), [x for x, r in zip(raws, rest.tolist()) if r], none, none, whole)
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, whole: bool = True, **sizes: int) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans (runs removed), kept_sha256 and, if ``whole``, ``kept``, the bytes that stay."""
    rows = texts(docs, "doc_id").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    with batches_of(docs.sparkSession, TEXT_ROWS):
        ranges = repeated_ranges(rows, length, **sizes)
        per_doc = stored(ranges.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "size")).alias("r")).select(
            F.col("doc_id").alias("its_doc"), F.col("th").alias("its_th"), F.col("r.start").alias("starts"),
            F.col("r.size").alias("sizes")), "suffix-ranges")
        # Only documents that may have ranges meet them in a join; the others stay where they are.
        told = Shared(docs.sparkSession, make_filter(per_doc.select("its_th").distinct(), "its_th", per_doc.count()))
    result = f"{RESULT}, kept binary" if whole else RESULT
    touched = rows.mapInArrow(released(_touched(told)), "doc_id bigint, text string, th bigint")
    joined = touched.join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("its_doc")) & (F.col("th") == F.col("its_th")), "left")
    out = joined.select("doc_id", "text", "starts", "sizes").mapInArrow(released(_apply(whole)), result).unionByName(
        rows.mapInArrow(released(_untouched(told, whole)), result))
    # Made here, as workers get TEXT_ROWS texts at once here only.
    with batches_of(docs.sparkSession, TEXT_ROWS):
        return stored(out, "suffix-result")
