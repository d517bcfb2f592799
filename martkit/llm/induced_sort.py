"""Suffix order and common prefixes of one shard by induced sorting with queues on disk.

The text is an array of small numbers in which 0 ends every segment.  A suffix is of type S if it
is smaller than the one that starts next to it, else of type L; an S with an L before it is a
seed.  Sorted seeds induce the order of all L suffixes from the smallest first letter up, and
those induce all S suffixes from the largest first letter down.  What is induced waits in a
priority queue of tuples (first letter, order of arrival): as tuples arrive in rank order, the
queue is one first-in-first-out list for each letter, kept in memory up to a bound and beyond it
in files.  Every tuple carries its start and its common prefix with the tuple before it, which is
one more than the smallest common prefix between the two suffixes that induced them.

Tuples are handled in batches: all that a letter's list holds at once.  Seeds are sorted through
the names of the pieces between them; the names are a string of a third of the length or less,
whose suffixes are sorted by doubling ranks, since names have no small alphabet to bucket by.

Orders and common prefixes are exact up to ``cap`` letters, which is all the caller asks for.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np

#: A shard's text is in memory, so a place in it has 31 bits.
TUPLE = np.dtype([("start", "<i4"), ("common", "u1")])


class DiskQueue:
    """One list of tuples per letter; beyond ``memory`` bytes the fullest lists go to files."""

    def __init__(self, letters: int, memory: int, open_file: Callable[[str, str], io.IOBase], name: str):
        self._held: list[list[np.ndarray]] = [[] for _ in range(letters)]
        self._files: list[list[str]] = [[] for _ in range(letters)]
        self._sizes = np.zeros(letters, np.int64)
        self._memory, self._open, self._name, self._count = memory, open_file, name, 0

    def push(self, letter: int, start: np.ndarray, common: np.ndarray) -> None:
        part = np.empty(len(start), TUPLE)
        part["start"], part["common"] = start, common
        self._held[letter].append(part)
        self._sizes[letter] += part.nbytes
        while self._sizes.sum() > self._memory:
            self._spill(int(self._sizes.argmax()))

    def _spill(self, letter: int) -> None:
        path = f"{self._name}-{letter}-{self._count}"
        self._count += 1
        with self._open(path, "w") as f:
            f.write(np.concatenate(self._held[letter]).tobytes())
        self._files[letter].append(path)
        self._held[letter], self._sizes[letter] = [], 0

    def take(self, letter: int) -> np.ndarray:
        """All tuples of the letter, in order of arrival; they leave the queue."""
        parts = []
        for path in self._files[letter]:
            with self._open(path, "r") as f:
                parts.append(np.frombuffer(f.read(), TUPLE))
        parts += self._held[letter]
        self._files[letter], self._held[letter], self._sizes[letter] = [], [], 0
        return np.concatenate(parts) if parts else np.empty(0, TUPLE)


def types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S; the last letter, a 0, is one."""
    n = len(text)
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    # Equal letters take the type of the next place where letters differ.
    place = np.where(differs, np.arange(n, dtype=np.int32), np.int32(n - 1))
    place = np.minimum.accumulate(place[::-1])[::-1]
    rises = np.ones(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    return rises[place]


def _words(text: np.ndarray, cap: int) -> np.ndarray:
    """Four letters of 16 bits from each place on, as one number; zeros follow the end.

    The numbers overlap in the letters themselves, which take 2 bytes a place instead of 8; ``_at`` reads them.
    """
    n = len(text) + cap + 4
    padded = np.zeros(n + 4, ">u2")
    padded[:len(text)] = text
    return np.ndarray(n, ">u8", padded, strides=(2,))


def _at(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    return words[places].astype(np.uint64)


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Letters that the suffixes a[i] and b[i] share, up to ``cap``."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for at in range(0, cap, 4):
        x = _at(words, a[live] + at) ^ _at(words, b[live] + at)
        same = x == 0
        rest = live[~same]
        y = x[~same]
        out[rest] = at + (y < 1 << 48).astype(np.int64) + (y < 1 << 32) + (y < 1 << 16)
        live = live[same]
        if not len(live):
            break
    out[live] = cap
    return np.minimum(out, cap)


def sort_seeds(text: np.ndarray, is_s: np.ndarray, cap: int) -> np.ndarray:
    """The seeds in the order of their suffixes."""
    seeds = np.flatnonzero(is_s & ~np.concatenate([[True], is_s[:-1]]))
    if len(seeds) < 2:
        return seeds
    # Name the pieces from a seed to the next one's letter, by four letters at a time.  Of equal letters
    # the one of type L is smaller, so no piece is a beginning of another.
    words = _words(2 * text + is_s, cap)
    sizes = (np.diff(np.append(seeds, len(text) - 1)) + 1).astype(np.int32)
    rank = np.zeros(len(seeds), np.int32)
    for at in range(0, min(int(sizes.max()), cap) + 4, 4):
        left = np.clip(sizes - at, 0, 4).astype(np.uint64)
        keep = np.where(left > 0, ~np.uint64(0) << (np.uint64(64) - np.maximum(left, 1) * np.uint64(16)), np.uint64(0))
        del left
        # Nothing is kept of a piece that has ended.
        keep &= _at(words, np.minimum(seeds + at, len(words) - 1))
        rank = _rank(rank, keep)
    del words, sizes, keep
    step = 1
    while step <= cap and rank.max() + 1 < len(rank):
        # Suffixes of the string of names, by twice as many names each round.
        after = np.zeros(len(rank), np.int32)
        after[:-step] = rank[step:] + 1
        new = _rank(rank, after)
        step *= 2
        if (new == rank).all():
            break
        rank = new
    return seeds[np.argsort(rank, kind="stable")]


def _rank(rank: np.ndarray, part: np.ndarray) -> np.ndarray:
    order = np.lexsort((part, rank))
    new = np.zeros(len(rank), bool)
    for values in (rank, part):
        values = values[order]
        new[1:] |= values[1:] != values[:-1]
    out = np.empty(len(rank), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low[i]:high[i] + 1]) for ranges that are not empty, by a table of powers of two."""
    size = high - low + 1
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(low), values.dtype)
    table = values
    for k in range(int(level.max(initial=0)) + 1):
        mine = level == k
        out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[:-(1 << k)], table[1 << k:])
    return out


class _Inducer:
    """Pushes what a sequence of suffixes, in rank order, induces; ``gap`` is the least common
    prefix met since a letter's last push."""

    def __init__(self, text, wanted, queue: DiskQueue, letters: int, cap: int):
        self._text, self._wanted, self._queue, self._cap = text, wanted, queue, cap
        self._gap = np.zeros(letters, np.uint8)

    def feed(self, start: np.ndarray, common: np.ndarray) -> None:
        if not len(start):
            return
        sources = np.flatnonzero(start > 0)
        sources = sources[self._wanted[start[sources] - 1]]
        letter = self._text[start[sources] - 1]
        order = np.argsort(letter, kind="stable")
        sources, letter = sources[order], letter[order]
        lead = np.minimum.accumulate(common)
        tail = np.append(np.minimum.accumulate(common[::-1])[::-1], self._cap)
        first = np.ones(len(sources), bool)
        first[1:] = letter[1:] != letter[:-1]
        least = np.empty(len(sources), np.uint8)
        least[first] = np.minimum(lead[sources[first]], self._gap[letter[first]])
        later = np.flatnonzero(~first)
        if len(later):
            least[later] = _range_minima(common, sources[later - 1] + 1, sources[later])
        bounds = np.append(np.flatnonzero(first), len(sources))
        made = np.minimum(least.astype(np.int64) + 1, self._cap).astype(np.uint8)
        self._gap = np.minimum(self._gap, lead[-1])
        for a, b in zip(bounds[:-1], bounds[1:]):
            c = int(letter[a])
            self._queue.push(c, start[sources[a:b]] - 1, made[a:b])
            self._gap[c] = tail[sources[b - 1] + 1]


def sorted_suffixes(text: np.ndarray, cap: int, memory: int, open_file: Callable[[str, str], io.IOBase],
                    name: str = "queue") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, common) by first letter, from the largest letter down; each in ascending order.

    ``common`` is the common prefix with the suffix before, 0 for the first of a letter.
    ``text`` ends with a 0 and has no other 0 beside a 0.
    """
    n, letters = len(text), int(text.max(initial=0)) + 1
    is_s = types(text)
    seeds = sort_seeds(text, is_s, cap)
    words = _words(text, cap)
    seed_common = np.zeros(len(seeds), np.uint8)
    if len(seeds) > 1:
        seed_common[1:] = common_prefix(words, seeds[:-1], seeds[1:], cap)
    bounds = np.searchsorted(text[seeds], np.arange(letters + 1))
    queue = DiskQueue(letters, memory, open_file, f"{name}-l")
    smaller = DiskQueue(letters, memory, open_file, f"{name}-done")
    up = _Inducer(text, ~is_s, queue, letters, cap)
    for c in range(letters):
        last = None
        while len(batch := queue.take(c)):
            start, common = batch["start"], batch["common"].copy()
            if last is None:
                common[0] = 0
            smaller.push(c, start, common)
            up.feed(start, common)
            last = start[-1]
        a, b = int(bounds[c]), int(bounds[c + 1])
        if b > a:
            common = seed_common[a:b].copy()
            common[0] = 0 if last is None else common_prefix(words, np.array([last]), seeds[a:a + 1], cap)[0]
            up.feed(seeds[a:b], common)
    queue = DiskQueue(letters, memory, open_file, f"{name}-s")
    down = _Inducer(text, is_s, queue, letters, cap)
    for c in range(letters - 1, -1, -1):
        parts, last = [], None
        while len(batch := queue.take(c)):
            start, common = batch["start"], batch["common"].copy()
            if last is None:
                common[0] = 0
            parts.append((start, common))
            down.feed(start, common)
            last = start[-1]
        low = smaller.take(c)
        start, common = low["start"], low["common"]
        if len(start):
            # Descending, the common prefix with the suffix before is that of the one above it.
            back = np.concatenate([[0 if last is None else common_prefix(words, start[-1:], np.array([last]), cap)[0]],
                                   common[:0:-1]]).astype(np.uint8)
            down.feed(start[::-1], back)
        if parts:
            s_start = np.concatenate([p[0] for p in parts])[::-1]
            s_down = np.concatenate([p[1] for p in parts])
            s_common = np.concatenate([[0], s_down[:0:-1]]).astype(np.uint8)
            if len(start):
                s_common[0] = common_prefix(words, start[-1:], s_start[:1], cap)[0]
            start, common = np.concatenate([start, s_start]), np.concatenate([common, s_common])
        if len(start):
            yield start, common
