"""What sorting a shard takes in memory, and that words which overlap hold the same letters."""

import gc
import random
import tracemalloc

import numpy as np

from conftest_llm import prose
from martkit.llm import induced_sort


def letters(texts):
    return np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.int16) + 1, np.int16(0)) for t in texts])


def test_a_shard_takes_few_bytes_a_letter():
    rng = random.Random(3)
    passages = [prose(i, 12).encode() for i in range(400)]
    text = letters([b" ".join(rng.choice(passages) for _ in range(3))[rng.randrange(90):][:150] for _ in range(3000)])
    gc.collect()
    tracemalloc.start()
    try:
        for _ in induced_sort.sorted_suffixes(text, 100, 64 << 20, None):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Measured: 24 bytes a letter, and 48 with four letters of every place in a number of its own.
    assert peak < 32 * len(text), peak / len(text)


def test_words_overlap_in_their_letters():
    text = letters([b"abcdefg", "é\U0001f642".encode(), b"\xff" * 9, b"z"])
    padded = [*text.tolist(), *[0] * 108]
    words = induced_sort._words(text, 100)
    places = np.arange(len(text) + 104)
    assert len(words) == len(places)
    assert induced_sort._at(words, places).tolist() == [
        sum(padded[p + i] << 48 - 16 * i for i in range(4)) for p in places]
