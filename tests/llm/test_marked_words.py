"""Words between marks are put together from pieces that are known, and letters are encoded many words at once."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from martkit.llm import token_shards

with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
    DEFINITION = f.read()


def test_marked_words_are_not_encoded_again(monkeypatch):
    encoder, asked = token_shards.Encoder(DEFINITION, 2, True), []
    ids = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda values, *more: asked.extend(values) or ids(values, *more))
    words = [f"{a}{w}{b}" for w in ("what", "straße", "él", "año") for a in ("", "(", "**") for b in ("", "!!", ").")]
    whole = Tokenizer.from_str(DEFINITION)
    got = np.frombuffer(b"".join(encoder([" ".join(words)])), "<u2").tolist()
    assert got == [*whole.encode(" ".join(words), add_special_tokens=False).ids, 2]
    assert {x for x in asked if x} <= {"!!", "(", ")", ").", "**", "."}


def test_ids_of_any_text_stay():
    pool = [*"abcxyzst'\"!.,<|>()[]{}*&%$#@~`^_-+=/\\:;?09 \nßéÿ÷×ÉÈñéÁſΣσçǿ­中🙂", "'s", "<|endoftext|>", "<|", "|>", "'re", " the ", "(784)"]
    rng, whole = random.Random(5), Tokenizer.from_str(DEFINITION)
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(20000)]
    texts += ["#!<|endoftext|>,", "'sup dogs' (don't)", "a'll ''s '", ""]
    # Little memory: words are forgotten many times.
    for memory in (1 << 28, 1 << 16):
        encoder = token_shards.Encoder(DEFINITION, 2, True, memory)
        for text, ids in zip(texts, encoder(texts)):
            assert np.frombuffer(ids, "<u2").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2], text
