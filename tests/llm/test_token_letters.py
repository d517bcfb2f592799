"""Words of plain letters skip the steps that leave them as they are; their ids stay the same."""

import json

import public_tokenizers
from tokenizers import Tokenizer

from conftest_llm import prose
from martkit.llm import token_shards

with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
    DEFINITION = f.read()


def test_words_of_letters():
    words = sorted({w.lower() for i in range(200) for w in prose(i).split()} | {
        a + b for a in ("un", "straw", "zz", "the", "q") for b in ("berry", "iouea", "lll", "s")})
    letters = [w for w in words if w.isascii() and w.isalpha()]
    short, whole = Tokenizer.from_str(token_shards._for_letters(DEFINITION)), Tokenizer.from_str(DEFINITION)
    assert short.normalizer is None and len(letters) > 50
    assert [short.encode(w).ids for w in letters] == [whole.encode(w).ids for w in letters]
    texts = [" ".join(words), "<|ENDOFTEXT|> ABC <|endoftext|> abc Abc", "don't İs aΣ ſ ＡＢＣ", ""]
    encoder = token_shards.Encoder(DEFINITION, 2, True)
    kind = "<u2" if encoder.width == 2 else "<u4"
    for text, ids in zip(texts, encoder(texts)):
        assert token_shards.np.frombuffer(ids, kind).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2]


def test_other_definitions_are_left_alone():
    for part in ({"normalizer": {"type": "Sequence", "normalizers": [{"type": "Prepend", "prepend": "x"}]}},
                 {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}):
        assert token_shards._for_letters(json.dumps(json.loads(DEFINITION) | part)) is None
