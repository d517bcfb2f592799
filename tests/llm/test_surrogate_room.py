"""Short forms that fill their whole space: replacements grow, and stay distinct."""

import pytest

from martkit.llm import surrogates
from martkit.llm.surrogates import entities, replace_entities


@pytest.mark.parametrize("texts, word", [
    ([f"Maria {a}{b} came." for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou"], 1),
    ([f"write to {c}@mail.example.com now" for c in "abcdefghijklmnopqrstuvwxyz"], 2),
])
def test_full_spaces_grow(frame, monkeypatch, texts, word):
    monkeypatch.setattr(surrogates, "ATTEMPTS", 3)
    docs = frame([(i, t) for i, t in enumerate(texts)])
    assert entities(docs).count() == len(texts)
    made = [r.text.split()[word] for r in replace_entities(docs).orderBy("doc_id").collect()]
    old = {t.split()[word] for t in texts}
    assert len(set(made)) == len(texts) and not set(made) & old
    assert max(map(len, made)) > max(map(len, old))
