"""Sets that cannot be linked are told apart by their bit sets, and their full sets stay where they are."""

import numpy as np

from conftest_llm import prose
from martkit.llm import jaccard
from test_pairs import near, plain_groups
from test_whole_texts_stay import most_shuffled, no_broadcasts  # noqa: F401


def test_no_link_is_turned_away():
    rng, turned = np.random.default_rng(1), 0
    for k in range(400):
        size = int(rng.integers(1, 1 << int(rng.integers(1, 11))))
        base = rng.integers(0, 1 << 63, size, np.uint64)
        other = np.concatenate([base[int(rng.integers(0, size)) // (1 + k % 4):], rng.integers(0, 1 << 63, int(rng.integers(0, size + 1)) // 4, np.uint64)])
        for one, two in ((base, other), (other, base)):
            linked = jaccard._similar(np.unique(one), np.unique(two), 0.8)
            n = [np.array([len(x)]) for x in (one, two)]
            kept = jaccard.may_link([jaccard.bit_set(one)], [jaccard.bit_set(two)], *n, 0.8)[0]
            assert kept or not linked
            turned += not kept
    assert turned > 100


def test_full_sets_of_unlike_texts_are_not_shuffled(spark, frame, monkeypatch, no_broadcasts):  # noqa: F811
    made = []

    def counted(df, name, *rows, stored=jaccard.stored):
        if name == "jaccard-links":
            df.collect()
            made.append(most_shuffled(df._jdf.queryExecution().executedPlan()))
        return stored(df, name, *rows)
    monkeypatch.setattr(jaccard, "stored", counted)
    monkeypatch.setattr(jaccard, "SMALL", 4)
    shared = prose(2, 40)
    # Half of their shingles are common: they share buckets, large ones too, but only two of them are linked.
    rows = [(i, prose(1000 + i, 40) + " " + shared) for i in range(80)]
    rows += [(100, near(rows[7][1], 1, 1))]
    links, _ = plain_groups(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.jaccard_groups(frame(rows)).collect()}
    assert got == {i: (7 if i in (7, 100) else i, n) for (i, _), n in zip(rows, links)}
    assert sum(links) == 2 and made and max(made) < 40
