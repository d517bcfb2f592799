"""Text helpers shared by the tests of this folder."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, words=60):
    rng = random.Random(seed)
    text = " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing", "é"]) for _ in range(words))
    return text[0].upper() + text[1:] + "."
