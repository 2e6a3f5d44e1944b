"""Texts for the tests."""

import random


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    pool = ["".join(random.Random(k).choices("abcdefghilmnoprstu", k=2 + k % 7)) for k in range(vocabulary)]
    return " ".join(rng.choice(pool) for _ in range(words))


def edge_documents():
    """Null ids and texts, empty and blank texts, ties, repeated rows, non-ASCII, one long text."""
    base = prose(1, 120)
    return [
        (1, base),
        (1, base),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, base + " " + prose(2, 30)),
        (None, base),
        (None, prose(3, 50)),
        (6, "Été ÇA va? ñ ß 日本語 😀 \x00 x", None),
        (7, "one"),
        (7, "another text under one id " + prose(4, 40)),
        (8, prose(5, 20_000)),
        (9, "12345 !!! ???"),
        (10, prose(5, 300)),
    ]
