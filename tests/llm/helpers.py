"""Small tables for the tests of the document operators."""

from __future__ import annotations

import random

WORDS = (
    "river stone window garden letter winter summer bread music paper silver mountain forest village harbour candle "
    "shadow mirror thunder meadow lantern orchard blanket kettle saddle copper marble velvet anchor barrel"
).split()


def prose(seed: int, words: int, per_sentence: int = 8) -> str:
    """Sentences of made-up words, the same for the same seed."""
    rng = random.Random(seed)
    out = []
    for _ in range(0, words, per_sentence):
        picked = [rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed", "ly"]) for _ in range(per_sentence)]
        out.append(" ".join(picked).capitalize() + ".")
    return " ".join(out)


def documents(spark, rows, extra: bool = True):
    """Rows (doc_id, text), with further columns that share names with inner ones."""
    schema = "doc_id long, text string" + (", h string, n int, kind string, base string, key string" if extra else "")
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "k") if extra else r for r in rows], schema)


#: Nulls, empty and blank texts, repeated rows and ids, and a long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (None, "an orphan text"),
    (None, None),
    (4, "twice"),
    (4, "twice"),
    (4, "another text of that id"),
    (5, prose(5, 6000)),
    (6, "word " * 3000),
]
