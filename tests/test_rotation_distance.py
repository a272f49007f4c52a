"""Least edit distances over rotations, compared as bits, against the plain matrix."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from arrayloom.operators import similarity


def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def _by_hand(a: str, b: str) -> int:
    if len(a) != len(b):
        return _edits(a, b)
    back = b.translate(str.maketrans("ACGTacgt", "TGCAtgca"))[::-1]
    return min([_edits(a, s[i:] + s[:i]) for s in (b, back) for i in range(len(b))], default=0)


def _pairs() -> list[tuple[str, str]]:
    rng = random.Random(23)
    word = lambda n: "".join(rng.choice("ACGTNaß") for _ in range(n))
    sizes = [1, 2, 5, 11, 12, 15, 16, 17, 31, 32, 33, 63, 64, 65]
    pairs = [(word(n), word(n)) for n in sizes for _ in range(8)] + [(w, w[k:] + w[:k]) for w in map(word, sizes) for k in (0, 1)]
    return pairs + [("", ""), ("", "A"), ("ACG", "ACGT"), ("ACGT", "")]


def test_distances_by_hand(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(_pairs())] + [(1000, None, "A"), (1001, "A", None)]
    got = {r["i"]: r["d"] for r in spark.createDataFrame(rows, "i int, a string, b string").select("i", similarity.rotation_distance(F.col("a"), F.col("b")).alias("d")).collect()}
    assert got == {i: None if a is None or b is None else _by_hand(a, b) for i, a, b in rows}


def test_rotations_are_compared_together():
    """Of short strings no rotation is a text of its own."""
    a, b = zip(*[p for p in _pairs() if 0 < len(p[0]) == len(p[1]) <= similarity.BITS], strict=True)
    assert similarity._turned_edits(pd.Series(a), pd.Series(b)).to_numpy(np.int64).tolist() == [_by_hand(x, y) for x, y in zip(a, b, strict=True)]
