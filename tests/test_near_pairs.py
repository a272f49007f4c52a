"""Near units meet on words of which few are no result, over as many tasks as are set."""

import random

from arrayloom.operators import families

BACK = str.maketrans("ACGT", "TGCA")


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def apart(a, b):
    if len(a) != len(b):
        return lev(a, b)
    return min(lev(a, t[i:] + t[:i]) for t in (b, b[::-1].translate(BACK)) for i in range(len(b)))


def test_candidates_are_few_and_no_pair_is_lost(spark, monkeypatch):
    rng = random.Random(8)
    words = {"".join(rng.choices("ACGT", k=n)) for n in (4, 5, 9, 10, 11, 12) for _ in range(60)}
    seeds = ["".join(rng.choices("ACGT", k=n)) for n in (6, 10, 12, 15, 16, 18, 19)]
    for s in seeds * 6:
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(s))
            s = s[:i] + rng.choice(["", "A", "CG", "T"]) + s[i + rng.randint(0, 1) :]
        i = rng.randrange(len(s))
        words.add(s[i:] + s[:i])
        words.add(s)
    words = sorted({min(t[i:] + t[:i] for t in (w, w[::-1].translate(BACK)) for i in range(len(w))) for w in words if w})
    allow = lambda a, b: min(3, ((20 + 1) * max(len(a), len(b)) - 1) // 100)
    want = {(a, b, apart(a, b)) for a in words for b in words if a != b and abs(len(a) - len(b)) <= 3 and apart(a, b) <= allow(a, b)}
    tables, write = [], families._written
    monkeypatch.setattr(families, "_written", lambda df: (tables.append(write(df)), tables[-1])[1])
    got = families.near_pairs(spark.createDataFrame([(w,) for w in words], "s string"))
    assert {tuple(r) for r in got.collect()} == want
    short = [r for t in tables if t.columns == ["a", "b"] for r in t.collect() if max(len(r["a"]), len(r["b"])) <= families.SHORT - 3]
    assert len(short) <= 1.1 * len([1 for a, b, _ in want if max(len(a), len(b)) <= families.SHORT - 3])
