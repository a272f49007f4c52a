"""Scans of long sequences over many tasks, packing in order, telomere ends and k-mer profiles against plain walks."""

import random

import pytest
from pyspark.sql import functions as F

from arrayloom.operators import extract, gaps, scans, tiles


def walk(rows, gap):
    out = []
    for s, a, b in sorted(rows):
        if out and out[-1][0] == s and a - out[-1][2] <= gap:
            out[-1] = (s, out[-1][1], max(b, out[-1][2]), out[-1][3] + 1)
        else:
            out.append((s, a, b, 1))
    return sorted(out)


def intervals(seed, n, longest, space=1000):
    rng = random.Random(seed)
    return [(rng.choice("ab"), a, a + rng.choice([1, rng.randint(1, 30), rng.randint(1, longest)])) for a in (rng.randint(0, space) for _ in range(n))]


@pytest.mark.parametrize("gap", [-1, 7])
@pytest.mark.parametrize(("n", "longest"), [(120, 40), (60, 400), (300, 3)])
def test_merge(spark, gap, n, longest):
    rows = intervals(n + gap, n, longest)
    df = spark.createDataFrame(rows, "seqid string, start long, end long").repartition(3)
    for width in (16, 1 << 20):
        assert sorted(tuple(r) for r in scans.merge_intervals(df, gap, width).collect()) == walk(rows, gap)


def test_merge_of_nothing_and_of_one_cover(spark):
    df = spark.createDataFrame([("a", 0, 5000)] + [("a", i * 10, i * 10 + 2) for i in range(400)], "seqid string, start long, end long")
    assert [tuple(r) for r in scans.merge_intervals(df, -1, 64).collect()] == [("a", 0, 5000, 401)]
    assert scans.merge_intervals(df.where("false"), 5).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_low_runs(spark, seed):
    rng = random.Random(seed)
    rows = [(s, i * 25, i * 25 + 100, rng.choice([None, 10, 10, 50, 60, 90]) if rng.random() < 0.6 else 10) for s in "ab" for i in range(rng.randint(0, 90)) if rng.random() < 0.9]
    want, run = [], None
    for s, a, b, u in [*sorted(rows, key=lambda r: r[:3]), ("", 0, 0, 99)]:
        if run and (run[0] != s or u is None or u >= 60):
            want.append(tuple(run))
            run = None
        if u is not None and u < 60:
            run = [s, run[1], max(b, run[2]), run[3] + 1] if run else [s, a, b, 1]
    want = sorted(r for r in want if r[2] - r[1] >= 150)
    df = spark.createDataFrame(rows, "seqid string, start long, end long, unique_kmers long").repartition(3)
    for width in (30, 200, 1 << 20):
        assert sorted(tuple(r) for r in scans.low_runs(df, 60, 150, width).collect()) == want


def test_low_runs_ties_do_not_depend_on_the_order_of_rows(spark):
    # at 100 to 200 a window under the threshold and one above it stand at the same place
    rows = [("a", 0, 100, 10), ("a", 100, 200, 90), ("a", 100, 200, 10), ("a", 200, 300, 10)]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "seqid string, start long, end long, unique_kmers long").coalesce(1)
        assert sorted(tuple(r) for r in scans.low_runs(df, 60, 1).collect()) == [("a", 0, 200, 2), ("a", 200, 300, 1)]


def test_running_sums_and_numbers(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), rng.randint(-50, 300), i, rng.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, at long, id long, x long").repartition(4)
    order = sorted(rows, key=lambda r: (str(r[0]), r[1], r[2]))
    want = {r[2]: (sum(q[3] for q in order if q[0] == r[0] and q[1:3] < r[1:3]), 1 + sum(q[0] == r[0] and q[1:3] < r[1:3] for q in order)) for r in rows}
    for width in (1, 40, 1 << 20):
        out = scans.running_sum(df, ["k"], ["at", "id"], F.col("x"), "total", width)
        assert {r["id"]: r["total"] for r in out.collect()} == {i: t for i, (t, _) in want.items()}
        assert {r["id"]: r["no"] for r in scans.numbered(df, ["k"], ["at", "id"], width=width).collect()} == {i: n for i, (_, n) in want.items()}


def test_upper_medians(spark):
    rows = [("a", 3), ("a", 1), ("a", 2), ("a", 9), ("b", 5), ("c", 7), ("c", 7), ("c", 1), ("d", None)]
    assert {tuple(r) for r in scans.upper_medians(spark.createDataFrame(rows, "k string, v int"), "k", "v").collect()} == {("a", 3), ("b", 5), ("c", 7)}


def greedy(lengths, size):
    out, chunk, total = [], 0, 0
    for n in lengths:
        out.append(chunk)
        total += n
        if total > size:
            chunk, total = chunk + 1, 0
    return out


@pytest.mark.parametrize(("seed", "n", "longest", "size"), [(1, 90, 60, 100), (2, 60, 400, 100), (3, 70, 3, 50), (4, 1, 10, 100), (5, 30, 100, 99)])
def test_chunks_are_greedy(spark, seed, n, longest, size):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 0, rng.randint(0, longest), size, size + 1]) for _ in range(n)]
    numbers = sorted(rng.sample(range(10 * n), n))
    df = spark.createDataFrame([(i, f"s{i}", "A" * k if k else rng.choice(["", None])) for i, k in zip(numbers, lengths, strict=True)], "no long, seqid string, seq string").repartition(3)
    assert [r["chunk"] for r in sorted(extract.chunked(df, size=size).collect())] == greedy(lengths, size)


def test_registered_chunks(spark, sf):
    from arrayloom.plans.registry import QUERIES

    rows = sorted(QUERIES["d10_chunks"](spark, sf).collect())
    assert [r["chunk"] for r in rows] == greedy([r["length"] for r in rows], 100000)
    assert extract.chunked(spark.createDataFrame([], "no long, seqid string, seq string")).count() == 0


def plain_end(end, motif):
    end = end.upper()
    cycle = {(motif * 2)[i : i + 4] for i in range(2 * len(motif) - 3)}
    share = sum(end[i : i + 4] in cycle for i in range(len(end) - 3)) / len(end) if len(end) > 3 else 0.0
    return round(share, 4), sum(sum(x != y for x, y in zip(end[i:], motif, strict=False)) <= 1 for i in range(len(end) - len(motif) + 1))


def test_telomere_ends(spark):
    rng = random.Random(8)
    seqs = {f"s{i}": "CCCTAA" * rng.randint(0, 9) + "".join(rng.choices("ACGTNacgt", k=rng.randint(0, 300))) + "TTAGGG" * rng.randint(0, 20) for i in range(60)} | {"": "", "one": "A", "six": "CCCTAA", "five": "TAGGG", "ü": "üTTAGGGü"}
    df = spark.createDataFrame([*seqs.items()], "seqid string, seq string").repartition(3)
    for window in (50, 10000):
        want = {k: (*plain_end(s[:window], "CCCTAA"), *plain_end(s[-window:], "TTAGGG")) for k, s in seqs.items()}
        got = {r["seqid"]: r for r in gaps.telomere_calls(df, window=window).collect()}
        for k, w in want.items():
            r = got[k]
            assert (r["left_hits"], r["right_hits"]) == (w[1], w[3]), k
            assert abs(r["left_share"] - w[0]) < 1e-4 and abs(r["right_share"] - w[2]) < 1e-4, k
        of_tiles = {r["seqid"]: r for r in gaps.telomere_calls_of_tiles(tiles.tiled(df, 40), window=window, size=40).collect()}
        assert of_tiles == {k: r for k, r in got.items() if seqs[k]}


@pytest.mark.parametrize(("k", "window", "step"), [(5, 40, 10), (4, 20, 50), (17, 100, 25), (2, 37, 5)])
def test_kmer_profile(spark, monkeypatch, k, window, step):
    monkeypatch.setattr(gaps, "SPAN", 2)
    monkeypatch.setattr(gaps, "CHUNK", 24)
    rng = random.Random(k)
    seqs = {"a": "".join(rng.choices("AC", k=700)), "b": "N" * 300 + "ACG" * 50, "c": "ACGT" * 3, "d": "", "e": "".join(rng.choices("ACGT", k=333)) * 2}
    df = spark.createDataFrame([*seqs.items()], "seqid string, seq string")
    want = {}
    for s, seq in seqs.items():
        for w in range(0, len(seq) - k + 1, step):
            want[s, w] = (min(w + window, len(seq)), len({seq[i : i + k] for i in range(w, min(w + window, len(seq) - k + 1))}))
    for tiled in (tiles.tiled(df, 64, k - 1), tiles.overlapping(tiles.tiled(df, 64), k - 1), tiles.tiled(df, overlap=k - 1)):
        got = {(r["seqid"], r["start"]): (r["end"], r["unique_kmers"]) for r in gaps.kmer_profile_of_tiles(tiled, k, window, step).collect()}
        assert got == want


def test_kmer_profile_counts_stretches_by_themselves(spark, monkeypatch):
    # what is shuffled are letters: a row a stretch and tile, none for each place
    rng = random.Random(33)
    seqs = {f"s{n}": "".join(rng.choices("ACGTN", k=n)) for n in (5, 6, 399, 400, 401, 6399, 6400, 6401, 20_000)} | {"é": "AÉAÉ𝔸" * 200}
    df = spark.createDataFrame([*seqs.items()], "seqid string, seq string")
    plan = gaps.kmer_profile(df, 5, 400, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    for k, window, step, at_once in ((5, 400, 100, 1 << 20), (17, 50, 70, 1), (40, 300, 100, 1 << 20)):
        monkeypatch.setattr(gaps, "AT_ONCE", at_once)
        got = {(r["seqid"], r["start"]): (r["end"], r["unique_kmers"]) for r in gaps.kmer_profile(df, k, window, step).collect()}
        want = {(s, w): (min(w + window, len(q)), len({q[i : i + k] for i in range(w, min(w + window, len(q) - k + 1))})) for s, q in seqs.items() for w in range(0, len(q) - k + 1, step)}
        assert got == want


def test_monomer_summary_is_that_of_the_monomers(spark):
    rng = random.Random(23)
    rows = [(f"a{i % 40}", "".join(rng.choices("ACGT", k=rng.randint(0, 30))), rng.randint(0, 9)) for i in range(300)]
    rows += [("a1", "ACGACGAC", 3), ("a1", "ACGACGAC", 3), ("a1", "ACGACGAT", 3), ("a2", None, 3), ("a2", "ACG", None), ("a3", "ACG", 3), ("a3", "AÉ𝔸", 1)]
    df = spark.createDataFrame(rows, "array_id string, seq string, period int")
    plan = gaps.monomer_summary(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    got = sorted((r["array_id"], r["n"], r["bp"], r["first"], r["lengths"]) for r in gaps.monomer_summary(df).collect())
    numbered = {f"{i}": r for i, r in enumerate(sorted({r for r in rows if None not in r}))}
    cut: dict = {}
    for r in gaps.monomers(spark.createDataFrame([(i, r[1], r[2]) for i, r in numbered.items()], df.schema)).where("type = 'monomer'").orderBy("no").collect():
        cut.setdefault(r["array_id"], []).append(r["cut_sequence"])
    assert got == sorted((numbered[i][0], len(c), sum(map(len, c)), c[0], ",".join(str(len(x)) for x in c)) for i, c in cut.items())
