"""Distances of units and runs of N against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from arrayloom.functions import seqfn
from arrayloom.operators import classify, families, gaps, similarity, views

OTHER = str.maketrans("ACGT", "TGCA")


def back(s):
    return s.translate(OTHER)[::-1]


def turns(s):
    return [t[i:] + t[:i] for t in (s, back(s)) for i in range(len(s))]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(seed, n, letters, least, most):
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=rng.randint(least, most))) for _ in range(n)]


@pytest.mark.parametrize(("most", "longest"), [(1, 8), (2, 8), (3, 6)])
def test_edit_pairs_equal_all_pairs(spark, most, longest):
    units = sorted({*words(1, 110, "ACGT", 0, longest), *"ACGTN", "", "AC", "ACG"})
    want = {(a, b, d) for a in units for b in units if a < b and (d := min(edits(a, b), edits(a, back(b)))) <= most}
    got = similarity.edit_pairs(spark.createDataFrame([(u,) for u in [*units, *units, None]], "s string"), most).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_one_edit_of_long_and_short_strings(spark, monkeypatch):
    monkeypatch.setattr(similarity, "SHORT", 4)
    units = sorted({*words(5, 150, "AC", 0, 8), "", "A", "ACGTACGT"})
    want = {(a, b, d) for a in units for b in units if a < b and (d := min(edits(a, b), edits(a, back(b)))) <= 1}
    got = similarity.edit_pairs(spark.createDataFrame([(u,) for u in units], "s string"), 1).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_distances_over_rotations(spark):
    pairs = list(zip(words(2, 60, "ACGTN", 1, 7), words(3, 60, "ACGTN", 1, 7), strict=True))
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", similarity.rotation_distance(F.col("a"), F.col("b")).alias("d")).collect():
        want = min(edits(r["a"], t) for t in turns(r["b"])) if len(r["a"]) == len(r["b"]) else edits(r["a"], r["b"])
        assert r["d"] == want
    df = df.withColumn("b", F.concat("b", "b")).withColumn("a", F.substring(F.col("b"), 1, F.expr("length(b) div 2")))
    for r in df.select("a", "b", similarity.sliding_hamming(F.col("a"), F.col("b")).alias("d")).collect():
        full = r["a"] * 2
        assert abs(r["d"] - min(sum(x != y for x, y in zip(t, full, strict=True)) / len(full) for t in turns(r["b"]))) < 1e-9


def test_n_runs_over_cuts(spark):
    seqs = [*words(4, 80, "ANn", 0, 30), *words(5, 40, "NNNNA", 0, 30), "N" * 12, "", "Äß N"]
    df = spark.createDataFrame(list(enumerate(seqs)), "seqid int, seq string")
    want = sorted((i, *m.span(), m.end() - m.start()) for i, s in enumerate(seqs) for m in re.finditer("[Nn]+", s))
    for piece in (4, 1 << 20):
        assert sorted(tuple(r) for r in gaps.n_runs(df, piece=piece).collect()) == want
    assert sorted(tuple(r) for r in gaps.n_runs(df, 20, 7).collect()) == [w for w in want if len(seqs[w[0]]) >= 20]


def test_gap_summary_has_a_total(spark):
    df = spark.createDataFrame([(4,), (40,), (44,), (4000,)], "length long")
    got = gaps.gap_summary(df, spark.createDataFrame([(10000,)], "genome long")).collect()
    assert sorted(tuple(r) for r in got) == [("10-100", 2, 50.0, 84, 0.84, 42.0), ("<10", 1, 25.0, 4, 0.04, 4.0), (">1k", 1, 25.0, 4000, 40.0, 4000.0), ("total", 4, 100.0, 4088, 40.88, 1022.0)]


def test_cosine_of_all_pairs(spark):
    v = spark.createDataFrame([("a", "AC", 1.0), ("a", "GT", 1.0), ("b", "AC", 2.0), ("c", "TT", 1.0), ("z", "TT", 0.0)], "id string, kmer string, tf double")
    near = {(r["id_a"], r["id_b"]): round(r["distance"], 4) for r in similarity.cosine_pairs(v, whole=True).collect()}
    assert near == {("a", "b"): 29.2893, ("a", "c"): 100.0, ("b", "c"): 100.0, ("a", "z"): 100.0, ("b", "z"): 100.0, ("c", "z"): 100.0}
    assert similarity.cosine_pairs(v).count() == 2
    with pytest.raises(ValueError, match="10000"):
        similarity.cosine_pairs(spark.range(10001).selectExpr("id", "'A' AS kmer", "1.0D AS tf"), whole=True)


def test_components_of_any_kind(spark):
    rng = random.Random(12)
    edges = [(rng.randrange(90), rng.randrange(90)) for _ in range(70)] + [(200, 200)]
    up = {x: x for e in edges for x in e}
    for _ in up:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    df = spark.createDataFrame(edges, "id_a long, id_b long").repartition(5)
    assert {r["id"]: r["comp"] for r in similarity.connected_components(df.union(spark.createDataFrame([(None, 3)], df.schema))).collect()} == up
    names = similarity.connected_components(df.select(*[F.format_string("n%03d", c).alias(c) for c in df.columns]))
    assert {r["id"]: r["comp"] for r in names.collect()} == {f"n{i:03d}": f"n{c:03d}" for i, c in up.items()}
    pairs = similarity.connected_components(df.select(*[F.struct(F.col(c).alias("x")).alias(c) for c in df.columns]))
    assert {r["id"]["x"]: r["comp"]["x"] for r in pairs.collect()} == up


def test_views(spark):
    lengths = spark.createDataFrame([("a", 200), ("b", 50)], "seqid string, length long")
    calls = spark.createDataFrame([("a", "PRESENT", "PRESENT", "T2T"), ("b", "ABSENT", "PARTIAL", "INCOMPLETE")], "seqid string, left_call string, right_call string, status string")
    families = spark.createDataFrame([("a", "SF1", 30), ("a", "SF0", 10), ("a", "SF1", 5)], "seqid string, family string, bp long")
    sites = spark.createDataFrame([("a", 90, 120, 5), ("a", 20, 50, 5)], "seqid string, start long, end long, repeats long")
    view = views.chromosome_view(lengths, calls, None, families, sites)
    a, b = sorted(view.collect())
    assert a["percent_of_longest"] == 100 and b["percent_of_longest"] == 25 and b["families"] == [] and b["sites"] == [] and "densities" not in view.columns
    assert [tuple(x) for x in a["families"]] == [("SF0", 1, 10), ("SF1", 2, 35)] and [x["start"] for x in a["sites"]] == [20, 90]
    assert view.select(views.flat(F.col("families"), ["family", "bp"]).alias("f")).where("f <> ''").first()["f"] == "SF0:10,SF1:35"
    assert '"status":"T2T"' in views.json_lines(view).where("seqid = 'a'").first()["value"]
    assert views.assembly_view(lengths, calls, sites).first().asDict() == {"n": 2, "bp": 250, "t2t": 1, "sites": 2}


def test_statistics_round_by_the_value(spark):
    # 641 / 640 is a double under 1.0015625, 69 / 120 one under 0.575
    rows = spark.range(640).select(F.lit("f").alias("trf_family"), F.lit(60).alias("trf_array_length"), F.when(F.col("id") == 0, 2.0).otherwise(1.0).alias("trf_pmatch"), F.lit(0.5).alias("trf_array_gc"))
    assert [r["mean_pmatch"] for r in classify.family_statistics(rows, 6).collect()] == [1.001562]
    gc = spark.sql("SELECT 69 / 120D AS x, 0.125D AS y, cast(NULL AS double) AS z").select(*[seqfn.rounded(F.col(c), 2) for c in "xyz"])
    assert tuple(gc.first()) == (0.57, 0.13, None)


def test_hamming_of_nulls_other_letters_and_part_lengths(spark):
    rows = [("AC", "CACA"), ("ACG", "ACGAC"), ("Aé", "éA"), (None, "A"), ("A", ""), ("", "A"), ("A" * 300, "A" * 299 + "C")]
    got = [r["d"] for r in spark.createDataFrame(rows, "a string, b string").coalesce(1).select(similarity.sliding_hamming(F.col("a"), F.col("b")).alias("d")).collect()]
    # before, an empty word had a mismatch at a place that it does not have, or stopped the query
    assert got == [0.0, 0.4, 0.0, None, None, None, 1 / 300]


def test_unit_components_broadcast_no_words(spark):
    """Words take the driver far more memory than their files say, so no join of them is a broadcast."""
    words = spark.createDataFrame([("ACGT",), ("ACGA",), ("TTTT",)], "motif string")
    for df in (similarity.edit_pairs(words.withColumnRenamed("motif", "s"), 1), families.unit_components(words)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_leaders_in_order_or_in_rounds(spark, monkeypatch):
    rng = random.Random(8)
    units = ["".join(rng.choices("ACGT", k=rng.randint(5, 7))) for _ in range(60)]
    rows = spark.createDataFrame([(u,) for u in units for _ in range(rng.randint(1, 4))], "canonical string")
    got = lambda: sorted(map(tuple, families.leaders(rows).collect()))
    at_once = got()
    monkeypatch.setattr(families, "FEW", 0)
    assert at_once == got() and len({x for _, x, _ in at_once}) < len({x for x, _, _ in at_once})
