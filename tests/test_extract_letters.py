"""The repeat table's letters, read in one step, against the column functions and a plain count."""

import random

import pytest
from pyspark.sql import functions as F

from arrayloom.functions import seqfn
from arrayloom.operators import extract
from arrayloom.plans.registry import QUERIES


def odd_rows():
    rng = random.Random(3)
    seqs = [(f"s{i}", "".join(rng.choices("ACGTNacgtnRx-", k=rng.randint(1, 90)))) for i in range(30)]
    seqs += [("wide", "ACGé\U0001f600TTAGé" * 4), ("one", "g"), ("same", "ACAC" * 20)]
    beds = []
    for name, s in seqs:
        for _ in range(8):
            a = rng.randrange(len(s))
            beds.append((name, a, rng.randint(a + 1, len(s)), rng.choice([None, 0, -2, 1, 2, 5, 200]), rng.choice(["+", "-", None])))
    return seqs, beds


@pytest.mark.parametrize("letters", [20, extract.LETTERS])
def test_letters_are_read_as_by_the_column_functions(spark, monkeypatch, letters):
    monkeypatch.setattr(extract, "LETTERS", letters)
    seqs, beds = odd_rows()
    whole = dict(seqs)
    got = extract.extract_arrays(spark.createDataFrame(seqs, "seqid string, seq string"), spark.createDataFrame(beds, "seqid string, start long, end long, period int, strand string"), "p", 32)
    turned = F.when(F.col("strand") == "-", seqfn.revcomp_n(F.col("bases"))).otherwise(F.col("bases"))
    want = spark.createDataFrame([(n, a, b, p, d, whole[n][a:b]) for n, a, b, p, d in beds], "seqid string, start long, end long, period int, strand string, bases string").withColumn("x", turned)
    want = want.select(
        "seqid", F.col("start") + 1, "end", "period", "x", seqfn.entropy(F.col("x")), seqfn.rounded(seqfn.gc_fraction(F.col("x")), 2),
        F.when(F.col("period") != 0, seqfn.percent_match(F.col("x"), F.col("period"))).otherwise(0.0),
    )
    columns = ["trf_head", "trf_l_ind", "trf_r_ind", "trf_period", "trf_array", "trf_entropy", "trf_array_gc", "trf_pmatch"]
    rows = sorted(map(str, map(tuple, got.select(*columns).collect())))
    assert len(rows) == len(beds) and rows == sorted(map(str, map(tuple, want.collect())))


def test_no_filter_reads_letters_anew(spark, sf):
    """Classes were told from the letters by expressions that the filter and each count of bases repeated."""
    plan = QUERIES["f07_c02_true_ssr"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "zip_with" not in plan and "zipwith" not in plan.lower() and plan.count("regexp_replace") <= 2
