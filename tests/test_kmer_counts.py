"""k-mers of sources, counted in tables, against counting them one by one."""

from collections import Counter

from pyspark.sql import functions as F

from arrayloom.operators import similarity
from arrayloom.plans import joins


def test_kmer_counts_by_hand(spark, monkeypatch):
    monkeypatch.setattr(similarity, "HELD", 1)  # tables are passed on at every new id
    rows = [("x", "ACGTACGTNACGTA"), ("y", "AAAAAAAA"), ("x", "acgtaACGTA"), ("y", "ACG"), ("z", ""), ("z", None), (None, "CCCCC"), ("é", "ACGßACGTACG")]
    want = Counter((i, s[j : j + 3]) for i, s in rows if s for j in range(len(s) - 2) if not s[j : j + 3].strip("ACGT"))
    got = similarity.kmer_counts(spark.createDataFrame(rows, "id string, seq string"), 3).collect()
    assert {(r["id"], r["kmer"]): r["n"] for r in got} == dict(want) and len(got) == len(want)


def test_source_vectors_hold_a_row_for_each_kmer(spark, sf):
    """No row for each place of a sequence is made on the way, and vectors are read from a table."""
    for canonical in (False, True):
        vectors = joins.source_vectors(spark, sf, canonical)
        assert "Generate" not in vectors._jdf.queryExecution().optimizedPlan().toString() and vectors.inputFiles()
        assert "/arrayloom/" in vectors.inputFiles()[0]
        assert vectors.groupBy("id", "kmer").agg(F.count(F.lit(1)).alias("n")).where("n > 1").count() == 0
