"""Non-redundant consensus sequences and their frequencies, and the work they take."""

from pyspark.sql import functions as F

from arrayloom.operators import similarity

ROWS = [("s1", "AC"), ("s1", "CA"), ("s1", "ACAC"), ("s1", "GT"), ("s2", "ACAC"), ("s2", "ACACAC"), ("s2", "ACACACAC"), (None, "AC"), ("s1", ""), ("s1", None)]


def test_classes_and_frequencies(spark):
    df = spark.createDataFrame(ROWS * 2, "seqid string, consensus string")
    got = {(r["seqid"], r["consensus"]): r["canonical"] for r in similarity.consensus_classes(df.where("seqid IS NOT NULL")).collect()}
    assert got == {("s1", "AC"): "AC", ("s1", "CA"): "AC", ("s1", "ACAC"): "AC", ("s1", "GT"): "AC", ("s2", "ACAC"): "ACAC", ("s2", "ACACAC"): "ACACAC", ("s2", "ACACACAC"): "ACAC"}
    assert [tuple(r) for r in similarity.consensus_frequencies(df.where("seqid IS NOT NULL")).collect()] == [("AC", 8), ("ACAC", 4), ("ACACAC", 2)]


def test_rows_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(ROWS, "seqid string, consensus string").where(F.col("seqid").isNotNull()).mapInArrow(count, "seqid string, consensus string")
    similarity.consensus_frequencies(df).collect()
    assert seen.value == 9


def test_entropy_counts_each_base_once(spark):
    """The plan holds one translation for each base, and the values those of the plain sum."""
    import math

    from pyspark.sql import functions as F

    from arrayloom.functions import seqfn

    texts = ["", "A", "acgt", "ACGTNN", "GGGGCC", "NNNN", "TtTa" * 40, None]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", seqfn.entropy(F.col("s")).alias("e"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("translate(") <= 4

    def plain(s: str) -> float:
        shares = [sum(map(s.upper().count, b)) / len(s) for b in "ACGT"] if s else []
        return round(sum(-p * math.log2(p) for p in shares if p), 2)

    assert all(abs(r["e"] - plain(r["s"] or "")) < 0.011 for r in df.collect())
