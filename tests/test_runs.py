"""Runs that fail in part: outcomes of projects as data, tables in versions."""

import pytest
from pyspark.sql import functions as F

from arrayloom import schemas
from arrayloom.operators import classify
from arrayloom.sources import quality, sinks, text, versions
from arrayloom.streaming import incremental


def repeat(project, name, start, array, length=None):
    n = len(array)
    return (project, name, "chr1", start, start + n - 1, 3, n / 3, 90.0, 10.0, 1.5, array[:3], array, 0.5, 0.5, n if length is None else length, 0, "f", None)


def test_one_bad_project_fails_alone(spark, tmp_path):
    rows = [repeat("good", f"g{i}", i, "ACGACGACG") for i in range(5)] + [repeat("bad", "b1", 1, "ACGACG"), repeat("bad", "b2", 1, "ACG", 7)] + [repeat("other", "o", 9, "AAC")]
    spark.createDataFrame(rows, schemas.SAT).repartition(3).write.parquet(str(tmp_path / "in"))
    run = lambda n: incremental.finished(incremental.repeats(spark, str(tmp_path / "in")), str(tmp_path / "log"), str(tmp_path / f"c{n}"), out=str(tmp_path / "out")).awaitTermination(120)
    # the second run has lost its checkpoint and repeats the batch
    for n in (1, 2):
        run(n)
        log = {r["project"]: r for r in spark.read.parquet(str(tmp_path / "log")).collect()}
        assert spark.read.parquet(str(tmp_path / "log")).count() == 3
        assert {p: (r["status"], r["n"]) for p, r in log.items()} == {"good": ("success", 5), "bad": ("failed", 0), "other": ("success", 1)}
        assert log["bad"]["error"] == "ValueError: place, length and array of b2 do not agree" and log["good"]["error"] is None
        out = spark.read.parquet(str(tmp_path / "out"))
        assert sorted((r["project"], r["trf_id"], r["bp"]) for r in out.collect()) == [*(("good", f"g{i}", 9) for i in range(5)), ("other", "o", 3)]


def test_any_error_is_an_outcome(spark):
    def work(rows):
        if rows["x"].iloc[0] is None or rows["x"].max() > 90:
            raise KeyError("too much")
        return rows.assign(y=1 / rows["x"].astype(int))[["y"]]

    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 99), (None, 4)], "project string, x int").coalesce(1)
    tried = incremental.attempted(df, work, "y double")
    assert sorted((str(r["project"]), r["y"], r["error"]) for r in tried.collect()) == [("None", 0.25, None), ("a", 0.5, None), ("a", 1.0, None), ("b", None, "KeyError: 'too much'")]
    assert {r["project"]: r["status"] for r in incremental.outcomes(tried).collect()} == {"a": "success", "b": "failed", None: "success"}


SEQS = "project string, seqid string, seq string"


def arrays(seqs):
    """Two rows for a sequence, none for an empty one."""
    return seqs.where(F.length("seq") > 0).select("project", "seqid", F.explode(F.array(F.lit(1), F.lit(2))).alias("no"), F.length("seq").alias("n"))


def rows_of(spark, path):
    df = versions.read_kind(spark, path, "rows", "project string, seqid string, no int, n int")
    return sorted((r["project"], r["seqid"], r["no"]) for r in df.collect())


def test_missing_sequences_are_added(spark, tmp_path):
    path = str(tmp_path / "table")
    some = [("p", "chr1", "ACGT"), ("p", "chr2", ""), ("q", "chr1", "AA")]
    asked = []

    def compute(seqs):
        asked.append(sorted((r["project"], r["seqid"]) for r in seqs.collect()))
        return arrays(seqs)

    assert rows_of(spark, path) == [] and versions.current(spark, path) == (0, {})
    assert versions.recompute_missing(spark.createDataFrame(some, SEQS), path, compute) == 3
    assert versions.recompute_missing(spark.createDataFrame([*some, ("q", "chr2", "CC")], SEQS), path, compute) == 1
    assert versions.recompute_missing(spark.createDataFrame(some, SEQS), path, compute) == 0
    assert asked == [[("p", "chr1"), ("p", "chr2"), ("q", "chr1")], [("q", "chr2")]]
    assert rows_of(spark, path) == [("p", "chr1", 1), ("p", "chr1", 2), ("q", "chr1", 1), ("q", "chr1", 2), ("q", "chr2", 1), ("q", "chr2", 2)]
    assert versions.current(spark, path)[0] == 2


def test_a_run_that_stops_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    versions.recompute_missing(spark.createDataFrame([("p", "chr1", "ACGT")], SEQS), path, arrays)
    before = rows_of(spark, path)
    more = spark.createDataFrame([("p", "chr1", "ACGT"), ("p", "chr2", "ACGT"), ("p", "chr3", "A")], SEQS)

    def half(seqs):
        return arrays(seqs).withColumn("n", F.when(F.col("seqid") == "chr3", F.raise_error(F.lit("the machine went away")).cast("int")).otherwise(F.col("n")))

    with pytest.raises(Exception, match="went away"):
        versions.recompute_missing(more, path, half)
    assert rows_of(spark, path) == before
    # a version that was not written to its end does not count either
    (tmp_path / "table" / "versions" / "000000007").write_text("rows\tnowhere\n")
    assert rows_of(spark, path) == before
    assert versions.recompute_missing(more, path, arrays) == 2 and len(rows_of(spark, path)) == 6


def test_two_runs_do_not_both_win(spark, tmp_path):
    path = str(tmp_path / "table")
    one = spark.createDataFrame([("p", "chr1", "ACGT")], SEQS)

    def slow(seqs):
        versions.recompute_missing(one, path, arrays)  # another run comes first
        return arrays(seqs)

    with pytest.raises(versions.Conflict):
        versions.recompute_missing(one, path, slow)
    assert rows_of(spark, path) == [("p", "chr1", 1), ("p", "chr1", 2)]


def test_consistency(spark):
    seqs = spark.createDataFrame([("a", 2000000), ("b", 1000000), ("c", 5)], "seqid string, length long")
    rows = spark.createDataFrame([("a",), ("a",), ("c",)], "seqid string")
    assert versions.consistency(seqs, rows).first().asDict() == {"total": 3, "large": 2, "skipped": 1, "bp": 3000005, "large_bp": 3000000, "with_rows": 2}
    assert [tuple(r) for r in versions.low_counts(seqs, rows).collect()] == [("b", 1000000, 0)]
    assert versions.consistency(seqs.where("false"), rows.where("false")).first()["bp"] == 0


def test_quality(spark, tmp_path):
    good, short = "c\ts\tgene\t5\t9\t.\t+\t.\tID=1", "c\ts\tgene"
    lines = lambda *rows: spark.createDataFrame([(r,) for r in rows], "value string")
    flags = quality.gff_quality(lines("# x", "", good, good.replace("5", "x"), good.replace("5", "10"), good.replace("5", "0"), short))
    assert {r["flag"]: r["n"] for r in quality.flag_counts(flags).collect()} == {"ok": 1, "bad number": 1, "reversed": 1, "below 1": 1, "short": 1}
    with pytest.warns(UserWarning, match="1 of 5"):
        assert quality.checked(flags, "f.gff") == {"features": 4, "malformed": 1}
    assert quality.checked(quality.gff_quality(lines(*[good] * 10, short)), "g.gff") == {"features": 10, "malformed": 1}  # a tenth is not more than a tenth
    with pytest.raises(ValueError, match="no features"):
        quality.checked(quality.gff_quality(lines("# x")), "h.gff")
    (tmp_path / "a.fa").write_text("\n>x\nACGT\n")
    (tmp_path / "b.fa").write_text("ACGT\n")
    (tmp_path / "c.fa").write_text("\n")
    quality.check_fasta(spark, str(tmp_path / "a.fa"))
    for name, what in (("b.fa", "no header"), ("c.fa", "empty")):
        with pytest.raises(ValueError, match=what):
            quality.check_fasta(spark, str(tmp_path / name))


def test_ids_run_through_files(spark, tmp_path):
    line = "{} 9 3 3.0 3 90 0 40 33 33 33 0 1.5 ACG ACGACGACG\n"
    for name, starts in (("b/z.dat", (5, 6)), ("a.dat", (1, 2, 3)), ("c.dat", (7,)), ("skip.txt", (8,))):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("".join(f"Sequence: s{s} x\n\n{line.format(s)}" for s in starts))
    rows = text.read_trf_folder(spark, str(tmp_path), "p").collect()
    assert sorted((r["trf_id"], r["start"], r["head"], r["project"]) for r in rows) == [(i + 1, s, f"s{s} x", "p") for i, s in enumerate((1, 2, 3, 5, 6, 7))]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "trf_id string, n int")
    sinks.write_repeats(df, str(tmp_path / "one"), key="trf_id")
    assert [r["trf_id"] for r in spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "one")).collect()] == ["a", "b"]
    for i in (1, 2):
        sinks.write_repeats(df, str(tmp_path / "more"), dataset_id=i)
    more = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "more"))
    assert sorted((r["trf_id"], r["giid"]) for r in more.collect()) == [("a", "1"), ("a", "2"), ("b", "1"), ("b", "2")]
    sinks.write_classes(df, str(tmp_path / "classes"), key="trf_id")
    assert [r["value"] for r in spark.read.text(str(tmp_path / "classes")).collect()] == ["a\t1", "b\t2"]
    rows = spark.createDataFrame([repeat("p", f"i{k}", 90 - k, "ACG" * 4) for k in range(5)], schemas.SAT)
    stats = classify.separated(rows, F.col("trf_period") == 3, F.lit("three"), F.concat_ws("\t", "trf_head", F.col("trf_l_ind").cast("string")), str(tmp_path / "three"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "three")).collect()] == [f"chr1\t{90 - k}" for k in (4, 3, 2, 1, 0)]
    assert [(r["trf_family"], r["n"]) for r in stats.collect()] == [("three", 5)]
