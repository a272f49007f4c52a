"""Sequences as tiles: the same letters, arrays and records as from whole rows."""

import gzip
import random

from pyspark.sql import functions as F

from arrayloom.functions import seqfn
from arrayloom.operators import extract, tiles
from arrayloom.sources import text


def letters(seed, n, of="ACGTN"):
    return "".join(random.Random(seed).choices(of, k=n))


def test_tiles_hold_the_sequence(spark):
    seqs = {"a": letters(1, 1000), "b": letters(2, 64), "c": "", "d": letters(3, 65), "e": "ÄCGTß" * 40}
    df = spark.createDataFrame([*seqs.items(), ("f", None)], "seqid string, seq string")
    rows = tiles.tiled(df, 64).collect()
    for r in rows:
        s = seqs.get(r["seqid"]) or ""
        assert r["length"] == len(s) and r["offset"] == 64 * r["tile"] and r["bases"] == s[r["offset"] : r["offset"] + 64]
    assert {k: sum(r["seqid"] == k for r in rows) for k in "abcdef"} == {"a": 16, "b": 1, "c": 1, "d": 2, "e": 4, "f": 1}
    assert {r["seqid"]: r["seq"] for r in tiles.assembled(tiles.tiled(df, 64)).collect()} == seqs | {"f": ""}


def test_spans_over_tiles(spark):
    seqs = {"a": letters(4, 700), "b": letters(5, 90), "ü": "äöü" * 50}
    rng = random.Random(6)
    spans = [(rng.choice([*seqs, "none"]), a, a + rng.randint(-2, 300)) for a in (rng.randint(-3, 720) for _ in range(400))]
    spans += [spans[0]] * 3 + [("a", 64, 128), ("a", 0, 700), ("a", 0, 701), ("a", 63, 65), ("b", 89, 90)] * 2
    df = spark.createDataFrame([(*s, "x", i % 3) for i, s in enumerate(spans)], "seqid string, start long, end long, tile string, length int").withColumnsRenamed({"tile": "note", "length": "kind"})
    got = tiles.cut_spans(df, tiles.tiled(spark.createDataFrame([*seqs.items()], "seqid string, seq string"), 64), 64)
    want = [(s, a, b, seqs[s][a:b]) for s, a, b in spans if s in seqs and 0 <= a < b <= len(seqs[s])]
    assert sorted((r["seqid"], r["start"], r["end"], r["bases"]) for r in got.collect()) == sorted(want)
    assert got.columns == [*df.columns, "bases"]


def test_extraction_does_not_depend_on_tiles(spark):
    seqs = spark.createDataFrame([("chr1 first", letters(7, 5000)), ("chr2", letters(8, 40))], "seqid string, seq string")
    rng = random.Random(9)
    beds = [(rng.choice(["chr1", "chr2", "chr3"]), a, a + rng.randint(1, 900), rng.randint(1, 9), rng.choice("+-")) for a in (rng.randint(0, 4900) for _ in range(200))]
    beds = spark.createDataFrame([*beds, beds[0]], "seqid string, start long, end long, period int, strand string")
    whole = sorted(map(str, extract.extract_arrays(seqs, beds, "p").collect()))
    assert len(whole) > 50
    for size in (50, 333):
        assert sorted(map(str, extract.extract_arrays(seqs, beds, "p", size).collect())) == whole
    # as it was before: cut out of whole rows
    old = beds.join(seqs.withColumn("seqid", seqfn.first_word(F.col("seqid"))), "seqid").where((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("seq")))
    bases = F.substring(F.col("seq"), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    old = sorted(r[0] for r in old.select(F.when(F.col("strand") == "-", seqfn.revcomp_n(bases)).otherwise(bases)).collect())
    assert sorted(r["trf_array"] for r in extract.extract_arrays(seqs, beds, "p", 100).collect()) == old


def test_a_long_sequence_is_many_rows(spark):
    """A sequence of 24 million letters: no row holds more than a tile, and a late interval costs what an early one does."""
    seqs = spark.range(1).select(F.lit("chr1").alias("seqid"), F.repeat(F.lit(letters(10, 1000)), 24000).alias("seq"))
    cut = tiles.tiled(seqs)
    sizes = cut.agg(F.count("*"), F.max(F.length("bases")), F.sum(F.length("bases"))).first()
    assert tuple(sizes) == (-(-24_000_000 // tiles.TILE), tiles.TILE, 24_000_000)
    spans = spark.range(2000).select(F.lit("chr1").alias("seqid"), (F.col("id") * 11_999).alias("start"), (F.col("id") * 11_999 + 40).alias("end"))
    got = tiles.cut_spans(spans, cut)
    unit = letters(10, 1000) * 2
    assert all(r["bases"] == unit[r["start"] % 1000 :][:40] for r in got.collect()) and got.count() == 2000


def test_fasta_as_tiles(spark, tmp_path):
    rng = random.Random(11)
    records = [(f"s{i} number {i}", letters(20 + i, n)) for i, n in enumerate((0, 1, 63, 64, 65, 5000, 20000))]
    wrap = lambda s, k: "\n".join(s[i : i + k] for i in range(0, len(s), k))
    body = "; before the first header\n\n" + "".join(f">{h}\n{wrap(s, rng.randint(3, 70))}\n\n" for h, s in records)
    (tmp_path / "a.fa").write_text(body + ">last\nACG T\nac")
    (tmp_path / "b.fa").write_bytes(b">other file\r\nACGT\r\nAC\r\n")
    with gzip.open(tmp_path / "c.fa.gz", "wt") as f:
        f.write(body)
    want = {h: s for h, s in records}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # many blocks, also inside records and lines
    try:
        for name, more in (("a.fa", {"last": "ACGTac"}), ("b.fa", None), ("c.fa.gz", {})):
            df = text.read_fasta_tiles(spark, str(tmp_path / name), size=64)
            rows = df.collect()
            got = {}
            for r in sorted(rows, key=lambda r: r["tile"]):
                got[r["header"]] = got.get(r["header"], "") + r["bases"]
                assert len(r["bases"]) <= 64 and r["seqid"] == r["header"].split()[0] and r["offset"] == 64 * r["tile"]
            assert got == ({"other file": "ACGTAC"} if more is None else want | more)
            assert {r["header"]: r["length"] for r in rows} == {h: len(s) for h, s in got.items()}
        lower = text.read_fasta_tiles(spark, str(tmp_path / "b.fa"), lower=True).first()
        assert lower["bases"] == "acgtac"
        all_ = text.read_fasta_tiles(spark, str(tmp_path), size=64)
        assert all_.select("header").distinct().count() == len(want) + 2
        beds = spark.createDataFrame([("s6", 60, 70, 3, "+"), ("s6", 19_990, 20_000, 3, "-"), ("s5", 4_999, 5_001, 1, "+")], "seqid string, start long, end long, period int, strand string")
        out = extract.arrays_of_tiles(text.read_fasta_tiles(spark, str(tmp_path / "a.fa"), size=64), beds, "p", 64).collect()
        seq = records[6][1]
        back = seq[19_990:].translate(str.maketrans("ACGT", "TGCA"))[::-1]
        assert sorted(r["trf_array"] for r in out) == sorted([seq[60:70], back])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_records_end_at_lines_of_slashes(spark, tmp_path):
    (tmp_path / "x.stk").write_text("#=GF ID one\n#=GF DR see https://example.org/a//b\n#=GF TP Repeat\n#=GF SQ 3\n//\n#=GF ID two\n#=GF TP Repeat\n#=GF SQ 4\n//\n")
    assert [tuple(r) for r in text.stockholm_totals(spark, str(tmp_path / "x.stk")).collect()] == [("Repeat", 2, 7)]
