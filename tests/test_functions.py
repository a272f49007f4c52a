"""Exact values of the sequence functions, scans of files, streams and clusters."""

import gzip

import pytest
from pyspark.sql import functions as F

from arrayloom import schemas
from arrayloom.functions import seqfn
from arrayloom.operators import extract, families, gaps, intervals, overlaps, similarity, telomeres
from arrayloom.sources import sinks, text
from arrayloom.streaming import incremental


def values(spark, column, inputs):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(inputs)], "i int, s string")
    return [r["v"] for r in df.select("i", column(F.col("s")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (seqfn.gc_fraction, {"ATGC": 0.5, "AAAA": 0.0, "GGCC": 1.0, "": 0.0, "A": 0.0, "G": 1.0, "ATGATGATG": 1 / 3}),
        (seqfn.revcomp_drop, {"ATGC": "GCAT", "GAATTC": "GAATTC", "": "", "N": "N", "AtCg": "cGaT"}),
        (seqfn.revcomp_n, {"ATNCG": "CGNAT", "AXT": "ANT"}),
        (seqfn.revcomp, {"AXT": "AXT", "ACG": "CGT"}),
        (seqfn.clean_sequence, {"A1T2G3C4": "ATGC", "AtGc\n\tXYZ": "ATGCY"}),
        (seqfn.entropy, {"AAAA": 0.0, "ATCG": 2.0, "": 0.0}),
        (seqfn.canonical, {"CTA": "ACT", "AGT": "ACT", "GTA": "ACT", "ACT": "ACT"}),
        (seqfn.primitive_root, {"ACTACTACT": "ACT", "AAAA": "A", "ACG": "ACG"}),
        (seqfn.lenient_int, {"123": 123, "12.0": 12, "": 0, "not-a-number": 0}),
        (lambda s: seqfn.percent_match(s, F.lit(3)), {"ATGATGATG": 100.0, "ATGATCATG": 89.0}),
        (lambda s: seqfn.percent_match(s, F.lit(5)), {"ATCGATCGAT": 50.0}),
        (seqfn.chromosome_name, {"x chromosome 1, y": "1", "chrX complete sequence": "X", "a mitochondrion genome": "MT", "q": "?"}),
    ],
)
def test_values(spark, function, cases):
    got = values(spark, function, list(cases))
    assert got == pytest.approx(list(cases.values())) if isinstance(got[0], float) else got == list(cases.values())


def test_restored_coordinates(spark):
    df = spark.createDataFrame([("chr10__127750000_127925000", 80932, 91887), ("chr1__1000000", 5, 9)], "h string, l long, r long")
    out = [tuple(r["v"]) for r in df.select(seqfn.restored_coordinates(F.col("h"), F.col("l"), F.col("r")).alias("v")).collect()]
    assert out == [("chr10", 127830932, 127841887), ("chr1__1000000", 5, 9)]


def test_extraction(spark):
    seqs = spark.createDataFrame([("chr1 long name", "ATCGATCGATTT")], "seqid string, seq string")
    beds = spark.createDataFrame([("chr1", 0, 10, 5, "+"), ("chr1", 5, 13, 5, "+"), ("chr1", -1, 5, 5, "+"), ("chr1", 9, 4, 5, "+")], "seqid string, start long, end long, period int, strand string")
    (row,) = extract.extract_arrays(seqs, beds, "p").collect()
    assert (row["trf_l_ind"], row["trf_r_ind"], row["trf_consensus"], row["trf_pmatch"], row["trf_n_copy"]) == (1, 10, "ATCGA", 50.0, 2.0)


def test_fasta_and_tables(spark, tmp_path):
    body = ">chr1 first\nACGT\nNNac\n>chr2\nGG\n"
    (tmp_path / "a.fa").write_text(body)
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(body)
    for name in ("a.fa", "b.fa.gz"):
        out = sorted(tuple(r) for r in text.read_fasta(spark, str(tmp_path / name)).collect())
        assert out == [("chr1", "chr1 first", "ACGTNNac", 8), ("chr2", "chr2", "GG", 2)]
    row = ["p", "i", "chr1", "1", "9", "3", "3.0", "90.0", "10.0", "1.5", "ACG", "ACGACGACG", "0.67", "0.67", "9", "0", "None", "None"]
    (tmp_path / "t.sat").write_text("# Fields: " + ",".join(schemas.names(schemas.SAT)) + "\n" + "\t".join(schemas.names(schemas.SAT)) + "\n" + "\t".join(row) + "\n")
    (got,) = text.read_sat(spark, str(tmp_path / "t.sat")).collect()
    assert got["trf_r_ind"] == 9 and got["trf_family"] is None
    text.check_fields(spark, str(tmp_path / "t.sat"))
    with pytest.raises(ValueError, match="do not match"):
        text.check_fields(spark, str(tmp_path / "t.sat"), schemas.FAI)
    (tmp_path / "x.dat").write_text("Sequence: chr1 one\n\nParameters: 2 7 7\n\n1 9 3 3.0 3 90 0 40 33 33 33 0 1.5 ACG ACGACGACG\nSequence: chr2\n\n")
    (hit,) = text.read_trf_dat(spark, str(tmp_path)).collect()
    assert (hit["head"], hit["start"], hit["array"]) == ("chr1 one", 1, "ACGACGACG")
    assert text.read_files(spark, str(tmp_path), "*.fa").count() == 1
    sinks.write_store(spark.createDataFrame([("p", 1), ("q", 2)], "project string, x int"), str(tmp_path / "store"))
    sinks.write_store(spark.createDataFrame([("q", 3)], "project string, x int"), str(tmp_path / "store"))
    assert sorted((r["project"], r["x"]) for r in spark.read.parquet(str(tmp_path / "store")).collect()) == [("p", 1), ("q", 3)]


def test_n_runs(spark):
    df = spark.createDataFrame([("a", "NNACGTnNA"), ("b", "ACGT"), ("c", "NN"), ("d", "")], "seqid string, seq string")
    assert sorted(tuple(r) for r in gaps.n_runs(df).collect()) == [("a", 0, 2, 2), ("a", 6, 8, 2), ("c", 0, 2, 2)]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "id_a int, id_b int")
    assert sorted(tuple(r) for r in similarity.connected_components(edges).collect()) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "id_a int, id_b int")
    assert {r["comp"] for r in similarity.connected_components(path).collect()} == {0}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def turned_distance(a, b):
    if len(a) != len(b):
        return edits(a, b)
    back = b.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    return min(edits(a, t[i:] + t[:i]) for t in (b, back) for i in range(len(b)))


def near_by_hand(a, b):
    long, short = max(len(a), len(b)), min(len(a), len(b))
    d = turned_distance(a, b) if long <= 2 * short else 99
    return d if d <= 3 and d * 100 // long <= 20 else None


def test_near_units_by_brute_force(spark):
    import random

    rng = random.Random(3)
    units = {"".join(rng.choice("ACGT") for _ in range(rng.choice((4, 5, 6, 9, 10, 12, 15, 16, 17, 20, 33)))) for _ in range(60)}
    for u in list(units)[:40]:
        v = list(u)
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(v))
            v[i : i + 1] = rng.choice((["A"], ["C", v[i]], []))
        i = rng.randrange(len(v) + 1)
        units.add("".join(v[i:] + v[:i]) if rng.random() < 0.5 else "".join(v))
    units = sorted(u for u in units if u)
    df = spark.createDataFrame([(u,) for u in units], "s string")
    got = {(r["a"], r["b"]): r["distance"] for r in families.near_pairs(df, df).collect()}
    want = {(a, b): d for a in units for b in units if a != b and (d := near_by_hand(a, b)) is not None}
    assert got == want and len(want) > 40


def test_families_by_hand(spark):
    """Units lead by number of arrays; later ones join the first leader near them, not one that has joined another."""
    import random

    rng = random.Random(4)
    base = ["".join(rng.choice("ACGT") for _ in range(n)) for n in (14, 15, 16, 20)]
    rows = []
    for k, u in enumerate(base):
        for step in range(4):
            v = u[:step] + "".join("TGCA"["ACGT".index(x)] for x in u[step : step + 2]) + u[step + 2 :] if step else u
            for i in range(rng.randint(1, 5)):
                turn = rng.randrange(len(v))
                rows.append((f"s{k}", 100 * len(rows), 100 * len(rows) + 50, rng.choice((12000, 500, 99)), len(v), (v[turn:] + v[:turn]) * rng.choice((1, 2))))
    got = families.family_table(spark.createDataFrame(rows, "seqid string, start long, end long, array_length long, period int, consensus string")).collect()

    def unit(s):
        n = next(d for d in range(1, len(s) + 1) if len(s) % d == 0 and s[:d] * (len(s) // d) == s)
        r = s[:n]
        return min(t[i:] + t[:i] for t in (r, r.translate(str.maketrans("ACGT", "TGCA"))[::-1]) for i in range(n))

    count, lead, order = {}, {}, []
    for r in rows:
        if r[3] >= 10000:
            count[unit(r[5])] = count.get(unit(r[5]), 0) + 1
    for u in sorted(count, key=lambda u: (-count[u], u)):
        first = next((x for x in order if near_by_hand(u, x) is not None), None)
        lead[u] = first or u
        if first is None:
            order.append(u)
    want = []
    for r in rows:
        u = unit(r[5])
        if r[3] >= 10000:
            want.append((r[1], f"SF{order.index(lead[u]):04d}", "core"))
        elif r[3] >= 100:
            fit = [i for i, x in enumerate(order) if x == u or near_by_hand(u, x) is not None]
            want += [(r[1], f"SF{fit[0]:04d}", "enriched")] if fit else []
    assert sorted((r["start"], r["family"], r["source"]) for r in got) == sorted(want) and any(w[2] == "enriched" for w in want)


def test_refined_overlaps(spark):
    import random

    rng = random.Random(5)
    seq = "".join(rng.choice("ACGT") for _ in range(400))
    given = [("a", 1, 50, 80.0), ("b", 1, 50, 90.0), ("c", 10, 40, 99.0), ("d", 100, 160, 70.0), ("e", 130, 200, 80.0), ("f", 300, 350, 70.0), ("g", 349, 399, 70.0), ("h", 360, 380, 1.0)]
    rows = [("p", i, "chr1", l, r, 5, 1.0, m, 100 - m, 1.5, seq[l - 1 : l + 4], seq[l - 1 : r], 0.5, 0.5, r - l + 1) for i, l, r, m in given]
    names = "project string, trf_id string, trf_head string, trf_l_ind long, trf_r_ind long, trf_period int, trf_n_copy double, trf_pmatch double, trf_pvar double, trf_entropy double, trf_consensus string, trf_array string, trf_array_gc double, trf_consensus_gc double, trf_array_length long"
    out = {r["trf_id"]: r for r in overlaps.refine_overlaps(spark.createDataFrame(rows, names)).collect()}
    assert set(out) == {"b", "d", "f", "g"}  # a: worse duplicate, c and h: nested, e: merged into d; f and g share too little
    d = out["d"]
    assert (d["trf_l_ind"], d["trf_r_ind"], d["trf_array"], d["trf_joined"], d["trf_consensus"]) == (100, 200, seq[99:200], 1, seq[129:134])
    assert abs(d["trf_pmatch"] - (70 * 61 + 80 * 71) / 132) < 1e-9 and d["trf_n_copy"] == 101 / 5
    bad = [{"trf_id": i, "trf_l_ind": l, "trf_r_ind": r, "trf_pmatch": 1.0, "trf_array": "ACGT", "trf_array_length": 4} for i, l, r in (("x", 1, 10), ("y", 3, 15))]
    with pytest.raises(ValueError, match="do not fit"):
        overlaps.settle(bad)


def test_telomeres(spark):
    """Terminal runs, sites inside and exact blocks, each on sequences made for it."""
    right, left, odd = "TTAGGG", "CCCTAA", "TTACGG"
    rows = [("a", "NN" + left * 3 + "ACGTACGTAC" + right * 2 + odd + right + "nn"), ("b", "A" * 30), ("c", ""), ("d", "NNNN"), ("e", "TTTTGGGGCC" * 3 + left * 5 + "A" + right * 12 + "ACACACACAC" * 3)]
    df = spark.createDataFrame(rows, "seqid string, seq string")
    assert {tuple(r) for r in telomeres.terminal_repeats(df).collect()} == {("a", 3, 4), ("b", 0, 0), ("c", 0, 0), ("d", 0, 0), ("e", 0, 0)}
    assert [tuple(r) for r in telomeres.interstitial_sites(df, skip=10, least=10).collect()] == [("e", 61, 133, 12)]
    block = spark.createDataFrame([("x", "A" * 100 + right * 31 + "C" * 80 + left * 30 + "A" * 300 + right * 30)], "seqid string, seq string")
    assert [tuple(r) for r in telomeres.exact_blocks(block).select("seqid", "start", "end", "n").orderBy("start").collect()] == [("x", 50, 596, 2), ("x", 796, 1026, 1)]
    calls = spark.createDataFrame([("PRESENT", "PRESENT", "T2T"), ("PRESENT", "ABSENT", "INCOMPLETE")], "left_call string, right_call string, status string")
    assert tuple(telomeres.telomere_summary(calls).first()) == (2, 1, 2, 1)


def test_overlaps_by_nested_loops(spark):
    import random

    rng = random.Random(1)
    make = lambda n: [(f"s{rng.randint(0, 2)}", a := rng.randint(0, 20000), a + rng.randint(1, 6000)) for _ in range(n)]
    a, b = sorted(set(make(80))), sorted(set(make(60)))
    got = intervals.overlap_join(spark.createDataFrame(a, "seqid string, a0 long, a1 long"), spark.createDataFrame(b, "seqid string, b0 long, b1 long"))
    want = sorted((s, x, y, u, v) for s, x, y in a for t, u, v in b if s == t and x < v and u < y)
    assert sorted((r["seqid"], r["a0"], r["a1"], r["b0"], r["b1"]) for r in got.collect()) == want


def test_streams(spark, tmp_path):
    row = ("p", "i", "chr1", 1, 9, 3, 3.0, 90.0, 10.0, 1.5, "ACG", "ACGACGACG", 0.67, 0.67, 9, 0, "f", None)
    folder = str(tmp_path / "in")
    spark.createDataFrame([row], schemas.SAT).write.parquet(folder)
    stream = lambda: incremental.repeats(spark, folder)
    incremental.totals_stream(stream(), F.col("trf_family"), F.col("trf_array_length"), "totals", str(tmp_path / "c1")).awaitTermination(120)
    assert [tuple(r) for r in spark.table("totals").collect()] == [("f", 1, 9)]
    for _ in range(2):  # a finished file is not taken again
        incremental.finished(stream(), str(tmp_path / "log"), str(tmp_path / "c2")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1
    renamed = stream().selectExpr("trf_id", "trf_head AS seqid", "trf_l_ind AS l_ind", "trf_r_ind AS r_ind")
    features = spark.createDataFrame([("chr1", "gene", 1, 20)], "seqid string, type string, start long, end long")
    incremental.annotate_stream(renamed, features, str(tmp_path / "out"), str(tmp_path / "c3")).awaitTermination(120)
    assert [r["trf_ref_annotation"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["TR in gene"]


def test_more_sources(spark, tmp_path):
    def file(name, text_):
        (tmp_path / name).write_text(text_)
        return str(tmp_path / name)

    old = ["x"] * 37
    for name, v in {"trf_id": "7", "trf_head": "chr2", "trf_l_ind": "5", "trf_period": "2", "trf_pmatch": "None"}.items():
        old[text.LEGACY[name]] = v
    wide = "\t".join(old)
    lines = spark.read.text(file("mixed.txt", "# c\np\t3\tchr1\t1\t4\n" + wide + "\n"))
    layouts = {5: {"project": 0, "trf_id": 1, "trf_head": 2, "trf_l_ind": 3, "trf_r_ind": 4}, 37: text.LEGACY}
    types = {"trf_id": "string", "trf_head": "string", "trf_l_ind": "bigint", "trf_period": "int", "trf_pmatch": "double"}
    assert [tuple(r) for r in text.parse_versions(lines, layouts, types).collect()] == [("3", "chr1", 1, None, None), ("7", "chr2", 5, 2, None)]
    with pytest.raises(Exception, match="a line of 2 fields"):
        text.parse_versions(spark.read.text(file("bad.txt", "a\tb\n")), layouts, types).collect()
    head = "\t".join(c.split()[0] for c in text.TELOMERES.split(", "))
    report = text.read_telomeres(spark, file("t.tsv", head + "\nchr1\t9\t3\t3\t0.5\tPRESENT\t3\t3\t0.5\tPRESENT\tT2T\nchr2\t9\t0\t0\t0.0\tABSENT\t3\t3\t0.5\tPRESENT\tINCOMPLETE\n"))
    assert [(r["seqid"], r["t2t"]) for r in report.collect()] == [("chr1", True), ("chr2", False)]
    sites = text.read_sites(spark, file("its.bed", "chr1\t50\t60\t11\nchr1\t5\t9\t10\n")).first()
    assert [tuple(x) for x in sites["sites"]] == [(5, 9, 10), (50, 60, 11)]
    totals = text.stockholm_totals(spark, file("f.sto", "#=GF ID   a\n#=GF TP   Sat\n#=GF SQ   3\n//\n#=GF ID   b\n#=GF TP   Sat\n#=GF SQ   4\n//\n"))
    assert [tuple(r) for r in totals.collect()] == [("Sat", 2, 7)]
    pairs = text.read_dictionary(spark, file("d.tsv", "a\t1\nb\t2\n"), lambda c: c.cast("int") * 2)
    assert sorted(tuple(r) for r in pairs.collect()) == [("a", 2), ("b", 4)]
    some = text.transformed(spark.read.text(file("l.txt", "x1\ny2\n")), before=F.upper, keep=lambda v: F.startswith(v, F.lit("X")))
    assert [r["value"] for r in some.collect()] == ["X1"]


def test_names_and_chunks(spark):
    seqs = spark.createDataFrame([("a one", "A" * 30), ("b", "C" * 50), ("c", "G" * 40)], "seqid string, seq string")
    assert extract.require_unique_names(seqs).count() == 3 and extract.duplicate_names(seqs).count() == 0
    with pytest.raises(ValueError, match="first words: a"):
        extract.require_unique_names(seqs.union(spark.createDataFrame([("a two", "A")], seqs.schema)))
    rows = extract.chunked(seqs, 60).collect()
    assert sorted(r["seqid"] for r in rows) == ["a one", "b", "c"] and {r["chunk"] for r in rows} <= {0, 1} and sum(r["chunk"] == 0 for r in rows) >= 1


def test_replaced_sequences(spark, tmp_path):
    path = str(tmp_path / "sat")
    old = spark.createDataFrame([("p", "chr1", 1), ("p", "chr2", 2)], "project string, trf_head string, n int")
    old.write.partitionBy("project", "trf_head").parquet(path)
    sinks.replace_sequences(old, spark.createDataFrame([("p", "chr2", 5), ("p", "chr3", 6)], old.schema), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("trf_head", "n").collect()) == [("chr1", 1), ("chr2", 5), ("chr3", 6)]
    sinks.write_summary(old, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 2
