"""Places in orders, attributes copied by key, unit components with taxa and guided regions against plain Python."""

import random

from pyspark.sql import functions as F

from arrayloom.operators import classify, families, intervals, orders, tiles
from arrayloom.sources import text


def test_places_are_those_of_a_sort(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.choice([None, 1, 2, 3]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "s string, x int, i int").repartition(5)
    got = {r["i"]: r["no"] for r in orders.places(df, [F.desc("s"), F.asc_nulls_last("x"), F.col("i")]).collect()}
    order = sorted(rows, key=lambda r: (-ord(r[0]), r[1] is None, r[1] or 0, r[2]))
    assert [got[r[2]] for r in order] == list(range(500))
    # ties take the places between them, each once
    assert sorted(r["no"] for r in orders.places(df, ["s"]).collect()) == list(range(500))
    assert orders.places(df.where("false"), ["s"], "place").columns == ["s", "x", "i", "place"]
    assert orders.places(df.where("false"), ["s"]).count() == 0


def test_orders(spark):
    df = spark.createDataFrame([("b", 1, 9, "p"), ("a", 5, 6, "q"), ("a", 2, 9, "r"), ("b", 1, 4, "s")], "seqid string, l_ind int, r_ind int, trf_id string")
    assert [r["trf_id"] for r in orders.in_sequence(df, "seqid", "l_ind", "trf_id").collect()] == ["r", "q", "p", "s"]
    assert [r["trf_id"] for r in orders.repeats_by_place(df).collect()] == ["s", "p", "r", "q"]
    assert [tuple(r) for r in orders.dictionary_by_value(df, "trf_id", "r_ind").collect()] == [(4, "s"), (6, "q"), (9, "p"), (9, "r")]
    assert [tuple(r) for r in orders.dictionary_by_value(df, "trf_id", "r_ind", descending=True).collect()] == [(9, "p"), (9, "r"), (6, "q"), (4, "s")]


def test_attributes_are_copied_where_names_match(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z"), ("c", 4, None)], "trf_id string, n int, kept string")
    new = spark.createDataFrame([("a", 10, 0), ("b", None, 0), (None, 30, 0), ("d", 40, 0), ("c", 8, 0), ("c", 7, 0)], "trf_id string, n int, other int")
    got = classify.with_attributes(rows, new)
    assert got.columns == ["trf_id", "n", "kept"]
    assert {(r["trf_id"], r["n"], r["kept"]) for r in got.collect()} == {("a", 10, "x"), ("b", None, "y"), (None, 3, "z"), ("c", 7, None)}
    assert classify.with_attributes(rows, new.select("trf_id", "other")).collect() == rows.collect()


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_unit_components_and_their_annotation(spark):
    rng = random.Random(11)
    units = sorted({"".join(rng.choice("ACGT") for _ in range(rng.choice([5, 8, 9]))) for _ in range(60)})
    back = str.maketrans("ACGT", "TGCA")
    of = {u: u for u in units}

    def top(u):
        return u if of[u] == u else top(of[u])

    for a in units:
        for b in units:
            if a < b and min(edits(a, b), edits(a, b.translate(back)[::-1])) <= 2:
                lo, hi = sorted((top(a), top(b)))
                of[hi] = lo
    got = {r["id"]: r["comp"] for r in families.unit_components(spark.createDataFrame([(u,) for u in [*units, units[0], None]], "motif string"), 2).collect()}
    assert got == {u: top(u) for u in units}

    bp = {u: 10 + i for i, u in enumerate(units)}
    members = spark.createDataFrame([(u, got[u], bp[u], u) for u in units], "id string, comp string, bp long, motif string")
    known = [(u, t) for i, u in enumerate(units) for t in ("human", "mouse", "rat") if (i + len(t)) % 3 == 0]
    out = {r["comp"]: r for r in families.annotated_components(members, spark.createDataFrame([*known, *known[:3], (units[0], None), ("none", "yeast")], "motif string, taxon string")).collect()}
    comps = {c: [u for u in units if got[u] == c] for c in set(got.values())}
    assert set(out) == set(comps)
    order = sorted(comps, key=lambda c: (-sum(bp[u] for u in comps[c]), c))
    for c, us in comps.items():
        has = {t for u, t in known if u in us}
        assert out[c]["taxa"] == " ".join(f"{t}{int(t in has)}" for t in ("human", "mouse", "rat", "yeast"))
        assert out[c]["n"] == len(us) and out[c]["bp"] == sum(bp[u] for u in us) and out[c]["no"] == order.index(c)
        assert out[c]["motif_sizes"] == {n: sum(len(u) == n for u in us) for n in {len(u) for u in us}}


def test_annotation_without_taxa(spark):
    members = spark.createDataFrame([("A", "A", 5, "A")], "id string, comp string, bp long, motif string")
    none = spark.createDataFrame([], "motif string, taxon string")
    assert [(r["comp"], r["taxa"], r["no"]) for r in families.annotated_components(members, none).collect()] == [("A", "", 0)]
    assert families.annotated_components(members.where("false"), none).count() == 0


def test_guided_regions(spark):
    lengths = spark.createDataFrame([("one", 950), ("none", 900), ("whole", 700), ("short", 10), ("poor", 900)], "seqid string, length int")
    low = [("one", 0, 100, 5), ("one", 50, 150, 5), ("one", 100, 200, 50), ("one", 230, 330, 5), ("one", 280, 380, 5), ("one", 800, 900, 1), ("one", 850, 1000, 1), ("one", 500, 560, 1)]
    windows = spark.createDataFrame([*low, *[("one", a, a + 60, 90) for a in (210, 400, 600)], ("poor", 0, 900, 99), ("none", 0, 900, 80)], "seqid string, start long, end long, unique_kmers long")
    got = intervals.guided_regions(lengths, windows, threshold=10, least_span=100, gap=80, least=120)
    # the runs (0, 150) and (230, 380) are 80 apart, the run of 60 letters is too short, a profiled sequence without runs has no part
    want = {("one", 0, 380, "one__0_380"), ("one", 800, 950, "one__800_950"), ("whole", 0, 700, "whole__0_700")}
    assert {tuple(r) for r in got.collect()} == want
    letters = tiles.cut_spans(got, tiles.tiled(spark.createDataFrame([("one", "ACGTN" * 190)], "seqid string, seq string"), 64), 64)
    assert {r["head"]: r["bases"] for r in letters.collect()} == {"one__0_380": "ACGTN" * 76, "one__800_950": "ACGTN" * 30}
    # without a profile every sequence of some length is whole
    assert {r["seqid"] for r in intervals.guided_regions(lengths, windows.where("false"), least=800).collect()} == {"one", "none", "poor"}


def test_dictionary_lines(spark):
    lines = spark.createDataFrame([("a\t1",), ("b\t",), ("alone",), ("c\t3\tmore",), ("",), (None,)], "value string")
    got = text.parse_dictionary(lines, F.upper)
    assert {tuple(r) for r in got.collect()} == {("a", "1"), ("b", ""), ("c", "3")}
