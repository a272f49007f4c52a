"""Cosine neighbours, spanning forests and clusters at thresholds against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrayloom.operators import forest, neighbours, similarity
from arrayloom.plans.joins import array_rows, neighbour_rows

OTHER = str.maketrans("ACGT", "TGCA")


def counts(seq, k=5):
    words = [w for i in range(len(seq) - k + 1) if not (w := seq[i : i + k].upper()).strip("ACGT")]
    return Counter(min(w, w.translate(OTHER)[::-1]) for w in words)


def classes_of(arrays, k=5):
    """{class: (counts, number)} and {id: class}."""
    by = defaultdict(list)
    for i, s in arrays:
        by[tuple(sorted(counts(s, k).items()))].append(i)
    return {min(ids): (dict(v), len(ids)) for v, ids in by.items() if v}, {i: min(ids) if v else None for v, ids in by.items() for i in ids}


def all_pairs(classes, most, only=None):
    """Pairs within the distance, every class of `only` (all, if not given) against all."""
    names = sorted(classes)
    kmers = {x: i for i, x in enumerate(sorted({x for v, _ in classes.values() for x in v}))}
    m = np.zeros((len(names), len(kmers)))
    for i, c in enumerate(names):
        for x, n in classes[c][0].items():
            m[i, kmers[x]] = n
    square = (m * m).sum(1)
    out = {}
    for i, c in enumerate(names):
        if only is None or c in only:
            d = np.maximum(1 - m @ m[i] / np.sqrt(square * square[i]), 0)
            out |= {(min(c, names[j]), max(c, names[j])): d[j] for j in np.flatnonzero(d <= most).tolist() if j != i}
    return out


def noisy_repeats(seed, n):
    rng = random.Random(seed)
    units = ["".join(rng.choices("ACGT", k=rng.randint(1, 30))) for _ in range(8)]
    out = []
    for i in range(n):
        s = list((rng.choice(units) * 60)[: rng.randint(0, 120)])
        for _ in range(rng.randint(0, 6)):
            if s:
                s[rng.randrange(len(s))] = rng.choice("ACGTNacg")
        s = "".join(s)
        out.append((f"r{i:04d}", s if rng.random() < 0.5 else s.translate(OTHER)[::-1]))
    return out


@pytest.mark.parametrize("block", [7, neighbours.BLOCK])
@pytest.mark.parametrize(("k", "most"), [(5, 0.2), (3, 0.05), (5, 0.6)])
def test_neighbours_equal_all_pairs(spark, monkeypatch, block, k, most):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    arrays = [*noisy_repeats(1, 240), ("none", None), ("short", "ACG"), ("ns", "NNNNNNNN")]
    near, members = neighbours.cosine_neighbours(spark.createDataFrame(arrays, "id string, seq string").repartition(3), most, k, 100.0)
    classes, of = classes_of([(i, s or "") for i, s in arrays], k)
    want = {p: d for p, d in all_pairs(classes, most).items()}
    rows = near.collect()
    assert len(rows) == len(want) and {(r["id_a"], r["id_b"]) for r in rows} == set(want)
    assert all(r["n_a"] == classes[r["id_a"]][1] and r["n_b"] == classes[r["id_b"]][1] and abs(r["distance"] - 100 * want[r["id_a"], r["id_b"]]) < 1e-9 for r in rows)
    assert {r["id"]: r["class"] for r in members.collect()} == of


def test_neighbours_need_a_common_kmer(spark):
    two = spark.createDataFrame([("a", "AAAAAAAA"), ("b", "CCCCCCCC"), ("c", "GGGGGGG"), ("d", "TTTTTT")], "id string, seq string")
    near, members = neighbours.cosine_neighbours(two, 0.5)
    assert [(r["id_a"], r["id_b"], round(r["distance"], 9)) for r in sorted(near.collect())] == [("a", "d", 0.0), ("b", "c", 0.0)]  # of other lengths, on other strands
    assert neighbours.cosine_neighbours(two.where("false"), 0.5)[0].count() == 0
    for bad in (1.0, -0.1):
        with pytest.raises(ValueError, match="below 1"):
            neighbours.cosine_neighbours(two, bad)
    with pytest.raises(ValueError, match="odd"):
        neighbours.canonical_counts(two, 4)


def test_prefixes_leave_out_frequent_kmers(spark):
    arrays = [(i, ("ACGTTGCA" * 4) + "".join(random.Random(i).choices("ACGT", k=24))) for i in range(100)]
    classes, _ = neighbours.vector_classes(neighbours.canonical_counts(spark.createDataFrame(arrays, "id long, seq string")))
    kept = {r["kmer"]: r["n"] for r in neighbours.prefixes(classes, 0.8).groupBy("kmer").agg(F.count("*").alias("n")).collect()}
    often = {x for x, n in Counter(k for _, s in arrays for k in counts(s)).items() if n == 100}
    assert len(often) >= 4 and sum(kept.get(x, 0) < 20 for x in often) >= 2


def test_registered_neighbours_by_brute_force(spark, sf):
    """Ids divisible by 20 (in order of the id) against all arrays of the smallest table."""
    arrays = sorted(map(tuple, array_rows(spark, sf).select("id", "seq").collect()))
    classes, _ = classes_of(arrays)
    some = set(sorted(classes)[::20])
    want = all_pairs(classes, 0.2, some)
    got = {(r["id_a"], r["id_b"]): r["distance"] for r in neighbour_rows(spark, sf).collect()}
    mine = {p: d for p, d in got.items() if p[0] in some or p[1] in some}
    assert set(mine) == set(want) and all(abs(d - want[p]) < 1e-6 for p, d in mine.items())


def union(n, edges):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    taken = []
    for d, a, b in sorted(edges):
        x, y = find(a), find(b)
        if x != y:
            up[max(x, y)] = min(x, y)
            taken.append((d, a, b))
    return [find(x) for x in range(n)], taken


def graph(seed, n, m):
    rng = random.Random(seed)
    return [(rng.choice([0.5, 1.0, 1.5, 2.0, rng.uniform(0, 6)]), *sorted(rng.sample(range(n), 2))) for _ in range(m)]


@pytest.mark.parametrize(("seed", "n", "m"), [(1, 60, 70), (2, 40, 300), (3, 30, 8)])
def test_forest_and_levels(spark, seed, n, m):
    edges = graph(seed, n, m)
    least = {}
    for d, a, b in edges:
        least[a, b] = min(d, least.get((a, b), d))
    plain = [(d, a, b) for (a, b), d in least.items()]
    df = spark.createDataFrame([(b, a, d) for d, a, b in edges] + [(1, 1, 0.0)], "id_a long, id_b long, distance double")
    tree = forest.spanning_forest(df)
    assert sorted((r["distance"], r["id_a"], r["id_b"]) for r in tree.collect()) == sorted(union(n, plain)[1])
    labels = defaultdict(dict)
    for r in forest.level_labels(tree, [0.5, 1, 2.5, 7]).collect():
        labels[r["level"]][r["id"]] = r["comp"]
    for level in (0.5, 1.0, 2.5, 7.0):
        want, _ = union(n, [e for e in plain if e[0] < level])
        assert [labels[level].get(i, i) for i in range(n)] == want


def test_long_path(spark):
    df = spark.range(300).select(F.col("id").alias("id_a"), (F.col("id") + 1).alias("id_b"), (F.col("id") % 7).cast("double").alias("distance"))
    tree = forest.spanning_forest(df)
    assert tree.count() == 300
    assert forest.level_labels(tree, [7]).select("comp").distinct().count() == 1


def plain_clusters(n, edges, size, periods, level):
    """[(members, name, component)] of clusters of four or more, by sizes of classes."""
    comp, _ = union(n, [e for e in edges if e[0] < level])
    by = defaultdict(list)
    for c in range(n):
        by[comp[c]] += [(c, p) for p in periods[c]]
    large = sorted((len(x), c) for c, x in by.items() if len(x) > 3)
    return {c: (f"{i}_{sorted(p for _, p in by[c])[k // 2]}", k) for i, (k, c) in enumerate(large)}, comp


@pytest.mark.parametrize("seed", [4, 5])
def test_clusters_and_flow(spark, seed):
    n, rng = 50, random.Random(seed)
    edges = [e for e in {(round(d, 6), a, b) for d, a, b in graph(seed, n, 80)}]
    best = {}
    for d, a, b in edges:
        best[a, b] = min(d, best.get((a, b), d))
    edges = [(d, a, b) for (a, b), d in best.items()]
    periods = [[rng.randint(1, 9) for _ in range(rng.choice([1, 1, 1, 2, 5]))] for _ in range(n)]
    members = [(f"{c}.{i}", c, p) for c in range(n) for i, p in enumerate(periods[c])]
    df = spark.createDataFrame([*members, ("x", None, 3)], "id string, class long, period int")
    tree = forest.spanning_forest(spark.createDataFrame([(a, b, d) for d, a, b in edges], "id_a long, id_b long, distance double"))
    for level in (1, 2.5):
        named, comp = plain_clusters(n, edges, None, periods, level)
        want = {i: named[comp[c]][0] if comp[c] in named else "SING" for i, c, _ in members} | {"x": "SING"}
        assert {r["id"]: r["name"] for r in forest.named_arrays(df, tree, level).collect()} == want
    # the flow, level by level
    want, last, n_comp = [], None, None
    for level in range(int(max(d for d, _, _ in union(n, edges)[1])), 0, -1):
        named, comp = plain_clusters(n, edges, None, periods, level)
        if len(set(comp)) == n_comp:
            continue
        n_comp = len(set(comp))
        for c, (name, size) in named.items():
            source = None if last is None else f"{last[0]}_{last[1][last[2][c]][0]}"
            want.append((level, source, f"{level}_{name}", size))
        last = (level, named, comp)
    assert sorted(map(str, want)) == sorted(str((r["level"], r["source"], r["target"], r["value"])) for r in forest.threshold_flow(df, tree).collect())


def test_flow_without_edges(spark):
    none = spark.createDataFrame([], "id_a long, id_b long, distance double")
    members = spark.createDataFrame([("a", 1, 3)] * 5, "id string, class long, period int")
    assert forest.threshold_flow(members, forest.spanning_forest(none)).count() == 0
    assert {r["name"] for r in forest.named_arrays(members, forest.spanning_forest(none)).collect()} == {"0_3"}


def test_clusters_below_a_level_look_for_no_other_pairs(spark, sf):
    """d05_array_clusters: the pairs it asks for are those below its level, and names are as with more pairs."""
    from arrayloom.plans import joins

    members, near = joins.array_clusters(spark, sf, 0.01 + 1e-9)
    every = similarity._written(joins.array_clusters(spark, sf, 0.05)[1])
    assert near.agg(F.max("distance")).first()[0] <= 1 + 1e-6 < every.agg(F.max("distance")).first()[0]
    want = {r["id"]: r["name"] for r in forest.named_arrays(members, every, 1).collect()}
    assert {r["id"]: r["name"] for r in joins.clusters_below(spark, sf).collect()} == want


def test_pairs_come_out_of_one_list(spark):
    """A pair that shares many k-mers is emitted once, and an index row holds places, not k-mers."""
    arrays = spark.createDataFrame([(i, "ACGTTGCATTAGGCA" * 3 + "ACGT"[i]) for i in range(4)], "id long, seq string")
    classes, _ = neighbours.vector_classes(neighbours.canonical_counts(arrays))
    placed = neighbours._placed(classes, 0.5)
    assert dict(placed.dtypes) == {"class": "bigint", "at": "array<int>", "c": "array<bigint>", "m": "int"}
    kept = {r["class"]: r["n"] for r in neighbours.prefixes(classes, 0.5).groupBy("class").agg(F.count("*").alias("n")).collect()}
    assert {r["class"]: r["m"] for r in placed.collect()} == kept and max(kept.values()) > 1
    near = neighbours.cosine_neighbours(arrays, 0.5)[0]
    assert sorted((r["id_a"], r["id_b"]) for r in near.collect()) == [(a, b) for a in range(4) for b in range(a + 1, 4)]


def test_many_kmers_have_their_places_from_a_table(spark, monkeypatch):
    arrays = spark.createDataFrame(noisy_repeats(2, 60), "id string, seq string")
    classes, _ = neighbours.vector_classes(neighbours.canonical_counts(arrays))
    rows = lambda: sorted((r["class"], r["at"], r["c"], r["m"]) for r in neighbours._placed(classes, 0.8).collect())
    fixed = rows()
    monkeypatch.setattr(neighbours, "FIXED", 3)
    assert rows() == fixed


def plain_array_pairs(arrays, most, k=5):
    classes, of = classes_of(arrays, k)
    near = all_pairs(classes, most)
    out = {}
    for n, (i, _) in enumerate(arrays):
        for j, _ in arrays[n + 1 :]:
            a, b = of[i], of[j]
            if a is not None and b is not None:
                d = 0.0 if a == b else near.get((min(a, b), max(a, b)))
                if d is not None:
                    out[min(i, j), max(i, j)] = d
    return out


@pytest.mark.parametrize(("dense", "pairs"), [(7, 100), (neighbours.DENSE, neighbours.PAIRS)])
@pytest.mark.parametrize(("k", "most"), [(5, 0.2), (3, 0.6)])
def test_every_pair_of_arrays(spark, monkeypatch, dense, pairs, k, most):
    """Arrays of equal vectors are pairs too, and a class stands for none of its arrays."""
    monkeypatch.setattr(neighbours, "DENSE", dense)
    monkeypatch.setattr(neighbours, "PAIRS", pairs)
    arrays = [*noisy_repeats(3, 60), *((f"s{i}", s) for i, s in noisy_repeats(3, 40)), ("none", None), ("short", "ACG"), ("ns", "NNNNNNNN")]
    got = [tuple(r) for r in neighbours.array_pairs(spark.createDataFrame(arrays, "id string, seq string").repartition(3), most, k).collect()]
    want = plain_array_pairs([(i, s or "") for i, s in arrays], most, k)
    assert len(got) == len(want) and {(a, b) for a, b, _ in got} == set(want)
    assert all(abs(d - want[a, b]) < 1e-8 for a, b, d in got) and min(want.values()) == 0
    assert neighbours.array_pairs(spark.createDataFrame([], "id string, seq string"), most, k).count() == 0


def test_registered_neighbours_hold_arrays_of_one_class(spark, sf):
    from arrayloom.plans.registry import QUERIES

    arrays = sorted(map(tuple, array_rows(spark, sf).select("id", "seq").collect()))
    classes, of = classes_of(arrays)
    near = all_pairs(classes, 0.2)
    own = sum(n * (n - 1) // 2 for _, n in classes.values())
    want = own + sum(classes[a][1] * classes[b][1] for a, b in near)
    rows = QUERIES["j14_array_neighbours"](spark, sf).collect()
    assert own and len(rows) == want == len({(r["id_a"], r["id_b"]) for r in rows})
    assert sum(of[r["id_a"]] == of[r["id_b"]] for r in rows) == own


@pytest.mark.parametrize(("dense", "edges"), [(7, 20), (neighbours.DENSE, neighbours.EDGES)])
def test_forest_of_blocks_connects_what_all_pairs_connect(spark, monkeypatch, dense, edges):
    monkeypatch.setattr(neighbours, "DENSE", dense)
    monkeypatch.setattr(neighbours, "EDGES", edges)
    arrays = noisy_repeats(4, 150)
    df = spark.createDataFrame(arrays, "id string, seq string")
    near, members = neighbours.near_forest(df, 0.5, scale=100.0)
    found = [tuple(r) for r in near.collect()]
    classes, of = classes_of(arrays)
    every = {p: 100 * d for p, d in all_pairs(classes, 0.5).items()}
    assert all(abs(every[a, b] - d) < 1e-8 for a, b, d in found) and len(found) < len(every)
    assert {r["id"]: r["class"] for r in members.collect()} == of
    place = {c: i for i, c in enumerate(sorted(classes))}
    for level in (5, 20, 33.3, 50):
        want, _ = union(len(place), [(d, place[a], place[b]) for (a, b), d in every.items() if d < level])
        assert union(len(place), [(d, place[a], place[b]) for a, b, d in found if d < level])[0] == want


@pytest.mark.parametrize("few", [0, 5, similarity.FEW])
def test_components_and_forests_in_rounds_or_at_once(spark, monkeypatch, few):
    monkeypatch.setattr(similarity, "FEW", few)
    n, edges = 40, graph(6, 40, 60)
    best = {}
    for d, a, b in edges:
        best[a, b] = min(d, best.get((a, b), d))
    plain = [(d, a, b) for (a, b), d in best.items()]
    df = spark.createDataFrame([(a, b, d) for d, a, b in plain] + [(3, None, 0.1), (5, 5, 0.2)], "id_a long, id_b long, distance double")
    comp, taken = union(n, plain)
    assert {r["id"]: r["comp"] for r in similarity.connected_components(df).collect()} == {i: comp[i] for i in range(n) if any(i in (a, b) for _, a, b in plain) or i == 5}
    assert sorted((r["distance"], r["id_a"], r["id_b"]) for r in forest.spanning_forest(df).collect()) == sorted(taken)


def test_a_level_follows_its_own_edges_alone(spark, monkeypatch):
    """Labels of 20 levels of a path: every edge is joined at one level, not at all levels above it."""
    seen = []
    inner = forest.connected_components
    monkeypatch.setattr(forest, "connected_components", lambda e: seen.append(e.count()) or inner(e))
    tree = spark.range(100).select(F.col("id").alias("id_a"), (F.col("id") + 1).alias("id_b"), (F.col("id") % 20).cast("double").alias("distance"))
    rows = forest.level_labels(tree, list(range(1, 21))).collect()
    assert sum(seen) == 100 and len({r["comp"] for r in rows if r["level"] == 20}) == 1
    assert {(r["id"], r["comp"]) for r in rows if r["level"] == 2} == {(i, i // 20 * 20) for i in range(100) if i % 20 < 3}
