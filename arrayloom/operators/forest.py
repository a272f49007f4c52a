"""Clusters of a distance graph at every threshold at once, from its minimum spanning forest.

Two nodes are connected by edges below a threshold if and only if they are by such edges of a minimum spanning forest. So the
forest, at most one edge for each node, stands for the components of every level; edges of equal distance are told apart by
their ends. It is found in Boruvka's rounds: every component takes its least edge to another one, components that these
edges join become one, and of the edges between two components the least stays. A round is a few joins and a table in the
shared folder; there are at most log2(nodes) of them. Up to similarity.FEW edges that are left are one task's.

Nodes are vector classes (see neighbours): arrays with equal vectors, which are in one cluster at every level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import similarity
from .neighbours import least_forest
from .similarity import _written, connected_components


def _roots(points: DataFrame) -> DataFrame:
    """(c, root) of points(c, o), where each component points to one other and only pairs point to each other: their lesser
    member is the root. Pointers are doubled until all stand at roots."""
    back = points.select(F.col("c").alias("o"), F.col("o").alias("back"))
    first = F.when((F.col("back") == F.col("c")) & (F.col("c") < F.col("o")), F.col("c")).otherwise(F.col("o"))
    now = _written(points.join(back, "o").select("c", first.alias("root")))
    while True:
        up = now.select(F.col("c").alias("root"), F.col("root").alias("above"))
        step = _written(now.join(up, "root").select("c", F.col("root").alias("was"), F.col("above").alias("root")))
        now = step.select("c", "root")
        if not step.where("was <> root").limit(1).count():
            return now


def _of_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(distance, a, b) of the least forest between components of rows (ca, cb, distance, a, b)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    ends = pa.chunked_array([c for x in ("ca", "cb") for c in rows.column(x).chunks]).combine_chunks().dictionary_encode()
    p, q = np.split(ends.indices.to_numpy().astype(np.int64), 2)
    order = pc.sort_indices(rows, [(c, "ascending") for c in ("distance", "a", "b")]).to_numpy().astype(np.int64)
    some = least_forest(p, q, order, len(ends.dictionary))
    yield from rows.take(pa.array(some)).select(["distance", "a", "b"]).to_batches(max_chunksize=1 << 16)


def spanning_forest(edges: DataFrame) -> DataFrame:
    """(id_a, id_b, distance), id_a < id_b: a minimum spanning forest of edges(id_a, id_b, distance); repeated edges count as
    their least distance, loops and null ends not at all."""
    a, b = F.least("id_a", "id_b"), F.greatest("id_a", "id_b")
    least = edges.where("id_a <> id_b").groupBy(a.alias("a"), b.alias("b")).agg(F.min("distance").alias("distance"))
    live = _written(least.select(F.col("a").alias("ca"), F.col("b").alias("cb"), F.struct("distance", "a", "b").alias("edge")))
    forest = live.select("edge").limit(0)
    while left := live.limit(similarity.FEW + 1).count():
        if left <= similarity.FEW and dict(live.dtypes)["ca"] in similarity.PLAIN:
            rows = live.select("ca", "cb", "edge.distance", "edge.a", "edge.b").coalesce(1)
            of = dict(rows.dtypes)
            some = rows.mapInArrow(_of_few, f"distance {of['distance']}, a {of['a']}, b {of['b']}")
            forest = forest.unionByName(some.select(F.struct("distance", "a", "b").alias("edge")))
            break
        both = live.select(F.col("ca").alias("c"), F.col("cb").alias("o"), "edge").unionByName(live.select(F.col("cb").alias("c"), F.col("ca").alias("o"), "edge"))
        best = _written(both.groupBy("c").agg(F.min(F.struct("edge", "o")).alias("m")).select("c", "m.o", "m.edge"))
        forest = forest.unionByName(best.select("edge").distinct())
        root = _roots(best.select("c", "o"))
        of = lambda c: root.select(F.col("c").alias(c), F.col("root").alias(f"r{c}"))
        moved = live.join(of("ca"), "ca").join(of("cb"), "cb").where("rca <> rcb")
        live = _written(moved.groupBy(F.least("rca", "rcb").alias("ca"), F.greatest("rca", "rcb").alias("cb")).agg(F.min("edge").alias("edge")))
    return _written(forest.select(F.col("edge.a").alias("id_a"), F.col("edge.b").alias("id_b"), F.col("edge.distance").alias("distance")))


def level_labels(forest: DataFrame, levels: list[float]) -> DataFrame:
    """(level, id, comp) of every node that has an edge of a distance below the level: the least id it is connected to by such
    edges. A level joins the components of the one below by its own edges, so an edge is followed once."""
    kind = dict(forest.dtypes)["id_a"]
    labels, found, below = None, None, None
    for x in sorted(map(float, levels)):
        own = forest.where((F.col("distance") < x) & (F.lit(True) if below is None else F.col("distance") >= below)).select("id_a", "id_b")
        nodes = own.select(F.col("id_a").alias("id")).union(own.select("id_b")).distinct()
        if labels is None:
            labels = connected_components(own)
        else:
            of = lambda c: labels.select(F.col("id").alias(c), F.col("comp").alias(f"c{c}"))  # noqa: B023, E731
            ends = own.join(of("id_a"), "id_a", "left").join(of("id_b"), "id_b", "left")
            joined = connected_components(ends.select(F.coalesce("cid_a", "id_a").alias("id_a"), F.coalesce("cid_b", "id_b").alias("id_b")).where("id_a <> id_b"))
            every = labels.unionByName(nodes.join(labels, "id", "left_anti").select("id", F.col("id").alias("comp")))
            to = joined.select(F.col("id").alias("comp"), F.col("comp").alias("into"))
            labels = _written(every.join(to, "comp", "left").select("id", F.coalesce("into", "comp").alias("comp")))
        at, below = labels.select(F.lit(x).alias("level"), "id", "comp"), x
        found = at if found is None else found.unionByName(at)
    return found if found is not None else forest.sparkSession.createDataFrame([], f"level double, id {kind}, comp {kind}")


def level_clusters(labels: DataFrame, members: DataFrame, levels: list[float], least: int = 4) -> DataFrame:
    """(level, comp, size, name) of clusters with at least so many of members(id, class, period): {rank}_{upper median period},
    ranks from 0 by rising size, ties by component. The rows of a level that are ranked are its clusters alone.

    labels(level, id, comp) are of classes; a class without a label at a level is a component of its own."""
    periods = members.where(F.col("class").isNotNull()).groupBy("class", "period").agg(F.count(F.lit(1)).alias("n"))
    every = periods.withColumn("level", F.explode(F.lit([float(x) for x in levels])))
    by = every.join(labels.withColumnRenamed("id", "class"), ["level", "class"], "left").groupBy("level", F.coalesce("comp", "class").alias("comp"), "period").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("level", "comp")
    by = by.withColumns({"upto": F.sum("n").over(own.orderBy("period")), "size": F.sum("n").over(own)}).where(F.col("size") >= least)
    # the upper median is the period at place size // 2, counted from 0
    half = by.where(F.col("upto") > F.floor(F.col("size") / 2)).groupBy("level", "comp", "size").agg(F.min("period").alias("median"))
    rank = F.row_number().over(Window.partitionBy("level").orderBy("size", "comp")) - 1
    return half.select("level", "comp", "size", F.concat_ws("_", rank.cast("string"), F.col("median").cast("string")).alias("name"))


def named_arrays(members: DataFrame, forest: DataFrame, level: float = 1, least: int = 4) -> DataFrame:
    """(id, name) of members(id, class, period): the cluster of distances below the level that an array is in, SING for arrays of
    smaller ones and for arrays in no class."""
    labels = _written(level_labels(forest, [level]))
    clusters = _written(level_clusters(labels, members, [level], least).select("comp", "name"))
    of = labels.select(F.col("id").alias("class"), "comp")
    rows = members.join(of, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    return rows.join(clusters, "comp", "left").select("id", F.coalesce("name", F.lit("SING")).alias("name"))


def threshold_flow(members: DataFrame, forest: DataFrame, least: int = 4) -> DataFrame:
    """(level, source, target, value): for each cluster, its members, and the cluster of the level before that it came out of.

    Levels fall from the whole part of the largest distance to 1; one at which no component breaks up is left out. Names are
    {level}_{rank}_{upper median period}; the first level's clusters have no source and stand for themselves (source null)."""
    top = int(forest.agg(F.max("distance")).first()[0] or 0)
    # edges that fall away between a level and the one below say whether a component breaks up: one row for each level
    levels = [float(x) for x in range(top, 0, -1)]
    below = {r["level"]: r["n"] for r in forest.withColumn("level", F.explode(F.filter(F.lit(levels), lambda x: x > F.col("distance")))).groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()} if levels else {}
    kept: list[float] = []
    for x in levels:
        if not kept or below.get(x, 0) != below.get(kept[-1], 0):
            kept.append(x)
    if not kept:
        return members.sparkSession.createDataFrame([], "level int, source string, target string, value long")
    labels = _written(level_labels(forest, kept))
    clusters = level_clusters(labels, members, kept, least)
    clusters = _written(clusters.withColumn("name", F.concat_ws("_", F.col("level").cast("int").cast("string"), "name")))
    before = F.create_map(*[F.lit(x) for pair in zip(kept[1:], kept[:-1], strict=True) for x in pair]) if len(kept) > 1 else F.create_map(F.lit(-1.0), F.lit(-1.0))
    to = clusters.withColumn("earlier", F.element_at(before, F.col("level")))
    # the component of the level before, by the cluster's own least class
    at = labels.select(F.col("level").alias("earlier"), F.col("id").alias("comp"), F.col("comp").alias("came"))
    to = to.join(at, ["earlier", "comp"], "left").withColumn("came", F.coalesce("came", "comp"))
    names = clusters.select(F.col("level").alias("earlier"), F.col("comp").alias("came"), F.col("name").alias("source"))
    return to.join(names, ["earlier", "came"], "left").select(F.col("level").cast("int").alias("level"), "source", F.col("name").alias("target"), F.col("size").alias("value"))
