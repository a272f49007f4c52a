"""Families of repeats: units within few edits of each other, up to rotation and strand."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrayloom.functions import seqfn

from .orders import places
from .similarity import _written, connected_components, discard, edit_pairs, rotation_distance, sorted_side

#: Units up to this length meet on what is left after deletions, longer ones on a segment that stands unchanged.
SHORT = 18
#: Edits that deletions are made for.
MOST = 3
#: Pairs of near units up to which one task decides who leads; more of them take rounds of joins.
FEW = 1 << 22


def allowed(n: Column, most: int, percent: int) -> Column:
    """Edits that units may differ by whose longer one has n letters: at most `most`, and a whole percentage up to percent."""
    return F.least(F.lit(most), F.floor(((percent + 1) * n - 1) / 100)).cast("int")


def _reduced(words: DataFrame) -> DataFrame:
    """words(s, out, hidden, ...) with left: s without `out` of its letters and with `hidden` of the others, all of them at most,
    as dots, every way. Places are taken from left to right, so a way comes once."""
    left, at = F.col("left"), F.col("_at")
    rows = words.withColumns({"left": F.col("s"), "_at": F.lit(1), "hidden": F.least(F.col("hidden"), F.length("s") - F.col("out"))})
    for column, letter in (("out", ""), ("hidden", ".")):
        for i in range(1, MOST + 1):
            each = lambda p: F.struct(F.concat(F.substring(left, F.lit(1), p - 1), F.lit(letter), F.substring(left, p + 1, F.length(left))).alias("left"), (p + len(letter)).alias("_at"))  # noqa: B023, E731
            ways = F.when(at <= F.length(left), F.transform(F.sequence(at, F.length(left)), each))
            ways = F.when(F.col(column) < i, F.array(F.struct(left, at))).otherwise(ways)
            rows = rows.select(*[c for c in rows.columns if c not in ("left", "_at")], F.inline(ways))
        rows = rows.withColumn("_at", F.lit(1))
    return rows.drop("_at", "out", "hidden")


def near_pairs(a: DataFrame, b: DataFrame | None = None, most: int = 3, percent: int = 20) -> DataFrame:
    """(a, b, distance) of units a(s) and b(s), by default a itself, distinct and not equal, within the edits allowed for
    the longer of them.

    Of equal lengths the distance is the least over rotations and strands; else the plain one. Words within k edits are equal
    once the letters that only one of them has are left out, e of the shorter one and as many more of the longer one as it is
    longer by, and what the other edits change is hidden; cyclic words that match up to rotation leave the same cyclic word. So
    few words meet that are no result. Long words are cut into k + 1 segments, one of which stands unchanged in the other."""
    if most > MOST:
        raise ValueError(f"at most {MOST} edits")
    # few bytes that become many ways: over as many tasks as are set, not as few as the bytes would ask for
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = lambda x: x.where(F.length("s") <= SHORT).select("s", F.length("s").alias("n")).repartition(tasks, "s", "n").distinct()
    longer, n = F.greatest("n", "m"), F.col("n")

    # letters of the shorter word that the longer one has not, up to half of the edits
    only = F.array(*[F.lit(e) for e in range(most // 2 + 1)])

    def turned(x: DataFrame) -> DataFrame:
        ways = units(x).withColumn("k", allowed(n, most, percent)).where("k > 0").withColumn("out", F.explode(only))
        left = _reduced(ways.where(F.col("k") >= 2 * F.col("out")).withColumn("hidden", F.col("k") - 2 * F.col("out")))
        return _written(left.select("s", "n", seqfn.canonical(F.col("left")).alias("key")).distinct())

    def shifted(x: DataFrame) -> DataFrame:
        """For each length a partner can have: as many edits as that pair of lengths allows."""
        other = units(x).withColumn("m", F.explode(F.array(*[n + d for d in range(-most, most + 1) if d]))).withColumn("e", F.explode(only))
        hidden = allowed(longer, most, percent) - F.abs(F.col("m") - n) - 2 * F.col("e")
        left = _reduced(other.withColumns({"out": F.col("e") + F.greatest(n - F.col("m"), F.lit(0)), "hidden": hidden}).where((F.col("m") >= 0) & (F.col("hidden") >= 0)))
        return _written(left.select("s", longer.alias("longer"), F.least("n", "m").alias("shorter"), "n", "left").distinct())

    def met(made, keys: list[str]) -> DataFrame:
        left = made(a)
        right = left if b is None else made(b)
        of = lambda x, name: x.select(F.col("s").alias(name), F.col("n").alias(f"n_{name}"), *keys)
        return of(left.withColumn("size", n), "a").join(of(right.withColumn("size", n), "b"), keys)

    same = met(turned, ["size", "key"]).select("a", "b")
    other = met(shifted, ["longer", "shorter", "left"]).where("n_a <> n_b")
    pairs = same.union(other.select("a", "b"))
    pairs = _written(pairs.union(_long_pairs(a, a if b is None else b, most)).where("a <> b").distinct())
    longest = F.greatest(F.length("a"), F.length("b"))
    # each edit changes two of the counts of bases by one at most
    bases = lambda c: [seqfn.count_of(F.col(c), x) for x in "ACGT"]
    if_complement = F.when(F.length("a") == F.length("b"), sum((F.abs(x - y) for x, y in zip(bases("a"), reversed(bases("b")), strict=True)), F.lit(0))).otherwise(99)
    apart = F.least(sum((F.abs(x - y) for x, y in zip(bases("a"), bases("b"), strict=True)), F.lit(0)), if_complement)
    pairs = pairs.where((longest <= 2 * F.least(F.length("a"), F.length("b"))) & (apart <= 2 * allowed(longest, most, percent)))
    # a table, so that a filter does not ask for the distances once more
    return _written(pairs.withColumn("distance", rotation_distance(F.col("a"), F.col("b")))).where(F.col("distance") <= allowed(longest, most, percent))


def _long_pairs(a: DataFrame, b: DataFrame, most: int) -> DataFrame:
    """Pairs of units, one of them long, that share a segment: of the doubled word if the lengths are equal."""
    pick = lambda x: x.where(F.length("s") > SHORT - most).select("s").distinct()
    k = F.floor(F.length("s") / (most + 1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(most)), lambda i: F.struct((i * k).alias("at"), F.substring(F.col("s"), i * k + 1, k).alias("seg")))
    index = pick(a).select(F.col("s").alias("a"), F.length("s").alias("n"), k.alias("k"), F.explode(cut).alias("p"))
    probes = pick(b).select(F.col("s").alias("b"), F.length("s").alias("m"))
    turned = probes.select("b", F.col("m").alias("n"), F.explode(F.array(F.repeat("b", F.lit(2)), F.repeat(seqfn.revcomp(F.col("b")), F.lit(2)))).alias("t"))
    turned = turned.withColumn("k", F.floor(F.col("n") / (most + 1)).cast("int"))
    turned = turned.select("b", "n", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("n")), lambda j: F.substring(F.col("t"), j, F.col("k"))))).alias("seg"))
    same = index.select("a", "n", F.col("p.seg").alias("seg")).join(turned, ["n", "seg"]).select("a", "b")
    shifted = probes.select("b", "m", F.explode(F.array(*[F.lit(d) for d in range(-most, most + 1) if d])).alias("d")).withColumn("n", F.col("m") + F.col("d"))
    shifted = shifted.withColumn("k", F.floor(F.col("n") / (most + 1)).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(most))))
    places = F.sequence(F.greatest(F.col("i") * F.col("k") - most, F.lit(0)), F.col("i") * F.col("k") + most)
    shifted = shifted.select("b", "n", (F.col("i") * F.col("k")).alias("at"), F.explode(F.array_distinct(F.transform(places, lambda j: F.substring(F.col("b"), j + 1, F.col("k"))))).alias("seg"))
    other = index.select("a", "n", F.col("p.at").alias("at"), F.col("p.seg").alias("seg")).join(shifted, ["n", "at", "seg"]).select("a", "b")
    return same.union(other)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(canonical, leader) of the units of all pairs (a, b, n_a, n_b), b the earlier one: in their order, a unit that no leader has
    yet leads, and has the later ones near it that no leader has."""
    pairs = [b for b in batches if b.num_rows]
    if not pairs:
        return
    whole = lambda x: pa.chunked_array([b.column(f"{x}{c}") for c in "ab" for b in pairs]).combine_chunks()
    units = whole("").dictionary_encode()
    names, code, sizes = units.dictionary, units.indices.to_numpy(), whole("n_").to_numpy()
    n = np.zeros(len(names), np.int64)
    n[code] = sizes
    order = pc.sort_indices(pa.table({"n": -n, "s": names}), [("n", "ascending"), ("s", "ascending")]).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    later, earlier = np.split(place[code], 2)
    by = np.argsort(earlier, kind="stable")
    later, cut = later[by], np.searchsorted(earlier[by], np.arange(len(order) + 1))
    lead = np.full(len(order), -1)
    for i, (lo, hi) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        if lead[i] < 0:
            lead[i] = i
            near = later[lo:hi]
            lead[near[lead[near] < 0]] = i
    for lo in range(0, len(order), 1 << 16):
        yield pa.RecordBatch.from_arrays([names.take(pa.array(order[lo : lo + (1 << 16)])), names.take(pa.array(order[lead[lo : lo + (1 << 16)]]))], ["canonical", "leader"])


def leaders(arrays: DataFrame, most: int = 3, percent: int = 20) -> DataFrame:
    """(canonical, leader, family) of arrays(canonical): units in order of their number of arrays, ties by the unit
    itself, lead a family or join the first earlier leader near them. family: SF and the leader's place among leaders.

    Up to FEW pairs are decided in order by one task. Of more in rounds of joins: a unit leads once no earlier neighbour is
    undecided or leads. Each round is a table."""
    groups = _written(arrays.groupBy("canonical").agg(F.count(F.lit(1)).alias("n")))
    units = groups.select(F.col("canonical").alias("s"))
    rank = lambda n, s: F.struct((-F.col(n)).alias("k"), F.col(s).alias("s"))
    of = lambda c: groups.select(F.col("canonical").alias(c), F.col("n").alias(f"n_{c}"))
    near = near_pairs(units, None, most, percent).join(of("a"), "a").join(of("b"), "b")
    earlier = _written(near.where(rank("n_b", "b") < rank("n_a", "a")).select("a", "b", rank("n_b", "b").alias("key"), "n_a", "n_b"))
    few = earlier.limit(FEW + 1).count() <= FEW
    if few:
        led = earlier.select("a", "b", "n_a", "n_b").coalesce(1).mapInArrow(_in_order, "canonical string, leader string")
        state = _written(groups.select("canonical").join(led, "canonical", "left").select("canonical", F.coalesce("leader", "canonical").alias("leader")))
    else:
        state = _written(groups.select("canonical", F.lit(None).cast("string").alias("leader")))
    while not few and state.where("leader IS NULL").limit(1).count():
        seen = earlier.join(state.select(F.col("canonical").alias("b"), F.col("leader").alias("lb")), "b")
        seen = seen.groupBy("a").agg(F.min(F.when(F.col("lb") == F.col("b"), F.col("key"))).alias("first"), F.min(F.when(F.col("lb").isNull(), F.col("key"))).alias("wait"))
        now = state.join(seen, state["canonical"] == seen["a"], "left")
        joins = F.col("first").isNotNull() & (F.col("wait").isNull() | (F.col("first") < F.col("wait")))
        lead = F.when(joins, F.col("first.s")).when(F.col("first").isNull() & F.col("wait").isNull(), F.col("canonical"))
        last, state = state, _written(now.select("canonical", F.coalesce("leader", lead).alias("leader")))
        discard(last)
    discard(earlier)
    heads = state.where("leader = canonical").join(groups, "canonical").select("leader", "n")
    numbered = places(heads, [F.desc("n"), F.col("leader")]).select("leader", "no")
    return state.join(numbered, "leader").select("canonical", "leader", F.concat(F.lit("SF"), F.lpad(F.col("no").cast("string"), 4, "0")).alias("family"))


def family_table(arrays: DataFrame, core_from: int = 10000, small_from: int = 100, least_unit: int = 13, most: int = 3, percent: int = 20) -> DataFrame:
    """Families of arrays(seqid, start, end, array_length, period, consensus): long arrays found them (source core), and
    shorter ones whose unit is near a family's leader, both of some length, are added to the first such family (enriched).
    Columns: seqid, start, end, array_length, period, family, consensus, base_period, source."""
    unit = seqfn.bound(seqfn.primitive_root(F.upper("consensus")), seqfn.canonical)
    rows = _written(arrays.where((F.length("consensus") > 0) & (F.col("array_length") >= small_from)).withColumn("base_period", unit))
    core = rows.where(F.col("array_length") >= core_from)
    found = _written(leaders(core.select(F.col("base_period").alias("canonical")), most, percent))
    core = core.join(found.select(F.col("canonical").alias("base_period"), "family"), "base_period").withColumn("source", F.lit("core"))
    small = rows.where((F.col("array_length") < core_from) & (F.length("base_period") >= least_unit))
    heads = found.where((F.col("leader") == F.col("canonical")) & (F.length("leader") >= least_unit)).select("leader", "family")
    near = near_pairs(heads.select(F.col("leader").alias("s")), small.select(F.col("base_period").alias("s")), most, percent)
    equal = heads.select(F.col("leader").alias("a"), F.col("leader").alias("b"))
    best = near.select("a", "b").union(equal).join(heads, F.col("a") == F.col("leader")).groupBy(F.col("b").alias("base_period")).agg(F.min("family").alias("family"))
    enriched = small.join(best, "base_period").withColumn("source", F.lit("enriched"))
    return core.unionByName(enriched).select("seqid", "start", "end", "array_length", "period", "family", "consensus", "base_period", "source")


def named_clusters(members: DataFrame, least: int = 4) -> DataFrame:
    """(id, comp, name) of members(id, comp, period): clusters of at least so many get {rank}_{upper median period}, ranks from
    0 by rising number of members, ties by component; members of others are SING."""
    periods = members.groupBy("comp", "period").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("comp").orderBy("period")
    periods = periods.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy("comp"))})
    # the upper median is the period at place n // 2, counted from 0
    half = periods.where(F.col("upto") > F.floor(F.col("all") / 2)).groupBy("comp").agg(F.min("period").alias("median"), F.first("all").alias("size"))
    large = places(half.where(F.col("size") >= least), ["size", "comp"], "rank")
    names = large.select("comp", F.concat_ws("_", F.col("rank").cast("string"), F.col("median").cast("string")).alias("name"))
    return members.join(names, "comp", "left").select("id", "comp", F.coalesce("name", F.lit("SING")).alias("name"))


def component_annotation(members: DataFrame) -> DataFrame:
    """Per component of members(id, comp, bp, motif_size): n, bp, percent of all members' bp, and a map from motif size to
    members."""
    sizes = members.groupBy("comp", "motif_size").agg(F.count(F.lit(1)).alias("n"), F.sum("bp").alias("bp"))
    by = sizes.groupBy("comp").agg(F.sum("n").alias("n"), F.sum("bp").alias("bp"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("motif_size", "n")))).alias("motif_sizes"))
    total = by.agg(F.sum("bp").alias("total"))  # one row
    return by.crossJoin(F.broadcast(total)).select("comp", "n", "bp", seqfn.rounded(100.0 * F.col("bp") / F.col("total"), 4).alias("percent"), "motif_sizes")


def unit_components(units: DataFrame, most: int = 1) -> DataFrame:
    """(id, comp) of units(motif) that links of at most so many edits, on either strand, connect: the least unit reachable; a
    unit without a link is a component of its own. Null units are left out."""
    every = units.select(F.col("motif").alias("id")).where("id IS NOT NULL").distinct()
    links = edit_pairs(every.withColumnRenamed("id", "s"), most).select(F.col("a").alias("id_a"), F.col("b").alias("id_b"))
    return every.join(sorted_side(connected_components(links)), "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))


def taxon_flags(members: DataFrame, taxa: DataFrame) -> DataFrame:
    """(comp, taxa) of members(comp, motif): every taxon of taxa(motif, taxon) in order, with 1 if a motif of the component is
    known of it and else 0. The list of all taxa is one row; null taxa are left out."""
    known = taxa.where("taxon IS NOT NULL").select("motif", "taxon").distinct()
    names = known.agg(F.array_sort(F.collect_set("taxon")).alias("all"))  # one row
    held = members.select("comp", "motif").distinct().join(sorted_side(known), "motif").groupBy("comp").agg(F.collect_set("taxon").alias("has"))
    rows = members.select("comp").distinct().join(sorted_side(held), "comp", "left").crossJoin(F.broadcast(names))
    flag = lambda t: F.concat(t, F.when(F.array_contains(F.coalesce("has", F.array().cast("array<string>")), t), "1").otherwise("0"))
    return rows.select("comp", F.array_join(F.transform("all", flag), " ").alias("taxa"))


def annotated_components(members: DataFrame, taxa: DataFrame) -> DataFrame:
    """component_annotation of members(id, comp, bp, motif) with taxon_flags, and each component's place by falling bp, from 0,
    ties by component."""
    by = component_annotation(members.withColumn("motif_size", F.length("motif")))
    return places(by.join(sorted_side(taxon_flags(members, taxa)), "comp"), [F.desc("bp"), F.col("comp")])
