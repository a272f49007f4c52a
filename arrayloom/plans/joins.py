"""Queries of joins, set operations, sorts, distances and clusters (J, U, T, D)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrayloom.functions import seqfn
from arrayloom.operators import classify, families, forest, gaps, intervals, neighbours, orders, similarity, tiles

from .scalars import CANON, ROT
from .tables import ARRAYS, BEDS, FEATURES, SAT, SEQS, arrays, beds, features, sat, seqs, table

QUERIES, ORACLE_SQL = {}, {}


def over(name: str, rows, sql: str | None) -> None:
    QUERIES[name] = rows
    if sql:
        ORACLE_SQL[name] = sql


LABEL = """CASE WHEN l_ind = b0 AND r_ind = b1 THEN 'TR equal ' || type WHEN l_ind >= b0 AND r_ind <= b1 THEN 'TR in ' || type WHEN b0 >= l_ind AND b1 <= r_ind THEN type || ' in TR'
WHEN r_ind > b0 AND r_ind <= b1 AND l_ind < b0 THEN 'TR overlap left ' || type WHEN l_ind < b1 AND l_ind >= b0 AND r_ind > b1 THEN 'TR overlap right ' || type ELSE 'No overlap' END"""
HITS = f"""f AS (SELECT DISTINCT seqid, type, "start" - 1 AS b0, "end" AS b1 FROM features), hits AS (SELECT trf_id, seqid, l_ind, r_ind, b0, b1, type, {LABEL} AS label FROM arrays JOIN f USING (seqid) WHERE l_ind < b1 AND b0 < r_ind)"""
over("j01_p27_interval_overlap", lambda spark, sf: intervals.annotate(arrays(spark, sf), features(spark, sf)).select("trf_id", "seqid", "l_ind", "r_ind", "b0", "b1", "type", "label"), f"WITH {ARRAYS}, {FEATURES}, {HITS} SELECT * FROM hits")
over("p28_p29_overlap_lengths", lambda spark, sf: intervals.annotate(arrays(spark, sf), features(spark, sf)).select("trf_id", "b0", "b1", "type", seqfn.overlap_length(F.col("l_ind"), F.col("r_ind"), F.col("b0"), F.col("b1")).alias("bp")), f"WITH {ARRAYS}, {FEATURES}, {HITS} SELECT trf_id, b0, b1, type, least(r_ind, b1) - greatest(l_ind, b0) AS bp FROM hits")
over("j02_j03_f12_annotation", lambda spark, sf: intervals.annotation_labels(arrays(spark, sf), features(spark, sf)).select("trf_id", "seqid", "l_ind", "r_ind", "trf_ref_annotation"),
     f"""WITH {ARRAYS}, {FEATURES}, {HITS}, m AS (SELECT *, bool_or(type = 'CDS') OVER (PARTITION BY trf_id, seqid, l_ind, r_ind) AS cds FROM hits), k AS (SELECT DISTINCT trf_id, l_ind, r_ind, b0, b1, type, label FROM m WHERE type <> 'region' AND NOT (cds AND type IN ('gene', 'mRNA', 'exon'))),
l AS (SELECT trf_id, l_ind, r_ind, string_agg(label, '|' ORDER BY label DESC) AS s FROM k GROUP BY 1, 2, 3) SELECT a.trf_id, a.seqid, a.l_ind, a.r_ind, coalesce(s, 'No annotation') AS trf_ref_annotation FROM arrays a LEFT JOIN l USING (trf_id, l_ind, r_ind)""")  # fmt: skip
def gap_rows(spark: SparkSession, sf: str) -> DataFrame:
    return features(spark, sf).where("type = 'region'").select("seqid", "start", "end")


GAPS = """gaps AS (SELECT seqid, "start", "end" FROM features WHERE type = 'region'), near AS (SELECT trf_id, seqid, l_ind, r_ind, min("start") AS g0, max("end") AS g1 FROM arrays JOIN gaps USING (seqid) WHERE greatest(l_ind - 10000, 0) < "end" AND "start" < r_ind + 10000 GROUP BY ALL)"""
over("j04_gap_proximity", lambda spark, sf: intervals.gap_neighbours(arrays(spark, sf), gap_rows(spark, sf)), f"""WITH {ARRAYS}, {FEATURES}, {GAPS} SELECT trf_id, seqid, least(l_ind, g0) AS "start", greatest(r_ind, g1) AS "end", CASE WHEN l_ind < g0 AND r_ind < g1 THEN 'aN' WHEN l_ind < g0 AND r_ind > g1 THEN 'aNa' WHEN g0 < l_ind THEN 'Na' ELSE 'unknown' END AS gap_type, greatest(r_ind, g1) - least(l_ind, g0) AS span FROM near""")
over("j05_without_gaps", lambda spark, sf: intervals.without_gaps(arrays(spark, sf), gap_rows(spark, sf)), f"WITH {ARRAYS}, {FEATURES}, {GAPS} SELECT trf_id, seqid, l_ind, r_ind FROM arrays WHERE seqid IN (SELECT seqid FROM gaps) AND trf_id NOT IN (SELECT trf_id FROM near)")
over("j06_extract", lambda spark, sf: sat(spark, sf), f"WITH {SAT} SELECT * FROM sat")
over("j07_missing_sequences", lambda spark, sf: seqs(spark, sf).where(F.length("seq") >= 200).select("seqid").join(sat(spark, sf).select(F.col("trf_head").alias("seqid")).distinct(), "seqid", "left_anti"), f"WITH {SAT} SELECT seqid FROM seqs WHERE length(seq) >= 200 AND seqid NOT IN (SELECT trf_head FROM sat)")
over("j08_a21_low_counts", lambda spark, sf: seqs(spark, sf).select("seqid", F.length("seq").cast("bigint").alias("length")).join(sat(spark, sf).groupBy(F.col("trf_head").alias("seqid")).agg(F.count(F.lit(1)).alias("n")), "seqid", "left").select("seqid", "length", F.coalesce("n", F.lit(0)).alias("n")).where("n < 20"), f"WITH {SAT}, c AS (SELECT trf_head AS seqid, count(*) AS n FROM sat GROUP BY 1) SELECT s.seqid, length(seq) AS length, coalesce(n, 0) AS n FROM seqs s LEFT JOIN c USING (seqid) WHERE coalesce(n, 0) < 20")
over("j09_j12_subset_by_names", lambda spark, sf: seqs(spark, sf).join(beds(spark, sf).where("period = 7").select("seqid").distinct(), "seqid", "left_semi"), f"WITH {SEQS}, {BEDS} SELECT seqid, seq FROM seqs WHERE seqid IN (SELECT seqid FROM beds WHERE period = 7)")
over("j10_u05_name_differences", lambda spark, sf: seqs(spark, sf).select("seqid").subtract(sat(spark, sf).select("trf_head")), f"WITH {SAT} SELECT seqid FROM seqs EXCEPT SELECT trf_head FROM sat")
over("j11_by_id", lambda spark, sf: arrays(spark, sf).groupBy("seqid").agg(F.min("trf_id").alias("trf_id")).join(arrays(spark, sf).select("trf_id", "l_ind"), "trf_id"), f"WITH {ARRAYS}, m AS (SELECT seqid, min(trf_id) AS trf_id FROM arrays GROUP BY 1) SELECT trf_id, m.seqid, l_ind FROM m JOIN arrays USING (trf_id)")
over("j11_attribute_copy", lambda spark, sf: classify.with_attributes(arrays(spark, sf), intervals.gap_neighbours(arrays(spark, sf), gap_rows(spark, sf)).withColumnsRenamed({"start": "l_ind", "end": "r_ind"})),
     f"WITH {ARRAYS}, {FEATURES}, {GAPS} SELECT a.trf_id, a.seqid, coalesce(least(n.l_ind, n.g0), a.l_ind) AS l_ind, coalesce(greatest(n.r_ind, n.g1), a.r_ind) AS r_ind FROM arrays a LEFT JOIN near n USING (trf_id)")


def source_vectors(spark: SparkSession, sf: str, canonical: bool) -> DataFrame:
    """5-mer vectors of whole sequences, one per source and language."""
    rows = table(spark, sf, "documents").join(seqs(spark, sf).withColumn("doc_id", F.substring("seqid", 4, 20).cast("bigint")), "doc_id")
    counts = similarity.kmer_counts(rows.select(F.concat_ws("-", "source", "lang").alias("id"), "seq"), 5)
    if canonical:
        counts = counts.groupBy("id", F.least(F.col("kmer"), seqfn.revcomp(F.col("kmer"))).alias("kmer")).agg(F.sum("n").alias("n"))
    # distances read vectors several times
    return similarity._written(counts.select("id", "kmer", F.col("n").cast("double").alias("tf")))


def _sql_cosine(kmer: str, scale: int, where: str) -> str:
    return f"""WITH {SEQS}, k AS (SELECT concat_ws('-', source, lang) AS id, {kmer} AS kmer, count(*)::DOUBLE AS tf FROM (SELECT d.source, d.lang, substr(seq, CAST(i AS INTEGER), 5) AS x FROM documents d JOIN seqs ON seqid = 'doc' || doc_id, LATERAL (SELECT unnest(range(1, length(seq) - 3)) AS i) WHERE length(seq) > 4) WHERE regexp_full_match(x, '[ACGT]{{5}}') GROUP BY 1, 2),
n AS (SELECT id, sqrt(sum(tf * tf)) AS norm FROM k GROUP BY 1), d AS (SELECT a.id AS id_a, b.id AS id_b, sum(a.tf * b.tf) AS dot FROM k a JOIN k b ON a.kmer = b.kmer AND a.id < b.id GROUP BY 1, 2), r AS (SELECT id_a, id_b, abs(round({scale} * (1 - dot / (na.norm * nb.norm)), 6)) AS distance FROM d JOIN n na ON na.id = id_a JOIN n nb ON nb.id = id_b) SELECT * FROM r WHERE {where}"""


over("j13_cosine_distance", lambda spark, sf: similarity.cosine_pairs(source_vectors(spark, sf, False)).withColumn("distance", F.abs(F.round("distance", 6))), _sql_cosine("x", 100, "TRUE"))
over("j14_canonical_cosine", lambda spark, sf: similarity.cosine_pairs(source_vectors(spark, sf, True), 1.0).withColumn("distance", F.abs(F.round("distance", 6))).where("distance <= 0.2"), _sql_cosine("least(x, reverse(translate(x, 'ACGT', 'TGCA')))", 1, "distance <= 0.2"))


def array_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(id, seq, period): every distinct array of the repeat table, with an id of its own (its place, period and strand)."""
    rows = sat(spark, sf).select("trf_id", F.col("trf_period").alias("period"), F.col("trf_array").alias("seq"))
    # at one place and period, two arrays differ by their strand alone
    return rows.groupBy("trf_id", "period", "seq").agg(F.count(F.lit(1)).alias("n")).select(F.concat_ws("_", "trf_id", F.col("period").cast("string"), F.substring(F.sha2("seq", 256), 1, 8)).alias("id"), "seq", "period")


def neighbour_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of classes of equal 5-mer vectors of all arrays at a distance of 0.2 or less."""
    return neighbours.cosine_neighbours(array_rows(spark, sf), 0.2)[0].withColumn("distance", F.round("distance", 9))


def array_pair_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of all arrays at a distance of 0.2 or less, those of equal 5-mer vectors included."""
    return neighbours.array_pairs(array_rows(spark, sf), 0.2)


def array_clusters(spark: SparkSession, sf: str, most: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Members (id, class, period) of vector classes, and the edges of distances (from 0 on a scale of 100) between the classes
    up to 100 * most."""
    rows = similarity._written(array_rows(spark, sf))
    near, members = neighbours.cosine_neighbours(rows, most, scale=100.0)
    return similarity._written(members.join(rows.select("id", "period"), "id")), near


def clusters_below(spark: SparkSession, sf: str, level: float = 1) -> DataFrame:
    """Names of the clusters of all arrays whose distance is below the level: no other pairs are looked for."""
    members, near = array_clusters(spark, sf, level / 100 + 1e-9)
    return forest.named_arrays(members, near, level)


def array_flow(spark: SparkSession, sf: str) -> DataFrame:
    rows = similarity._written(array_rows(spark, sf))
    near, members = neighbours.near_forest(rows, 0.2, scale=100.0)
    members = similarity._written(members.join(rows.select("id", "period"), "id"))
    return forest.threshold_flow(members, forest.spanning_forest(near))


# every pair of arrays is too much for SQL; tests compare arrays with ids divisible by 20 with all, and clusters with union-find
over("j14_array_neighbours", array_pair_rows, None)
over("d05_array_clusters", clusters_below, None)
over("d06_threshold_flow", array_flow, None)


def copy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct pairs of a consensus (a) and a whole copy of it (b) in its array, of all repeats."""
    rows = sat(spark, sf).select(F.col("trf_consensus").alias("array_id"), F.col("trf_array").alias("seq"), F.col("trf_period").alias("period"))
    return gaps.monomers(rows).where("type = 'monomer'").select(F.col("array_id").alias("a"), F.col("cut_sequence").alias("b")).distinct()


COPIES = f"WITH {SAT}, p AS (SELECT DISTINCT trf_consensus AS a, substr(trf_array, CAST(i AS INTEGER) + 1, trf_period) AS b FROM sat, LATERAL (SELECT unnest(range(0, length(trf_array) - trf_period + 1, trf_period)) AS i))"
TURNS = "list_concat({r}, {rr})".format(r=ROT.format("b"), rr=ROT.format("reverse(translate(b, 'ACGT', 'TGCA'))"))
HAM = f"list_min(list_transform({TURNS}, lambda y: len(list_filter(range(1, length(b) + 1), lambda i: substr(y, CAST(i AS INTEGER), 1) <> substr(a, CAST(i AS INTEGER), 1))) / length(b)::DOUBLE))"
over("j16_sliding_hamming", lambda spark, sf: copy_pairs(spark, sf).select("a", "b", F.round(similarity.sliding_hamming(F.col("a"), F.col("b")), 6).alias("distance")), f"{COPIES} SELECT a, b, round({HAM}, 6) AS distance FROM p")
# all pairs are too slow for SQL on whole tables; a test compares the operator with all pairs of a small one
over("j17_edit_distance", lambda spark, sf: similarity.edit_pairs(sat(spark, sf).select(F.col("trf_consensus").alias("s")), 1), None)
over("j18_rotation_distance", lambda spark, sf: copy_pairs(spark, sf).select("a", "b", similarity.rotation_distance(F.col("a"), F.col("b")).alias("distance")), f"{COPIES} SELECT a, b, CAST(list_min(list_transform({TURNS}, lambda y: levenshtein(a, y))) AS INTEGER) AS distance FROM p")
over("j20_self_overlaps", lambda spark, sf: intervals.self_overlaps(arrays(spark, sf)), f"WITH {ARRAYS} SELECT a.seqid, a.trf_id AS id_a, b.trf_id AS id_b, CASE WHEN a.l_ind = b.l_ind AND a.r_ind = b.r_ind THEN 'duplicate' WHEN a.l_ind <= b.l_ind AND a.r_ind >= b.r_ind THEN 'contains' WHEN a.l_ind >= b.l_ind AND a.r_ind <= b.r_ind THEN 'contained' ELSE 'partial' END AS kind FROM arrays a JOIN arrays b ON a.seqid = b.seqid AND a.trf_id < b.trf_id AND a.l_ind < b.r_ind AND b.l_ind < a.r_ind")
over("d04_connected_components", lambda spark, sf: similarity.connected_components(intervals.self_overlaps(arrays(spark, sf)).select("id_a", "id_b")), f"""WITH {ARRAYS}, o AS (SELECT *, max(r_ind) OVER (PARTITION BY seqid ORDER BY l_ind, r_ind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM arrays), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR l_ind >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY seqid ORDER BY l_ind, r_ind ROWS UNBOUNDED PRECEDING) AS run FROM o),
c AS (SELECT trf_id, min(trf_id) OVER (PARTITION BY seqid, run) AS comp, max(trf_id) OVER (PARTITION BY seqid, run) AS most FROM g) SELECT DISTINCT trf_id AS id, comp FROM c WHERE most > comp""")


def overlap_members(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats in components of overlaps: id, comp, bp, period (bases in hundreds)."""
    comps = similarity.connected_components(intervals.self_overlaps(arrays(spark, sf)).select("id_a", "id_b"))
    bp = F.col("r_ind") - F.col("l_ind")
    return comps.join(arrays(spark, sf).select(F.col("trf_id").alias("id"), bp.alias("bp"), F.floor(bp / 100).alias("period")), "id")


MEMBERS = f"""WITH {ARRAYS}, o AS (SELECT *, max(r_ind) OVER (PARTITION BY seqid ORDER BY l_ind, r_ind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM arrays), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR l_ind >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY seqid ORDER BY l_ind, r_ind ROWS UNBOUNDED PRECEDING) AS run FROM o),
c AS (SELECT trf_id AS id, r_ind - l_ind AS bp, (r_ind - l_ind) // 100 AS period, min(trf_id) OVER (PARTITION BY seqid, run) AS comp, max(trf_id) OVER (PARTITION BY seqid, run) AS most FROM g), m AS (SELECT DISTINCT id, comp, bp, period FROM c WHERE most > comp)"""
over("a22_component_annotation", lambda spark, sf: families.component_annotation(overlap_members(spark, sf).withColumnRenamed("period", "motif_size")).select("comp", "n", "bp", "percent", F.array_join(F.transform(F.map_entries("motif_sizes"), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ",").alias("motif_sizes")),
     f"""{MEMBERS}, s AS (SELECT comp, period, count(*) AS n, CAST(sum(bp) AS BIGINT) AS bp FROM m GROUP BY 1, 2) SELECT comp, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bp) AS BIGINT) AS bp, round(100.0 * sum(bp) / (SELECT sum(bp) FROM m), 4) AS percent, string_agg(period || ':' || n, ',' ORDER BY period) AS motif_sizes FROM s GROUP BY 1""")
over("d05_t07_named_clusters", lambda spark, sf: families.named_clusters(overlap_members(spark, sf)), f"""{MEMBERS}, k AS (SELECT comp, count(*) AS size, list_sort(list(period))[count(*) // 2 + 1] AS median FROM m GROUP BY 1), r AS (SELECT comp, (row_number() OVER (ORDER BY size, comp) - 1) || '_' || median AS name FROM k WHERE size >= 4)
SELECT id, m.comp, coalesce(name, 'SING') AS name FROM m LEFT JOIN r USING (comp)""")


def family_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Families of all repeats: those of 120 bases or more found them, others of 60 or more are added, units from 5 on."""
    rows = sat(spark, sf).select(F.col("trf_head").alias("seqid"), (F.col("trf_l_ind") - 1).alias("start"), F.col("trf_r_ind").alias("end"), "trf_array_length", F.col("trf_period").alias("period"), F.col("trf_consensus").alias("consensus"))
    return families.family_table(rows.withColumnRenamed("trf_array_length", "array_length"), core_from=120, small_from=60, least_unit=5)


over("d02_d03_j19_families", family_rows, None)
over("d09_restored_regions", lambda spark, sf: seqs(spark, sf).join(intervals.merge_intervals(beds(spark, sf).select("seqid", "start", "end"), 50).select("seqid", F.col("start").alias("s"), F.col("end").alias("e")), "seqid", "left").select("seqid", F.coalesce("s", F.lit(0)).alias("start"), F.least(F.coalesce("e", F.length("seq")), F.length("seq")).alias("end")).where("end > start").select(F.concat_ws("_", F.concat("seqid", F.lit("_")), F.col("start").cast("string"), F.col("end").cast("string")).alias("head")),
     f"""WITH {SEQS}, {BEDS}, x AS (SELECT seqid, "start", "end" FROM beds), o AS (SELECT *, max("end") OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM x), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR "start" - reach > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS run FROM o), m AS (SELECT seqid, min("start") AS s, max("end") AS e FROM g GROUP BY seqid, run),
r AS (SELECT seqid, coalesce(s, 0) AS s, least(coalesce(e, length(seq)), length(seq)) AS e FROM seqs LEFT JOIN m USING (seqid)) SELECT seqid || '__' || s || '_' || e AS head FROM r WHERE e > s""")  # fmt: skip
over("d13_d14_bars", lambda spark, sf: arrays(spark, sf).select("seqid", "trf_id", "l_ind", F.greatest(F.col("r_ind") - F.col("l_ind"), F.lit(500)).alias("bar"), F.when(F.col("r_ind") - F.col("l_ind") > 900, "large").otherwise("small").alias("trace")), f"WITH {ARRAYS} SELECT seqid, trf_id, l_ind, greatest(r_ind - l_ind, 500) AS bar, CASE WHEN r_ind - l_ind > 900 THEN 'large' ELSE 'small' END AS trace FROM arrays")
over("u01_u06_union_with_source", lambda spark, sf: arrays(spark, sf).select("seqid", F.col("l_ind").alias("start"), F.lit("core").alias("source")).unionByName(features(spark, sf).select("seqid", "start", F.lit("enriched").alias("source"))), f"""WITH {ARRAYS}, {FEATURES} SELECT seqid, l_ind AS "start", 'core' AS source FROM arrays UNION ALL SELECT seqid, "start", 'enriched' FROM features""")
over("u03_u04_distinct_features", lambda spark, sf: features(spark, sf).unionByName(features(spark, sf)).distinct(), f"WITH {FEATURES} SELECT DISTINCT * FROM features")
over("t01_t04_scaffolds_by_length", lambda spark, sf: seqs(spark, sf).select("seqid", F.length("seq").cast("bigint").alias("length")).orderBy(F.desc("length"), "seqid"), f"WITH {SEQS} SELECT seqid, length(seq) AS length FROM seqs ORDER BY length DESC, seqid")
over("t05_top_families", lambda spark, sf: sat(spark, sf).groupBy(seqfn.canonical(F.col("trf_consensus")).alias("family")).agg(F.sum("trf_array_length").alias("bp")).orderBy(F.desc("bp"), "family").limit(12), f"WITH {SAT} SELECT {CANON.format('trf_consensus')} AS family, CAST(sum(trf_array_length) AS BIGINT) AS bp FROM sat GROUP BY 1 ORDER BY bp DESC, family LIMIT 12")
over("j15_euclidean_distance", lambda spark, sf: similarity.euclidean_pairs(source_vectors(spark, sf, False)).withColumn("distance", F.round("distance", 4)), _sql_cosine("x", 100, "TRUE").replace("round(100 * (1 - dot / (na.norm * nb.norm)), 6)", "round(sqrt(greatest(na.norm * na.norm + nb.norm * nb.norm - 2 * dot, 0.0)), 4)").replace("abs(round(sqrt", "(round(sqrt"))


def overlap_flow(spark: SparkSession, sf: str) -> DataFrame:
    """How components of any overlap pass into components of containment only."""
    # read by both, so the overlaps are joined once
    pairs = similarity._written(intervals.self_overlaps(arrays(spark, sf)).select("id_a", "id_b", "kind"))
    loose = similarity.connected_components(pairs.select("id_a", "id_b"))
    tight = similarity.connected_components(pairs.where("kind <> 'partial'").select("id_a", "id_b"))
    return similarity.cluster_flow(loose, tight)


over("d06_cluster_flow", overlap_flow, None)


def unit_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Units of all repeats: members (id, comp, bp, motif) in components of one edit, bp their repeats' bases, and the sources
    (motif, taxon) they stand in."""
    source = table(spark, sf, "documents").select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("trf_head"), F.col("source").alias("taxon"))
    rows = similarity._written(sat(spark, sf).join(source, "trf_head").groupBy(F.col("trf_consensus").alias("motif"), "taxon").agg(F.sum("trf_array_length").alias("bp")))
    comps = families.unit_components(rows)
    members = rows.groupBy("motif").agg(F.sum("bp").alias("bp")).join(similarity.sorted_side(comps), F.col("motif") == F.col("id")).select("id", "comp", "bp", "motif")
    return members, rows.select("motif", "taxon")


# components by edits are too slow for SQL, as j17; a test compares them and their annotation with union-find
over("a22_unit_components", lambda spark, sf: families.annotated_components(*unit_rows(spark, sf)).select("no", "comp", "n", "bp", "percent", "taxa", F.array_join(F.transform(F.map_entries("motif_sizes"), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ",").alias("motif_sizes")), None)
# of the families of D02, which have no SQL either
over("a18_families_ranked", lambda spark, sf: classify.family_info(classify.family_members(family_rows(spark, sf))), None)
LEAST_ROWS = f"WITH {SAT}, k AS (SELECT trf_consensus AS key, count(*) AS value FROM sat GROUP BY 1)"
over("t01_repeats_by_head", lambda spark, sf: orders.places(sat(spark, sf).select("trf_head", "trf_id", "trf_period", "trf_array"), ["trf_head", "trf_id", "trf_period", "trf_array"]), f"WITH {SAT} SELECT trf_head, trf_id, trf_period, trf_array, row_number() OVER (ORDER BY trf_head, trf_id, trf_period, trf_array) - 1 AS no FROM sat")
over("t02_bed_order", lambda spark, sf: orders.places(beds(spark, sf), ["seqid", "start", "end", "period", "strand"]), f"""WITH {BEDS} SELECT *, row_number() OVER (ORDER BY seqid, "start", "end", period, strand) - 1 AS no FROM beds""")
over("t03_repeats_by_place", lambda spark, sf: orders.places(arrays(spark, sf), ["l_ind", "r_ind", "trf_id"]), f"WITH {ARRAYS} SELECT *, row_number() OVER (ORDER BY l_ind, r_ind, trf_id) - 1 AS no FROM arrays")
over("t06_dictionary_by_value", lambda spark, sf: orders.places(orders.dictionary_by_value(sat(spark, sf).groupBy("trf_consensus").agg(F.count(F.lit(1)).alias("n")), "trf_consensus", "n"), ["value", "key"]), f"{LEAST_ROWS} SELECT value, key, row_number() OVER (ORDER BY value, key) - 1 AS no FROM k")
over("t08_arrays_by_place", lambda spark, sf: orders.places(arrays(spark, sf).select("seqid", "l_ind", "trf_id"), ["seqid", "l_ind", "trf_id"]), f"WITH {ARRAYS} SELECT seqid, l_ind, trf_id, row_number() OVER (ORDER BY seqid, l_ind, trf_id) - 1 AS no FROM arrays")


def guided_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences' parts of few different k-mers with their letters: 5-mers, windows of 400 by 100, as d11_z07_kmer_profile;
    those whose number ends in 9 or 0 are left out of the profile, so that they stay whole."""
    rows = similarity._written(seqs(spark, sf))
    profiled = rows.where(F.substring("seqid", -1, 1).isin("1", "2", "3", "4", "5", "6", "7", "8"))
    parts = intervals.guided_regions(rows.select("seqid", F.length("seq").alias("length")), gaps.kmer_profile(profiled, 5, 400, 100), threshold=200, least_span=300, gap=100, least=200)
    return tiles.cut_spans(parts, tiles.tiled(rows))


over("d09_guided_parts", guided_parts, f"""WITH {SEQS}, q AS (SELECT *, right(seqid, 1) NOT IN ('9', '0') AS profiled FROM seqs), k AS (SELECT seqid, length(seq) AS n, i, substr(seq, CAST(i AS INTEGER) + 1, 5) AS kmer FROM q, LATERAL (SELECT unnest(range(0, length(seq) - 4)) AS i) WHERE profiled AND length(seq) > 4),
w AS (SELECT *, unnest(range(greatest(CAST(floor((i - 400) / 100.0) AS BIGINT) + 1, 0), i // 100 + 1)) AS w FROM k), p AS (SELECT seqid, w * 100 AS "start", least(w * 100 + 400, n) AS "end", count(DISTINCT kmer) AS unique_kmers FROM w GROUP BY seqid, w, n),
r AS (SELECT *, sum(CASE WHEN unique_kmers < 200 THEN 0 ELSE 1 END) OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS run FROM p), x AS (SELECT seqid, min("start") AS "start", max("end") AS "end" FROM r WHERE unique_kmers < 200 GROUP BY seqid, run HAVING max("end") - min("start") >= 300),
o AS (SELECT *, max("end") OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM x), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR "start" - reach > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS run FROM o),
m AS (SELECT seqid, min("start") AS "start", max("end") AS "end" FROM g GROUP BY seqid, run), a AS (SELECT * FROM m UNION ALL SELECT seqid, 0, length(seq) FROM seqs WHERE seqid NOT IN (SELECT seqid FROM p))
SELECT a.seqid, a."start", least(a."end", length(seq)) AS "end", a.seqid || '__' || a."start" || '_' || least(a."end", length(seq)) AS head, substr(seq, CAST(a."start" AS INTEGER) + 1, CAST(least(a."end", length(seq)) - a."start" AS INTEGER)) AS bases FROM a JOIN seqs USING (seqid) WHERE a."end" - a."start" >= 200""")  # fmt: skip
