"""Queries of the aggregations, densities and summaries (A, W, D)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrayloom.functions import seqfn
from arrayloom.operators import classify, extract, gaps, intervals, overlaps, scans, similarity, telomeres, tiles, views

from arrayloom.sources import versions

from .scalars import CLASSES, ROOT
from .scalars import CANON as SQL_CANON
from .tables import ARRAYS, FEATURES, SAT, SEQS, arrays, features, sat, seqs, table

QUERIES, ORACLE_SQL = {}, {}


def over(name: str, rows, sql: str | None) -> None:
    QUERIES[name] = rows
    if sql:
        ORACLE_SQL[name] = sql


def genome(spark: SparkSession, sf: str) -> DataFrame:
    return seqs(spark, sf).agg(F.sum(F.length("seq")).alias("genome"))


def classes(spark: SparkSession, sf: str) -> DataFrame:
    return classify.all_classes(sat(spark, sf))


GENOME = "(SELECT sum(length(seq)) FROM seqs)"
WITH = f"WITH {SAT}, classes AS ({CLASSES})"
over("j06_extract_classify_summary", lambda spark, sf: classify.category_summary(classes(spark, sf), genome(spark, sf)), f"{WITH} SELECT category, count(*) AS n, CAST(sum(trf_array_length) AS BIGINT) AS total_length, round(100.0 * sum(trf_array_length) / {GENOME}, 3) AS pgenome FROM classes GROUP BY category")
over("a01_x07_family_statistics", lambda spark, sf: classify.family_statistics(classes(spark, sf).where("category = 'micro'"), 6),
     f"{WITH} SELECT trf_family, count(*) AS n, CAST(sum(trf_array_length) AS BIGINT) AS total_length, " + ", ".join(f"min({c}) AS min_{n}, max({c}) AS max_{n}, round(avg({c}), 6) AS mean_{n}, round(stddev_pop({c}), 6) AS std_{n}" for c, n in (("trf_array_length", "length"), ("trf_pmatch", "pmatch"), ("100 * trf_array_gc", "gc"))) + " FROM classes WHERE category = 'micro' GROUP BY trf_family")
over("a03_micro_summary", lambda spark, sf: classify.micro_summary(classes(spark, sf).where("category = 'micro'")), f"{WITH} SELECT trf_family, count(*) AS n, CAST(sum(abs(trf_r_ind - trf_l_ind)) AS BIGINT) AS span, round(100 - 100.0 * count(*) FILTER (trf_pmatch = 100) / count(*), 2) AS imperfect, round(100.0 * count(*) FILTER (trf_pmatch = 100) / count(*), 2) AS perfect FROM classes WHERE category = 'micro' GROUP BY 1")


def statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Mean, population variance and deviation, sum of absolute deviations and one-sample t of prices by flag."""
    items = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").alias("x"))
    means = items.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("variance"), F.stddev_pop("x").alias("std"))
    off = items.join(F.broadcast(means), "l_returnflag").groupBy("l_returnflag", "n", "mean", "variance", "std").agg(F.sum(F.abs(F.col("x") - F.col("mean"))).alias("sigma"))
    t = (F.col("mean") - 25) / F.sqrt(F.col("variance") / F.col("n"))
    return off.select("l_returnflag", "n", *[F.round(c, 4).alias(c) for c in ("mean", "variance", "std", "sigma")], F.round(t, 4).alias("t"))


over("a04_a05_statistics", statistics, "WITH m AS (SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS mean, var_pop(l_quantity) AS variance, stddev_pop(l_quantity) AS std FROM lineitem GROUP BY 1) SELECT l_returnflag, n, round(mean, 4) AS mean, round(variance, 4) AS variance, round(std, 4) AS std, round(sum(abs(l_quantity - mean)), 4) AS sigma, round((mean - 25) / sqrt(variance / n), 4) AS t FROM lineitem JOIN m USING (l_returnflag) GROUP BY l_returnflag, n, mean, variance, std")
over("a06_a07_frequencies", lambda spark, sf: sat(spark, sf).groupBy("trf_period").agg(F.count(F.lit(1)).alias("n")), f"WITH {SAT} SELECT trf_period, count(*) AS n FROM sat GROUP BY 1")
over("a08_two_fields", lambda spark, sf: sat(spark, sf).select("trf_array_length", "trf_entropy").orderBy("trf_array_length", "trf_entropy"), f"WITH {SAT} SELECT trf_array_length, trf_entropy FROM sat ORDER BY 1, 2")
over("a09_a10_repeats_per_sequence", lambda spark, sf: arrays(spark, sf).groupBy("seqid").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("r_ind") - F.col("l_ind") > 300).alias("n_300"), F.count_if(F.col("r_ind") - F.col("l_ind") > 900).alias("n_900")), f"WITH {ARRAYS} SELECT seqid, count(*) AS n, count(*) FILTER (r_ind - l_ind > 300) AS n_300, count(*) FILTER (r_ind - l_ind > 900) AS n_900 FROM arrays GROUP BY 1")
over("a11_genome_size", lambda spark, sf: seqs(spark, sf).rollup("seqid").agg(F.sum(F.length("seq")).alias("length")).select(F.coalesce("seqid", F.lit("TOTAL")).alias("seqid"), "length"), f"WITH {SEQS} SELECT coalesce(seqid, 'TOTAL') AS seqid, CAST(sum(length(seq)) AS BIGINT) AS length FROM seqs GROUP BY ROLLUP (seqid)")
over("a12_line_count", lambda spark, sf: table(spark, sf, "documents").agg(F.sum(F.size(F.split("text", "\n"))).alias("n_lines")), "SELECT CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines FROM documents")
over("a25_upper_median", lambda spark, sf: scans.upper_medians(sat(spark, sf), "trf_head", "trf_period"), f"WITH {SAT} SELECT trf_head, list_sort(list(trf_period))[len(list(trf_period)) // 2 + 1] AS median FROM sat GROUP BY 1")
over("a26_composition", lambda spark, sf: seqs(spark, sf).select("seqid", *[seqfn.count_of(F.col("seq"), b).alias(f"n_{b.lower()}") for b in "ACGT"]), f"WITH {SEQS} SELECT seqid, " + ", ".join(f"CAST(length(seq) - length(replace(seq, '{b}', '')) AS INTEGER) AS n_{b.lower()}" for b in "ACGT") + " FROM seqs")
over("a27_length_distribution", lambda spark, sf: seqs(spark, sf).groupBy(F.floor(F.length("seq") / 100).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(seqfn.gc_fraction(F.col("seq"))), 6).alias("mean_gc")), f"WITH {SEQS} SELECT length(seq) // 100 AS bin, count(*) AS n, round(avg(CASE WHEN length(seq) > 0 THEN (length(seq) - length(translate(seq, 'GC', ''))) / length(seq)::DOUBLE ELSE 0 END), 6) AS mean_gc FROM seqs GROUP BY 1")
RUNS = "runs AS (SELECT seqid, unnest(regexp_extract_all(seq, '([Nn]+|[^Nn]+)')) AS r, generate_subscripts(regexp_extract_all(seq, '([Nn]+|[^Nn]+)'), 1) AS k FROM seqs), placed AS (SELECT seqid, r, sum(length(r)) OVER (PARTITION BY seqid ORDER BY k) - length(r) AS pos FROM runs), gaps AS (SELECT seqid, CAST(pos AS BIGINT) AS \"start\", CAST(pos + length(r) AS BIGINT) AS \"end\", length(r) AS length FROM placed WHERE upper(r[1]) = 'N')"
over("w01_w02_n_runs", lambda spark, sf: gaps.n_runs(seqs(spark, sf)), f'WITH {SEQS}, {RUNS} SELECT seqid, "start", "end", length FROM gaps')
over("a14_gap_summary", lambda spark, sf: gaps.gap_summary(gaps.n_runs(seqs(spark, sf)), genome(spark, sf)), f"WITH {SEQS}, {RUNS}, k AS (SELECT CASE WHEN length < 10 THEN '<10' WHEN length < 100 THEN '10-100' WHEN length < 1000 THEN '100-1k' ELSE '>1k' END AS size_range, length FROM gaps) SELECT coalesce(size_range, 'total') AS size_range, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM gaps), 3) AS pgaps, CAST(sum(length) AS BIGINT) AS bp, round(100.0 * sum(length) / {GENOME}, 3) AS pgenome, round(sum(length)::DOUBLE / count(*), 3) AS mean FROM k GROUP BY ROLLUP (size_range)")
DENS = "WITH {a}, cut AS (SELECT *, unnest(range(l_ind // {b}, r_ind // {b} + 1)) AS bin FROM arrays), d AS (SELECT seqid, bin, {c} AS category, CAST(sum(greatest(least(r_ind, (bin + 1) * {b}) - greatest(l_ind, bin * {b}), 0)) AS BIGINT) AS bp FROM cut GROUP BY ALL)"
CAT = "CASE WHEN r_ind - l_ind < 1000 THEN '<1k' WHEN r_ind - l_ind < 10000 THEN '1-10k' WHEN r_ind - l_ind < 100000 THEN '10-100k' ELSE '>100k' END"
for size, label in ((500000, "coarse"), (50000, "fine")):
    over(f"a15_a16_density_{label}", lambda spark, sf, size=size: intervals.density(arrays(spark, sf), seqfn.length_category(F.col("r_ind") - F.col("l_ind")), size).withColumn("density", intervals.normalised(F.col("bp"), size)), DENS.format(a=ARRAYS, b=size, c=CAT) + f" SELECT *, round(least(bp / {size}.0::DOUBLE, 1.0), 3) AS density FROM d")


def family_density(spark: SparkSession, sf: str) -> DataFrame:
    """Density of the 12 families with most bases, others as 'other'; a family is the customer key of an order here."""
    rows = features(spark, sf).select("seqid", F.col("start").alias("l_ind"), F.col("end").alias("r_ind"), (F.col("end") % 40).cast("string").alias("family"))
    top = rows.groupBy("family").agg(F.sum(F.col("r_ind") - F.col("l_ind")).alias("bp")).orderBy(F.desc("bp"), "family").limit(12).select("family", F.lit(True).alias("top"))
    rows = rows.join(F.broadcast(top), "family", "left")
    return intervals.density(rows, F.when(F.col("top"), F.col("family")).otherwise("other"), 500000)


over("a17_w09_family_density", family_density, f"""WITH {FEATURES}, arrays AS (SELECT seqid, "start" AS l_ind, "end" AS r_ind, CAST("end" % 40 AS VARCHAR) AS family FROM features), top AS (SELECT family FROM arrays GROUP BY 1 ORDER BY sum(r_ind - l_ind) DESC, family LIMIT 12), cut AS (SELECT *, unnest(range(l_ind // 500000, r_ind // 500000 + 1)) AS bin FROM arrays)
SELECT seqid, bin, CASE WHEN family IN (SELECT family FROM top) THEN family ELSE 'other' END AS category, CAST(sum(greatest(least(r_ind, (bin + 1) * 500000) - greatest(l_ind, bin * 500000), 0)) AS BIGINT) AS bp FROM cut GROUP BY ALL""")
over("a23_d01_consensus_classes", lambda spark, sf: similarity.consensus_classes(sat(spark, sf).select(F.col("trf_head").alias("seqid"), F.col("trf_consensus").alias("consensus"))),
     f"""WITH {SAT}, m AS (SELECT DISTINCT trf_head AS seqid, trf_consensus AS consensus, {ROOT.format('trf_consensus')} AS u FROM sat WHERE length(trf_consensus) > 0), r AS (SELECT seqid, consensus, {SQL_CANON.format('u')} AS root FROM m)
SELECT a.seqid, a.consensus, repeat(a.root, CAST(min(length(b.consensus)) // length(a.root) AS INTEGER)) AS canonical FROM r a JOIN r b ON a.seqid = b.seqid AND a.root = b.root AND length(a.consensus) % length(b.consensus) = 0 GROUP BY a.seqid, a.consensus, a.root""")  # fmt: skip
CLASSED = ORACLE_SQL["a23_d01_consensus_classes"].replace("SELECT a.seqid, a.consensus, repeat", ", k AS (SELECT a.seqid, a.consensus, repeat") + ")"
over("a23_consensus_frequencies", lambda spark, sf: similarity.consensus_frequencies(sat(spark, sf).select(F.col("trf_head").alias("seqid"), F.col("trf_consensus").alias("consensus"))), f"{CLASSED} SELECT canonical, count(*) AS n FROM sat s JOIN k ON k.seqid = s.trf_head AND k.consensus = s.trf_consensus GROUP BY 1")
PROFILE = "p AS (SELECT 'u' || user_id AS seqid, CAST(floor(epoch(ts)) AS BIGINT) AS \"start\", CAST(floor(epoch(ts)) AS BIGINT) + 1000 AS \"end\", CAST(floor(value) AS BIGINT) AS unique_kmers FROM events)"


def profile(spark: SparkSession, sf: str) -> DataFrame:
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("seqid"), at.alias("start"), (at + 1000).alias("end"), F.floor("value").alias("unique_kmers"))


over("w03_low_kmer_runs", lambda spark, sf: intervals.low_runs(profile(spark, sf), 60, 1000), f"""WITH {PROFILE}, r AS (SELECT *, sum(CASE WHEN unique_kmers < 60 THEN 0 ELSE 1 END) OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS run FROM p)
SELECT seqid, min("start") AS "start", max("end") AS "end", count(*) AS n FROM r WHERE unique_kmers < 60 GROUP BY seqid, run HAVING max("end") - min("start") >= 1000""")
MERGE = """, o AS (SELECT *, max("end") OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM x),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR "start" - reach > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY seqid ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT seqid, min("start") AS "start", max("end") AS "end", count(*) AS n FROM g GROUP BY seqid, run"""
for gap, label in ((-1, "w05_merge_overlaps"), (1000, "w04_merge_near")):
    over(label, lambda spark, sf, gap=gap: intervals.merge_intervals(arrays(spark, sf).select("seqid", F.col("l_ind").alias("start"), F.col("r_ind").alias("end")), gap), f'WITH {ARRAYS}, x AS (SELECT seqid, l_ind AS "start", r_ind AS "end" FROM arrays)' + MERGE.format(gap=gap))
over("w06_exact_duplicates", lambda spark, sf: intervals.drop_duplicates(sat(spark, sf).select("trf_id", F.col("trf_head").alias("seqid"), F.col("trf_l_ind").alias("l_ind"), F.col("trf_r_ind").alias("r_ind"), "trf_pmatch")).select("seqid", "l_ind", "r_ind", "trf_pmatch"), f"WITH {SAT} SELECT trf_head AS seqid, trf_l_ind AS l_ind, trf_r_ind AS r_ind, max(trf_pmatch) AS trf_pmatch FROM sat GROUP BY 1, 2, 3")
over("w08_running_ids", lambda spark, sf: scans.numbered(arrays(spark, sf), ["seqid"], ["l_ind", "r_ind", "trf_id"]).select("trf_id", "seqid", F.col("no").cast("int").alias("no")), f"WITH {ARRAYS} SELECT trf_id, seqid, CAST(row_number() OVER (PARTITION BY seqid ORDER BY l_ind, r_ind, trf_id) AS INTEGER) AS no FROM arrays")
over("a13_w12_label_report", lambda spark, sf: intervals.label_report(intervals.annotation_labels(arrays(spark, sf), features(spark, sf))), f"""WITH {ARRAYS}, {FEATURES}, f AS (SELECT DISTINCT seqid, type, "start" - 1 AS b0, "end" AS b1 FROM features),
hits AS (SELECT trf_id, seqid, l_ind, r_ind, b0, b1, type, CASE WHEN l_ind = b0 AND r_ind = b1 THEN 'TR equal ' || type WHEN l_ind >= b0 AND r_ind <= b1 THEN 'TR in ' || type WHEN b0 >= l_ind AND b1 <= r_ind THEN type || ' in TR' WHEN l_ind < b0 THEN 'TR overlap left ' || type ELSE 'TR overlap right ' || type END AS label FROM arrays JOIN f USING (seqid) WHERE l_ind < b1 AND b0 < r_ind),
m AS (SELECT *, bool_or(type = 'CDS') OVER (PARTITION BY trf_id, seqid, l_ind, r_ind) AS cds FROM hits), k AS (SELECT DISTINCT trf_id, l_ind, r_ind, b0, b1, type, label FROM m WHERE type <> 'region' AND NOT (cds AND type IN ('gene', 'mRNA', 'exon'))),
l AS (SELECT trf_id, l_ind, r_ind, string_agg(label, '|' ORDER BY label DESC) AS s FROM k GROUP BY 1, 2, 3), a AS (SELECT coalesce(s, 'No annotation') AS trf_ref_annotation FROM arrays LEFT JOIN l USING (trf_id, l_ind, r_ind))
SELECT trf_ref_annotation, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM a), 4) AS percent FROM a GROUP BY 1""")


def source_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The sequences of each source, one behind the other by doc_id, as tiles."""
    rows = table(spark, sf, "documents").select("doc_id", "source").join(seqs(spark, sf).select(F.substring("seqid", 4, 20).cast("bigint").alias("doc_id"), F.col("seq").alias("letters")), "doc_id")
    placed = scans.running_sum(rows, ["source"], ["doc_id"], F.length("letters").cast("bigint"), "at").select(F.col("source").alias("seqid"), "at", "letters")
    lengths = placed.groupBy("seqid").agg(F.sum(F.length("letters")).alias("length"))
    return tiles.of_pieces(placed, ["seqid"]).join(lengths, "seqid")


def telomere_seqs(spark: SparkSession, sf: str) -> DataFrame:
    n = F.length("seq") % 4
    return seqs(spark, sf).select("seqid", F.concat(F.when(n < 2, F.lit("CCCTAA" * 40)).otherwise(""), "seq", F.when(n == 0, F.lit("TTAGGG" * 40)).when(n == 2, F.lit("TTAGGGTTACGG" * 2)).otherwise("")).alias("seq"))


TEL = f"t AS (SELECT seqid, CASE WHEN length(seq) % 4 < 2 THEN '{'CCCTAA' * 40}' ELSE '' END || seq || CASE length(seq) % 4 WHEN 0 THEN '{'TTAGGG' * 40}' WHEN 2 THEN '{'TTAGGGTTACGG' * 2}' ELSE '' END AS seq FROM seqs)"


def _sql_end(end: str, motif: str, side: str) -> str:
    cycle = ", ".join(f"'{k}'" for k in sorted({(motif * 2)[i : i + 4] for i in range(9)}))
    wrong = " + ".join(f"CAST(substr(e, CAST(i AS INTEGER) + {j}, 1) <> '{b}' AS INTEGER)" for j, b in enumerate(motif))
    return f"{side} AS (SELECT seqid, round(CASE WHEN length(e) > 3 THEN len(list_filter(range(1, length(e) - 2), lambda i: substr(e, CAST(i AS INTEGER), 4) IN ({cycle}))) / length(e)::DOUBLE ELSE 0 END, 4) AS {side}_share, CAST(CASE WHEN length(e) > 5 THEN len(list_filter(range(1, length(e) - 4), lambda i: ({wrong}) <= 1)) ELSE 0 END AS INTEGER) AS {side}_hits FROM (SELECT seqid, {end} AS e FROM t))"


over("d07_a20_telomere_calls", lambda spark, sf: gaps.telomere_calls(telomere_seqs(spark, sf)),
     f"WITH {SEQS}, {TEL}, {_sql_end('substr(seq, 1, 10000)', 'CCCTAA', 'left')}, {_sql_end('substr(seq, greatest(length(seq) - 9999, 1), 10000)', 'TTAGGG', 'right')}, c AS (SELECT *, CASE WHEN left_share >= 0.15 THEN 'PRESENT' WHEN left_hits >= 10 THEN 'PARTIAL' ELSE 'ABSENT' END AS left_call, CASE WHEN right_share >= 0.15 THEN 'PRESENT' WHEN right_hits >= 10 THEN 'PARTIAL' ELSE 'ABSENT' END AS right_call FROM \"left\" JOIN \"right\" USING (seqid)) SELECT seqid, left_share, left_hits, left_call, right_share, right_hits, right_call, CASE WHEN left_call = 'PRESENT' AND right_call = 'PRESENT' THEN 'T2T' ELSE 'INCOMPLETE' END AS status FROM c".replace('left AS (', '"left" AS (').replace('right AS (', '"right" AS ('))
over("d11_z07_kmer_profile", lambda spark, sf: gaps.kmer_profile(seqs(spark, sf), 5, 400, 100),
     f"""WITH {SEQS}, k AS (SELECT seqid, length(seq) AS n, i, substr(seq, CAST(i AS INTEGER) + 1, 5) AS kmer FROM seqs, LATERAL (SELECT unnest(range(0, length(seq) - 4)) AS i) WHERE length(seq) > 4), w AS (SELECT *, unnest(range(greatest(CAST(floor((i - 400) / 100.0) AS BIGINT) + 1, 0), i // 100 + 1)) AS w FROM k)
SELECT seqid, w * 100 AS "start", least(w * 100 + 400, n) AS "end", count(DISTINCT kmer) AS unique_kmers FROM w GROUP BY seqid, w, n""")  # fmt: skip
# the same with the defaults, on the sequences of a source one behind the other
over("d11_kmer_profile_defaults", lambda spark, sf: gaps.kmer_profile_of_tiles(source_tiles(spark, sf)),
     f"""WITH {SEQS}, j AS (SELECT source AS seqid, string_agg(seq, '' ORDER BY doc_id) AS seq FROM documents d JOIN seqs s ON s.seqid = 'doc' || doc_id GROUP BY 1), k AS (SELECT seqid, length(seq) AS n, i, substr(seq, CAST(i AS INTEGER) + 1, 17) AS kmer FROM j, LATERAL (SELECT unnest(range(0, length(seq) - 16)) AS i) WHERE length(seq) > 16),
w AS (SELECT *, unnest(range(greatest(CAST(floor((i - 100000) / 25000.0) AS BIGINT) + 1, 0), i // 25000 + 1)) AS w FROM k) SELECT seqid, w * 25000 AS "start", least(w * 25000 + 100000, n) AS "end", count(DISTINCT kmer) AS unique_kmers FROM w GROUP BY seqid, w, n""")  # fmt: skip
over("d12_a24_w14_monomers", lambda spark, sf: gaps.monomer_summary(sat(spark, sf).select(F.col("trf_id").alias("array_id"), F.col("trf_array").alias("seq"), F.col("trf_period").alias("period"))).select("n", "bp", "first", "lengths"),
     f"WITH {SAT}, d AS (SELECT DISTINCT trf_id, trf_period, trf_array FROM sat WHERE trf_array_length >= trf_period), m AS (SELECT trf_id, trf_period AS p, trf_array, i, substr(trf_array, CAST(i AS INTEGER) + 1, trf_period) AS cut FROM d, LATERAL (SELECT unnest(range(0, length(trf_array), trf_period)) AS i)) SELECT count(*) AS n, CAST(sum(length(cut)) AS BIGINT) AS bp, min_by(cut, i) AS first, string_agg(length(cut), ',' ORDER BY i) AS lengths FROM m WHERE length(cut) = p GROUP BY trf_id, p, trf_array")
over("d16_gene_density", lambda spark, sf: intervals.density(features(spark, sf).where("type = 'CDS'").select("seqid", F.col("start").alias("l_ind"), F.col("end").alias("r_ind")), F.lit("CDS"), 50000), f"""WITH {FEATURES}, arrays AS (SELECT seqid, "start" AS l_ind, "end" AS r_ind FROM features WHERE type = 'CDS'), """ + DENS.format(a="", b=50000, c="'CDS'").removeprefix("WITH , ") + " SELECT * FROM d")


def families(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats as members of families named by their period; those longer than 60 bases are core."""
    return sat(spark, sf).select(F.concat(F.lit("SF"), F.lpad(F.col("trf_period").cast("string"), 4, "0")).alias("family"), F.col("trf_l_ind").alias("start"), F.col("trf_array_length").alias("bp"), (F.col("trf_array_length") > 60).alias("core"), F.col("trf_consensus").alias("consensus"))


over("a18_family_info", lambda spark, sf: classify.family_info(families(spark, sf)), f"""WITH {SAT}, f AS (SELECT 'SF' || lpad(CAST(trf_period AS VARCHAR), 4, '0') AS family, count(*) AS n, CAST(sum(trf_array_length) AS BIGINT) AS bp, CAST(sum(CASE WHEN trf_array_length > 60 THEN trf_array_length ELSE 0 END) AS BIGINT) AS core_bp, first(trf_consensus ORDER BY trf_l_ind, trf_consensus) AS consensus FROM sat GROUP BY 1)
SELECT *, CAST(row_number() OVER (ORDER BY core_bp DESC, family) AS INTEGER) AS rank FROM f""")
over("a19_assembly_summary", lambda spark, sf: seqs(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("seq")).alias("bp"), F.max(F.length("seq")).alias("longest"), F.count_if(F.length("seq") >= 500).alias("n_500")), f"WITH {SEQS} SELECT count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS bp, CAST(max(length(seq)) AS INTEGER) AS longest, count(*) FILTER (length(seq) >= 500) AS n_500 FROM seqs")
over("a21_consistency", lambda spark, sf: versions.consistency(seqs(spark, sf).select("seqid", F.length("seq").cast("bigint").alias("length")), sat(spark, sf).select(F.col("trf_head").alias("seqid")), 500), f"WITH {SAT} SELECT count(*) AS total, count(*) FILTER (length(seq) >= 500) AS large, count(*) FILTER (length(seq) < 500) AS skipped, CAST(sum(length(seq)) AS BIGINT) AS bp, CAST(coalesce(sum(length(seq)) FILTER (length(seq) >= 500), 0) AS BIGINT) AS large_bp, (SELECT count(DISTINCT trf_head) FROM sat) AS with_rows FROM seqs")
over("a28_run_summary", lambda spark, sf: classify.run_summary(table(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("skipped").alias("status"), F.col("o_totalprice").alias("seconds"))), "SELECT count(*) FILTER (o_orderstatus = 'F') AS success, count(*) FILTER (o_orderstatus = 'O') AS failed, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS skipped, round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS mean_seconds FROM orders")
over("a20_telomere_summary", lambda spark, sf: telomeres.telomere_summary(gaps.telomere_calls(telomere_seqs(spark, sf))), ORACLE_SQL["d07_a20_telomere_calls"].replace("SELECT seqid, left_share, left_hits, left_call", "SELECT count(*) AS n, count(*) FILTER (left_call = 'PRESENT' AND right_call = 'PRESENT') AS t2t, count(*) FILTER (left_call = 'PRESENT') AS left_present, count(*) FILTER (right_call = 'PRESENT') AS right_present FROM c -- ").split(" -- ")[0])
BACK = "(?:" + "|".join("CCCTAA"[:i] + "." + "CCCTAA"[i + 1 :] for i in range(6)) + ")"
REVERSED = "(?:" + "|".join("GGGATT"[:i] + "." + "GGGATT"[i + 1 :] for i in range(6)) + ")"
over("w11_terminal_repeats", lambda spark, sf: telomeres.terminal_repeats(telomere_seqs(spark, sf)), f"""WITH {SEQS}, {TEL} SELECT seqid, length(regexp_extract(seq, '^[Nn]*({BACK}*)', 1)) // 6 AS "left", length(regexp_extract(reverse(seq), '^[Nn]*({REVERSED}*)', 1)) // 6 AS "right" FROM t""")


def view_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Length, telomere calls, densities of length categories and families (their consensus as it stands) of every sequence."""
    rows = sat(spark, sf).select(F.col("trf_head").alias("seqid"), F.col("trf_l_ind").alias("l_ind"), F.col("trf_r_ind").alias("r_ind"), F.col("trf_consensus").alias("family"), F.col("trf_array_length").alias("bp"))
    lengths = seqs(spark, sf).select("seqid", F.length("seq").cast("bigint").alias("length"))
    view = views.chromosome_view(lengths, gaps.telomere_calls(telomere_seqs(spark, sf)), intervals.density(rows, F.when(F.col("bp") < 60, "short").otherwise("long"), 100), rows)
    return view.withColumns({"densities": views.flat(F.col("densities"), ["bin", "category", "bp"]), "families": views.flat(F.col("families"), ["family", "n", "bp"])})


CALLS = ORACLE_SQL["d07_a20_telomere_calls"].removeprefix(f"WITH {SEQS}, ").replace(" SELECT seqid, left_share", ", calls AS (SELECT seqid, left_share") + ")"
over("d13_chromosome_view", view_rows, f"""WITH {SAT}, {CALLS}, cut AS (SELECT trf_head AS seqid, trf_l_ind AS l, trf_r_ind AS r, CASE WHEN trf_array_length < 60 THEN 'short' ELSE 'long' END AS category, unnest(range(trf_l_ind // 100, trf_r_ind // 100 + 1)) AS bin FROM sat),
d AS (SELECT seqid, bin, category, CAST(sum(greatest(least(r, (bin + 1) * 100) - greatest(l, bin * 100), 0)) AS BIGINT) AS bp FROM cut GROUP BY ALL), ds AS (SELECT seqid, string_agg(bin || ':' || category || ':' || bp, ',' ORDER BY bin, category) AS densities FROM d GROUP BY 1),
f AS (SELECT trf_head AS seqid, trf_consensus AS family, count(*) AS n, CAST(sum(trf_array_length) AS BIGINT) AS bp FROM sat GROUP BY 1, 2), fs AS (SELECT seqid, string_agg(family || ':' || n || ':' || bp, ',' ORDER BY family) AS families FROM f GROUP BY 1)
SELECT s.seqid, length(seq) AS length, round(100.0 * length(seq) / (SELECT max(length(seq)) FROM seqs)::DOUBLE, 2) AS percent_of_longest, left_call, right_call, status, coalesce(densities, '') AS densities, coalesce(families, '') AS families
FROM seqs s LEFT JOIN calls USING (seqid) LEFT JOIN ds USING (seqid) LEFT JOIN fs USING (seqid)""".replace(", cut AS (SELECT trf_head", ", bins AS (SELECT trf_head").replace("FROM cut GROUP BY ALL)", "FROM bins GROUP BY ALL)"))
over("a19_t2t_and_sites", lambda spark, sf: views.assembly_view(seqs(spark, sf).select("seqid", F.length("seq").cast("bigint").alias("length")), gaps.telomere_calls(telomere_seqs(spark, sf)), telomeres.interstitial_sites(telomere_seqs(spark, sf), skip=10, least=4)), None)
over("d08_exact_blocks", lambda spark, sf: telomeres.exact_blocks(telomere_seqs(spark, sf)), None)
over("w10_x08_interstitial_sites", lambda spark, sf: telomeres.interstitial_sites(telomere_seqs(spark, sf), skip=10, least=4), None)
# one sequence after the other has no SQL; a test walks the smallest table
over("d10_chunks", lambda spark, sf: extract.chunked(seqs(spark, sf).withColumn("no", F.substring("seqid", 4, 20).cast("bigint")), size=100000), None)
over("w06_w07_refined_overlaps", lambda spark, sf: overlaps.refine_overlaps(sat(spark, sf)), None)


def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The category summary with display labels."""
    labels = spark.createDataFrame([("pmicro", "Perfect microsatellites"), ("micro", "Microsatellites"), ("tSSR", "True SSR"), ("fSSR", "Fuzzy SSR"), ("complex", "Complex")], "category string, label string")
    return classify.category_summary(classes(spark, sf), genome(spark, sf)).join(F.broadcast(labels), "category").select("category", "label", "n", "pgenome")


over("d15_report_rows", report_rows, f"{WITH}, l(category, label) AS (VALUES ('pmicro', 'Perfect microsatellites'), ('micro', 'Microsatellites'), ('tSSR', 'True SSR'), ('fSSR', 'Fuzzy SSR'), ('complex', 'Complex')) SELECT category, label, count(*) AS n, round(100.0 * sum(trf_array_length) / {GENOME}, 3) AS pgenome FROM classes JOIN l USING (category) GROUP BY 1, 2")
