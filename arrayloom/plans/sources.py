"""Queries of parsers and line forms (S, K, Z): lines are written from the driver's tables and parsed again."""

from __future__ import annotations

from pyspark.sql import functions as F

from arrayloom.functions import seqfn
from arrayloom.sources import quality, sinks, text
from arrayloom.streaming import incremental

from .tables import BEDS, FEATURES, SAT, beds, features, sat, table

QUERIES, ORACLE_SQL = {}, {}


def over(name: str, rows, sql: str) -> None:
    QUERIES[name], ORACLE_SQL[name] = rows, sql


def bed_line():
    return F.when(F.col("start") % 50 == 0, F.lit("# comment")).when(F.col("start") % 50 == 1, F.concat_ws("\t", "seqid", "start")).when(F.col("start") % 50 == 2, F.concat_ws("\t", "seqid", F.lit("x"), "end")).when(
    F.col("start") % 50 == 3, F.concat_ws("\t", "seqid", "end", "start")).otherwise(F.concat_ws("\t", F.concat("seqid", F.lit(" more")), "start", "end", "period", F.lit("."), "strand"))


over("s07_parse_bed", lambda spark, sf: text.parse_bed(beds(spark, sf).select(bed_line().alias("value"))), f'WITH {BEDS} SELECT seqid, "start", "end", period, strand FROM beds WHERE "start" % 50 > 3')
over("s04_s06_parse_sat", lambda spark, sf: text.parse_sat(sat(spark, sf).select(F.concat_ws("\t", "project", "trf_id", "trf_head", F.concat(F.col("trf_l_ind").cast("string"), F.lit(".0")), "trf_r_ind", F.lit("bad"), "trf_n_copy", F.lit(""), "trf_pvar", "trf_entropy", F.lit("None"), "trf_array", "trf_array_gc", "trf_consensus_gc", "trf_array_length", F.lit("0")).alias("value"))).select("trf_id", "trf_head", "trf_l_ind", "trf_r_ind", "trf_period", "trf_n_copy", "trf_pmatch", "trf_pvar", "trf_entropy", "trf_consensus", "trf_array", "trf_array_length", "trf_joined"),
     f"WITH {SAT} SELECT trf_id, trf_head, trf_l_ind, trf_r_ind, 0 AS trf_period, trf_n_copy, 0.0 AS trf_pmatch, trf_pvar, trf_entropy, NULL AS trf_consensus, trf_array, trf_array_length, 0 AS trf_joined FROM sat")
def gff():
    return F.concat_ws("\t", "seqid", F.lit("src"), "type", "start", "end", F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit("ID=f"), F.col("start").cast("string"), F.lit(";Dbxref=GeneID:"), F.col("end").cast("string"), F.lit(",HGNC:7")))


over("s08_f11_parse_gff3", lambda spark, sf: text.parse_gff3(features(spark, sf).select(gff().alias("value")), ["CDS", "gene"]).select("seqid", "type", "start", "end", F.element_at("attributes", F.lit("ID")).alias("id"), F.element_at("dbxref", F.lit("GeneID")).alias("gene_id")),
     f"""WITH {FEATURES} SELECT seqid, type, "start", "end", 'f' || "start" AS id, CAST("end" AS VARCHAR) AS gene_id FROM features WHERE type IN ('CDS', 'gene')""")
def repeatmasker():
    e50 = F.floor(F.col("end") / 50)
    return F.when(e50 % 4 == 2, F.concat(F.lit(" 100 1.0 2.0 3.0 "), F.concat_ws("   ", "seqid", "end", "start"), F.lit(" (0) + rep "), F.col("type"))).when(e50 % 8 == 0, F.lit("   SW  perc perc")).when(e50 % 8 == 4, F.concat_ws("  ", F.lit("1 2 3 4"), "seqid", "start")).otherwise(F.concat(F.lit(" 100 1.0 2.0 3.0 "), F.concat_ws("   ", "seqid", "start", "end"), F.lit(" (0) + rep "), F.col("type")))


over("s09_f13_repeatmasker_quality", lambda spark, sf: text.repeatmasker_quality(features(spark, sf).select(repeatmasker().alias("value"))).groupBy("flag").agg(F.count(F.lit(1)).alias("n")),
     f"""WITH {FEATURES} SELECT CASE WHEN ("end" // 50) % 4 = 2 THEN 'reversed' WHEN ("end" // 50) % 8 = 4 THEN 'short' ELSE 'ok' END AS flag, count(*) AS n FROM features WHERE NOT (("end" // 50) % 4 <> 2 AND ("end" // 50) % 8 = 0) GROUP BY 1""")
def broken_gff():
    e = F.col("end") % 16
    return F.when(e == 0, F.lit("#comment")).when(e == 1, F.concat_ws("\t", "seqid", "start")).when(e == 2, F.regexp_replace(gff(), "\t\\d+\t\\d+", "\tx\t9")).when(e == 3, F.regexp_replace(gff(), "\t\\d+\t\\d+", "\t10\t9")).when(e == 4, F.regexp_replace(gff(), "\t\\d+\t\\d+", "\t0\t9")).otherwise(gff())


over("f13_gff_quality", lambda spark, sf: quality.flag_counts(quality.gff_quality(features(spark, sf).select(broken_gff().alias("value")))),
     f"""WITH {FEATURES} SELECT CASE "end" % 16 WHEN 1 THEN 'short' WHEN 2 THEN 'bad number' WHEN 3 THEN 'reversed' WHEN 4 THEN 'below 1' ELSE 'ok' END AS flag, count(*) AS n FROM features WHERE "end" % 16 > 0 GROUP BY 1""")
over("s09_parse_repeatmasker", lambda spark, sf: text.parse_repeatmasker(features(spark, sf).select(repeatmasker().alias("value"))), f"""WITH {FEATURES} SELECT seqid, "start", "end", 'RM_' || type AS type FROM features WHERE ("end" // 50) % 4 <> 2 AND ("end" // 50) % 4 <> 0""")
def trf():
    return F.concat_ws(" ", "start", "end", "period", F.lit("2.5"), "period", F.lit("90"), F.lit("1"), F.lit("55"), F.lit("25"), F.lit("25"), F.lit("25"), F.lit("25"), F.lit("1.9"), F.lit("ACG"), "seqid")


over("s11_parse_trf_line", lambda spark, sf: beds(spark, sf).withColumn("r", text.parse_trf_line(F.when(F.col("start") % 5 == 0, F.lit("1 2 3")).otherwise(trf()))).where("r IS NOT NULL").select("r.start", "r.end", "r.period", "r.copies", "r.pmatch", "r.entropy", "r.consensus", "r.array"),
     f"""WITH {BEDS} SELECT "start", "end", period, 2.5::DOUBLE AS copies, 90::DOUBLE AS pmatch, 1.9::DOUBLE AS entropy, 'ACG' AS consensus, seqid AS "array" FROM beds WHERE "start" % 5 <> 0""")
over("s20_array_id_parts", lambda spark, sf: beds(spark, sf).select(sinks.coordinate_name(F.concat(F.lit("NC_1."), "seqid"), F.col("start"), F.col("end"), F.col("period")).alias("array_id")).withColumn("p", text.array_id_parts(F.col("array_id"))).select("array_id", "p.*"),
     f"""WITH {BEDS} SELECT 'NC_1.' || seqid || '_' || "start" || '_' || "end" || '_' || ("end" - "start") || '_' || period AS array_id, 'NC_1.' || seqid AS seqid, "start", "end", "end" - "start" AS length, period FROM beds""")
over("s22_dictionary", lambda spark, sf: table(spark, sf, "orders").join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), "SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
over("s22_parse_dictionary", lambda spark, sf: text.parse_dictionary(table(spark, sf, "customer").select(F.concat_ws("\t", F.col("c_custkey").cast("string"), "c_mktsegment", "c_name").alias("value")), F.lower), "SELECT CAST(c_custkey AS VARCHAR) AS key, lower(c_mktsegment) AS value FROM customer")
RC = "reverse(translate(trf_consensus, 'ACGTacgt', 'TGCAtgca'))"
over("s23_s24_both_strand_index", lambda spark, sf: sat(spark, sf).select("trf_head", F.explode(F.array("trf_consensus", seqfn.revcomp(F.col("trf_consensus")))).alias("kmer")).groupBy("kmer").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("trf_head").alias("n_heads")), f"WITH {SAT}, k AS (SELECT trf_head, unnest([trf_consensus, {RC}]) AS kmer FROM sat) SELECT kmer, count(*) AS n, count(DISTINCT trf_head) AS n_heads FROM k GROUP BY 1")
over("k03_row_lines", lambda spark, sf: sat(spark, sf).select(sinks.row_line("project", "trf_id", "trf_head", "trf_l_ind", "trf_r_ind", "trf_period", "trf_array").alias("line")), f"WITH {SAT} SELECT concat_ws(chr(9), project, trf_id, trf_head, trf_l_ind, trf_r_ind, trf_period, trf_array) AS line FROM sat")
over("k04_json", lambda spark, sf: sat(spark, sf).select(F.to_json(F.struct("trf_id", "trf_l_ind", "trf_array")).alias("line")), f"""WITH {SAT} SELECT '{{"trf_id":"' || trf_id || '","trf_l_ind":' || trf_l_ind || ',"trf_array":"' || trf_array || '"}}' AS line FROM sat""")
over("k05_k06_k07_fasta", lambda spark, sf: sat(spark, sf).select(sinks.fasta_record(F.concat_ws("_", "trf_id", "project"), F.col("trf_array")).alias("record"), sinks.fasta_record(sinks.coordinate_name(F.col("trf_head"), F.col("trf_l_ind") - 1, F.col("trf_r_ind"), F.col("trf_period")), F.col("trf_array")).alias("placed"), sinks.fasta_record(F.concat_ws("\t", "trf_id", F.lit("F")), F.repeat("trf_consensus", F.lit(3))).alias("monomer")),
     f"WITH {SAT} SELECT '>' || trf_id || '_' || project || chr(10) || trf_array AS record, '>' || trf_head || '_' || (trf_l_ind - 1) || '_' || trf_r_ind || '_' || trf_array_length || '_' || trf_period || chr(10) || trf_array AS placed, '>' || trf_id || chr(9) || 'F' || chr(10) || repeat(trf_consensus, 3) AS monomer FROM sat")
over("k08_c04_gff3_lines", lambda spark, sf: sat(spark, sf).select(sinks.gff3_line(F.col("trf_head"), "tool", "tSSR", F.col("trf_r_ind"), F.col("trf_l_ind"), 1000, {"id": F.col("trf_id"), "period": F.col("trf_period")}).alias("line")), f"WITH {SAT} SELECT concat_ws(chr(9), trf_head, 'tool', 'tSSR', least(trf_l_ind, trf_r_ind), greatest(trf_l_ind, trf_r_ind), '1000', CASE WHEN trf_r_ind < trf_l_ind THEN '+' ELSE '-' END, '.', 'id=' || trf_id || ';period=' || trf_period) AS line FROM sat")
over("k09_gff3_attributes", lambda spark, sf: text.parse_gff3(features(spark, sf).select(gff().alias("value"))).select("seqid", "start", sinks.gff3_attributes(F.col("attributes")).alias("attributes")), f"""WITH {FEATURES} SELECT seqid, "start", 'Dbxref=GeneID:' || "end" || ',HGNC:7;ID=f' || "start" AS attributes FROM features""")
over("k10_k12_bed_lines", lambda spark, sf: sat(spark, sf).select(sinks.bed3_line(F.col("trf_head"), F.col("trf_r_ind"), F.col("trf_l_ind")).alias("bed"), sinks.gap_line(F.col("trf_head"), F.col("trf_l_ind"), F.col("trf_r_ind")).alias("gap")), f"WITH {SAT} SELECT concat_ws(chr(9), trf_head, trf_l_ind, trf_r_ind) AS bed, concat_ws(chr(9), trf_head, trf_l_ind, trf_r_ind, 'gap', trf_r_ind - trf_l_ind, '.') AS gap FROM sat")
over("k11_index_rows", lambda spark, sf: sat(spark, sf).select("trf_id", F.concat_ws("\t", "trf_id", "trf_period", "trf_array_length", "trf_consensus").alias("line")), f"WITH {SAT} SELECT trf_id, concat_ws(chr(9), trf_id, trf_period, trf_array_length, trf_consensus) AS line FROM sat")
over("z07_windowed_totals", lambda spark, sf: incremental.windowed_totals(table(spark, sf, "events")).select(F.unix_seconds(F.col("start").cast("timestamp")).alias("start"), F.unix_seconds(F.col("end").cast("timestamp")).alias("end"), "event_type", "n", F.round("total", 4).alias("total")),
     """WITH w AS (SELECT event_type, value, unnest(range(CAST(floor(epoch(ts) / 900) AS BIGINT) - 3, CAST(floor(epoch(ts) / 900) AS BIGINT) + 1)) * 900 AS s FROM events) SELECT s AS "start", s + 3600 AS "end", event_type, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY 1, 2, 3""")  # fmt: skip
