"""Domain tables derived from the driver's tables, in Spark and as SQL common table expressions of the same content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrayloom.operators.extract import extract_arrays


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if it comes from fewer files than there are; large tables are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores // 2 else df


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seqid, seq): the letters a, c, g, t, n of every document in upper case."""
    seq = F.regexp_replace(F.translate("text", "acgtn", "ACGTN"), "[^ACGTN]+", "")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("seqid"), F.coalesce(seq, F.lit("")).alias("seq"))


SEQS = "seqs AS (SELECT 'doc' || doc_id AS seqid, coalesce(regexp_replace(translate(text, 'acgtn', 'ACGTN'), '[^ACGTN]', '', 'g'), '') AS seq FROM documents)"


def beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seqid, start, end, period, strand), 0-based half-open; one per line item."""
    n = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n_docs"))
    start = (F.col("l_partkey") * 7 + F.col("l_linenumber")) % 300
    items = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")).crossJoin(F.broadcast(n))  # one row
    return items.select(
        F.concat(F.lit("doc"), (F.col("l_orderkey") % F.col("n_docs")).cast("string")).alias("seqid"),
        start.alias("start"),
        (start + F.col("l_quantity").cast("bigint") * 3).alias("end"),
        (F.col("l_partkey") % 12 + 1).cast("int").alias("period"),
        F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("strand"),
    )


BEDS = """beds AS (SELECT 'doc' || (l_orderkey % (SELECT count(*) FROM documents)) AS seqid, (l_partkey * 7 + l_linenumber) % 300 AS "start",
(l_partkey * 7 + l_linenumber) % 300 + CAST(l_quantity AS BIGINT) * 3 AS "end", CAST(1 + l_partkey % 12 AS INTEGER) AS period,
CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand FROM lineitem)"""


def sat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeat table cut out of the sequences."""
    return extract_arrays(seqs(spark, sf_dir), beds(spark, sf_dir), "sf")


REVCOMP_N = "reverse(translate(regexp_replace({0}, '[^ACGTNacgtn]', 'N', 'g'), 'ACGTacgt', 'TGCAtgca'))"


def sql_gc(s: str) -> str:
    return f"CASE WHEN length({s}) > 0 THEN (length({s}) - length(translate({s}, 'GCgc', ''))) / length({s})::DOUBLE ELSE 0.0 END"


def sql_entropy(s: str) -> str:
    term = lambda b: f"CASE WHEN length({s}) > length(translate({s}, '{b}', '')) THEN -((length({s}) - length(translate({s}, '{b}', ''))) / length({s})::DOUBLE) * log2((length({s}) - length(translate({s}, '{b}', ''))) / length({s})::DOUBLE) ELSE 0.0 END"
    return f"CASE WHEN length({s}) > 0 THEN round({' + '.join(term(b) for b in ('Aa', 'Cc', 'Gg', 'Tt'))}, 2) ELSE 0.0 END"


def sql_pmatch(s: str, p: str) -> str:
    return f"CASE WHEN length({s}) > 0 AND {p} > 0 THEN round(100.0 * len(list_filter(range(0, length({s})), lambda i: substr({s}, CAST(i AS INTEGER) + 1, 1) = substr({s}, CAST(i AS INTEGER) % {p} + 1, 1))) / length({s})::DOUBLE) ELSE 0.0 END"


SAT = f"""{SEQS}, {BEDS}, cut AS (SELECT b.seqid, b."start", b."end", b.period,
CASE WHEN b.strand = '-' THEN {REVCOMP_N.format('substr(s.seq, b."start" + 1, b."end" - b."start")')} ELSE substr(s.seq, b."start" + 1, b."end" - b."start") END AS trf_array
FROM beds b JOIN seqs s USING (seqid) WHERE b."start" >= 0 AND b."start" < b."end" AND b."end" <= length(s.seq)),
sat AS (SELECT 'sf' AS project, seqid || '_' || ("start" + 1) || '_' || "end" AS trf_id, seqid AS trf_head, "start" + 1 AS trf_l_ind, "end" AS trf_r_ind, period AS trf_period,
CASE WHEN period > 0 THEN round(("end" - "start") / period::DOUBLE, 1) ELSE 0.0 END AS trf_n_copy, {sql_pmatch('trf_array', 'period')} AS trf_pmatch,
100 - {sql_pmatch('trf_array', 'period')} AS trf_pvar, {sql_entropy('trf_array')} AS trf_entropy, substr(trf_array, 1, period) AS trf_consensus, trf_array,
round({sql_gc('trf_array')}, 2) AS trf_array_gc, round({sql_gc('substr(trf_array, 1, period)')}, 2) AS trf_consensus_gc, "end" - "start" AS trf_array_length FROM cut)"""


def arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trf_id, seqid, l_ind, r_ind): repeats on 25 sequences."""
    l_ind = F.col("l_orderkey") * 1000 + F.col("l_linenumber") * 100
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("trf_id"),
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 25).cast("string")).alias("seqid"),
        l_ind.alias("l_ind"),
        (l_ind + F.col("l_quantity").cast("bigint") * 20).alias("r_ind"),
    )


ARRAYS = "arrays AS (SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS trf_id, 'chr' || (l_suppkey % 25) AS seqid, l_orderkey * 1000 + l_linenumber * 100 AS l_ind, l_orderkey * 1000 + l_linenumber * 100 + CAST(l_quantity AS BIGINT) * 20 AS r_ind FROM lineitem)"


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seqid, type, start, end): annotation on the same sequences, 1-based inclusive."""
    start = F.col("o_orderkey") * 1000 + F.col("o_custkey") % 7 * 100
    kind = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("chr"), (F.col("o_custkey") % 25).cast("string")).alias("seqid"),
        F.when(kind == "1-URGENT", "CDS").when(kind == "2-HIGH", "gene").when(kind == "3-MEDIUM", "exon").when(kind == "5-LOW", "mRNA").otherwise("region").alias("type"),
        start.alias("start"),
        (start + 200 + F.col("o_orderkey") % 9 * 150).alias("end"),
    )


FEATURES = """features AS (SELECT 'chr' || (o_custkey % 25) AS seqid, CASE o_orderpriority WHEN '1-URGENT' THEN 'CDS' WHEN '2-HIGH' THEN 'gene' WHEN '3-MEDIUM' THEN 'exon' WHEN '5-LOW' THEN 'mRNA' ELSE 'region' END AS type,
o_orderkey * 1000 + o_custkey % 7 * 100 AS "start", o_orderkey * 1000 + o_custkey % 7 * 100 + 200 + o_orderkey % 9 * 150 AS "end" FROM orders)"""
