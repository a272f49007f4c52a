"""Queries of the sequence functions, filters and class names (P, F, C)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrayloom.functions import seqfn
from arrayloom.operators import classify, gaps

from .tables import SAT, SEQS, sat, seqs, sql_entropy, sql_gc, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
RC = "reverse(translate({0}, 'ACGTacgt', 'TGCAtgca'))"
ROT = "list_transform(range(1, length({0}) + 1), lambda i: substr({0} || {0}, CAST(i AS INTEGER), CAST(length({0}) AS INTEGER)))"
CANON = f"list_min(list_concat({ROT}, {ROT.replace('{0}', RC)}))"


def over_seqs(name: str, make: Callable[[], dict[str, Column]], sql: str, where: str = "TRUE") -> None:
    """A query of expressions over the sequences."""
    QUERIES[name] = lambda spark, sf: seqs(spark, sf).where(where).select("seqid", *[c.alias(k) for k, c in make().items()])
    ORACLE_SQL[name] = f"WITH {SEQS} SELECT seqid, {sql} FROM seqs WHERE {where}"


def over(name: str, rows: Callable[[SparkSession, str], DataFrame], sql: str) -> None:
    QUERIES[name], ORACLE_SQL[name] = rows, sql


S = "seq"
over("p01_clean_sequence", lambda spark, sf: table(spark, sf, "documents").select("doc_id", seqfn.clean_sequence(F.replace("text", F.lit("ß"), F.lit("-"))).alias("clean")),
     r"SELECT doc_id, regexp_replace(upper(replace(text, 'ß', '-')), '[^ACTGNUWSMKRYBDHV\-]', '', 'g') AS clean FROM documents")
over_seqs("p02_gc_fraction", lambda: {"gc": F.round(seqfn.gc_fraction(S), 6)}, f"round({sql_gc('seq')}, 6) AS gc")
over_seqs("p03_gc_percent", lambda: {"gc": F.round(seqfn.gc_percent(S), 4)}, f"round(100 * ({sql_gc('seq')}), 4) AS gc")
over_seqs("p04_int_gc", lambda: {"gc": seqfn.int_gc(S)}, f"CAST(trunc(100 * round_even({sql_gc('seq')}, 2)) AS INTEGER) AS gc")
over_seqs("p05_revcomp_drop", lambda: {"rc": seqfn.revcomp_drop(F.concat(S, F.lit("xyZ[~]")))}, r"reverse(translate(regexp_replace(seq || 'xyZ[~]', '[^ACGTNacgtn~\[\]]', '', 'g'), 'ACGTacgt[]', 'TGCAtgca][')) AS rc")
over_seqs("p06_revcomp_n", lambda: {"rc": seqfn.revcomp_n(F.concat(S, F.lit("xyZ")))}, "reverse(translate(regexp_replace(seq || 'xyZ', '[^ACGTNacgtn]', 'N', 'g'), 'ACGTacgt', 'TGCAtgca')) AS rc")
over_seqs("p07_revcomp_keep", lambda: {"rc": seqfn.revcomp(F.concat(S, F.lit("xyZ")))}, f"{RC.format('(seq || ' + chr(39) + 'xyZ' + chr(39) + ')')} AS rc")
over_seqs("p08_entropy", lambda: {"entropy": seqfn.entropy(S)}, f"{sql_entropy('seq')} AS entropy")
over("p09_p11_match_copies_consensus", lambda spark, sf: sat(spark, sf).select("trf_id", "trf_period", "trf_pmatch", "trf_n_copy", "trf_consensus"), f"WITH {SAT} SELECT trf_id, trf_period, trf_pmatch, trf_n_copy, trf_consensus FROM sat")
over("p12_rotations", lambda spark, sf: sat(spark, sf).select("trf_id", F.array_join(seqfn.rotations(F.col("trf_consensus")), ",").alias("rotations")), f"WITH {SAT} SELECT trf_id, array_to_string({ROT.format('trf_consensus')}, ',') AS rotations FROM sat")
over("p13_canonical", lambda spark, sf: sat(spark, sf).select("trf_id", seqfn.canonical(F.col("trf_consensus")).alias("canonical")), f"WITH {SAT} SELECT trf_id, {CANON.format('trf_consensus')} AS canonical FROM sat")
ROOT = "substr({0}, 1, CAST(list_min(list_filter(range(1, length({0}) + 1), lambda d: length({0}) % d = 0 AND repeat(substr({0}, 1, CAST(d AS INTEGER)), CAST(length({0}) // d AS INTEGER)) = {0})) AS INTEGER))"
over("p14_primitive_root", lambda spark, sf: sat(spark, sf).select("trf_id", seqfn.primitive_root(F.col("trf_consensus")).alias("root")), f"WITH {SAT} SELECT trf_id, {ROOT.format('trf_consensus')} AS root FROM sat")

HEADS = [
    ("0", "concat('>gi|', doc_id, '|ref|', 'NC_', doc_id, '.1|', source, ' chromosome ', doc_id % 24, ', whole')"),
    ("1", "concat('>probe|p', doc_id, '|ref|r', doc_id % 7, '|start|', doc_id, '|end|', doc_id + 25)"),
    ("2", "concat('>lcl|', source, ' local ', lang)"),
    ("3", "concat('psu|', source, ' psu chr', doc_id % 9, ' part')"),
    ("4", "concat('>', doc_id, chr(9), source)"),
    ("5", "concat('>', doc_id, '-', doc_id + 3)"),
    ("6", "concat('>', doc_id)"),
    ("7", "concat('>gnl|ti|', doc_id, ' trace ', lang)"),
    ("8", "concat('scaffold ', source, ' mitochondrion genome gb|ABCD', doc_id)"),
]
HEAD = "CASE doc_id % 9 " + " ".join(f"WHEN {k} THEN {v}" for k, v in HEADS) + " END"


def heads(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.expr(HEAD).alias("head"))


def _sql_heads() -> str:
    rx = lambda p, i: f"regexp_extract(head, '{p}', {i})"
    m = lambda p: f"regexp_matches(head, '{p}')"
    g, pr, lc, ps, sh, pa, nu, tr = seqfn.GENBANK, seqfn.PROBE, seqfn.LOCAL, seqfn.PSU, seqfn.SHORT, seqfn.PAIR, seqfn.NUMBER, seqfn.TRACE
    forms = [
        (g, rx(g, 1), rx(g, 2), rx(g, 3)),
        (pr, f"concat_ws('_', {rx(pr, 2)}, {rx(pr, 3)}, {rx(pr, 4)})", "'None'", f"concat_ws('_', {rx(pr, 2)}, {rx(pr, 3)}, {rx(pr, 4)}, {rx(pr, 1)})"),
        (lc, rx(lc, 1), rx(lc, 1), rx(lc, 2)),
        (ps, rx(ps, 1), rx(ps, 1), rx(ps, 2)),
        (sh, rx(sh, 1), rx(sh, 2), "'Unknown'"),
        (pa, rx(pa, 1), rx(pa, 2), "'Unknown'"),
        (nu, rx(nu, 1), "'Unknown'", "'Unknown'"),
        (tr, rx(tr, 1), rx(tr, 2), rx(tr, 2)),
    ]
    case = lambda k: "CASE " + " ".join(f"WHEN {m(f[0])} THEN {f[k]}" for f in forms) + " ELSE 'Unknown' END"
    return f"WITH h AS (SELECT doc_id, {HEAD} AS head FROM documents) SELECT doc_id, {case(1)} AS gi, {case(2)} AS accession, {case(3)} AS description FROM h"


over("p15_fasta_head", lambda spark, sf: heads(spark, sf).withColumn("h", seqfn.parse_fasta_head(F.col("head"))).select("doc_id", "h.gi", "h.accession", "h.description"), _sql_heads())
over("p16_p17_chromosome_and_wgs", lambda spark, sf: heads(spark, sf).select("doc_id", seqfn.chromosome_name(F.col("head")).alias("chromosome"), seqfn.wgs_prefix_of_accession(F.col("head")).alias("wgs_ref"), seqfn.wgs_prefix_of_head(F.col("head")).alias("wgs_head")),
     f"""WITH h AS (SELECT doc_id, {HEAD} AS head FROM documents) SELECT doc_id, coalesce(nullif(regexp_extract(head, 'chromosome ([^, ]+)', 1), ''), nullif(regexp_extract(head, 'chr(\\S+?) ', 1), ''), CASE WHEN regexp_matches(head, ' (mitochon\\S+?) ') THEN 'MT' END, '?') AS chromosome,
coalesce(nullif(regexp_extract(head, '([A-Z]+)', 1), ''), 'UNKN') AS wgs_ref, coalesce(nullif(regexp_extract(head, 'ref.([A-Z]{{4,}})', 1), ''), nullif(regexp_extract(head, 'gb.([A-Z]{{4,}})', 1), '')) AS wgs_head FROM h""")  # fmt: skip
over("p18_refined_ids", lambda spark, sf: sat(spark, sf).select(seqfn.refined_id(F.concat("trf_head", F.lit(" extra words")), F.col("trf_l_ind"), F.col("trf_r_ind")).alias("trf_id"), seqfn.numbered_id(F.col("trf_l_ind")).alias("agt"), F.upper("trf_consensus").alias("consensus")),
     f"WITH {SAT} SELECT trf_head || '_' || trf_l_ind || '_' || trf_r_ind AS trf_id, 'AGT' || lpad(CAST((trf_l_ind + 1) * 100 AS VARCHAR), 13, '0') AS agt, upper(trf_consensus) AS consensus FROM sat")
CHUNK = "CASE WHEN doc_id % 3 = 0 THEN concat('chr', doc_id % 25, '__', doc_id * 1000, '_', doc_id * 1000 + 900) ELSE concat('chr', doc_id) END"
over("p19_restored_coordinates", lambda spark, sf: table(spark, sf, "documents").select("doc_id", F.expr(CHUNK).alias("head")).withColumn("r", seqfn.restored_coordinates(F.col("head"), F.col("doc_id") % 100, F.col("doc_id") % 100 + 50)).select("doc_id", "r.head", "r.l_ind", "r.r_ind"),
     f"WITH h AS (SELECT doc_id, {CHUNK} AS head FROM documents) SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN split_part(head, '__', 1) ELSE head END AS head, doc_id % 100 + CASE WHEN doc_id % 3 = 0 THEN doc_id * 1000 ELSE 0 END AS l_ind, doc_id % 100 + 50 + CASE WHEN doc_id % 3 = 0 THEN doc_id * 1000 ELSE 0 END AS r_ind FROM h")


def motif() -> Column:
    """Sequences with planted motifs."""
    return F.when(F.length(S) % 5 == 0, F.concat(S, F.lit("TTAGGG" * 5))).when(F.length(S) % 5 == 1, F.concat(F.lit("ATTCGAAAAATTCGGGA"), S)).otherwise(S)


MOTIF_SQL = f"CASE length(seq) % 5 WHEN 0 THEN seq || '{'TTAGGG' * 5}' WHEN 1 THEN 'ATTCGAAAAATTCGGGA' || seq ELSE seq END"
over_seqs("p20_p21_motifs_and_log", lambda: {"tel": seqfn.has_telomere(motif()), "cenpb": seqfn.has_cenpb(motif()), "class_name": seqfn.motif_class(motif()), "log_length": F.round(seqfn.log_length(F.length(S)), 6)},
          f"CAST(regexp_matches({MOTIF_SQL}, '{seqfn.TELOMERE}') AS INTEGER) AS tel, CAST(regexp_matches({MOTIF_SQL}, '{seqfn.CENPB}') AS INTEGER) AS cenpb, CASE WHEN regexp_matches({MOTIF_SQL}, '{seqfn.TELOMERE}') THEN 'TEL' WHEN regexp_matches({MOTIF_SQL}, '{seqfn.CENPB}') THEN 'CENPB' ELSE 'UNK' END AS class_name, CASE WHEN length(seq) > 0 THEN round(ln(length(seq)), 6) END AS log_length")
NUMBERS = "CASE doc_id % 5 WHEN 0 THEN CAST(doc_id AS STRING) WHEN 1 THEN concat(doc_id, '.0') WHEN 2 THEN '' WHEN 3 THEN 'not-a-number' END"
over("p22_lenient_int", lambda spark, sf: table(spark, sf, "documents").select("doc_id", seqfn.lenient_int(F.expr(NUMBERS)).alias("n")), "SELECT doc_id, CASE WHEN doc_id % 5 < 2 THEN doc_id ELSE 0 END AS n FROM documents")
over("p23_trimer_and_scaffold", lambda spark, sf: sat(spark, sf).select("trf_id", F.repeat("trf_consensus", F.lit(3)).alias("trimer"), seqfn.first_word(F.concat("trf_head", F.lit(" x"))).alias("scaffold")), f"WITH {SAT} SELECT trf_id, repeat(trf_consensus, 3) AS trimer, trf_head AS scaffold FROM sat")
over("p24_renamed_chromosomes", lambda spark, sf: table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lit("chr"), F.col("n_name")).alias("chromosome")), "SELECT c_custkey, 'chr' || n_name AS chromosome FROM customer JOIN nation ON c_nationkey = n_nationkey")
KMERS = "k AS (SELECT seqid, length(seq) - 4 AS n, substr(seq, CAST(i AS INTEGER), 5) AS kmer FROM seqs, LATERAL (SELECT unnest(range(1, length(seq) - 3)) AS i) WHERE length(seq) > 4)"
over("p25_kmer_vector", lambda spark, sf: gaps.kmer_frequencies(seqs(spark, sf)).select("seqid", "kmer", F.round("tf", 8).alias("tf")),
     f"WITH {SEQS}, {KMERS}, strands AS (SELECT seqid, n, unnest([kmer, {RC.format('kmer')}]) AS kmer FROM k WHERE regexp_full_match(kmer, '[ACGT]{{5}}')) SELECT seqid, kmer, round(count(*) / (2 * first(n))::DOUBLE, 8) AS tf FROM strands GROUP BY seqid, kmer")
over("p26_canonical_kmer_vector", lambda spark, sf: gaps.canonical_frequencies(seqs(spark, sf)).select("seqid", "kmer", F.round("tf", 8).alias("tf")),
     f"WITH {SEQS}, {KMERS} SELECT seqid, least(kmer, {RC.format('kmer')}) AS kmer, round(count(*) / first(n)::DOUBLE, 8) AS tf FROM k WHERE regexp_full_match(kmer, '[ACGT]{{5}}') GROUP BY 1, 2")
over("p30_p31_length_category", lambda spark, sf: table(spark, sf, "orders").select("o_orderkey", seqfn.length_category(F.col("o_totalprice")).alias("category")), "SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN '<1k' WHEN o_totalprice < 10000 THEN '1-10k' WHEN o_totalprice < 100000 THEN '10-100k' ELSE '>100k' END AS category FROM orders")
over("p32_taxon_flags", lambda spark, sf: table(spark, sf, "documents").groupBy("source").agg(F.collect_set("lang").alias("langs")).select("source", seqfn.taxon_flags(F.col("langs"), ["de", "en", "es", "fr", "it"]).alias("flags")),
     "SELECT source, concat_ws(' ', " + ", ".join(f"CAST(CAST(bool_or(coalesce(lang = '{t}', FALSE)) AS INTEGER) AS VARCHAR)" for t in ("de", "en", "es", "fr", "it")) + ") AS flags FROM documents GROUP BY source")
NAMES = "CASE c_custkey % 4 WHEN 0 THEN concat('chr', c_custkey % 23) WHEN 1 THEN concat('chr', chr(CAST(87 + c_custkey % 4 AS INT))) WHEN 2 THEN concat('chr', c_custkey % 19, '_mat') ELSE concat('scaf', c_custkey) END"
over("p33_karyotype_key", lambda spark, sf: table(spark, sf, "customer").select("c_custkey", F.expr(NAMES).alias("name")).select("c_custkey", seqfn.karyotype_key(F.col("name")).alias("key")), "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_custkey % 23 WHEN 1 THEN 1000 + 88 WHEN 2 THEN c_custkey % 19 ELSE 10000 END AS key FROM customer")
over("p34_proposed_label", lambda spark, sf: heads(spark, sf).select("doc_id", F.coalesce(F.concat(F.lit("chr"), F.nullif(F.regexp_extract("head", r"chromosome (\d+)", 1), F.lit(""))), F.concat(F.lit("chr"), F.col("doc_id").cast("string"))).alias("label")),
     f"WITH h AS (SELECT doc_id, {HEAD} AS head FROM documents) SELECT doc_id, coalesce('chr' || nullif(regexp_extract(head, 'chromosome (\\d+)', 1), ''), 'chr' || doc_id) AS label FROM h")

# filters and classes over the repeat table
UP = "upper(trf_array)"
CNT = {b: f"(length({UP}) - length(replace({UP}, '{b}', '')))" for b in "ACGT"}
RARE = {b: f"({CNT[b]} < 4 OR {CNT[b]} / length(trf_array)::DOUBLE < 0.01)" for b in "ACGT"}
MICRO_NAME = "'(' || upper(trf_consensus) || ')n'"


def _sql_name(prefix: str, has: dict[str, str]) -> str:
    a, c, g, t = (has[b] for b in "ACGT")
    return f"CASE WHEN ({a} AND {c} AND {g}) OR ({t} AND {g} AND {c}) THEN '{prefix}_ACG' WHEN ({a} AND {c} AND {t}) OR ({t} AND {g} AND {a}) THEN '{prefix}_ACT' WHEN {a} AND {g} AND {t} THEN '{prefix}_AGT' WHEN ({a} AND {c}) OR ({t} AND {g}) THEN '{prefix}_AC' WHEN ({a} AND {g}) OR ({t} AND {c}) THEN '{prefix}_AG' WHEN {a} AND {t} THEN '{prefix}_AT' WHEN {c} AND {g} THEN '{prefix}_CG' WHEN {c} OR {g} THEN '{prefix}_C' WHEN {a} OR {t} THEN '{prefix}_A' END"


TSSR = _sql_name("tSSR", {b: f"{CNT[b]} > 0" for b in "ACGT"})
FSSR = _sql_name("fSSR", {b: f"NOT {RARE[b]}" for b in "ACGT"})
COMPLEX = "coalesce(length(trf_consensus) > 4 AND trf_array_length > 100 AND trf_pmatch < 100 AND trf_array_gc > 0.2 AND trf_array_gc < 0.8 AND trf_n_copy > 4 AND trf_entropy > 1.82, FALSE)"
FUZZY = " OR ".join(RARE.values())
TRUE = f"least({', '.join(CNT.values())}) = 0"
KEEP = ["trf_id", "trf_head", "trf_period", "trf_array_length"]


def over_class(name: str, predicate: Callable[[], Column], family: Callable[[], Column], where: str, sql_family: str) -> None:
    over(name, lambda spark, sf: classify.classify(sat(spark, sf), predicate(), family()).select(*KEEP, "trf_family"), f"WITH {SAT} SELECT {', '.join(KEEP)}, {sql_family} AS trf_family FROM sat WHERE {where}")


over_class("f01_larger_than", lambda: F.col("trf_array_length") > 100, lambda: F.lit("100"), "trf_array_length > 100", "'100'")
over_class("f02_monomer_longer", lambda: F.col("trf_period") > 5, lambda: F.lit("long"), "trf_period > 5", "'long'")
over_class("f05_c01_perfect_micro", classify.perfect_micro, classify.micro_name, "trf_period < 6 AND trf_pmatch = 100", MICRO_NAME)
over_class("f06_c01_micro", classify.micro, classify.micro_name, "trf_period < 6", MICRO_NAME)
over_class("f07_c02_true_ssr", classify.true_ssr, classify.true_ssr_name, TRUE, TSSR)
over_class("f08_c03_fuzzy_ssr", classify.fuzzy_ssr, classify.fuzzy_ssr_name, FUZZY, FSSR)
over_class("f09_complex", classify.complex_repeat, lambda: F.lit("complex"), COMPLEX, "'complex'")
CLASSES = " UNION ALL ".join(f"SELECT *, '{k}' AS category, {n} AS trf_family FROM sat WHERE {w}" for k, n, w in [("pmicro", MICRO_NAME, "trf_period < 6 AND trf_pmatch = 100"), ("micro", MICRO_NAME, "trf_period < 6"), ("tSSR", TSSR, TRUE), ("fSSR", FSSR, FUZZY), ("complex", "NULL", COMPLEX), ("1kb", "NULL", "trf_array_length > 1000"), ("10kb", "NULL", "trf_array_length > 10000"), ("100kb", "NULL", "trf_array_length > 100000"), ("1000kb", "NULL", "trf_array_length > 1000000")])
over("c05_all_classes", lambda spark, sf: classify.all_classes(sat(spark, sf)).select("trf_id", "trf_array", "category", "trf_family"), f"WITH {SAT}, classes AS ({CLASSES}) SELECT trf_id, trf_array, category, trf_family FROM classes")
over("f03_exclude_list", lambda spark, sf: table(spark, sf, "lineitem").join(table(spark, sf, "supplier").where("s_nationkey < 5").select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey", "left_anti").groupBy("l_suppkey").count().withColumnRenamed("count", "n"), "SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5) GROUP BY 1")
over("f04_subset_by_head", lambda spark, sf: sat(spark, sf).agg(F.count_if(F.contains("trf_head", F.lit("7"))).alias("n"), F.count(F.lit(1)).alias("total"), F.sum(F.when(F.contains("trf_head", F.lit("7")), F.col("trf_array_length"))).alias("bp")), f"WITH {SAT} SELECT count(*) FILTER (contains(trf_head, '7')) AS n, count(*) AS total, CAST(sum(trf_array_length) FILTER (contains(trf_head, '7')) AS BIGINT) AS bp FROM sat")
over("f10_least_scaffold_length", lambda spark, sf: seqs(spark, sf).where(F.length("seq") >= 500).select("seqid", F.length("seq").cast("bigint").alias("length")), f"WITH {SEQS} SELECT seqid, length(seq) AS length FROM seqs WHERE length(seq) >= 500")
over("f15_centromere_or_telomere", lambda spark, sf: seqs(spark, sf).select("seqid", seqfn.motif_class(motif()).alias("class_name")).where("class_name <> 'UNK'"), f"WITH {SEQS} SELECT seqid, CASE WHEN regexp_matches({MOTIF_SQL}, '{seqfn.TELOMERE}') THEN 'TEL' ELSE 'CENPB' END AS class_name FROM seqs WHERE regexp_matches({MOTIF_SQL}, '{seqfn.TELOMERE}') OR regexp_matches({MOTIF_SQL}, '{seqfn.CENPB}')")
over("f16_t05_longest", lambda spark, sf: sat(spark, sf).where("trf_period > 5").select("trf_array_length", "trf_id", "trf_array").orderBy(F.desc("trf_array_length"), "trf_id", "trf_array").limit(2000), f"WITH {SAT} SELECT trf_array_length, trf_id, trf_array FROM sat WHERE trf_period > 5 ORDER BY trf_array_length DESC, trf_id, trf_array LIMIT 2000")
