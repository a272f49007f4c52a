"""Interval joins, merges and densities. Intervals are half-open; joins meet in bins, so no pair of tables is crossed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrayloom.functions.seqfn import relation, rounded

from .scans import low_runs, merge_intervals  # noqa: F401

#: Bin of an overlap join; near the median length, so that most intervals stand in one or two bins.
BIN = 2000
#: Names of sequences that rows are compared with one by one; more are joined.
NAMES = 256


def binned(df: DataFrame, lo: Column, hi: Column, size: int, name: str) -> DataFrame:
    first = F.floor(lo / size)
    return df.withColumn(f"{name}_bin0", first).withColumn("bin", F.explode(F.sequence(first, F.greatest(first, F.floor((hi - 1) / size)))))


def overlap_join(a: DataFrame, b: DataFrame, size: int = BIN) -> DataFrame:
    """Pairs of overlapping rows of a(seqid, a0, a1, ...) and b(seqid, b0, b1, ...); a pair comes out once, in the first
    bin both stand in. Skewed bins are split by the adaptive skew join."""
    left = binned(a, F.col("a0"), F.col("a1"), size, "a")
    right = binned(b, F.col("b0"), F.col("b1"), size, "b")
    # the first bin follows from the place, so it is not shuffled beside it
    pairs = left.drop("a_bin0").join(right.drop("b_bin0"), ["seqid", "bin"])
    first = F.greatest(F.floor(F.col("a0") / size), F.floor(F.col("b0") / size))
    return pairs.where((F.col("a0") < F.col("b1")) & (F.col("b0") < F.col("a1")) & (F.col("bin") == first)).drop("bin")


def annotate(arrays: DataFrame, features: DataFrame, size: int = BIN) -> DataFrame:
    """Hits of repeats on features: trf_id, seqid, l_ind, r_ind, b0, b1, type, label.

    Features count from start - 1, repeats from their 1-based start, as the data model has it."""
    a = arrays.withColumns({"a0": F.col("l_ind"), "a1": F.col("r_ind")})
    b = features.select("seqid", "type", (F.col("start") - 1).alias("b0"), F.col("end").alias("b1")).distinct()
    hits = overlap_join(a, b, size)
    return hits.withColumn("label", relation(F.col("a0"), F.col("a1"), F.col("b0"), F.col("b1"), F.col("type"))).drop("a0", "a1")


def filter_hits(hits: DataFrame, by: list[str]) -> DataFrame:
    """Hits left by the hierarchy: no region; CDS hides gene, mRNA and exon; ncRNA and tRNA hide gene and exon."""
    has = lambda t: F.max((F.col("type") == t).cast("int")).over(Window.partitionBy(*by)) == 1
    marked = hits.withColumns({"_cds": has("CDS"), "_rna": has("ncRNA") | has("tRNA")})
    kept = marked.where(
        (F.col("type") != "region")
        & ~(F.col("_cds") & F.col("type").isin("gene", "mRNA", "exon"))
        & ~(F.col("_rna") & F.col("type").isin("gene", "exon"))
    )
    return kept.drop("_cds", "_rna").distinct()


def annotation_labels(arrays: DataFrame, features: DataFrame, size: int = BIN) -> DataFrame:
    """Each repeat with its labels, descending, pipe-joined; 'No annotation' without any."""
    # regions never label a repeat and span whole sequences: they would fill every bin
    hits = filter_hits(annotate(arrays, features.where("type <> 'region'"), size), ["trf_id", "seqid", "l_ind", "r_ind"])
    labels = hits.groupBy("trf_id", "l_ind", "r_ind").agg(F.array_join(F.sort_array(F.collect_list("label"), asc=False), "|").alias("trf_ref_annotation"))
    out = arrays.join(labels, ["trf_id", "l_ind", "r_ind"], "left")
    return out.withColumn("trf_ref_annotation", F.coalesce("trf_ref_annotation", F.lit("No annotation")))


def label_report(annotated: DataFrame) -> DataFrame:
    """Every set of labels with its number of repeats and their share of all, in percent."""
    by = annotated.groupBy("trf_ref_annotation").agg(F.count(F.lit(1)).alias("n"))
    total = by.agg(F.sum("n").alias("total"))  # one row
    return by.crossJoin(F.broadcast(total)).select("trf_ref_annotation", "n", rounded(100.0 * F.col("n") / F.col("total"), 4).alias("percent"))


def _gap_pairs(arrays: DataFrame, gaps: DataFrame, reach: int) -> DataFrame:
    """(trf_id, seqid, l_ind, r_ind, start, end): repeats and the gaps in their reach. The gaps are widened, not the many repeats,
    so a repeat stands in one bin or two."""
    a = arrays.select("trf_id", "seqid", F.col("l_ind").alias("a0"), F.col("r_ind").alias("a1"))
    b = gaps.select("seqid", (F.col("start") - reach).alias("b0"), (F.col("end") + reach).alias("b1"))
    pairs = overlap_join(a, b, 4 * reach).select("trf_id", "seqid", F.col("a0").alias("l_ind"), F.col("a1").alias("r_ind"), (F.col("b0") + reach).alias("start"), (F.col("b1") - reach).alias("end"))
    # a repeat reaches no further than to the sequence's first letter
    return pairs.where("end > 0")


def gap_neighbours(arrays: DataFrame, gaps: DataFrame, reach: int = 10000) -> DataFrame:
    """Repeats within reach of gaps: the span with the gaps and how repeat and gap lie (aN, aNa, Na, unknown)."""
    near = _gap_pairs(arrays, gaps, reach).groupBy("trf_id", "seqid", "l_ind", "r_ind").agg(F.min("start").alias("gap_start"), F.max("end").alias("gap_end"))
    before = F.col("l_ind") < F.col("gap_start")
    kind = F.when(before & (F.col("r_ind") < F.col("gap_end")), "aN").when(before & (F.col("r_ind") > F.col("gap_end")), "aNa").when(F.col("gap_start") < F.col("l_ind"), "Na").otherwise("unknown")
    return near.select("trf_id", "seqid", F.least("l_ind", "gap_start").alias("start"), F.greatest("r_ind", "gap_end").alias("end"), kind.alias("gap_type"), (F.greatest("r_ind", "gap_end") - F.least("l_ind", "gap_start")).alias("span"))


def without_gaps(arrays: DataFrame, gaps: DataFrame, reach: int = 10000) -> DataFrame:
    """Repeats with no gap in reach, on sequences that have gaps."""
    sequences = gaps.where("seqid IS NOT NULL").select("seqid").distinct()
    if len(names := sequences.limit(NAMES + 1).collect()) <= NAMES:
        on = arrays.where(F.col("seqid").isin([r["seqid"] for r in names]))
    else:
        on = arrays.join(sequences, "seqid", "left_semi")
    return on.join(_gap_pairs(arrays, gaps, reach).select("trf_id"), "trf_id", "left_anti")


def density(df: DataFrame, category: Column, size: int) -> DataFrame:
    """Bases of each category in each bin: (seqid, bin, category, bp)."""
    first, last = F.floor(F.col("l_ind") / size), F.floor(F.col("r_ind") / size)
    cut = df.withColumn("category", category).withColumn("bin", F.explode(F.sequence(first, last)))
    bp = F.greatest(F.least(F.col("r_ind"), (F.col("bin") + 1) * size) - F.greatest(F.col("l_ind"), F.col("bin") * size), F.lit(0))
    return cut.groupBy("seqid", "bin", "category").agg(F.sum(bp).alias("bp"))


def normalised(bp: Column, size: int) -> Column:
    return F.round(F.least(bp / size, F.lit(1.0)), 3)


def self_overlaps(arrays: DataFrame, size: int = BIN) -> DataFrame:
    """Overlapping pairs of repeats of one sequence and how they lie: duplicate, contains, contained, partial."""
    a = arrays.select("seqid", F.col("trf_id").alias("id_a"), F.col("l_ind").alias("a0"), F.col("r_ind").alias("a1"))
    b = arrays.select("seqid", F.col("trf_id").alias("id_b"), F.col("l_ind").alias("b0"), F.col("r_ind").alias("b1"))
    pairs = overlap_join(a, b, size).where("id_a < id_b")
    kind = (
        F.when((F.col("a0") == F.col("b0")) & (F.col("a1") == F.col("b1")), "duplicate")
        .when((F.col("a0") <= F.col("b0")) & (F.col("a1") >= F.col("b1")), "contains")
        .when((F.col("a0") >= F.col("b0")) & (F.col("a1") <= F.col("b1")), "contained")
        .otherwise("partial")
    )
    return pairs.select("seqid", "id_a", "id_b", kind.alias("kind"))


def drop_duplicates(arrays: DataFrame) -> DataFrame:
    """Of repeats with equal place the one with the best match stays, ties by id."""
    best = Window.partitionBy("seqid", "l_ind", "r_ind").orderBy(F.desc("trf_pmatch"), "trf_id")
    return arrays.withColumn("_r", F.row_number().over(best)).where("_r = 1").drop("_r")


def guided_regions(lengths: DataFrame, windows: DataFrame, threshold: int = 90000, least_span: int = 50000, gap: int = 100000, least: int = 1000) -> DataFrame:
    """(seqid, start, end, head): the parts of sequences(seqid, length) to search for repeats. Of a sequence with
    windows(seqid, start, end, unique_kmers), the runs of windows under the threshold that span enough, those at most gap apart
    as one, cut at the sequence's end; of a sequence without any window, all of it. Parts shorter than least are left out. head
    names the place; tiles.cut_spans gives the letters."""
    runs = merge_intervals(low_runs(windows, threshold, least_span).select("seqid", "start", "end"), gap).select("seqid", "start", "end")
    unknown = lengths.join(windows.select("seqid").distinct(), "seqid", "left_anti").select("seqid", F.lit(0).cast("bigint").alias("start"), F.col("length").cast("bigint").alias("end"))
    rich = runs.where(F.col("end") - F.col("start") >= least).join(lengths.select("seqid", "length"), "seqid").select("seqid", "start", F.least("end", "length").cast("bigint").alias("end"))
    parts = rich.unionByName(unknown.where(F.col("end") >= least))
    return parts.select("seqid", "start", "end", F.concat_ws("_", F.concat("seqid", F.lit("__"), F.col("start").cast("string")), F.col("end").cast("string")).alias("head"))
