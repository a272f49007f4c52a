"""Running sums, merges and runs of one long sequence over many tasks.

A window over a whole sequence sorts it in one task. Here rows are put into bins of their position: sums and prefixes are
taken inside bins, all at once, then over bins (a row each), and both are joined. A task sorts a bin, whatever the length of
the sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a bin of positions.
WIDTH = 1 << 20


def _bins_before(bins: DataFrame, by: list[str], made: dict[str, Column]) -> DataFrame:
    """(by, _bin, ...) with columns over all earlier bins of bins(by, _bin, ...), under other names of the keys (_k0, ...)."""
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]
    return bins.select(*keys, F.col("_bin").alias("_b"), *[c.over(before).alias(n) for n, c in made.items()])


def _with_bins(rows: DataFrame, by: list[str], carried: DataFrame) -> DataFrame:
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)] + [F.col("_bin") == F.col("_b")]
    return rows.join(carried, on).drop("_b", *[f"_k{i}" for i in range(len(by))])


def running_sum(rows: DataFrame, by: list[str], order: list[str], value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """rows with the sum of value over the rows before each one (0 for the first) of the same `by`; the first column of the
    order is a number that says the bin, and ties in the whole order share no place: it should tell rows apart."""
    binned = rows.withColumns({"_bin": F.floor(F.col(order[0]) / width), "_value": value})
    inside = Window.partitionBy(*by, "_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    carried = _bins_before(binned.groupBy(*by, "_bin").agg(F.sum("_value").alias("_sum")), by, {"_carry": F.sum("_sum")})
    out = _with_bins(binned.withColumn("_own", F.sum("_value").over(inside)), by, carried)
    return out.withColumn(name, F.coalesce("_carry", F.lit(0)) + F.coalesce("_own", F.lit(0))).drop("_bin", "_value", "_own", "_carry")


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str = "no", width: int = WIDTH) -> DataFrame:
    """rows with their place, from 1, in the order within the same `by`."""
    return running_sum(rows, by, order, F.lit(1).cast("bigint"), name, width).withColumn(name, F.col(name) + 1)


def _merged(rows: DataFrame, by: list[str], gap: int) -> DataFrame:
    """(by, start, end, n): intervals (by, start, end, n) at most gap apart become one, in one window for each `by`."""
    order = Window.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("start") - reach > gap), 1).otherwise(0)
    runs = rows.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy(*by, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("_run")


def merge_intervals(rows: DataFrame, gap: int, width: int = WIDTH) -> DataFrame:
    """(seqid, start, end, n): intervals at most gap apart become one; gap -1 merges overlaps only.

    Intervals are merged within the bins they start in. Of what a bin then holds, only pieces that earlier bins reach, taken
    together, and its last one, if it may reach into later bins, are left to merge: two for each bin."""
    binned = rows.select("seqid", "start", "end", F.lit(1).cast("bigint").alias("n"), F.floor(F.col("start") / width).alias("_bin"))
    pieces = _merged(binned, ["seqid", "_bin"], gap)
    # of the rows themselves, so that the windows are not computed for it once more
    carried = _bins_before(binned.groupBy("seqid", "_bin").agg(F.max("end").alias("_most")), ["seqid"], {"_reach": F.max("_most")})
    pieces = _with_bins(pieces, ["seqid"], carried)
    reached = F.coalesce(F.col("start") - F.col("_reach") <= gap, F.lit(False))
    reaches = F.col("end") + gap >= (F.col("_bin") + 1) * width
    pieces = pieces.withColumns({"_reached": reached, "_open": reached | reaches})
    ends = pieces.where("_open").groupBy("seqid", "_bin", "_reached").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
    closed = pieces.where("NOT _open").select("seqid", "start", "end", "n")
    return closed.unionByName(_merged(ends.drop("_bin", "_reached"), ["seqid"], gap).select("seqid", "start", "end", "n"))


def low_runs(windows: DataFrame, threshold: int, least_span: int, width: int = WIDTH) -> DataFrame:
    """(seqid, start, end, n): runs of consecutive windows(seqid, start, end, unique_kmers) under the threshold that span
    enough. A run is told by the number of windows before it that are not under the threshold. Of windows at the same place
    those under the threshold come first, so reruns and other orders of the rows give the same runs."""
    high = F.coalesce((F.col("unique_kmers") >= threshold).cast("bigint"), F.lit(1))
    binned = windows.select("seqid", "start", "end", high.alias("_high"), F.floor(F.col("start") / width).alias("_bin"))
    upto = Window.partitionBy("seqid", "_bin").orderBy("start", "end", "_high").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low = binned.withColumn("_run", F.sum("_high").over(upto)).where("_high = 0")
    pieces = low.groupBy("seqid", "_bin", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))
    carried = _bins_before(binned.groupBy("seqid", "_bin").agg(F.sum("_high").alias("_highs")), ["seqid"], {"_carry": F.sum("_highs")})
    pieces = _with_bins(pieces, ["seqid"], carried).withColumn("_run", F.col("_run") + F.coalesce("_carry", F.lit(0)))
    runs = pieces.groupBy("seqid", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
    return runs.where(F.col("end") - F.col("start") >= least_span).select("seqid", "start", "end", "n")


def upper_medians(rows: DataFrame, by: str, value: str) -> DataFrame:
    """(by, median): of each group the value at place n // 2, counted from 0, in order. Values are counted before they are
    shuffled, so a group is as many rows as it has different values."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(by)
    counts = counts.withColumns({"_upto": F.sum("_n").over(own.orderBy(value)), "_all": F.sum("_n").over(own)})
    return counts.where(F.col("_upto") > F.floor(F.col("_all") / 2)).groupBy(by).agg(F.min(value).alias("median"))
