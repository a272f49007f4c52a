"""Rows in an order and their places in it, without a task that sorts the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .similarity import _written


def places(rows: DataFrame, order: list[str | Column], name: str = "no") -> DataFrame:
    """rows with their place, from 0, in the order of the whole table; ties stand in any order, so reruns give equal places
    where the order tells rows apart.

    Rows are dealt to ranges, sorted within them and written; ranges, a row each, are counted and their sums joined back. A
    number a range is all that one task sees."""
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    kept = _written(ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    ranges = kept.groupBy(F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_least"))
    before = F.sum("_n").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
    firsts = ranges.select("_r", (F.coalesce(before, F.lit(0)) - F.col("_least")).alias("_shift"))
    placed = kept.join(F.broadcast(firsts), F.col("_range") == F.col("_r"))  # a row a range
    return placed.withColumn(name, F.col("_at") + F.col("_shift")).drop("_range", "_at", "_r", "_shift")


def in_sequence(rows: DataFrame, seqid: str = "seqid", start: str = "start", *ties: str) -> DataFrame:
    """Intervals by sequence and start, ties by the columns named: the order of BED files and of arrays on chromosomes."""
    return rows.orderBy(seqid, start, *ties)


def repeats_by_place(rows: DataFrame, start: str = "l_ind", end: str = "r_ind", ident: str = "trf_id") -> DataFrame:
    """Repeats of all sequences by start and end, ties by id."""
    return rows.orderBy(start, end, ident)


def dictionary_by_value(rows: DataFrame, key: str, value: str, descending: bool = False) -> DataFrame:
    """(value, key) by value, ties by key; nulls come first, last if descending."""
    rows = rows.select(F.col(value).alias("value"), F.col(key).alias("key"))
    return rows.orderBy(F.desc("value") if descending else F.asc("value"), "key")
