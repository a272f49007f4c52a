"""Combined views: a row for each sequence with what other operators found on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _by_sequence(rows: DataFrame, name: str, fields: list[str]) -> DataFrame:
    """(seqid, name): the rows of a sequence as an array of structs, in order of the fields."""
    return rows.groupBy("seqid").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def chromosome_view(lengths: DataFrame, calls: DataFrame | None = None, densities: DataFrame | None = None, families: DataFrame | None = None, sites: DataFrame | None = None) -> DataFrame:
    """Per sequence of lengths(seqid, length): its share of the longest one in percent, and of the parts that are given: calls
    (gaps.telomere_calls), densities(seqid, bin, category, bp), families(seqid, family, bp) and sites(seqid, start, end, repeats).

    A sequence has a density for each bin and category and a site for each run inside it, arrays of their own in order; families
    are counted by sequence before they are put together. What a sequence does not have is an empty array or null."""
    longest = lengths.agg(F.max("length").alias("_longest"))  # one row
    out = lengths.crossJoin(F.broadcast(longest)).select("seqid", "length", F.round(100.0 * F.col("length") / F.col("_longest"), 2).alias("percent_of_longest"))
    if calls is not None:
        out = out.join(calls.select("seqid", "left_call", "right_call", "status"), "seqid", "left")
    parts = []
    if densities is not None:
        parts.append(("densities", densities, ["bin", "category", "bp"]))
    if families is not None:
        counted = families.groupBy("seqid", "family").agg(F.count(F.lit(1)).alias("n"), F.sum("bp").alias("bp"))
        parts.append(("families", counted, ["family", "n", "bp"]))
    if sites is not None:
        parts.append(("sites", sites, ["start", "end", "repeats"]))
    for name, rows, fields in parts:
        out = out.join(_by_sequence(rows, name, fields), "seqid", "left").withColumn(name, F.coalesce(name, F.array()))
    return out


def flat(structs: Column, fields: list[str]) -> Column:
    """An array of structs as text: fields joined by colons, structs by commas."""
    return F.array_join(F.transform(structs, lambda s: F.concat_ws(":", *[s[f].cast("string") for f in fields])), ",")


def json_lines(view: DataFrame) -> DataFrame:
    """(seqid, value): each row of a view as a JSON text."""
    return view.select("seqid", F.to_json(F.struct(*view.columns)).alias("value"))


def assembly_view(lengths: DataFrame, calls: DataFrame, sites: DataFrame) -> DataFrame:
    """One row: n and bp of lengths(seqid, length), how many sequences are complete at both ends, and the sites inside."""
    of = lengths.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bp"))
    for more in (calls.agg(F.count_if(F.col("status") == "T2T").alias("t2t")), sites.agg(F.count(F.lit(1)).alias("sites"))):
        of = of.crossJoin(F.broadcast(more))  # one row each
    return of
