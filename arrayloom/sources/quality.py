"""Quality of input files: a flag for every line, counts of flags, and whether too many lines are malformed."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Share of malformed lines, against well-formed ones, from which a file is suspect.
MOST_MALFORMED = 0.1


def gff_quality(lines: DataFrame) -> DataFrame:
    """(value, flag) of GFF3 lines(value) but blanks and comments: ok, short (under nine fields), bad number, reversed, below 1.
    Only short lines are malformed; the others are features with a doubtful place."""
    line = F.trim("value")
    f = F.split(line, "\t")
    start, end = (F.get(f, F.lit(i)).try_cast("bigint") for i in (3, 4))
    flag = F.when(F.size(f) < 9, "short").when(start.isNull() | end.isNull(), "bad number").when(start > end, "reversed").when(start < 1, "below 1").otherwise("ok")
    return lines.where((line != "") & ~F.startswith(line, F.lit("#"))).select("value", flag.alias("flag"))


def flag_counts(flagged: DataFrame) -> DataFrame:
    """(flag, n)."""
    return flagged.groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def report(flagged: DataFrame, malformed: tuple[str, ...] = ("short",), most: float = MOST_MALFORMED) -> DataFrame:
    """One row: features, malformed, and high, whether more than `most` times as many lines are malformed as are features."""
    bad = F.col("flag").isin(*malformed)
    of = flagged.agg(F.count_if(~bad).alias("features"), F.count_if(bad).alias("malformed"))
    return of.withColumn("high", F.col("malformed") > most * F.col("features"))


def checked(flagged: DataFrame, name: str, malformed: tuple[str, ...] = ("short",), most: float = MOST_MALFORMED) -> dict[str, int]:
    """The counts of report; a warning if they are high, an error if there is nothing in the file."""
    features, bad, high = report(flagged, malformed, most).first()
    if not features and not bad:
        raise ValueError(f"{name}: no features")
    if high:
        warnings.warn(f"{name}: a high share of malformed lines, {bad} of {features + bad}", stacklevel=2)
    return {"features": features, "malformed": bad}


def check_fasta(spark: SparkSession, path: str) -> None:
    """An error if there is nothing in the files, or a file without a header line."""
    lines = spark.read.text(path).select(F.trim("value").alias("line"), F.col("_metadata.file_path").alias("file")).where("line <> ''")
    seen = lines.groupBy("file").agg(F.count_if(F.startswith("line", F.lit(">"))).alias("headers")).collect()  # a row for each file
    if not seen:
        raise ValueError(f"{path}: empty")
    for r in seen:
        if not r["headers"]:
            raise ValueError(f"{r['file']}: no header, a line that starts with >")
