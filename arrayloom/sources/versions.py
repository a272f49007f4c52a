"""Tables in versions: new parts are written aside and become current by one rename.

A table is a folder with `parts` (folders of Parquet files, never changed once written) and `versions`. A version is a small
file that names the parts it is made of, ending in a line `end`; the current one has the highest number. Writers put parts
where no version names them yet, write the next version's file under another name and rename it. A run that ends half way
leaves parts that nobody reads, and the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = "end"


class Conflict(Exception):
    """Another run made the next version first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def current(spark: SparkSession, path: str) -> tuple[int, dict[str, list[str]]]:
    """The number of the current version, and its parts by kind; 0 and none where there is no table."""
    jvm, fs = _fs(spark, path)
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    if not fs.exists(folder):
        return 0, {}
    numbers = sorted((int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()), reverse=True)
    for n in numbers:
        lines = [r[0] for r in spark.read.text(f"{path}/versions/{n:09d}").collect()]
        if lines and lines[-1] == END:
            parts: dict[str, list[str]] = {}
            for x in lines[:-1]:
                kind, part = x.split("\t")
                parts.setdefault(kind, []).append(part)
            return n, parts
    return 0, {}


def publish(spark: SparkSession, path: str, number: int, parts: dict[str, list[str]]) -> None:
    """Make these parts version `number`, by one rename; Conflict if there is such a version."""
    jvm, fs = _fs(spark, path)
    to, aside = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{number:09d}"), jvm.org.apache.hadoop.fs.Path(f"{path}/versions/_{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray("".join(f"{k}\t{p}\n" for k in sorted(parts) for p in parts[k]).encode() + END.encode() + b"\n"))
    out.close()
    if fs.exists(to) or not fs.rename(aside, to):
        fs.delete(aside, False)
        raise Conflict(f"version {number} of {path} is there already")


def read_kind(spark: SparkSession, path: str, kind: str, schema: str | None = None) -> DataFrame | None:
    """One kind of rows of the current version; an empty table of the schema, or None without one, where there are none."""
    _, parts = current(spark, path)
    if parts.get(kind):
        return spark.read.parquet(*[f"{path}/parts/{p}" for p in parts[kind]])
    return spark.createDataFrame([], schema) if schema else None


def recompute_missing(seqs: DataFrame, path: str, compute: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = ("project", "seqid")) -> int:
    """Compute the rows of the sequences that the table has not seen, and add them, in one job; the number of sequences.

    seqs has the keys; compute gets the missing sequences whole and returns their rows. Which sequences were seen is a part of
    the table as well, so one without rows is not taken for missing again. Missing ones are found by anti join."""
    spark = seqs.sparkSession
    number, parts = current(spark, path)
    seen = read_kind(spark, path, "sequences")
    new = seqs if seen is None else seqs.join(seen.select(*keys), list(keys), "left_anti")
    names, rows = (f"{kind}-{uuid.uuid4().hex}" for kind in ("sequences", "rows"))
    new.select(*keys).distinct().write.parquet(f"{path}/parts/{names}")
    found = spark.read.parquet(f"{path}/parts/{names}")
    n = found.count()
    if n:
        # exactly the sequences that are noted as seen, should the source have changed in between
        compute(new.join(found, list(keys), "left_semi")).write.parquet(f"{path}/parts/{rows}")
        publish(spark, path, number + 1, {"sequences": [*parts.get("sequences", []), names], "rows": [*parts.get("rows", []), rows]})
    return n


def low_counts(seqs: DataFrame, rows: DataFrame, large: int = 1000000, least: int = 1) -> DataFrame:
    """(seqid, length, n) of sequences of at least `large` letters with fewer than `least` rows; seqs(seqid, length)."""
    counts = rows.groupBy("seqid").agg(F.count(F.lit(1)).alias("n"))
    return seqs.where(F.col("length") >= large).join(counts, "seqid", "left").withColumn("n", F.coalesce("n", F.lit(0))).where(F.col("n") < least)


def consistency(seqs: DataFrame, rows: DataFrame, large: int = 1000000) -> DataFrame:
    """One row of seqs(seqid, length) and rows(seqid): total, large and skipped (smaller) sequences, sequences with rows, bp of
    all and of large ones."""
    big = F.col("length") >= large
    zero = lambda c: F.coalesce(c, F.lit(0))
    of = seqs.agg(F.count(F.lit(1)).alias("total"), F.count_if(big).alias("large"), F.count_if(~big).alias("skipped"), zero(F.sum("length")).alias("bp"), zero(F.sum(F.when(big, F.col("length")))).alias("large_bp"))
    return of.crossJoin(F.broadcast(rows.agg(F.count_distinct("seqid").alias("with_rows"))))  # one row each
