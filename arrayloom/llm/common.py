"""Helpers shared by the training-data operators: tables in the shared folder, words, checked broadcasts."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many narrow rows (tens of bytes each) may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 1_000_000
#: A run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Where that is unset, a local master gets a temporary
    one; on a cluster, whose machines would not see each other's files, that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="arrayloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors, fixes generated ids."""
    path = f"{shared_dir(df.sparkSession)}/arrayloom/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that written() made and that no result still to be computed reads."""
    for t in tables:
        if t is None:
            continue
        # all part files of a table stand in its one folder
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            if "/arrayloom/" in folder:
                path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished queries. It does once their plans are garbage that the JVM has
    collected; a driver that makes little garbage may not collect any for half an hour, while the files fill the disks."""
    gc.collect()
    spark._jvm.System.gc()


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores in front of those that would clash with the columns."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def small_or_shuffled(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast when its counted rows are few, else left to a shuffled join."""
    return F.broadcast(df) if rows <= most else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(text: Column) -> Column:
    """UTF-8 bytes of a text; null gives no bytes."""
    return F.coalesce(text, F.lit("")).cast("binary")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the rows of an Arrow batch, so that a batch of very long texts still fits a Python worker; and let workers
    find this package where the driver found it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def with_computed(df: DataFrame, column: str, make: Callable[[], Callable[[list], dict[str, list]]], fields: dict[str, str], keep: bool = False) -> DataFrame:
    """df with fields computed in Python from the values of one column; keep: whether that column stays.

    make runs once for a task and returns a function from a batch's values to lists by field. Other columns pass
    through as Arrow, untouched."""
    small_batches(df.sparkSession)
    others = [c for c in df.columns if keep or c != column]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for b in batches:
            new = compute(b.column(b.schema.get_field_index(column)).to_pylist())
            arrays = [b.column(b.schema.get_field_index(c)) for c in others]
            arrays += [pa.array(new[f], _ARROW[t]) for f, t in fields.items()]
            yield pa.RecordBatch.from_arrays(arrays, [*others, *fields])

    types = dict(df.dtypes) | fields
    return df.mapInArrow(rows, ", ".join(f"`{c}` {types[c]}" for c in (*others, *fields)))
