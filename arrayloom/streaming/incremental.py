"""Incremental runs over arriving repeat tables, as Structured Streaming jobs; a job resumes from its checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arrayloom import schemas
from arrayloom.operators.intervals import annotation_labels
from arrayloom.operators.similarity import _written, discard


def repeats(spark: SparkSession, folder: str, fmt: str = "parquet", schema: str = schemas.SAT) -> DataFrame:
    """Repeat tables as they arrive in a folder; each file is taken once."""
    return spark.readStream.schema(schema).format(fmt).load(folder)


def annotate_stream(stream: DataFrame, features: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Arriving repeats joined to static annotation, appended batch by batch."""

    def batch(df: DataFrame, no: int) -> None:
        annotation_labels(df, features).write.mode("overwrite").parquet(f"{out}/batch={no}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals_stream(stream: DataFrame, category: Column, length: Column, name: str, checkpoint: str) -> StreamingQuery:
    """Running count and bases of each category in an in-memory table of that name."""
    sums = stream.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("bp"))
    return sums.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_totals(events: DataFrame, width: str = "1 hour", slide: str = "15 minutes", late: str = "2 hours") -> DataFrame:
    """Sliding-window counts and sums of events(ts, event_type, value); the same code serves a stream and a table."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    out = marked.groupBy(F.window("ts", width, slide), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")


def attempted(rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, by: str = "project") -> DataFrame:
    """What work makes of the rows of each project, with what went wrong as data: by, the schema's columns, error.

    work gets some of one project's rows at a time, as tasks come to them, and may raise; its error becomes a row (the other
    columns null) and ends neither the task nor the work on other projects."""
    kind = dict(rows.dtypes)[by]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, part in b.groupby(by, dropna=False, sort=False):
                try:
                    out = work(part.reset_index(drop=True)).assign(error=None)
                except Exception as e:  # whatever a project's rows bring about is that project's outcome
                    out = pd.DataFrame({"error": [f"{type(e).__name__}: {e}"]})
                out[by] = None if pd.isna(key) else key
                out = out.reindex(columns=[by, *names, "error"]).astype(object)
                yield out.where(out.notna(), None)

    names = [f.split()[0] for f in schema.split(", ")]
    return rows.mapInPandas(run, f"`{by}` {kind}, {schema}, error string")


def outcomes(tried: DataFrame, by: str = "project") -> DataFrame:
    """(by, status, n, error) of attempted rows: a project with any error has failed, with the first of its errors."""
    wrong = F.col("error").isNotNull()
    of = tried.groupBy(by).agg(F.count_if(~wrong).alias("n"), F.min("error").alias("error"))
    return of.select(by, F.when(F.col("error").isNull(), "success").otherwise("failed").alias("status"), F.when(F.col("error").isNull(), F.col("n")).otherwise(0).alias("n"), "error")


def sound(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeat rows whose places, lengths and arrays agree, as (trf_id, bp); an error names the first row that is not."""
    n = rows["trf_r_ind"] - rows["trf_l_ind"] + 1
    wrong = (n < 1) | (rows["trf_array_length"] != n) | (rows["trf_array"].str.len() != n)
    if wrong.any():
        raise ValueError(f"place, length and array of {rows.loc[wrong, 'trf_id'].iloc[0]} do not agree")
    return pd.DataFrame({"trf_id": rows["trf_id"], "bp": n})


def finished(stream: DataFrame, log: str, checkpoint: str, work: Callable[[pd.DataFrame], pd.DataFrame] = sound, schema: str = "trf_id string, bp bigint", out: str | None = None) -> StreamingQuery:
    """Work on arriving projects side by side in one job, with a run log: a row for each project and batch (project, status,
    n, error, batch). Results of projects that succeeded go to `out`, if given.

    A batch is a folder of its own in both, written over when the batch is repeated, so a repeated batch adds nothing."""

    def batch(df: DataFrame, no: int) -> None:
        tried = _written(attempted(df, work, schema))
        ended = _written(outcomes(tried))
        if out is not None:
            good = ended.where("status = 'success'").select(F.col("project").alias("_p"))
            kept = tried.join(good, F.col("project").eqNullSafe(F.col("_p")), "left_semi").drop("error")
            kept.write.mode("overwrite").parquet(f"{out}/batch={no}")
        ended.write.mode("overwrite").parquet(f"{log}/batch={no}")  # last: what the log names is there
        discard(tried, ended)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
