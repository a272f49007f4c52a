"""Line forms of the written formats, and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_line(*cols: str) -> Column:
    """Tab-joined fields."""
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in cols])


def fasta_record(name: Column, seq: Column) -> Column:
    return F.concat(F.lit(">"), name, F.lit("\n"), seq)


def coordinate_name(seqid: Column, start: Column, end: Column, period: Column) -> Column:
    """name_start_end_length_period."""
    return F.concat_ws("_", seqid, *[c.cast("string") for c in (start, end, end - start, period)])


def gff3_line(seqid: Column, source: str, kind: str, l_ind: Column, r_ind: Column, score: int, properties: dict[str, Column]) -> Column:
    """Nine columns; a reversed interval is written forward with strand -."""
    extra = F.concat_ws(";", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in properties.items()]) if properties else F.lit(".")
    strand = F.when(l_ind < r_ind, "+").otherwise("-")
    return F.concat_ws("\t", seqid, F.lit(source), F.lit(kind), F.least(l_ind, r_ind).cast("string"), F.greatest(l_ind, r_ind).cast("string"), F.lit(str(score)), strand, F.lit("."), extra)


def gff3_attributes(attributes: Column) -> Column:
    """Attributes as text, keys in order."""
    keys = F.array_sort(F.map_keys(attributes))
    return F.array_join(F.transform(keys, lambda k: F.concat(k, F.lit("="), F.element_at(attributes, k))), ";")


def bed3_line(seqid: Column, l_ind: Column, r_ind: Column) -> Column:
    return F.concat_ws("\t", seqid, F.least(l_ind, r_ind).cast("string"), F.greatest(l_ind, r_ind).cast("string"))


def gap_line(seqid: Column, start: Column, end: Column) -> Column:
    return F.concat_ws("\t", seqid, start.cast("string"), end.cast("string"), F.lit("gap"), (end - start).cast("string"), F.lit("."))


def write_table(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.options(sep="\t", header=header, quote="", nullValue="None").mode(mode).csv(path)


def write_repeats(df: DataFrame, path: str, dataset_id: int | None = None, key: str | None = None) -> None:
    """A repeat table with a header; with a dataset id, rows are added to what is there, tagged with it (giid). Rows are in
    order of the key, if one is given: parts are ranges of it, each sorted."""
    rows = df.orderBy(key) if key else df
    if dataset_id is None:
        write_table(rows, path)
    else:
        write_table(rows.withColumn("giid", F.lit(dataset_id)), path, mode="append")


def write_classes(df: DataFrame, path: str, key: str | None = None) -> None:
    """A table of classes, without a header; in order of the key, if one is given."""
    write_table(df.orderBy(key) if key else df, path, header=False)


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def write_store(df: DataFrame, path: str, by: str = "project") -> None:
    """The primary store: Parquet partitioned by project; only the partitions present in df are replaced."""
    df.write.partitionBy(by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The summary document: one JSON line per category."""
    summary.write.mode("overwrite").json(path)


def replace_sequences(table: DataFrame, new: DataFrame, path: str, by: tuple[str, ...] = ("project", "trf_head")) -> None:
    """Recomputed sequences into a table stored by project and sequence: only their partitions are written anew."""
    new.select(table.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
