"""Sequences as tiles: rows of (seqid, length, tile, offset, bases) instead of one row a sequence.

A tile holds `size` letters, the last one of a sequence what is left; tile i starts at letter i * size (offset). Work on
tiles is spread over tasks whatever the length of a sequence, and a row stays small. An interval meets the tiles it
touches; the pieces it takes from them are put together in order. Letters are taken as bytes where a tile has no others
than ASCII letters, so that neither the place of a tile nor that of an interval in it matters for the time it takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters of a tile.
TILE = 1 << 15


def slice_of(s: Column, at: Column, n: Column) -> Column:
    """n letters of a text from letter `at` (from 0), without a walk from its front where all letters are single bytes."""
    at, n = at.cast("int"), n.cast("int")
    plain = F.octet_length(s) == F.length(s)
    return F.when(plain, F.substring(s.cast("binary"), at + 1, n).cast("string")).otherwise(F.substring(s, at + 1, n))


def tiled(seqs: DataFrame, size: int = TILE, overlap: int = 0) -> DataFrame:
    """The tiles of seqs(seqid, seq); an empty sequence has one empty tile, a null one is empty; other columns go. With an
    overlap, tiles also hold so many letters of what follows."""
    last = F.greatest(F.floor((F.col("length") - 1) / size), F.lit(0))
    # the texts of all tiles of a row are cut while it is at hand, so the row itself never goes beside each of them
    cut = F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda i: F.struct(i.alias("tile"), (i * size).alias("offset"), slice_of(F.col("_body"), i * size, F.lit(size + overlap)).alias("bases")))
    rows = seqs.select("seqid", F.coalesce("seq", F.lit("")).alias("_body")).withColumn("length", F.length("_body").cast("bigint"))
    return rows.select("seqid", "length", F.inline(cut))


def overlapping(tiles: DataFrame, overlap: int) -> DataFrame:
    """Tiles with the first letters, at most a tile's, of the next one behind their own; only those letters move."""
    heads = tiles.where("tile > 0").select("seqid", (F.col("tile") - 1).alias("tile"), F.substring("bases", 1, overlap).alias("_head"))
    out = tiles.join(heads, ["seqid", "tile"], "left")
    return out.withColumn("bases", F.concat("bases", F.coalesce("_head", F.lit("")))).drop("_head").select(tiles.columns)


def of_pieces(pieces: DataFrame, keys: list[str], size: int = TILE) -> DataFrame:
    """(keys, tile, offset, bases) from pieces(keys, at, letters) of sequences, at being the place of a piece's first letter;
    pieces do not overlap. A piece goes to the tiles it touches."""
    n = F.length("letters")
    t = F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + n - 1) / size))
    rows = pieces.where(n > 0).select(*keys, "at", "letters", F.explode(t).alias("tile"))
    lo, hi = F.greatest(F.col("at"), F.col("tile") * size), F.least(F.col("at") + n, (F.col("tile") + 1) * size)
    rows = rows.select(*keys, "tile", lo.alias("lo"), slice_of(F.col("letters"), lo - F.col("at"), hi - lo).alias("part"))
    parts = F.array_sort(F.collect_list(F.struct("lo", "part")))
    out = rows.groupBy(*keys, "tile").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("bases"))
    return out.select(*keys, "tile", (F.col("tile") * size).alias("offset"), "bases")


def assembled(tiles: DataFrame) -> DataFrame:
    """(seqid, seq) from the tiles of each sequence."""
    parts = F.array_sort(F.collect_list(F.struct("tile", "bases")))
    return tiles.groupBy("seqid").agg(F.array_join(F.transform(parts, lambda p: p["bases"]), "").alias("seq"))


def _pieces(spans: DataFrame, tiles: DataFrame, size: int) -> DataFrame:
    """Rows of spans(seqid, start, end, tile, ...) with length and `piece`, what the span has of that tile."""
    met = spans.join(tiles.select("seqid", "length", "tile", "offset", "bases"), ["seqid", "tile"]).where(F.col("end") <= F.col("length"))
    lo, hi = F.greatest(F.col("start"), F.col("offset")), F.least(F.col("end"), F.col("offset") + size)
    return met.withColumn("piece", slice_of(F.col("bases"), lo - F.col("offset"), hi - lo)).drop("bases", "offset")


def cut_spans(spans: DataFrame, tiles: DataFrame, size: int = TILE, name: str = "bases") -> DataFrame:
    """spans(seqid, start, end, ...), 0-based half-open, with the letters of the sequence there, for spans within the bounds
    of a known sequence; repeated spans stay repeated, names of tiles are unique.

    A span within one tile is cut where it meets it. One that reaches over several is cut piece by piece, and only those
    pieces are shuffled once more."""
    columns = spans.columns
    good = spans.where((F.col("start") >= 0) & (F.col("start") < F.col("end")))
    first, last = F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size)
    one = _pieces(good.where(first == last).withColumn("tile", first), tiles, size).select(*columns, F.col("piece").alias(name))
    many = good.where(first < last).withColumn("_row", F.monotonically_increasing_id()).withColumn("tile", F.explode(F.sequence(first, last)))
    parts = F.array_sort(F.collect_list(F.struct("tile", "piece")))
    whole = _pieces(many, tiles, size).groupBy("_row", *columns).agg(F.array_join(F.transform(parts, lambda p: p["piece"]), "").alias(name))
    return one.unionByName(whole.select(*columns, name))
