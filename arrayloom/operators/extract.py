"""Cutting repeat arrays out of sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrayloom.functions import seqfn
from arrayloom.operators import tiles
from arrayloom.operators.scans import running_sum
from arrayloom.operators.similarity import _written

#: Letters of arrays that are read at once.
LETTERS = 1 << 21
_BACK = np.full(256, ord("N"), np.uint32)
_BACK[list(b"ACGTNacgtn")] = list(b"TGCANtgcan")
_BASE = np.full(256, 4, np.int64)
for _i, _b in enumerate(b"ACGT"):
    _BASE[[_b, _b + 32]] = _i


def duplicate_names(seqs: DataFrame) -> DataFrame:
    """(seqid, n) of first words that several sequences share."""
    return seqs.groupBy(seqfn.first_word(F.col("seqid")).alias("seqid")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique_names(seqs: DataFrame) -> DataFrame:
    """The sequences; an error if two share a first word, since intervals could not be told apart then."""
    found = duplicate_names(seqs).orderBy("seqid").limit(5).collect()
    if found:
        raise ValueError(f"sequences share their first words: {', '.join(r['seqid'] for r in found)}")
    return seqs


def chunked(seqs: DataFrame, size: int = 100000) -> DataFrame:
    """(no, seqid, length, chunk) of seqs(seqid, seq): sequences packed greedily in order of a column no of distinct numbers, or,
    without one, as they are read. A chunk is closed by the sequence with which it holds more than size letters; chunks
    count from 0.

    What one sequence after the other decides is found without walking: with sums of lengths before each sequence, the chunk
    that would start at a sequence ends at the first one whose sum is more than size greater, so every sequence knows the next
    chunk's start. From the first sequence on, these steps are followed by doubling: each round is a join and a table."""
    no = F.col("no").cast("bigint") if "no" in seqs.columns else F.monotonically_increasing_id()
    rows = _written(seqs.select(no.alias("no"), "seqid", F.length(F.coalesce("seq", F.lit(""))).cast("bigint").alias("length")))
    rows = _written(running_sum(rows, [], ["no"], F.col("length"), "base"))
    # in one order of numbers, each chunk asks from its base + size on for the first sequence whose letters reach beyond it
    asks = rows.select((F.col("base") + size).alias("at"), F.lit(0).alias("kind"), F.col("no").alias("start"), F.lit(None).cast("bigint").alias("no"))
    ends = rows.select((F.col("base") + F.col("length")).alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("start"), "no")
    # equal numbers: an end at exactly base + size is not beyond it
    both = asks.unionByName(ends.withColumn("at", F.col("at") - 1)).withColumn("_bin", F.floor(F.col("at") / (4 * size)))
    behind = Window.partitionBy("_bin").orderBy("at", "kind", "no").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    found = both.withColumn("last", F.first("no", ignorenulls=True).over(behind))
    # where a bin has no end behind, the first end of a later bin; a row for each bin
    firsts = both.groupBy("_bin").agg(F.min("no").alias("first"))
    later = Window.orderBy("_bin").rowsBetween(1, Window.unboundedFollowing)
    firsts = firsts.select("_bin", F.first("first", ignorenulls=True).over(later).alias("next_first"))
    found = found.where("start IS NOT NULL").join(firsts, "_bin").select("start", F.coalesce("last", "next_first").alias("last"))
    follows = rows.where("length > 0").select(F.col("no").alias("last"), (F.col("base") + F.col("length")).alias("base")).join(rows.select(F.col("no").alias("next"), "base", "length"), "base")
    # of sequences that begin where the last one ends, the first: those without letters stand before the one with letters
    follows = follows.where(F.col("next") > F.col("last")).groupBy("last").agg(F.min("next").alias("next"))
    jump = _written(found.join(follows, "last").select(F.col("start").alias("no"), "next"))
    heads = _written(rows.agg(F.min("no").alias("no")).where("no IS NOT NULL"))
    while True:
        reached = _written(heads.unionByName(heads.join(jump, "no").select(F.col("next").alias("no"))).distinct())
        if reached.count() == heads.count():
            break
        heads = reached
        onward = jump.select(F.col("no").alias("next"), F.col("next").alias("far"))
        jump = _written(jump.join(onward, "next").select("no", F.col("far").alias("next")))
    marked = rows.join(heads.select("no", F.lit(1).cast("bigint").alias("_head")), "no", "left").withColumn("_head", F.coalesce("_head", F.lit(0)))
    marked = running_sum(marked, [], ["no"], F.col("_head"), "_before")
    return marked.select("no", "seqid", "length", (F.col("_before") + F.col("_head") - 1).alias("chunk"))


def extract_arrays(seqs: DataFrame, beds: DataFrame, project: str, size: int = tiles.TILE) -> DataFrame:
    """The repeat table of intervals (0-based half-open) within the bounds of their sequence.

    Sequences join intervals on the first word of the name, as tiles: a sequence is spread over as many rows as its length
    asks for, and an interval moves with the letters of the tiles it touches alone.
    """
    return arrays_of_tiles(tiles.tiled(seqs.withColumn("seqid", seqfn.first_word(F.col("seqid"))), size), beds, project, size)


def _letters(s: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of texts as numbers one after the other, bytes where all are ASCII, and where each text begins and the last
    one ends."""
    s = s.cast(pa.string())
    at = np.frombuffer(s.buffers()[1], np.int32)[s.offset : s.offset + len(s) + 1].astype(np.int64)
    x = np.frombuffer(s.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    if (x < 128).all():
        return x, at - at[0]
    texts = s.to_pylist()
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def _texts(x: np.ndarray, at: np.ndarray) -> pa.Array:
    if x.dtype == np.uint8:
        return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(x.tobytes()))
    return pa.array([x[a:b].tobytes().decode("utf-32-le") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string())


def _read(minus: np.ndarray, period: np.ndarray, bases: pa.Array) -> list[pa.Array]:
    """trf_array, the letters as they read on their strand (as seqfn.revcomp_n); the number of those equal to the same letter of the
    first unit; and the counts of the four bases in either case. All rows are read at once."""
    x, at = _letters(bases)
    sizes, place = np.diff(at), np.arange(len(x))
    row = np.repeat(np.arange(len(sizes)), sizes)
    if minus.any():
        turned = minus[row]
        x = x[np.where(turned, at[row] + at[row + 1] - 1 - place, place)]
        x = np.where(turned, _BACK[np.minimum(x, 255)], x).astype(x.dtype)
    unit = np.maximum(period, 1)
    same = np.concatenate([[0], np.cumsum(x == x[at[row] + (place - at[row]) % unit[row]])])
    same = np.where(period > 0, same[at[1:]] - same[at[:-1]], 0)
    counts = np.bincount(row * 5 + _BASE[np.minimum(x, 255)], minlength=5 * len(sizes)).reshape(-1, 5)
    return [_texts(x, at), pa.array(same.astype(np.int64)), *(pa.array(counts[:, i].astype(np.int64)) for i in range(4))]


def _measured(cut: DataFrame) -> DataFrame:
    """cut(seqid, start, end, period, strand, bases) with trf_array, same and n_A to n_T (see _read) in place of strand and bases.

    Rows pass through one step of tasks, so that no filter or column that is derived from them reads the letters anew."""
    kept = ["seqid", "start", "end", "period"]
    names = [*kept, "trf_array", "same", *(f"n_{b}" for b in seqfn.BASES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = np.cumsum(b.column("size").to_numpy()) // LETTERS
            edge = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if lo < hi:
                    some = b.slice(lo, hi - lo)
                    minus, unit = some.column("minus").to_numpy(zero_copy_only=False), some.column("unit").to_numpy()
                    yield pa.RecordBatch.from_arrays([*(some.column(c) for c in kept), *_read(minus, unit, some.column("bases"))], names)

    kinds = dict(cut.dtypes)
    rows = cut.select(*kept, "bases", F.coalesce(F.col("strand") == "-", F.lit(False)).alias("minus"), F.coalesce(F.col("period").cast("long"), F.lit(0)).alias("unit"), F.octet_length("bases").cast("long").alias("size"))
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "trf_array string", *(f"{c} long" for c in names[5:])]))


def arrays_of_tiles(tiled: DataFrame, beds: DataFrame, project: str, size: int = tiles.TILE) -> DataFrame:
    """The repeat table of intervals on sequences that are tiles of that size already (see tiles and sources.text)."""
    cut = _measured(tiles.cut_spans(beds.select("seqid", "start", "end", "period", "strand"), tiled, size))
    n = F.length("trf_array")
    cut = cut.withColumn("trf_pmatch", seqfn.percent_of(F.col("same"), n, F.col("period")))
    first = seqfn.consensus(F.col("trf_array"), F.col("period"))
    gc = F.when(n > 0, (F.col("n_C") + F.col("n_G")) / n).otherwise(F.lit(0.0))
    return cut.select(
        F.lit(project).alias("project"),
        seqfn.refined_id(F.col("seqid"), F.col("start") + 1, F.col("end")).alias("trf_id"),
        F.col("seqid").alias("trf_head"),
        (F.col("start") + 1).alias("trf_l_ind"),
        F.col("end").alias("trf_r_ind"),
        F.col("period").alias("trf_period"),
        seqfn.copy_number(F.col("end") - F.col("start"), F.col("period")).alias("trf_n_copy"),
        "trf_pmatch",
        (100 - F.col("trf_pmatch")).alias("trf_pvar"),
        seqfn.entropy_of([F.col(f"n_{b}") for b in seqfn.BASES], n).alias("trf_entropy"),
        first.alias("trf_consensus"),
        "trf_array",
        seqfn.rounded(gc, 2).alias("trf_array_gc"),
        seqfn.rounded(seqfn.gc_fraction(first), 2).alias("trf_consensus_gc"),
        (F.col("end") - F.col("start")).alias("trf_array_length"),
    )
