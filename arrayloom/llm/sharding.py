"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Shards own virtual nodes on a ring of 64-bit positions. A key belongs to the first node at or after its position. A
shard takes its own keys up to its capacity; keys that overflow continue clockwise to the next node whose shard has
room. At load factor 1 the capacities add up to the number of rows and differ by one at most, so row counts do too.

Only counts per ring segment reach the driver: at most shards x nodes x SEGMENTS_PER_ARC small rows, whatever the
input. The walk over them gives quotas (segment, from rank, to rank, shard); a row then needs its rank within its
segment, which many tasks compute at once. Texts are not shuffled.

Defined results: null text has size 1 and CRC 0; rows that repeat a doc_id share a ring position and are dealt out
like other rows of their segment; a null doc_id has a position of its own; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, utf8, written

#: Parts into which the keys of one arc are split by a second hash, so that ranks are computed in small groups.
SEGMENTS_PER_ARC = 8


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finalizer, so that ring positions do not depend on a process."""
    x = x.astype(np.uint64)
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
    return x ^ (x >> np.uint64(31))


@lru_cache
def ring(n_shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted node positions (signed 64-bit) and the shard of each."""
    shard = np.repeat(np.arange(n_shards), nodes)
    at = _mixed((shard.astype(np.uint64) << np.uint64(32)) + np.tile(np.arange(nodes), n_shards).astype(np.uint64) + np.uint64(1)).view(np.int64)
    order = np.lexsort((shard, at))
    return at[order], shard[order]


def capacities(n_rows: int, n_shards: int, load_factor: float) -> np.ndarray:
    """At factor 1, floor or ceiling of the mean with the exact total; above it, the mean times the factor."""
    if load_factor <= 1:
        return n_rows // n_shards + (np.arange(n_shards) < n_rows % n_shards)
    return np.full(n_shards, int(np.ceil(load_factor * n_rows / n_shards)))


def quotas(counts: np.ndarray, owners: np.ndarray, room: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(segment, from rank, to rank, shard, first slot): own keys first, then overflow clockwise to shards with room."""
    room, slot, out, over = room.copy(), np.zeros_like(room), [], []

    def give(seg: int, lo: int, n: int, shard: int) -> None:
        out.append((seg, lo, lo + n, int(shard), int(slot[shard])))
        slot[shard] += n
        room[shard] -= n

    for seg, (n, shard) in enumerate(zip(counts.tolist(), owners.tolist(), strict=True)):
        take = min(n, int(room[shard]))
        if take:
            give(seg, 0, take, shard)
        if n > take:
            over.append((seg, take, n - take))
    for seg, lo, n in over:
        at = seg
        while n:
            at = (at + 1) % len(owners)
            take = min(n, int(room[owners[at]]))
            if take:
                give(seg, lo, take, owners[at])
                lo, n = lo + take, n - take
    return out


def shard_rows(docs: DataFrame, n_shards: int = 16, nodes: int = 64, load_factor: float = 1.0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per input row: doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, slot (gapless in a shard)."""
    spark = docs.sparkSession
    small_batches(spark, 10000)

    @F.pandas_udf("int")
    def arc(pos: pd.Series) -> pd.Series:
        at, _ = ring(n_shards, nodes)
        return pd.Series((np.searchsorted(at, pos.to_numpy()) % len(at)).astype(np.int32))

    body = utf8(F.col(text))
    slim = docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(F.lit("ring"), F.col(key)).alias("pos"))
    part = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(SEGMENTS_PER_ARC)).cast("int")
    slim = written(slim.withColumn("seg", arc("pos") * SEGMENTS_PER_ARC + part), "ring")
    _, owners = ring(n_shards, nodes)
    owners = np.repeat(owners, SEGMENTS_PER_ARC)
    counts = np.zeros(len(owners), dtype=np.int64)
    for seg, n in slim.groupBy("seg").count().collect():  # at most len(owners) rows
        counts[seg] = n
    plan = quotas(counts, owners, capacities(int(counts.sum()), n_shards, load_factor))
    plan = spark.createDataFrame(plan, "seg int, lo long, hi long, shard int, first long")
    plan = plan.groupBy("seg").agg(F.collect_list(F.struct("lo", "hi", "shard", "first")).alias("parts"))
    ranked = slim.withColumn("rank", F.row_number().over(Window.partitionBy("seg").orderBy("pos", "doc_id", "text_crc32", "size")) - 1)
    mine = F.filter("parts", lambda p: (F.col("rank") >= p["lo"]) & (F.col("rank") < p["hi"]))[0]
    out = ranked.join(F.broadcast(plan), "seg").withColumn("mine", mine)
    return out.select("doc_id", "size", "text_crc32", F.col("mine.shard").alias("shard"), (F.col("mine.first") + F.col("rank") - F.col("mine.lo")).alias("slot"))
