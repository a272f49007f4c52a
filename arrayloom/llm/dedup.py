"""Exact duplicates by deterministic block naming.

Every text is cut into fixed-size byte blocks. Equal blocks get one integer name by sorting; then adjacent pairs of
names are named in the same way, level by level, until one name is left for each document. Names come from sorting
the blocks themselves, so two documents share an identity only if their bytes are equal: a hash only says in which
bucket a block is sorted. Everything is DataFrame code.

A block or pair that occurs very often would put a large share of the rows into one sort. Such blocks are found by
counting (pre-aggregated before the shuffle), reduced to their distinct contents, named there and joined back.

Defined results: null text equals the empty text; an empty text is one empty block; rows with equal doc_id and equal
text are still separate rows of which one stays; a null doc_id sorts below all others; very long texts are cut into as
many blocks as they need; other columns are not read by exact_groups and passed through by drop_exact, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, fresh, small_or_shuffled, utf8, written

#: Blocks are sorted in this many buckets; a name is the bucket, then the block's rank in it.
BUCKETS = 1 << 20
RANK_BITS = 40


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS).cast("bigint"))


def _named(distinct: DataFrame, bucket: Column, order: list[str]) -> Column:
    rank = F.dense_rank().over(Window.partitionBy(bucket).orderBy(*order)).cast("bigint")
    return F.shiftleft(bucket, RANK_BITS).bitwiseOR(rank)


def name_blocks(docs: DataFrame, text: str = "text", key: str = "doc_id", block_bytes: int = 8192, hot_rows: int = 1000) -> DataFrame:
    """One row per block: rid (one per input row), doc_id, sha (first block only), n_blocks, pos, name (a long)."""
    body = docs.select(F.col(key).alias("doc_id"), utf8(F.col(text)).alias("body"), F.monotonically_increasing_id().alias("rid"))
    body = body.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("body") / block_bytes).cast("int")))
    pieces = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda i: F.substring(F.col("body"), i * block_bytes + 1, F.lit(block_bytes)),
    )
    blocks = body.select("rid", "doc_id", F.unhex(F.sha2("body", 256)).alias("sha"), "n_blocks", F.posexplode(pieces).alias("pos", "block"))
    blocks = blocks.withColumn("sha", F.when(F.col("pos") == 0, F.col("sha"))).withColumn("h", F.xxhash64("block"))
    hot = written(blocks.groupBy("h").count().where(F.col("count") > hot_rows).select("h"), "hot-blocks")
    n_hot = hot.count()
    out = ["rid", "doc_id", "sha", "n_blocks", "pos", "name"]
    if not n_hot:
        return written(blocks.withColumn("name", _named(blocks, _bucket(F.col("h")), ["block"])).select(out), "blocks")
    marked = small_or_shuffled(hot, n_hot)
    rare = blocks.join(marked, "h", "left_anti")
    rare = rare.withColumn("name", _named(rare, _bucket(F.col("h")), ["block"])).select(out)
    often = blocks.join(marked, "h", "left_semi")
    contents = often.groupBy("h", "block").agg(F.count(F.lit(1)).alias("n"))
    contents = written(contents.select("h", "block", (-_named(contents, _bucket(F.col("h")), ["block"])).alias("name")), "hot-names")
    # contents hold block_bytes each, so the bound for a broadcast is on bytes
    often = often.join(small_or_shuffled(contents, contents.count() * block_bytes, 32 << 20), ["h", "block"]).select(out)
    return written(rare.unionByName(often), "blocks")


def name_pairs(rows: DataFrame) -> DataFrame:
    """The next level: (rid, n, pos, name) with adjacent names renamed as pairs; the last of an odd count pairs with 0."""
    even = F.col("pos") % 2 == 0
    pairs = rows.groupBy("rid", "n", F.shiftright("pos", 1).alias("to")).agg(
        F.max(F.when(even, F.col("name"))).alias("l"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(0)).alias("r")
    )
    distinct = pairs.groupBy("l", "r").agg(F.count(F.lit(1)).alias("c"))
    names = distinct.select("l", "r", _named(distinct, _bucket(F.xxhash64("l", "r")), ["l", "r"]).alias("name"))
    half = F.shiftright(F.col("n") + 1, 1)
    return pairs.join(names, ["l", "r"]).select("rid", half.alias("n"), F.col("to").alias("pos"), "name")


def identities(docs: DataFrame, text: str = "text", key: str = "doc_id", block_bytes: int = 8192) -> DataFrame:
    """One row per input row: rid, doc_id, sha, n_blocks and name; (n_blocks, name) is the collision-free identity."""
    blocks = name_blocks(docs, text, key, block_bytes)
    most = blocks.agg(F.max("n_blocks")).first()[0] or 1
    heads = blocks.where("pos = 0").select("rid", "doc_id", "sha", "n_blocks", "name")
    level = blocks.where("n_blocks > 1").select("rid", F.col("n_blocks").alias("n"), "pos", "name")
    ended = []
    for k in range(math.ceil(math.log2(most))):
        level = written(name_pairs(level), f"level-{k}")
        ended.append(level.where("n = 1").select("rid", "name"))
        level = level.where("n > 1")
    out = heads.where("n_blocks = 1")
    if ended:
        last = ended[0]
        for x in ended[1:]:
            last = last.unionByName(x)
        out = out.unionByName(heads.where("n_blocks > 1").drop("name").join(last, "rid").select(out.columns))
    return out


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", block_bytes: int = 8192) -> DataFrame:
    """Per input row: doc_id, keep_id (largest doc_id of its group), group_size, kept (one row of each group), text_sha256."""
    ids = written(identities(docs, text, key, block_bytes), "identities")
    # a table of its own: a join with it may split a group of very many rows, one after an aggregate could not
    groups = written(ids.groupBy("n_blocks", "name").agg(F.max(F.struct("doc_id", "rid")).alias("best"), F.count(F.lit(1)).alias("group_size")), "groups")
    return ids.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs without the rows whose text another row keeps; all columns stay."""
    ident, sha, own, no, kept_id, kept_sha = fresh(docs.columns, "id_", "sha_", "own_", "no_", "kept_id_", "kept_sha_")
    found = written(exact_groups(docs, text, key), "found")
    lost = written(found.where(~F.col("kept")).select(F.col("doc_id").alias(ident), F.col("text_sha256").alias(sha)), "dropped")
    n = lost.count()
    # a doc_id repeated with the same text: both a kept and a dropped row carry the pair, so keep one of the copies
    kept = found.where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    both = lost.join(kept, F.col(ident).eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    both = written(both.distinct(), "repeated")
    discard(found)
    n_both = both.count()
    tagged = docs.withColumn(own, F.sha2(utf8(F.col(text)), 256))
    same = F.col(key).eqNullSafe(F.col(ident)) & (F.col(sha) == F.col(own))
    out = tagged.join(small_or_shuffled(lost.distinct(), n), same, "left_anti").drop(own)
    if n_both:
        again = tagged.join(small_or_shuffled(both, n_both), same, "left_semi")
        one = again.withColumn(no, F.row_number().over(Window.partitionBy(key, own).orderBy(key))).where(F.col(no) == 1)
        out = out.unionByName(one.drop(no, own))
    return out
