"""Mixing sources to target weights.

Each source's documents form one stream of words, cut into fixed-length blocks. A source gets slots in proportion to
its target. Source counts are drawn for every output shard: a table (src, shard, n) that holds, for each source, one
multinomial draw of its slots over the shards. That is the draw of sources per shard, conditioned on the exact totals of
the sources; independent draws would miss the targets and take documents of capped sources more than twice. The n slots
of a row of that table are numbered on from those of the shards before; a slot's number goes through its source's
pseudorandom index permutation, one per epoch, and blocks join slots by index. Within the shard, slots are dealt to places a
prime step apart, which interleaves the sources.

Everything is DataFrame code. Per-source sums are pre-aggregated. Positions in a stream come from sums over hash
buckets and then within a bucket, so a source with a third of the rows is spread over many tasks. Ordered as a whole
are the table of sources (one row each) and, per source, the counts per shard (one row for shard_words words).

Defined results: null text or one without words has size 0 and takes nothing; a null source is a source of its own,
last in order; rows that repeat a doc_id, or whole rows, count as separate rows; rows that tie in everything else are
told apart by a number of their own; very long texts are cut like others; other columns are passed through by
mixed_documents whatever their names, and not read by mixed; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WORD, discard, fresh, release, written

#: Weights by a source's place in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Hash buckets a source's stream is laid out in.
STREAM_BUCKETS = 4096
#: Slots that one row of a table stands for before they are made into rows.
RUN = 4096
#: Words of an output shard, on average.
SHARD_WORDS = 1 << 20
#: Rounds of the swap-or-not shuffle that permutes block indices.
ROUNDS = 8
#: A prime beyond the slots of any shard: the step between the places of a shard's slots.
STRIDE = 1_000_000_007


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: src, source, source_size, target.

    share x all words is dealt by weight; a source stops at most x its size and its excess is dealt again by weight.
    That ends where target = min(most x size, weight x level), and the level follows from sums in order of size/weight.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int"))
    srcs = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    srcs = srcs.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    srcs = srcs.withColumns({"w": w, "cap": most * F.col("source_size")})
    before = Window.orderBy(F.col("cap") / F.col("w"), "src").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col("cap") / F.col("w"), "src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.sum("w").over(after) + F.col("w")
    )
    srcs = srcs.withColumn("level", level)
    below = F.when(F.col("cap") >= F.col("level") * F.col("w"), F.struct(F.col("cap") / F.col("w"), F.col("src")))
    srcs = srcs.withColumn("level", F.min_by("level", below).over(every))
    return srcs.select("src", "source", "source_size", F.least("cap", F.col("w") * F.coalesce("level", F.lit(float("inf")))).alias("target"))


def shuffled_index(index: Column, n: Column, *tweak: Column) -> Column:
    """index permuted over 0..n-1: swap-or-not rounds, each a bijection for any n, keyed by tweak."""

    def swap_or_not(x: Column, r: Column) -> Column:
        other = F.pmod(F.xxhash64(*tweak, r) - x, n)
        return F.when(F.xxhash64(*tweak, -r, F.greatest(x, other)) % 2 == 0, other).otherwise(x)

    return F.aggregate(F.array(*map(F.lit, range(1, ROUNDS + 1))), index, swap_or_not)


def spread_index(index: Column, n: Column, *tweak: Column) -> Column:
    """index over 0..n-1 (n below STRIDE) to places far apart: steps of a prime, which no n below it divides."""
    return F.pmod(index * STRIDE + F.pmod(F.xxhash64(*tweak), n), n)


def shard_counts(srcs: DataFrame, n_shards: int) -> DataFrame:
    """(src, shard, n, base, offset, shard_slots): slots of each source drawn for each shard; base: slots of the source
    in the shards before; offset: slots of the shard that belong to the sources before; shard_slots: all of the shard.

    srcs: src, slots. Every slot draws its shard; draws are counted where they are made."""
    runs = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / RUN))
    runs = srcs.where("slots > 0").select("src", "slots", F.explode(runs).alias("run"))
    # a fixed number of partitions: adaptive execution would see few small rows here and make one task of all draws
    runs = runs.repartition(_tasks(srcs), "src", "run")
    slot = F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("slots"), (F.col("run") + 1) * RUN) - 1)).alias("slot")
    drawn = runs.select("src", slot).select("src", F.pmod(F.xxhash64(F.lit("shard"), "src", "slot"), F.lit(n_shards)).alias("shard"))
    counts = written(drawn.groupBy("src", "shard").agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumns({
        "base": before(Window.partitionBy("src").orderBy("shard")),
        "offset": before(Window.partitionBy("shard").orderBy("src")),
        "shard_slots": F.sum("n").over(Window.partitionBy("shard")),
    })


def _tasks(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", share: float = 1.5, most: float = 2.0, block_words: int = 32, shard_words: int = SHARD_WORDS, rid: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces). rows: rid, doc_id, source, size, src, source_size, target. pieces: one per document part in a
    slot of the mix: rid, shard, place (in the shard), epoch, idx (block), lo, hi (words of the document)."""
    rid = F.monotonically_increasing_id() if rid is None else rid
    sized = docs.select(rid.alias("rid"), F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    sized = written(sized, "sizes")
    srcs = source_targets(sized, share, most).withColumns({"n_blocks": F.ceil(F.col("source_size") / block_words)})
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.col("n_blocks"))).otherwise(0).cast("bigint")
    srcs = written(srcs.withColumn("slots", slots), "sources")
    n_shards = max(1, round((srcs.agg(F.sum("target")).first()[0] or 0) / shard_words))
    rows = written(sized.join(srcs.select("src", F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "rows")
    discard(sized)

    laid = rows.where("size > 0").withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(STREAM_BUCKETS)))
    sums = laid.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("base", F.sum("n").over(Window.partitionBy("src").orderBy("bucket")) - F.col("n")).drop("n")
    within = Window.partitionBy("src", "bucket").orderBy("doc_id", "size", "rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = laid.withColumn("end", F.sum("size").over(within)).join(sums, ["src", "bucket"])
    laid = laid.select("src", "rid", (F.col("base") + F.col("end") - F.col("size")).alias("start"), (F.col("base") + F.col("end")).alias("end"))
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("end") - 1) / block_words)
    parts = laid.withColumn("idx", F.explode(F.sequence(first, last)))
    parts = parts.select(
        "src", "idx", "rid",
        (F.greatest(F.col("start"), F.col("idx") * block_words) - F.col("start")).alias("lo"),
        (F.least(F.col("end"), (F.col("idx") + 1) * block_words) - F.col("start")).alias("hi"),
    )

    # a count is cut into runs, so that one shard's slots of one source are no task's whole work
    runs = shard_counts(srcs, n_shards).join(F.broadcast(srcs.select("src", "n_blocks")), "src") if srcs.count() <= BROADCAST_ROWS else shard_counts(srcs, n_shards).join(srcs.select("src", "n_blocks"), "src")
    runs = runs.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / RUN)))).repartition(_tasks(docs), "src", "shard", "run")
    at = F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1)).alias("at")
    drawn = runs.select("src", "shard", "n_blocks", "base", "offset", "shard_slots", at)
    slot = F.col("base") + F.col("at")
    epoch = F.floor(slot / F.col("n_blocks"))
    drawn = drawn.select(
        "src", "shard", spread_index(F.col("offset") + F.col("at"), F.col("shard_slots"), F.col("shard")).alias("place"), epoch.alias("epoch"),
        shuffled_index(slot % F.col("n_blocks"), F.col("n_blocks"), F.col("src"), epoch).alias("idx"),
    )
    # both sides come out of explodes, whose size Spark can't foresee: never broadcast them
    return rows, parts.join(drawn.hint("merge"), ["src", "idx"]).drop("src")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """Per input row: doc_id, size, source_size, target (its source's), taken (words the mix takes, repeats counted),
    n_slots (slots of the mix that hold words of it), first_shard and first_place (the first of these; null if none)."""
    rows, pieces = mix(docs, **options)
    taken = pieces.groupBy("rid").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"), F.count(F.lit(1)).alias("n_slots"), F.min(F.struct("shard", "place")).alias("first"))
    out = rows.join(taken, "rid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select("doc_id", "size", "source_size", "target", zero("taken"), zero("n_slots"), F.col("first.shard").cast("bigint").alias("first_shard"), F.col("first.place").alias("first_place"))


def mixed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", laid_out: bool = True, **options) -> DataFrame:
    """The mix as documents: for each epoch that takes words of a document, a row with those words in order (the whole
    text unchanged when all its words are taken); documents without words keep no row. laid_out: rows come by output
    shard, in order of place, each at the first slot that holds words of it, for which texts are shuffled once more;
    else in no order."""
    release(docs.sparkSession)
    names = dict(zip(("row", "spans", "n", "size", "first"), fresh(docs.columns, "row_", "spans_", "n_", "size_", "first_"), strict=True))
    row, spans, n, size, first = names.values()
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows, pieces = mix(docs, text, key, source, rid=F.col(row), **options)
    picks = pieces.groupBy("rid", "epoch").agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias(spans), F.sum(F.col("hi") - F.col("lo")).alias(n), F.min(F.struct("shard", "place")).alias(first)
    )
    picks = picks.join(rows.select("rid", F.col("size").alias(size)), "rid").withColumnRenamed("rid", row).drop("epoch")
    # a document taken whole needs no spans
    picks = picks.withColumn(spans, F.when(F.col(n) < F.col(size), F.col(spans)))
    out = docs.join(picks, row).withColumn(text, F.when(F.col(spans).isNull(), F.col(text)).otherwise(_cut(F.col(text), F.col(spans))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast("bigint"))
    if laid_out:
        out = out.repartitionByRange(_tasks(docs), F.col(f"{first}.shard"), F.col(f"{first}.place")).sortWithinPartitions(F.col(f"{first}.shard"), F.col(f"{first}.place"))
    return out.select([c for c in docs.columns if c != row])


def _cut(text: Column, spans: Column) -> Column:
    """The words of the spans, each with the white space after it. The text is split once: words are bound to a lambda's
    variable, so that no span splits it again."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1))
    some = lambda w: F.array_join(F.flatten(F.transform(spans, lambda s: F.slice(w, (s["lo"] + 1).cast("int"), (s["hi"] - s["lo"]).cast("int")))), "")
    return F.transform(F.array(words), some)[0]
