"""Document fingerprints by a threshold-scaled sketch: every shingle hash below a fixed fraction of the hash range.

A text's shingles are its runs of five words (runs of other characters than ASCII white space, A-Z lower-cased); a text
of fewer words is one shingle. A shingle is hashed to 64 bits, and its hash is retained if it is below 2^64 / scaled. The
threshold is the same for every text, so sketches of long and short texts hold the same hashes of what they share: the
share of A's sketch that B's sketch holds estimates the containment of A in B, however unequal the two are, and the union
of two sketches is the sketch of the two texts' shingles together. A text none of whose hashes is below the threshold
retains its least one, so that no text with words has an empty sketch; merging drops such hashes where others are there.

A fingerprint is a string: the hashes in ascending order, sixteen hexadecimal digits each.

`edited_fingerprints` compares each document with its successor in descending order of doc_id, and with a text edited with
the successor's first characters. Neighbours meet by range partitioning: bin borders are keys of a bounded sample of rows
(BORDER_SAMPLE a bin), all rows are dealt to bins, and each bin also gets the first row of the next one. A bin is then
sorted and read as a stream, two texts at a time. A border says only which task handles a row, never what comes out.

Defined results: a null text is empty; a text without words has the empty fingerprint, which is like the empty one (1)
and unlike all others (0). Order: doc_id descending, null last, ties by the text's hash; rows that tie in both have the same
text, so their order says nothing, and such a run may span bins. Equal texts have equal fingerprints. A single row succeeds
itself. Very long texts and words are read whole. Other columns are not read by edited_fingerprints and passed through by
fingerprinted. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches, with_computed

WORDS, SCALED = 5, 8
#: Bytes of text in a bin, rows of the sample for each bin, and the most bins.
BIN_BYTES, BORDER_SAMPLE, MOST_BINS = 64 << 20, 20, 20_000

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """At least n powers of the base, modulo 2^64."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, _BASE, np.uint64)], dtype=np.uint64)
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finalizer."""
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """The hashes of all shingles of a text, in order of their places."""
    b = np.frombuffer(text.encode(), np.uint8)
    inside = np.r_[False, ~_WHITE[b], False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    # letters of words only, each times the power of its place in its word
    letters = _LOWER[b[inside[1:-1]]] + np.uint64(1)
    first = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(first, size)
    word = _mixed(np.add.reduceat(letters * _power(int(size.max()))[place], first) + size.astype(np.uint64))
    k = min(words, len(word))
    out = np.full(len(word) - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + word[i : len(word) - k + 1 + i]
    return _mixed(out)


def sketch(text: str | None, scaled: int = SCALED, words: int = WORDS) -> np.ndarray:
    """The retained hashes of a text in ascending order."""
    h = shingle_hashes(text or "", words)
    low = h[h < np.uint64((1 << 64) // scaled)] if scaled > 1 else h
    return np.unique(low) if len(low) or not len(h) else h.min(keepdims=True)


def to_string(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").tobytes().hex()


def from_string(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the lesser sketch that the other one holds; two empty ones are alike, an empty one is unlike others."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """The same share of the union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprinted(docs: DataFrame, text: str = "text", name: str = "fingerprint", scaled: int = SCALED, words: int = WORDS) -> DataFrame:
    """docs with the fingerprints of their texts; all columns stay, one of that name gives way to the fingerprint's new name
    (underscores in front)."""
    (name,) = fresh(docs.columns, name)
    return with_computed(docs, text, lambda: lambda texts: {name: [to_string(sketch(t, scaled, words)) for t in texts]}, {name: "string"}, keep=True)


def retained(marked: DataFrame, by: str, fingerprint: str = "fingerprint") -> DataFrame:
    """(by, hash): the retained hashes of rows with fingerprints, as hexadecimal digits."""
    f = F.col(fingerprint)
    at = F.sequence(F.lit(0), (F.length(f) / 16).cast("int") - 1)
    return marked.where(F.length(f) > 0).select(F.col(by).alias("by"), F.explode(F.transform(at, lambda i: F.substring(f, i * 16 + 1, F.lit(16)))).alias("hash"))


def merged(marked: DataFrame, by: str, fingerprint: str = "fingerprint", scaled: int = SCALED) -> DataFrame:
    """(by, hash): the sketches of all shingles of each value of by, as rows, whatever their number; a null value is one too.

    Hashes over the threshold, of texts with no lower one, stay only where a value has no others, and then the least."""
    rows = retained(marked, by, fingerprint).distinct()
    if scaled <= 1:
        return rows
    low = F.col("hash") < f"{(1 << 64) // scaled:016x}"
    high = rows.where(~low).groupBy("by").agg(F.min("hash").alias("hash"))
    alone = high.join(rows.where(low).select(F.col("by").alias("_by")).distinct(), F.col("by").eqNullSafe(F.col("_by")), "left_anti")
    return rows.where(low).unionByName(alone)


def contained(marked: DataFrame, key: str, whole: DataFrame, fingerprint: str = "fingerprint") -> DataFrame:
    """(key, hashes, found, containment) of each row's fingerprint in one merged sketch, whole(hash): a join on hashes that
    stand once on that side, so it grows with the rows and makes no pairs. A key is a row's identity."""
    rows = retained(marked, key, fingerprint).withColumnRenamed("by", key)
    hit = rows.join(whole.select("hash", F.lit(1).alias("hit")).distinct(), "hash", "left")
    by = hit.groupBy(key).agg(F.count(F.lit(1)).alias("hashes"), F.count("hit").alias("found"))
    return by.withColumn("containment", F.col("found") / F.col("hashes"))


Key = tuple[bool, int, int]


def _order(doc_id: Column, text: Column) -> list[Column]:
    """Ascending columns of the order: null last, doc_id descending, then the text's hash."""
    return [doc_id.isNull().alias("k0"), F.coalesce(F.bitwise_not(doc_id.cast("bigint")), F.lit(0)).alias("k1"), F.xxhash64(text).alias("k2")]


def borders(keys: DataFrame, n_bins: int, rows: int) -> list[Key]:
    """The first keys of at most n_bins bins: the least of all, then keys of a sample in even steps. One key stands several
    times if it fills several bins. n_bins also bounds the sample."""
    least = keys.agg(F.min(F.struct(*keys.columns))).first()[0]
    share = min(1.0, n_bins * BORDER_SAMPLE / rows)
    found = keys if share == 1.0 else keys.sample(share, seed=11)
    drawn = sorted((bool(a), int(b), int(c)) for a, b, c in found.collect())  # about n_bins * BORDER_SAMPLE rows
    inner = [drawn[len(drawn) * i // n_bins] for i in range(1, n_bins)] if drawn else []
    first = tuple(least)
    if len(drawn) < 2 * n_bins:
        inner = sorted(set(inner) - {first})
    return [first, *inner]


def _dealt(starts: list[Key]):
    """Rows (k0, k1, k2, doc_id, text) to their bins; a bin's first row also goes, as a guest, to the bin before it.

    A key that fills several bins is dealt over them in turn, the last of them first: there the row after it follows. A
    task sends one row of a key as a guest, however many it has."""
    last = len(starts) - 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[Key, int] = {}
        for b in batches:
            to, row, guest = [], [], []
            for i, key in enumerate(zip(*(b.column(j).to_pylist() for j in range(3)), strict=True)):
                lo, hi = bisect_left(starts, key), bisect_right(starts, key) - 1
                if lo <= hi:  # the key starts bins
                    turn = turns.get(key, 0)
                    if not turn:
                        to.append(lo - 1 if lo else last)
                        row.append(i)
                        guest.append(True)
                    turns[key] = turn + 1
                    hi -= turn % (hi - lo + 1)
                to.append(hi)
                row.append(i)
                guest.append(False)
            took = b.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(guest), *took.columns], ["bin", "guest", *b.schema.names])

    return rows


_FIELDS = {"n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(), "jaccard_edited": pa.float64(), "jaccard_next": pa.float64()}


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the following one, or all of it."""
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


def compared(text: str, own: np.ndarray, following: str, its: np.ndarray, scaled: int, words: int) -> tuple:
    """The values of _FIELDS for a text and the one after it, with their sketches."""
    new = edited(text, following)
    changed = sketch(new, scaled, words)
    return (len(text), hashlib.sha256(new.encode()).hexdigest(), to_string(own), to_string(changed), containment(own, changed), containment(own, its), resemblance(own, changed), resemblance(own, its))


def _streamed(scaled: int, words: int, kind: pa.DataType):
    """Bins' sorted rows (bin, guest, doc_id, text), a bin's guests last, to the results of all rows but the guests."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (bin, doc_id, text, sketch) of the row whose successor comes next
        for b in batches:
            ids, out = [], []

            def close(following: str, its: np.ndarray) -> None:
                _, doc_id, text, own = waiting
                ids.append(doc_id)
                out.append(compared(text, own, following, its, scaled, words))

            for at, guest, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text = text or ""
                if waiting is not None and waiting[0] != at:  # no guest came: the next bins hold the same text
                    close(waiting[2], waiting[3])
                    waiting = None
                if guest and waiting is None:
                    continue
                its = sketch(text, scaled, words)
                if waiting is not None:
                    close(text, its)
                waiting = None if guest else (at, doc_id, text, its)
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), *(pa.array([r[i] for r in out], t) for i, t in enumerate(_FIELDS.values()))], ["doc_id", *_FIELDS])
        if waiting is not None:
            ids, out = [waiting[1]], [compared(waiting[2], waiting[3], waiting[2], waiting[3], scaled, words)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), *(pa.array([r[i] for r in out], t) for i, t in enumerate(_FIELDS.values()))], ["doc_id", *_FIELDS])

    return rows


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", scaled: int = SCALED, words: int = WORDS) -> DataFrame:
    """Per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (containment
    of the lesser sketch in the other, of the edited text and of the next document), jaccard_edited, jaccard_next.

    key: a column of whole numbers."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = "int" if dict(docs.dtypes)[key] == "int" else "long"
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(*_order(F.col(key), body), F.col(key).cast(kind).alias("doc_id"), body.alias("text"))
    n, size = keyed.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    types = ", ".join(f"{c} {'long' if t == pa.int64() else 'double' if t == pa.float64() else 'string'}" for c, t in _FIELDS.items())
    if not n:
        return spark.createDataFrame([], f"doc_id {kind}, {types}")
    n_bins = min(n, MOST_BINS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BIN_BYTES)))
    starts = borders(keyed.select("k0", "k1", "k2"), n_bins, n)
    dealt = keyed.mapInArrow(_dealt(starts), f"bin int, guest boolean, k0 boolean, k1 long, k2 long, doc_id {kind}, text string")
    sorted_ = dealt.repartitionById(len(starts), F.col("bin")).sortWithinPartitions("bin", "guest", "k0", "k1", "k2")
    return sorted_.select("bin", "guest", "doc_id", "text").mapInArrow(_streamed(scaled, words, pa.int32() if kind == "int" else pa.int64()), f"doc_id {kind}, {types}")
