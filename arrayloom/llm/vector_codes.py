"""Vector code compression: product codes whose exact nearest entries are found by LAESA pivots.

A vector's components become integers, floor(256 * x). It is cut into equal consecutive parts, and each part position has
a codebook, which starts as that part of the vectors with the smallest ids. A round assigns every part to its nearest
entry (squared Euclidean distance, ties to the lower index) and replaces each entry by the componentwise floor of its
parts' mean. After the rounds all parts are assigned once more.

LAESA: each part position has a few fixed pivots, taken from its first codebook far from one another. The distances of
all parts to their pivots are computed once and written beside the vectors. In a round, the pivots' distances to the
entries give a lower bound for each entry, the largest difference |d(part, pivot) - d(entry, pivot)|. Entries are
evaluated exactly, in integers, in the order of their bounds; once a bound exceeds the best distance the rest is pruned.

Tasks send back sums by part position and entry, which Spark adds up; the driver holds codebooks alone (parts x entries
x components, whatever the number of vectors).

Defined results: rows with a null vector, or with a null, infinite or NaN component, are dropped. So are vectors whose
length is not a positive multiple of the number of parts, or differs from that of the first vector with such a length (by
id, then by content). Components beyond +-2^26 (of 256 * x) count as that. A null id sorts after all others; rows that
repeat an id are separate rows. Fewer vectors than entries give as many entries as there are vectors. Labels are compared
null-safe. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, small_or_shuffled, written

#: Pivots of each part position.
PIVOTS = 4
#: Integer components stay within this, so that squared distances fit 64 bits.
LIMIT = 1 << 26
#: Relative slack of the bounds, which come from floating-point roots, under the exact integers.
SLACK = 1e-12


def integer_vectors(rows: DataFrame, n_parts: int = 16, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """(vec_id, label, v): the rows whose vectors can be cut into parts, as integers; lengths may still differ."""
    v = F.col(vector)
    finite = v.isNotNull() & ~F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    ints = F.transform(v, lambda x: F.greatest(F.least(F.floor(x.cast("double") * 256), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    good = rows.where(finite & (F.size(v) > 0) & (F.size(v) % n_parts == 0))
    return good.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), ints.alias("v"))


def far_apart(entries: np.ndarray, n: int) -> np.ndarray:
    """n of the entries, the first one and then always the one farthest from those taken (ties to the lower index)."""
    taken = [0]
    least = ((entries - entries[0]) ** 2).sum(1)
    while len(taken) < min(n, len(entries)):
        taken.append(int(least.argmax()))
        least = np.minimum(least, ((entries - entries[taken[-1]]) ** 2).sum(1))
    return entries[taken]


def squared_to_pivots(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(parts x pivots) exact squared distances."""
    return ((parts[:, None, :] - pivots[None, :, :]) ** 2).sum(2)


def nearest(parts: np.ndarray, entries: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of each part's nearest entry, ties to the lower index, and how many pairs were evaluated.

    to_pivots: the parts' squared distances to the pivots."""
    here, there = np.sqrt(to_pivots.astype(np.float64)), np.sqrt(squared_to_pivots(entries, pivots).astype(np.float64))
    bound = reduce(np.maximum, (np.abs(here[:, j, None] - there[None, :, j]) for j in range(len(pivots))))
    bound = np.maximum(bound - SLACK * (here.max(1, keepdims=True) + there.max()), 0)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1) ** 2 * (1 - SLACK)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    index = np.zeros(len(parts), np.int64)
    open_, evaluated = np.arange(len(parts)), 0
    for k in range(len(entries)):
        open_ = open_[bound[open_, k] <= best[open_]]  # later bounds are no smaller
        if not len(open_):
            break
        at = order[open_, k]
        d = ((parts[open_] - entries[at]) ** 2).sum(1)
        evaluated += len(open_)
        better = (d < best[open_]) | ((d == best[open_]) & (at < index[open_]))
        rows = open_[better]
        best[rows], index[rows] = d[better], at[better]
    return index, best, evaluated


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


Books = list[np.ndarray]


def with_pivots(table: DataFrame, pivots: Books, dim: int) -> DataFrame:
    """The vectors with d, their parts' squared distances to the pivots, part by part."""
    n_parts = len(pivots)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column("v"), dim)
            d = np.concatenate([squared_to_pivots(x, p) for x, p in zip(np.split(v, n_parts, axis=1), pivots, strict=True)], axis=1)
            d = pa.FixedSizeListArray.from_arrays(pa.array(d.ravel()), d.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, d], [*b.schema.names, "d"])

    types = dict(table.dtypes)
    return table.mapInArrow(rows, ", ".join(f"`{c}` {types[c]}" for c in table.columns) + ", d array<long>")


def _assigned(b: pa.RecordBatch, books: Books, pivots: Books, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """By part position: the parts, their entries' indexes, their distances and how many pairs were evaluated."""
    v, d = _matrix(b.column("v"), dim), _matrix(b.column("d"), sum(map(len, pivots)))
    at = 0
    for x, book, own in zip(np.split(v, len(books), axis=1), books, pivots, strict=True):
        index, best, evaluated = nearest(x, book, d[:, at : at + len(own)], own)
        at += len(own)
        yield x, index, best, evaluated


def updated(table: DataFrame, books: Books, pivots: Books, dim: int) -> tuple[Books, int]:
    """The codebooks after a round, and how many pairs of part and entry were evaluated. Tasks add up their own parts;
    Spark adds up the tasks; the driver gets one row for each entry and component in use."""
    width = dim // len(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(books), len(books[0]), width), np.int64)
        count = np.zeros((len(books), len(books[0])), np.int64)
        pairs = 0
        for b in batches:
            for p, (x, index, _, evaluated) in enumerate(_assigned(b, books, pivots, dim)):
                np.add.at(total[p], index, x)
                np.add.at(count[p], index, 1)
                pairs += evaluated
        p, e = np.nonzero(count)
        # one row more, of part -1, for the evaluations
        part, entry = np.append(p, -1), np.append(e, 0)
        n = np.append(count[p, e], pairs)
        s = np.concatenate([total[p, e], np.zeros((1, width), np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(n), *(pa.array(s[:, i]) for i in range(width))], ["part", "entry", "n", *(f"s{i}" for i in range(width))])

    partial = table.mapInArrow(sums, "part long, entry long, n long, " + ", ".join(f"s{i} long" for i in range(width)))
    added = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(width)))
    new, pairs = [b.copy() for b in books], 0
    for part, entry, n, *s in added.collect():  # one row for each entry in use and one for the evaluations
        if part < 0:
            pairs = n
        else:
            new[part][entry] = np.array(s, np.int64) // n
    return new, pairs


def first_books(vectors: DataFrame, n_parts: int, n_entries: int) -> tuple[Books, int]:
    """The first codebooks, from the vectors of the smallest ids, and the length of a vector (0 without any)."""
    order = [F.col("vec_id").asc_nulls_last(), "v"]
    head = vectors.orderBy(*order).limit(1).collect()
    if not head:
        return [], 0
    dim = len(head[0]["v"])
    seeds = vectors.where(F.size("v") == dim).orderBy(*order).limit(n_entries).collect()
    return np.split(np.array([r["v"] for r in seeds], np.int64), n_parts, axis=1), dim


def digest(books: Books) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def trained(rows: DataFrame, n_parts: int = 16, n_entries: int = 64, rounds: int = 2, **columns: str) -> tuple[DataFrame | None, Books, Books, list[int]]:
    """The vectors with their pivot distances (a table), the codebooks after the rounds, the pivots, and the pairs that
    each round evaluated. None and no books for a table without usable vectors."""
    vectors = integer_vectors(rows, n_parts, **columns)
    books, dim = first_books(vectors, n_parts, n_entries)
    if not dim:
        return None, [], [], []
    small_batches(rows.sparkSession, 4096)
    pivots = [far_apart(b, PIVOTS) for b in books]
    table = written(with_pivots(vectors.where(F.size("v") == dim), pivots, dim), "pivot-distances")
    evaluated = []
    for _ in range(rounds):
        books, pairs = updated(table, books, pivots, dim)
        evaluated.append(pairs)
    return table, books, pivots, evaluated


def encoder(books: Books, pivots: Books, dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of vectors with pivot distances to (vec_id, label, code, error)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(_assigned(b, books, pivots, dim))
            index = np.stack([i for _, i, _, _ in found], axis=1).astype(np.uint8)
            error = sum(d for _, _, d, _ in found)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array([r.tobytes().hex() for r in index], pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return rows


def vector_codes(rows: DataFrame, n_parts: int = 16, n_entries: int = 64, rounds: int = 2, **columns: str) -> DataFrame:
    """Per kept vector: vec_id, code (two hexadecimal digits a part, so at most 256 entries), error (squared distances
    summed over its parts), label_error (error summed over the rows of its label), codebooks_sha256.

    columns: vector, key and label, the names of the columns read."""
    if not 0 < n_entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    kinds = dict(rows.dtypes)
    table, books, pivots, _ = trained(rows, n_parts, n_entries, rounds, **columns)
    kind = f"vec_id {kinds[columns.get('key', 'vec_id')]}, label {kinds[columns.get('label', 'label')]}, code string, error long"
    if table is None:
        return rows.sparkSession.createDataFrame([], f"{kind}, label_error long, codebooks_sha256 string")
    dim = sum(b.shape[1] for b in books)
    coded = written(table.mapInArrow(encoder(books, pivots, dim), kind), "codes")
    discard(table)
    labels = written(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    out = coded.join(small_or_shuffled(labels, labels.count()), F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


_DISTANCE = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
_ROUND = """a{k} AS (SELECT r, p, x, min({{'d': {d}, 'e': e}}) AS m FROM parts JOIN b{k} USING (p) GROUP BY r, p, x),
n{k} AS (SELECT p, m.e AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS y FROM a{k}),
m{k} AS (SELECT p, e, i, CAST(floor(CAST(sum(y) AS BIGINT) / count(*)) AS BIGINT) AS y FROM n{k} GROUP BY p, e, i),
l{k} AS (SELECT p, e, list(y ORDER BY i) AS c FROM m{k} GROUP BY p, e),
b{next} AS (SELECT p, e, coalesce(l{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN l{k} USING (p, e))"""


def vector_codes_sql(rounds: int = 2) -> str:
    """The registered query by brute force: every part against every entry."""
    return f"""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS x FROM kept, (SELECT unnest(range(16)) AS p)),
b0 AS (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64),
{", ".join(_ROUND.format(k=k, next=k + 1, d=_DISTANCE) for k in range(rounds))},
f AS (SELECT r, p, min({{'d': {_DISTANCE}, 'e': e}}) AS m FROM parts JOIN b{rounds} USING (p) GROUP BY r, p),
codes AS (SELECT r, string_agg(format('{{:02x}}', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM f GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM books) AS codebooks_sha256 FROM codes JOIN kept USING (r)"""
