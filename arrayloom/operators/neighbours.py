"""Cosine neighbours of arrays: all pairs of k-mer vectors whose distance is within a threshold, without all pairs.

Every array is a vector of canonical k-mer counts (a k-mer and its reverse complement count as the lesser one). For odd k
no k-mer is its own reverse complement, so vectors that count both strands have the same cosines.

Arrays with equal vectors are one class. k-mers are ordered by the number of classes that have them, rare ones first, and
each class is indexed by a prefix of its k-mers in that order: by those from which on the rest of its vector still has a
norm of the least cosine t or more. Two vectors that share no k-mer of both prefixes have all they share in the rest of one
of them, so their cosine is below t. Frequent k-mers, the last in the order, are in few prefixes.

A class is written once, with its k-mers as their places in that order and the length of its prefix. The classes that a
k-mer lists are compared by matrix products, in blocks of BLOCK classes, so a task holds two blocks however long a list is. A
pair comes out of the list of the first k-mer that both have alone. Counts and products are whole numbers below 2^53, hence
exact.

Where the threshold is loose, prefixes hold most of a vector and a pair meets in many lists. Then every two blocks of DENSE
classes are compared once (array_pairs, near_forest), and what is asked for comes out of the task that compares them: pairs
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .orders import places
from .similarity import _written, discard

#: Bounds of the index are floating-point numbers; they give way by this much.
SLACK = 1e-9
#: Classes of a k-mer that are compared at once, and rows of them that are multiplied at once.
BLOCK, ROWS = 8192, 512
#: Letters counted at once, and longest k-mers that are counted.
LETTERS, LONGEST = 1 << 21, 23
#: Whole numbers up to here are exact as 32-bit floating-point numbers.
EXACT = 1 << 24
#: k-mers whose places in the order are a fixed list in each task; 5-mers are 512.
FIXED = 1 << 15
#: Classes of a block where all are compared with all; pairs of arrays that are passed on, and edges that are held, at once.
DENSE, PAIRS, EDGES = 1 << 15, 1 << 18, 1 << 21


def _counter(k: int):
    """Batches (id, seq) of upper-case letters to (id, v)."""
    code = np.full(256, -1, np.int64)
    code[list(b"ACGT")] = range(4)
    kind = pa.list_(pa.struct([("kmer", pa.string()), ("n", pa.int64())]))

    def counted(seqs: pa.Array) -> pa.Array:
        data = [s.as_py() or b"" for s in seqs]
        sizes = np.array([len(s) for s in data], np.int64)
        letters = code[np.frombuffer(b"".join(data), np.uint8)]
        n = max(0, len(letters) - k + 1)
        ahead, back, good = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
        for j in range(k):
            x = letters[j : j + n]
            ahead += x << 2 * (k - 1 - j)
            back += (3 - x) << 2 * j
            good &= x >= 0
        row, ends = np.repeat(np.arange(len(data)), sizes)[:n], np.cumsum(sizes)
        good &= np.arange(n) + k <= ends[row] if n else good
        key, times = np.unique(row[good] << 2 * k | np.minimum(ahead, back)[good], return_counts=True)
        names = np.frombuffer(b"ACGT", np.uint8)[key[:, None] >> 2 * np.arange(k - 1, -1, -1) & 3]
        names = pa.StringArray.from_buffers(len(key), pa.py_buffer((np.arange(len(key) + 1) * k).astype(np.int32)), pa.py_buffer(names.tobytes()))
        offsets = np.searchsorted(key >> 2 * k, np.arange(len(data) + 1)).astype(np.int32)
        values = pa.StructArray.from_arrays([names, pa.array(times.astype(np.int64))], ["kmer", "n"])
        return pa.ListArray.from_arrays(pa.array(offsets), values).cast(kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = np.cumsum(b.column("n").to_numpy()) // LETTERS
            edge = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if lo < hi:
                    yield pa.RecordBatch.from_arrays([b.column("id")[lo:hi], counted(b.column("seq")[lo:hi])], ["id", "v"])

    return count


def canonical_counts(arrays: DataFrame, k: int = 5) -> DataFrame:
    """(id, v) of arrays(id, seq): v holds the array's canonical k-mers and how often each occurs, in order of the k-mer;
    empty where there is none. Ids tell arrays apart, so every row is counted where it is."""
    if k % 2 == 0:
        raise ValueError("an odd k, so that no k-mer is its own reverse complement")
    if not 0 < k <= LONGEST:
        raise ValueError(f"k-mers of at most {LONGEST} letters")
    kind, seq = dict(arrays.dtypes)["id"], F.coalesce(F.upper("seq"), F.lit("")).cast("binary")
    rows = arrays.select("id", seq.alias("seq")).withColumn("n", F.octet_length("seq").cast("long"))
    return rows.mapInArrow(_counter(k), f"id {kind}, v array<struct<kmer: string, n: bigint>>")


def vector_classes(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables (class, v, n: members) of vectors with k-mers, named by their least id, and (id, class) of all counts(id, v); an
    array without k-mers is in no class (null). Vectors are compared by SHA-256 of their texts, and move once."""
    rows = _written(counts.withColumn("key", F.when(F.size("v") > 0, F.unhex(F.sha2(F.col("v").cast("string"), 256)))))
    # a table of its own, so that the join may split a class of very many arrays
    named = _written(rows.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("n")))
    members = _written(rows.select("id", "key").join(named, "key", "left").select("id", "class", "n"))
    own = members.where("id = class").select("class", "n")
    classes = _written(own.join(rows.select(F.col("id").alias("class"), "v"), "class").select("class", "v", "n"))
    discard(rows, named)
    return classes, members.select("id", "class")


def prefixes(classes: DataFrame, least: float) -> DataFrame:
    """(kmer, class): the k-mers of each class's prefix for a least cosine."""
    entry = classes.select("class", F.explode("v").alias("e")).select("class", "e.kmer", F.col("e.n").cast("double").alias("c"))
    often = entry.groupBy("kmer").agg(F.count(F.lit(1)).alias("df"))  # a row for each k-mer there is
    own = Window.partitionBy("class")
    later = own.orderBy(F.desc("df"), F.desc("kmer")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    square = F.col("c") * F.col("c")
    rest = entry.join(often, "kmer").withColumn("rest", F.sqrt(F.sum(square).over(later) / F.sum(square).over(own)))
    return rest.where(F.col("rest") >= least - SLACK).select("kmer", "class")


def _placed(classes: DataFrame, least: float) -> DataFrame:
    """(class, at, c, m): the k-mers of each class as places in the order of all k-mers, rising, with their counts; the first m
    are its prefix for a least cosine."""
    often = classes.select(F.explode("v.kmer").alias("kmer")).groupBy("kmer").agg(F.count(F.lit(1)).alias("df"))
    often = _written(often)
    kind = dict(classes.dtypes)["class"]
    if often.limit(FIXED + 1).count() > FIXED:
        order = places(often, ["df", "kmer"], "at").select("kmer", F.col("at").cast("int").alias("at"))
        entry = classes.select("class", F.inline("v")).join(order, "kmer").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("e"))
        kept = prefixes(classes, least).groupBy("class").agg(F.count(F.lit(1)).cast("int").alias("m"))
        return _written(entry.join(kept, "class").select("class", F.col("e.at").alias("at"), F.col("e.n").alias("c"), "m"))
    known = often.orderBy("df", "kmer").toArrow().column("kmer").to_pylist()
    place = {x: i for i, x in enumerate(known)}

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            flat = v.flatten()
            code = flat.field("kmer").dictionary_encode()
            at = np.array([place[x] for x in code.dictionary.to_pylist()], np.int32)[code.indices.to_numpy()]
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((at, row))
            at, n = at[order], flat.field("n").to_numpy()[order]
            upto = np.concatenate([[0.0], np.cumsum(n.astype(float) ** 2)])
            ends = np.cumsum(sizes)
            rest, all_of = upto[ends][row] - upto[:-1], upto[ends] - upto[ends - sizes]
            m = np.bincount(row[np.sqrt(rest / all_of[row]) >= least - SLACK], minlength=len(sizes))
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("class"), pa.ListArray.from_arrays(offsets, pa.array(at)), pa.ListArray.from_arrays(offsets, pa.array(n)), pa.array(m.astype(np.int32))], ["class", "at", "c", "m"])

    placed = _written(classes.select("class", "v").mapInArrow(put, f"class {kind}, at array<int>, c array<bigint>, m int"))
    discard(often)
    return placed


def _unpacked(at: pa.ListArray, c: pa.ListArray, places: np.ndarray) -> np.ndarray:
    """Vectors as rows of a matrix over the k-mers at `places`."""
    x = np.zeros((len(at), len(places)))
    x[np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy())), np.searchsorted(places, at.flatten().to_numpy())] = c.flatten().to_numpy()
    return x


def _close(found: list[np.ndarray], squares: list[np.ndarray], most: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(p, q, distance) of rows of two matrices of vectors within most, some rows of the first at a time; of one matrix p < q."""
    if max((s.max(initial=0) for s in squares), default=0) < EXACT:
        found = [x.astype(np.float32) for x in found]
    x, y, norm = found[0], found[-1], np.sqrt(squares[-1]).astype(found[-1].dtype)
    for lo in range(0, len(x), ROWS):
        since = lo if len(found) == 1 else 0
        dot = x[lo : lo + ROWS] @ y[since:].T
        # norms as they are here may be off by a little
        bound = (1 - most - 1e-5) * np.sqrt(squares[0][lo : lo + ROWS])
        p, q = np.divmod(np.flatnonzero(dot >= np.outer(bound.astype(dot.dtype), norm[since:])), max(1, dot.shape[1]))
        d = np.maximum(1 - dot[p, q].astype(float) / np.sqrt(squares[0][lo + p] * squares[-1][since + q]), 0.0)
        p, q = lo + p, since + q
        keep = (d <= most) & (p < q) if len(found) == 1 else d <= most
        yield p[keep], q[keep], d[keep]


def _near(most: float):
    """One pair of blocks of a k-mer's list, rows (kmer, class, at, c, block, i, j), to (a, b, distance) within most, for the pairs
    that have no earlier k-mer in common."""

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        block, i, j = (rows.column(c).to_numpy() for c in ("block", "i", "j"))
        first = rows.column("kmer")[0].as_py()
        whole = lambda c: pa.concat_arrays(c.chunks)
        vectors = [whole(rows.column(c)) for c in ("at", "c")]
        kmers = np.unique(vectors[0].flatten().to_numpy())
        sides = [pa.array(np.flatnonzero(block == x)) for x in ({i[0], j[0]} if i[0] == j[0] else (i[0], j[0]))]
        names = [rows.column("class").take(s).combine_chunks() for s in sides]
        found = [_unpacked(*[v.take(s) for v in vectors], kmers) for s in sides]
        squares = [(x * x).sum(1) for x in found]
        earlier = np.searchsorted(kmers, first)
        x, y = found[0], found[-1]
        out: list[tuple] = []
        for p, q, d in _close(found, squares, most):
            if earlier:
                new = [~((x[p[k : k + BLOCK], :earlier] * y[q[k : k + BLOCK], :earlier]).any(axis=1)) for k in range(0, len(p), BLOCK)]
                new = np.concatenate([*new, np.zeros(0, bool)])
                p, q, d = p[new], q[new], d[new]
            out.append((p, q, d))
        p, q, d = (np.concatenate([o[k] for o in out] or [np.zeros(0)]) for k in range(3))
        return pa.table({"a": names[0].take(pa.array(p.astype(np.int64))), "b": names[-1].take(pa.array(q.astype(np.int64))), "distance": pa.array(d)})

    return compare


def cosine_neighbours(arrays: DataFrame, most: float = 0.2, k: int = 5, scale: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Pairs (id_a, id_b, n_a, n_b, distance) of vector classes of arrays(id, seq) whose distance, scale * (1 - cosine), is at
    most scale * most, id_a < id_b, named by their least ids and with their numbers of arrays; and the membership (id, class).

    most is below 1. Arrays of one class are at distance 0 and are not paired; arrays that share no k-mer, or have none, are at
    distance `scale` from each other and so in no pair."""
    if not 0 <= most < 1:
        raise ValueError("a distance below 1: vectors without a common k-mer are at 1")
    classes, members = vector_classes(canonical_counts(arrays, k))
    placed = _placed(classes, 1 - most)
    lists = placed.select(F.explode(F.slice("at", 1, F.col("m"))).alias("kmer")).groupBy("kmer").agg(F.count(F.lit(1)).alias("size")).where("size > 1")  # a row for each k-mer
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    listed = placed.withColumn("kmer", F.explode(F.slice("at", 1, F.col("m")))).join(lists, "kmer").withColumn("blocks", blocks)
    listed = listed.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # a block meets every block of its list, itself included
    listed = listed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    listed = listed.select("kmer", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "class", "at", "c")
    kind = dict(classes.dtypes)["class"]
    met = listed.groupBy("kmer", "i", "j").applyInArrow(_near(most), f"a {kind}, b {kind}, distance double")
    near = met.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), (scale * F.col("distance")).alias("distance"))
    size = lambda c: classes.select(F.col("class").alias(f"id_{c}"), F.col("n").alias(f"n_{c}"))
    return near.join(size("a"), "id_a").join(size("b"), "id_b").select("id_a", "id_b", "n_a", "n_b", "distance"), members


def _blocks(classes: DataFrame, most: float, each, schema: str) -> DataFrame:
    """Rows that each(names, sides, near) gives of every two blocks of classes(class, v, ...), a block with itself included.

    names: the columns of a side; sides: their tables, one of a block with itself; near: (p, q, distance) of their rows within
    most, some at a time. A task holds two blocks."""
    n, cores = classes.count(), classes.sparkSession.sparkContext.defaultParallelism
    # some pairs of blocks for each core, so that none waits long for the last ones
    blocks = max(1, -(-n // DENSE), min(isqrt(12 * cores) + 1, -(-n // (2 * ROWS))))
    rows = _placed(classes, 1 - most).drop("m").join(classes.drop("v"), "class")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")

    def compare(i: int, j: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        block = rows.column("block").to_numpy()
        sides = [rows.take(pa.array(np.flatnonzero(block == x))) for x in ([i] if i == j else [i, j])]
        if not all(s.num_rows for s in sides):
            return
        vectors = [[pa.concat_arrays(s.column(c).chunks) for c in ("at", "c")] for s in sides]
        kmers = np.unique(np.concatenate([v[0].flatten().to_numpy() for v in vectors]))
        found = [_unpacked(*v, kmers) for v in vectors]
        squares = [(x * x).sum(1) for x in found]
        yield from each(sides, _close(found, squares, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for b in batches:
            key = b.column("i").to_numpy().astype(np.int64) * blocks + b.column("j").to_numpy()
            edge = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if lo < hi:
                    if held and key[lo] != at:
                        yield from compare(*divmod(at, blocks), pa.Table.from_batches(held))
                        held = []
                    held.append(b.slice(lo, hi - lo))
                    at = int(key[lo])
        if held:
            yield from compare(*divmod(at, blocks), pa.Table.from_batches(held))

    return rows.repartition(blocks * (blocks + 1) // 2, "i", "j").sortWithinPartitions("i", "j").mapInArrow(run, schema)


def array_pairs(arrays: DataFrame, most: float = 0.2, k: int = 5, digits: int = 9) -> DataFrame:
    """(id_a, id_b, distance) of every two arrays(id, seq) whose distance, 1 - cosine to so many digits, is at most most, id_a < id_b;
    those of equal vectors are at 0. Arrays without a common k-mer are at 1 and in no pair, so most is below 1.

    Vectors are compared once a class; a class moves with the ids of its arrays."""
    if not 0 <= most < 1:
        raise ValueError("a distance below 1: vectors without a common k-mer are at 1")
    classes, members = vector_classes(canonical_counts(arrays, k))
    ids = members.where("class IS NOT NULL").groupBy("class").agg(F.collect_list("id").alias("ids"))
    kind = dict(arrays.dtypes)["id"]

    def each(sides: list[pa.Table], near: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        lists = [pa.concat_arrays(s.column("ids").chunks) for s in sides]
        sizes = [np.diff(x.offsets.to_numpy()).astype(np.int64) for x in lists]
        flat = pa.concat_arrays([x.flatten() for x in lists])
        order = pc.sort_indices(flat)
        names, rank = flat.take(order), np.empty(len(flat), np.int64)
        rank[order.to_numpy()] = np.arange(len(flat))
        starts = [np.cumsum(n) - n for n in sizes]
        starts[-1] = starts[-1] + (len(lists[0].flatten()) if len(lists) > 1 else 0)

        def told(p: np.ndarray, q: np.ndarray, d: np.ndarray, own: bool) -> Iterator[pa.RecordBatch]:
            m = sizes[-1][q]
            ends = np.cumsum(sizes[0][p] * m)
            for lo in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
                at = np.arange(lo, min(lo + PAIRS, int(ends[-1])))
                of = np.searchsorted(ends, at, "right")
                u, v = np.divmod(at - ends[of] + sizes[0][p[of]] * m[of], m[of])
                if own:
                    some = u < v
                    of, u, v = of[some], u[some], v[some]
                a, b = rank[starts[0][p[of]] + u], rank[starts[-1][q[of]] + v]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(np.minimum(a, b))), names.take(pa.array(np.maximum(a, b))), pa.array(d[of])], ["id_a", "id_b", "distance"])

        if len(sides) == 1:
            several = np.flatnonzero(sizes[0] > 1)
            yield from told(several, several, np.zeros(len(several)), True)
        for p, q, d in near:
            yield from told(p, q, np.round(d, digits), False)

    return _blocks(classes.join(ids, "class").select("class", "v", "ids"), most, each, f"id_a {kind}, id_b {kind}, distance double")


def least_forest(p: np.ndarray, q: np.ndarray, order: np.ndarray, nodes: int) -> np.ndarray:
    """Places of the edges (p, q) of a spanning forest, the least in this order of the edges."""
    live, taken = order, [np.zeros(0, np.int64)]
    u, v = p[live], q[live]
    while len(live):
        best = np.full(nodes, len(live))
        # of edges written to one node the last one stays, which is the least
        best[np.stack([u, v], 1)[::-1].ravel()] = np.repeat(np.arange(len(live))[::-1], 2)
        has = np.flatnonzero(best < len(live))
        taken.append(live[np.unique(best[has])])
        to = np.arange(nodes)
        to[has] = u[best[has]] + v[best[has]] - has
        # of two that point to each other the lesser one is the root
        own = np.arange(nodes)
        to = np.where((to[to] == own) & (own < to), own, to)
        while not np.array_equal(up := to[to], to):
            to = up
        u, v = to[u], to[v]
        stays = u != v
        u, v, live = u[stays], v[stays], live[stays]
    return np.concatenate(taken)


def near_forest(arrays: DataFrame, most: float = 0.2, k: int = 5, scale: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Edges (id_a, id_b, distance) of the pairs of cosine_neighbours that connect, below every level, what all of these pairs
    connect; and the membership (id, class). Of every two blocks a minimum spanning forest is passed on, so edges grow with
    the classes times the blocks, not with the pairs."""
    if not 0 <= most < 1:
        raise ValueError("a distance below 1: vectors without a common k-mer are at 1")
    classes, members = vector_classes(canonical_counts(arrays, k))
    kind = dict(classes.dtypes)["class"]

    def each(sides: list[pa.Table], near: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        flat = pa.concat_arrays([c for s in sides for c in s.column("class").chunks])
        order = pc.sort_indices(flat)
        names, rank = flat.take(order), np.empty(len(flat), np.int64)
        rank[order.to_numpy()] = np.arange(len(flat))
        other = sides[0].num_rows if len(sides) > 1 else 0
        held: list[tuple] = []

        def least() -> list[tuple]:
            a, b, d = (np.concatenate([h[c] for h in held]) for c in range(3))
            some = least_forest(a, b, np.lexsort((b, a, d)), len(flat))
            return [(a[some], b[some], d[some])]

        for p, q, d in near:
            a, b = rank[p], rank[q + other]
            held.append((np.minimum(a, b), np.maximum(a, b), scale * d))
            if sum(len(h[0]) for h in held) > EDGES:
                held = least()
        if held:
            a, b, d = least()[0]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(d)], ["id_a", "id_b", "distance"])

    return _blocks(classes.select("class", "v"), most, each, f"id_a {kind}, id_b {kind}, distance double"), members
