"""Distances between vectors and sequences, components, and families of repeats."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from arrayloom.functions import seqfn

#: Vectors of which all pairs may be asked for.
FULL_IDS = 10_000
#: Strings up to this length that may be one edit apart meet on what is left without one letter.
SHORT = 32
#: Longest k-mers counted in a table of all of them, and counts a task holds before it passes them on.
TABLE_K, HELD = 8, 1 << 22
#: Links up to which one task finds components; more of them take rounds of joins.
FEW = 1 << 20
#: Kinds of ids that a task may put in order.
PLAIN = ("string", "bigint", "int")
#: Letters of pairs of one length that are compared at once.
LETTERS = 1 << 20
#: Letters of the longest strings whose rotations are compared as bits of a number.
BITS = 64
_BACK = np.arange(128, dtype=np.uint32)
_BACK[list(b"ACGTacgt")] = list(b"TGCAtgca")


def kmer_counts(rows: DataFrame, k: int = 5) -> DataFrame:
    """(id, kmer, n) of rows(id, seq): how often each k-mer of A, C, G and T in upper case stands in the sequences of an id.

    A task adds sequences up in a table of all k-mers for each id and passes tables on once they hold HELD counts, so what is
    shuffled is a row for each k-mer of an id and task, however many letters there are."""
    if not 0 < k <= TABLE_K:
        raise ValueError(f"k-mers of 1 to {TABLE_K} letters")
    kind, size = dict(rows.dtypes)["id"], 4**k
    code = np.full(256, -1, np.int64)
    code[list(b"ACGT")] = range(4)
    names = pa.array(["".join(x) for x in itertools.product("ACGT", repeat=k)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict = {}

        def held() -> Iterator[pa.RecordBatch]:
            for name, table in tables.items():
                at = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), ids), names.take(pa.array(at)), pa.array(table[at])], ["id", "kmer", "n"])
            tables.clear()

        for b in batches:
            ids = b.schema.field("id").type
            for name, seq in zip(b.column("id").to_pylist(), b.column("seq").to_pylist(), strict=True):
                c = code[np.frombuffer((seq or "").encode("utf-8", "replace"), np.uint8)]
                if len(c) < k:
                    continue
                word, known = np.zeros(len(c) - k + 1, np.int64), np.ones(len(c) - k + 1, bool)
                for j in range(k):
                    part = c[j : len(c) - k + 1 + j]
                    word = word * 4 + part
                    known &= part >= 0
                if name not in tables:
                    if len(tables) * size >= HELD:
                        yield from held()
                    tables[name] = np.zeros(size, np.int64)
                found = word[known]
                if len(found) < size:
                    np.add.at(tables[name], found, 1)
                else:
                    tables[name] += np.bincount(found, minlength=size)
        yield from held()

    counted = rows.select("id", "seq").mapInArrow(count, f"id {kind}, kmer string, n long")
    return counted.groupBy("id", "kmer").agg(F.sum("n").alias("n"))


def cosine_pairs(vectors: DataFrame, scale: float = 100.0, whole: bool = False) -> DataFrame:
    """(id_a, id_b, distance) of vectors(id, kmer, tf) that share a k-mer: scale * (1 - cosine), each pair once.

    whole: every pair of ids, those that share none at distance `scale`; for at most FULL_IDS ids, since that result grows with
    their square. Of any number of vectors, neighbours.cosine_neighbours finds the pairs within a distance."""
    norms = vectors.groupBy("id").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("norm"))
    v = vectors.join(norms, "id")
    a = v.select("kmer", F.col("id").alias("id_a"), F.col("tf").alias("x"), F.col("norm").alias("norm_a"))
    b = v.select("kmer", F.col("id").alias("id_b"), F.col("tf").alias("y"), F.col("norm").alias("norm_b"))
    dots = a.join(b, "kmer").where("id_a < id_b").groupBy("id_a", "id_b").agg(F.sum(F.col("x") * F.col("y")).alias("dot"), F.first("norm_a").alias("na"), F.first("norm_b").alias("nb"))
    cosine = F.when(F.col("na") * F.col("nb") > 0, F.col("dot") / (F.col("na") * F.col("nb"))).otherwise(0.0)
    near = dots.select("id_a", "id_b", (scale * (1 - cosine)).alias("distance"))
    if not whole:
        return near
    if norms.limit(FULL_IDS + 1).count() > FULL_IDS:
        raise ValueError(f"all pairs of more than {FULL_IDS} vectors")
    every = norms.select(F.col("id").alias("id_a")).join(norms.select(F.col("id").alias("id_b")), F.col("id_a") < F.col("id_b"))
    return every.join(near, ["id_a", "id_b"], "left").withColumn("distance", F.coalesce("distance", F.lit(float(scale))))


def euclidean_pairs(vectors: DataFrame) -> DataFrame:
    """(id_a, id_b, distance) of vectors that share a k-mer, from norms and dot products."""
    norms = vectors.groupBy("id").agg(F.sum(F.col("tf") * F.col("tf")).alias("norm"))
    v = vectors.join(norms, "id")
    a = v.select("kmer", F.col("id").alias("id_a"), F.col("tf").alias("x"), F.col("norm").alias("norm_a"))
    b = v.select("kmer", F.col("id").alias("id_b"), F.col("tf").alias("y"), F.col("norm").alias("norm_b"))
    dots = a.join(b, "kmer").where("id_a < id_b").groupBy("id_a", "id_b").agg(F.sum(F.col("x") * F.col("y")).alias("dot"), F.first("norm_a").alias("na"), F.first("norm_b").alias("nb"))
    return dots.select("id_a", "id_b", F.sqrt(F.greatest(F.col("na") + F.col("nb") - 2 * F.col("dot"), F.lit(0.0))).alias("distance"))


def cluster_flow(before: DataFrame, after: DataFrame) -> DataFrame:
    """(source, target, value): members that clusters(id, comp) of one threshold pass to those of the next."""
    both = before.select("id", F.col("comp").alias("source")).join(after.select("id", F.col("comp").alias("target")), "id", "left")
    return both.groupBy("source", F.coalesce("target", F.lit("SING")).alias("target")).agg(F.count(F.lit(1)).alias("value"))


def _least_mismatches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of letters (as numbers, one length): the least number of mismatches of a over the rotations of b and of its
    reverse complement. All rows are compared at once, a rotation at a time."""
    n = b.shape[1]
    least = np.full(len(b), n)
    back = np.where(b < len(_BACK), _BACK[np.minimum(b, len(_BACK) - 1)], b)[:, ::-1]
    for strand in (b, back):
        twice = np.concatenate([strand, strand], axis=1)
        for k in range(n):
            np.minimum(least, (twice[:, k : k + n] != a).sum(axis=1), out=least)
    return least


def _hamming(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(b), np.nan)
    known = np.flatnonzero((a.notna() & b.notna() & (a != "") & (b != "")).to_numpy(bool))
    x, y = a.to_numpy(object), b.to_numpy(object)
    sizes = np.array([len(y[i]) for i in known], np.int64)
    for n in np.unique(sizes):
        of = known[sizes == n]
        for c in range(0, len(of), step := max(1, LETTERS // int(n))):
            rows = of[c : c + step]
            # what a does not reach to the end of b is a mismatch
            full = [(x[i] * (n // len(x[i]))).ljust(n, "\0") for i in rows]
            letters = lambda t: np.frombuffer("".join(t).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(t), -1)
            out[rows] = _least_mismatches(letters(full), letters([y[i] for i in rows])) / n
    return pd.Series(out).astype(object).where(~np.isnan(out), None)


def sliding_hamming(a: Column, b: Column) -> Column:
    """Least share of mismatches of a (repeated to b's length, which it divides) over the rotations of b and of its
    reverse complement; null if one is null or empty."""
    return F.pandas_udf(_hamming, DoubleType())(a, b)


def _least_edits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of letters (as numbers, one length up to BITS): the least edit distance of a to the rotations of b and of its
    reverse complement. A row of the edit matrix is two numbers, bits for its steps up and down; all rows and rotations are
    compared at once, a letter at a time."""
    n = b.shape[1]
    kind = np.uint16 if n <= 16 else np.uint32 if n <= 32 else np.uint64
    least = np.full(len(b), n, np.int32)
    back = np.where(b < len(_BACK), _BACK[np.minimum(b, len(_BACK) - 1)], b)[:, ::-1]
    for strand in (b, back):
        equal = np.zeros((n, len(b)), kind)
        for i in range(n):
            equal |= (strand.T == a[:, i]).astype(kind) << kind(i)
        twice = np.concatenate([equal, equal])
        up, down, score = np.full(equal.shape, ~kind(0)), np.zeros_like(equal), np.full(equal.shape, n, np.int16)
        for t in range(n):
            e = twice[t : t + n]
            vertical = e | down
            across = (((e & up) + up) ^ up) | e
            more, less = down | ~(across | up), up & across
            score += (more >> kind(n - 1) & kind(1)).astype(np.int16)
            score -= (less >> kind(n - 1) & kind(1)).astype(np.int16)
            more, less = more << kind(1) | kind(1), less << kind(1)
            up, down = less | ~(vertical | more), more & vertical
        np.minimum(least, score.min(axis=0), out=least)
    return least


def _turned_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of equal lengths from 1 to BITS; null of others."""
    x, y = a.to_numpy(object), b.to_numpy(object)
    sizes = np.array([len(s) if s and t and len(s) == len(t) <= BITS else 0 for s, t in zip(x, y, strict=True)], np.int64)
    out = np.zeros(len(sizes), np.int32)
    letters = lambda t: np.frombuffer("".join(t).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(t), -1)
    for n in np.unique(sizes[sizes > 0]):
        of = np.flatnonzero(sizes == n)
        for c in range(0, len(of), step := max(1, LETTERS // int(n) // 4)):
            rows = of[c : c + step]
            out[rows] = _least_edits(letters(x[rows].tolist()), letters(y[rows].tolist()))
    return pd.Series(out).astype("Int32").where(sizes > 0)


def rotation_distance(a: Column, b: Column) -> Column:
    """Edit distance; of equal lengths the least over rotations of b and of its reverse complement."""
    turned = F.array_min(F.transform(F.concat(seqfn.rotations(b), seqfn.rotations(seqfn.revcomp(b))), lambda r: F.levenshtein(a, r)))
    n = F.length(a)
    short = (n == F.length(b)) & n.between(1, BITS)
    return F.when(short, F.pandas_udf(_turned_edits, IntegerType())(a, b)).when(n == F.length(b), turned).otherwise(F.levenshtein(a, b))


def sorted_side(rows: DataFrame) -> DataFrame:
    """rows as a side of a join that is sorted and merged. Short strings are a few bytes each in files but a hundred in memory, so a
    table that is small enough for a broadcast by its files may be too large for the driver."""
    return rows.hint("merge")


def _one_edit(words: DataFrame) -> DataFrame:
    """(a, b, distance) as edit_pairs for one edit, of words(s). Strings that differ in a letter are equal without it, at the same
    place; of lengths one apart, the longer one without a letter is the other. So strings meet only if they are a result."""
    s, t = F.col("s"), F.col("t")
    places = F.when(F.length(s) > 0, F.sequence(F.lit(1), F.length(s))).otherwise(F.array().cast("array<int>"))
    without = lambda x, i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x)))
    turned = words.select(s.alias("b"), F.explode(F.array_distinct(F.array(s, seqfn.revcomp(s)))).alias("t"))
    at = words.select(s.alias("a"), F.explode(places).alias("i"), s).select("a", "i", without(s, F.col("i")).alias("rest"))
    other = turned.where(F.length(t) > 0).select("b", "t", F.explode(F.sequence(F.lit(1), F.length(t))).alias("i")).select("b", "i", without(t, F.col("i")).alias("rest"))
    same = at.join(sorted_side(other), ["i", "rest"]).where("a < b").select("a", "b")
    longer = at.select("a", "rest").distinct()
    shifted = longer.join(sorted_side(turned), F.col("rest") == t).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = same.unionByName(shifted).distinct()
    return pairs.withColumn("distance", F.when(F.col("a") == seqfn.revcomp(F.col("b")), 0).otherwise(1))


def edit_pairs(seqs: DataFrame, most: int) -> DataFrame:
    """(a, b, distance) of distinct sequences(s) of any length within most edits, forward or reverse complement; every pair
    once, a < b.

    If two strings are within d edits, one of d + 1 segments of the one stands unchanged in the other near its place:
    pairs meet on such a segment, so strings are never crossed. Strings of up to d letters, too short for d + 1 segments,
    meet longer ones on the longer one's segments; among themselves all of them are within d edits, so each of their pairs
    is a result (over the five bases there are 5 ** d such strings and fewer).

    Of strings of few letters many share a segment. For one edit those of up to SHORT letters meet on all letters but one; of two
    strings one of which is longer than SHORT + 1, both are longer than SHORT."""
    words = seqs.select("s").where(F.col("s").isNotNull()).distinct()
    n = F.length("s")
    if most != 1:
        return _segment_pairs(words, most)
    short = _one_edit(words.where(n <= SHORT + 1))
    return short.unionByName(_segment_pairs(words.where(n > SHORT), 1).where(F.greatest(F.length("a"), F.length("b")) > SHORT + 1))


def _segment_pairs(words: DataFrame, most: int) -> DataFrame:
    """edit_pairs of words(s), distinct, on segments."""
    parts = most + 1
    n = F.length("s")
    cut = lambda i: F.floor(n * i / parts).cast("int")
    index = words.where(n >= parts).select(F.col("s").alias("a"), n.alias("na"), F.explode(F.array(*[F.struct(F.lit(i).alias("i"), cut(i).alias("at"), F.substring(F.col("s"), cut(i) + 1, cut(i + 1) - cut(i)).alias("seg")) for i in range(parts)])).alias("p"))
    probes = words.where(n > 0).select(F.col("s").alias("b"), F.explode(F.array(F.col("s"), seqfn.revcomp(F.col("s")))).alias("t"))
    # segments of a string of length m, taken from strings of every length within most of it
    probes = probes.select("b", "t", F.explode(F.sequence(F.greatest(F.length("t") - most, F.lit(parts)), F.length("t") + most)).alias("na"))
    m = F.col("na")
    spans = F.array(*[F.struct(F.lit(i).alias("i"), F.floor(m * i / parts).cast("int").alias("at"), (F.floor(m * (i + 1) / parts) - F.floor(m * i / parts)).cast("int").alias("k")) for i in range(parts)])
    probes = probes.select("b", "t", "na", F.explode(spans).alias("p"))
    probes = probes.select("b", "t", "na", F.col("p.i").alias("i"), F.explode(F.transform(F.sequence(F.greatest(F.col("p.at") - most, F.lit(0)), F.col("p.at") + most), lambda j: F.substring(F.col("t"), j + 1, F.col("p.k")))).alias("seg"))
    index = index.select("a", "na", F.col("p.i").alias("i"), F.col("p.seg").alias("seg"))
    met = index.join(sorted_side(probes), ["na", "i", "seg"]).where((F.col("a") < F.col("b")) | (F.length("b") < parts))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    few = words.where(n < parts).withColumn("size", F.lit("short"))
    short = few.select("size", F.col("s").alias("a")).join(few.select("size", F.col("s").alias("b")), "size").where("a < b")
    pairs = pairs.unionByName(short.select("a", "b")).distinct()
    d = F.least(F.levenshtein("a", "b"), F.levenshtein(F.col("a"), seqfn.revcomp(F.col("b"))))
    return pairs.withColumn("distance", d).where(F.col("distance") <= most)


def _written(df: DataFrame) -> DataFrame:
    spark: SparkSession = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="arrayloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    path = f"{at.rstrip('/')}/arrayloom/components-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that _written made and that no result still to be computed reads."""
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            if "/arrayloom/" in folder:
                path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _least_reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, comp) of all links (u, v) at once; ids as their places in order."""
    links = [b for b in batches if b.num_rows]
    if not links:
        return
    ends = pa.chunked_array([b.column(c) for c in ("u", "v") for b in links]).combine_chunks().dictionary_encode()
    names = ends.dictionary
    order = pc.sort_indices(names).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    u, v = np.split(place[ends.indices.to_numpy()], 2)
    root = np.arange(len(order))
    while len(u):
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(up := root[root], root):
            root = up
        u, v = root[u], root[v]
        some = u != v
        u, v = u[some], v[some]
    for lo in range(0, len(order), 1 << 16):
        yield pa.RecordBatch.from_arrays([names.take(pa.array(order[lo : lo + (1 << 16)])), names.take(pa.array(order[root[lo : lo + (1 << 16)]]))], ["id", "comp"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, comp) of edges(id_a, id_b): the least id reachable. Rows with a null id are left out. Up to FEW links are one task's;
    of more, labels spread along edges and jump to their label's label; each round is a table in the shared folder, so a lost
    executor costs one round."""
    known = edges.where(F.col("id_a").isNotNull() & F.col("id_b").isNotNull())
    both = _written(known.select(F.col("id_a").alias("u"), F.col("id_b").alias("v")).union(known.select("id_b", "id_a")).distinct())
    kind = dict(both.dtypes)["u"]
    if kind in PLAIN and both.limit(2 * FEW + 1).count() <= 2 * FEW:
        found = _written(both.where("u <= v").coalesce(1).mapInArrow(_least_reachable, f"id {kind}, comp {kind}"))
        discard(both)
        return found
    labels = _written(both.groupBy(F.col("u").alias("id")).agg(F.least(F.first("u"), F.min("v")).alias("comp")))
    while True:
        near = both.join(sorted_side(labels), both["v"] == labels["id"]).groupBy("u").agg(F.min("comp").alias("near"))
        step = labels.join(sorted_side(near), labels["id"] == near["u"]).select("id", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("id").alias("comp"), F.col("comp").alias("above"))
        step = _written(step.join(sorted_side(up), "comp", "left").select("id", "was", F.least("comp", F.coalesce("above", "comp")).alias("comp")))
        discard(labels)
        labels = step.select("id", "comp")
        if not step.where("comp <> was").limit(1).count():
            discard(both)
            return labels


def consensus_classes(rows: DataFrame) -> DataFrame:
    """rows(seqid, consensus) with their non-redundant consensus: rotations, strands and multiples of a consensus present
    on the same sequence become one."""
    return _classed(_written(rows.where(F.length("consensus") > 0).select("seqid", "consensus").distinct()))


def _classed(units: DataFrame) -> DataFrame:
    """units(seqid, consensus, ...), one row each, with canonical. A root is found once for each consensus, whatever the
    number of sequences that have it; the shortest multiple is the least of the few sizes of a root on a sequence."""
    roots = units.select(F.col("consensus").alias("_unit")).distinct().withColumn("root", seqfn.bound(seqfn.primitive_root(F.col("_unit")), seqfn.canonical))
    marked = units.join(roots, F.col("consensus") == F.col("_unit")).drop("_unit")
    sizes = marked.groupBy("seqid", "root").agg(F.collect_set(F.length("consensus")).alias("sizes"))
    least = F.array_min(F.filter("sizes", lambda b: F.length("consensus") % b == 0))
    return marked.join(sizes, ["seqid", "root"]).withColumn("canonical", F.repeat("root", (least / F.length("root")).cast("int"))).drop("root", "sizes")


def consensus_frequencies(rows: DataFrame) -> DataFrame:
    """(canonical, n): how many rows(seqid, consensus) each non-redundant consensus stands for, most frequent first, ties by
    the consensus. Rows are counted by sequence and consensus before they are classed, so they are read once."""
    counted = _written(rows.where(F.length("consensus") > 0).groupBy("seqid", "consensus").agg(F.count(F.lit(1)).alias("_n")))
    of = _classed(counted).groupBy("canonical").agg(F.sum("_n").alias("n"))
    return of.orderBy(F.desc("n"), "canonical")
