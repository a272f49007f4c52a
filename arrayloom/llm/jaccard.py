"""Jaccard join on word n-grams with multiple global orders.

A text's set holds the distinct hashes of its word n-grams. If two sets reach the threshold, they share an element of
their prefixes under every global order of the elements. Each text's prefixes under three orders are computed together.
Order 1 puts frequent elements last and generates candidates through lists of the sets that hold an element in their
prefix; a join then keeps the candidates that also share elements of their prefixes under orders 2 and 3. Texts move
only for what passes all three, to be verified on the whole sets.

Equal sets form one class first, so copies are never paired. Links are only needed up to connection: a list first
links its members to one pivot, so that a group of near copies of any size costs as many pairs as it has members; lists
that still hold several components get another pivot, and what then remains is paired completely, except within one
component. No link between different components is lost: a list is closed only when its members are one component or
all its other pairs were tried.

Bounds: the frequent elements sent to tasks are at most FREQUENT_MOST (which ones changes the speed, not the result);
groups for verification hold one pivot and at most GROUP_ELEMENTS elements; everything else is joins and group-bys.

Defined results: null or word-less text has an empty set, no link and its own doc_id as component; fewer words than n
give one element, the whole sequence; a null doc_id is ignored where a component's smallest doc_id is sought; rows
that repeat a doc_id are separate rows; ties for a component's smallest doc_id are one value; very long texts are read
whole; an empty table gives an empty result; similarity_components does not read other columns, drop_near passes them
through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, discard, fresh, small_batches, small_or_shuffled, with_computed, written

#: An element of more texts than this counts as frequent, up to so many elements, most frequent first.
FREQUENT_FROM, FREQUENT_MOST = 16, 1 << 20
#: Elements of the sets verified against one pivot in one group.
GROUP_ELEMENTS = 1 << 20
#: Prefix lengths over which every element is counted: when frequent elements go last, later ones take their places.
FREQUENT_DEPTH = 2
#: Elements that a task counts at a time.
CHUNK_ELEMENTS = 1 << 21
#: Characters of texts hashed at a time.
CHUNK_CHARS = 1 << 18
#: What remains is paired completely after so many rounds of pivots, once lists hold so many open pairs per set, or
#: after a round in which fewer than one of so many pairs was a link.
PIVOT_ROUNDS, OPEN_PAIRS, FRUITLESS = 5, 100, 50
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[9, 10, 11, 12, 13, 32]] = False


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, for buffers of up to 2^bits bytes."""
    p = _ODD[0]
    q = pow(p, -1, 1 << 64)
    up = lambda v: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full((1 << bits) - 1, v, np.uint64)]), dtype=np.uint64)
    return up(p), up(q)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words begin (one place more than texts)."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    buf = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    inside = _WORD_BYTE[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    up, down = _powers(max(16, int(len(buf)).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(np.arange(1, 257, dtype=np.uint64))[buf] * up[: len(buf)], dtype=np.uint64)])
    hashes = _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    begins = 1 + np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    return hashes, np.searchsorted(start, begins)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text. Texts are hashed some CHUNK_CHARS at a time, so that the arrays of a
    batch stay small; a longer text is a chunk of its own."""
    out, some, held = [], [], 0
    for t in texts:
        some.append(t)
        held += len(t or "")
        if held >= CHUNK_CHARS:
            out += _shingle_sets(some, words)
            some, held = [], 0
    return out + _shingle_sets(some, words) if some else out


def _shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    h, at = word_hashes(texts)
    grams = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for i in range(words):
        grams += h[i : i + len(grams)] * np.uint64(_ODD[i % len(_ODD)] + 2 * (i // len(_ODD)))
    grams = _mix(grams)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for v in h[a:b].tolist():
                short = _mix(np.array([(int(short) * _ODD[1] + v) & (1 << 64) - 1], np.uint64))[0]
            out.append(np.array([short], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_size(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1 if n else 0


def first_order(s: np.ndarray, often: np.ndarray, p: int) -> np.ndarray:
    """The first p elements under order 1: frequent ones (a mask) last, else by hash."""
    return np.concatenate([s[~often], s[often]])[:p]


def other_order(s: np.ndarray, k: int, p: int) -> np.ndarray:
    """The first p elements under order k, by the upper half of their ranks: equal elements stay equal."""
    r = s * np.uint64(_ODD[k])
    if p < len(r):
        r = np.partition(r, p - 1)[:p]
    return (r >> np.uint64(32)).astype(np.uint32).view(np.int32)


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sets reach the threshold."""
    if num * max(len(a), len(b)) > den * min(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (len(a) + len(b) - both)


def frequent(docs: DataFrame, words: int, num: int, den: int) -> np.ndarray:
    """Sorted elements that stand in many texts; counted over all texts. Early elements of the order by hash are counted
    whole, later ones where a chunk of texts holds them twice: common ones show in most chunks, and those that only one
    text of a chunk holds, nearly all, are not shuffled."""

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        early, late, held = [], [], 0

        def counts() -> pd.DataFrame:
            tok, n = np.unique(np.concatenate([*early, *late, np.zeros(0, np.uint64)]), return_counts=True)
            keep = n > 1
            keep[np.searchsorted(tok, np.concatenate([*early, np.zeros(0, np.uint64)]))] = True
            return pd.DataFrame({"tok": tok[keep].view(np.int64), "n": n[keep]})

        for x in batches:
            for s in shingle_sets(list(x["text"]), words):
                p = FREQUENT_DEPTH * prefix_size(len(s), num, den)
                early.append(s[:p])
                late.append(s[p:])
                held += len(s)
            if held > CHUNK_ELEMENTS:
                yield counts()
                early, late, held = [], [], 0
        yield counts()

    counted = docs.select("text").mapInPandas(tokens, "tok long, n long").groupBy("tok").agg(F.sum("n").alias("n"))
    counted = written(counted.where(F.col("n") > FREQUENT_FROM), "frequent")
    # how many elements have about so high a count: some hundred rows; then the lowest count that keeps the bound
    step = F.floor(F.log2("n") * 16).cast("int")
    least, held = None, 0
    for k, m in sorted(counted.groupBy(step.alias("k")).count().collect(), reverse=True):
        held += m
        if held > FREQUENT_MOST:
            break
        least = k
    if least is None:
        return np.zeros(0, np.uint64)
    top = np.sort(counted.where(step >= least).select("tok").toArrow()["tok"].to_numpy().astype(np.int64).view(np.uint64))
    discard(counted)
    return top


def signatures(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Per row of docs(doc_id, row, text): rid, doc_id, row, n (set size), cls (128 bits that name the set; null if empty), prefix under order 1, and
    second and third, the prefixes under the other orders."""
    often = docs.sparkSession.sparkContext.broadcast(frequent(docs, words, num, den))

    def make():
        top = often.value

        def compute(texts: list) -> dict[str, list]:
            sets = shingle_sets(texts, words)
            every = np.concatenate([*sets, np.zeros(0, np.uint64)])
            mask = top[np.minimum(np.searchsorted(top, every), len(top) - 1)] == every if len(top) else np.zeros(len(every), bool)
            cut = np.cumsum([len(s) for s in sets], dtype=np.int64)[:-1]
            sizes = [prefix_size(len(s), num, den) for s in sets]
            prefix = [first_order(s, m, p).view(np.int64) for s, m, p in zip(sets, np.split(mask, cut), sizes, strict=True)] if sets else []
            others = {name: [other_order(s, k, p) for s, p in zip(sets, sizes, strict=True)] for k, name in ((2, "second"), (3, "third"))}
            return {"n": [len(s) for s in sets], "cls": [set_name(s) for s in sets], "prefix": prefix} | others

        return compute

    out = with_computed(docs, "text", make, {"n": "long", "cls": "binary", "prefix": "array<long>", "second": "array<int>", "third": "array<int>"})
    return written(out.withColumn("rid", F.monotonically_increasing_id()), "signatures")


def set_name(s: np.ndarray) -> bytes | None:
    """128 bits computed from all elements: equal for equal sets."""
    if not len(s):
        return None
    a = _mix(s * np.uint64(_ODD[4]) + np.uint64(len(s))).sum(dtype=np.uint64)
    b = _mix(s + np.uint64(_ODD[5])).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def filtered(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) that share prefix elements under orders 2 and 3 as well. orders: (node, second, third)."""
    of = lambda c: orders.select(F.col("node").alias(c), F.col("second").alias(f"second_{c}"), F.col("third").alias(f"third_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.where(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b")).select(pairs.columns)


def verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b, n: elements of b) that are links. Texts of b go to groups of their a, with a's; large groups are
    split and a stands in each part. docs: (row, text); nodes: (node, cls, row) of every class, row being one that has it."""
    load = written(pairs.groupBy("a").agg(F.ceil(F.sum("n") / GROUP_ELEMENTS).cast("int").alias("parts")), "loads")
    tails = pairs.join(load, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("node"))
    heads = load.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("node"))
    roles = written(tails.unionByName(heads).join(nodes, "node"), "roles")
    given = docs.select("row", "text").join(small_or_shuffled(roles, roles.count(), BROADCAST_ROWS // 4), "row")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, head, seen = None, None, set()
        for x in batches:
            a, part, node, cls, text = (x.column(c).to_pylist() for c in ("a", "part", "node", "cls", "text"))
            hit = []
            for i, s in enumerate(shingle_sets(text, words)):
                if set_name(s) != cls[i]:
                    raise AssertionError("a row's text is another one than when it was named")
                if (a[i], part[i]) != at:
                    at, head, seen = (a[i], part[i]), s, {a[i]}  # a stands first
                elif node[i] not in seen:
                    seen.add(node[i])
                    if linked(head, s, num, den):
                        hit.append((a[i], node[i]))
            yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in hit], pa.int64()) for k in (0, 1)], ["a", "b"])

    grouped = given.select("a", "part", "node", "cls", "text").repartition("a", "part").sortWithinPartitions("a", "part", F.col("node") != F.col("a"))
    links = written(grouped.mapInArrow(compare, "a long, b long"), "links")
    discard(load, roles)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable. Labels spread along edges and jump to their label's label."""
    both = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("comp")).withColumnRenamed("u", "node"), "labels")
    while True:
        seen = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("comp").alias("near"))
        step = labels.join(seen, labels["node"] == seen["u"]).select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("above"))
        step = written(step.join(up, "comp", "left").select("node", "was", F.least("comp", F.coalesce("above", "comp")).alias("comp")), "labels")
        labels = step.select("node", "comp")
        if not step.where("comp <> was").limit(1).count():
            return labels


def _relabelled(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Labels after more links between nodes; the graph of components is small."""
    if not links.limit(1).count():
        return labels
    if labels is None:
        return components(links)
    of = lambda c: labels.select(F.col("node").alias(c), F.col("comp").alias(f"_{c}"))
    own = lambda c: F.coalesce(f"_{c}", c).alias(c)
    merged = components(links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(own("a"), own("b")).where("a <> b"))
    new = merged.select(F.col("node").alias("comp"), F.col("comp").alias("_to"))
    old = labels.join(new, "comp", "left").select("node", F.coalesce("_to", "comp").alias("comp"))
    fresh = merged.join(labels, "node", "left_anti")
    return written(old.unionByName(fresh), "labels")


def similarity_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links of num/den similarity)."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    # rows are fetched by doc_id if it tells them apart, else by a number that a written table fixes
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m")).agg(F.max("m"), F.max(F.col("doc_id").isNull())).first()
    numbered = None
    if (ids[0] or 1) > 1 or ids[1]:
        docs = numbered = written(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    else:
        docs = docs.withColumn("row", F.col("doc_id"))
    sigs = signatures(docs, words, num, den)
    classes = written(sigs.where("n > 0").groupBy("cls").agg(F.min("rid").alias("node"), F.min_by("row", "rid").alias("row")), "classes")
    n_classes = classes.count()
    orders = sigs.select(F.col("rid").alias("node"), "second", "third")
    heads = sigs.select("rid", "n", "prefix").join(small_or_shuffled(classes.select(F.col("node").alias("rid")), n_classes), "rid", "left_semi")
    postings = heads.select(F.col("rid").alias("node"), "n", F.posexplode("prefix").alias("pos", "tok"))
    lists = postings.groupBy("tok").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("tok")
    shared = written(postings.join(lists, "tok"), "shared")
    n_nodes = shared.select("node").distinct().count()
    labels = tried = None
    done: list[DataFrame] = []

    def fits(a: Column, i: Column, b: Column, j: Column) -> Column:
        """Whether sets of sizes a and b whose first common element stands at i and j can reach the threshold: by size,
        and by what can still be common. A pair fails at later common elements only, never at its first."""
        most = F.least(a - i, b - j)
        return (den * F.least(a, b) >= num * F.greatest(a, b)) & ((num + den) * most >= num * (a + b))

    last = not n_nodes
    turn, fruitless = 0, False
    while not last:
        mine = shared.withColumn("comp", F.col("node"))
        if labels is not None:
            mine = shared.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        # the member with the fewest elements before the list's own is the likeliest to be near all others; later rounds
        # look for it in another eighth of the members
        h = F.xxhash64("node", F.lit(turn))
        choice = ((F.pmod(h, F.lit(8)) > 0).alias("late") if turn else F.lit(False).alias("late"), F.col("pos").alias("ahead"), h.alias("h"))
        live = mine.groupBy("tok").agg(F.min(F.struct(*choice, "node", "n", "pos", "comp")).alias("pivot"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi")
        mine = written(mine.join(live.select("tok", "pivot", "m"), "tok"), "open")
        # pairs of different components that lists still hold; a pair counts once for every list and way round
        per = mine.groupBy("tok", "comp").agg(F.count(F.lit(1)).alias("k"), F.first("m").alias("m"))
        left = per.agg(F.sum(F.col("k") * (F.col("m") - F.col("k")))).first()[0] or 0
        last = turn == PIVOT_ROUNDS or fruitless or left <= 2 * OPEN_PAIRS * n_nodes and turn > 0
        if last:
            other = mine.select("tok", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"), F.col("comp").alias("comp_b"))
            pairs = mine.join(other, "tok").where((F.col("node") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & fits(F.col("n"), F.col("pos"), F.col("n_b"), F.col("pos_b")))
            pairs = pairs.select(F.col("node").alias("a"), "b", F.col("n_b").alias("n")).distinct()
        else:
            pairs = mine.where((F.col("comp") != F.col("pivot.comp")) & fits(F.col("n"), F.col("pos"), F.col("pivot.n"), F.col("pivot.pos")))
            pairs = pairs.select(F.col("pivot.node").alias("a"), F.col("node").alias("b"), "n").distinct()
        pairs = pairs.withColumn("key", F.struct(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")))
        if tried is not None:
            pairs = pairs.join(tried, "key", "left_anti")
        pairs = written(pairs, "pairs")
        discard(mine)
        tried = pairs.select("key") if tried is None else tried.unionByName(pairs.select("key"))
        held = written(filtered(pairs.select("a", "b", "n"), orders), "candidates")
        links = verify(held, docs, classes, words, num, den)
        fruitless = FRUITLESS * links.count() < pairs.count()
        labels = _relabelled(labels, links)
        done += [pairs, held, links]
        turn += 1
    rows = sigs.select("rid", "doc_id", "n", "cls").join(classes.select("cls", "node"), "cls", "left")
    if labels is not None:
        rows = rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    else:
        rows = rows.withColumn("comp", F.col("node"))
    rows = written(rows.select("doc_id", "n", "comp"), "members")
    discard(sigs, classes, shared, numbered, *done)
    # a table of its own: a join with it may split a component of very many rows, one after an aggregate could not
    least = written(rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("component_id")), "least")
    return rows.join(least, "comp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each group of near duplicates (the smallest doc_id, null after all others); rows with an empty
    set stay. Rows are told apart by a number of their own, so repeated and null ids are rows like all others."""
    row, ident, comp = fresh(docs.columns, "row_", "id_", "comp_")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = similarity_components(numbered, words, num, den, text, row).where("n_shingles > 0")
    rows = found.select(F.col("doc_id").alias(row), F.col("component_id").alias(comp))
    rows = written(rows.join(numbered.select(row, F.col(key).alias(ident)), row), "rows")
    groups = rows.groupBy(comp).agg(F.min(F.struct(F.col(ident).isNull().alias("unknown"), F.col(ident).alias("ident"), F.col(row).alias("row"))).alias("best"), F.count(F.lit(1)).alias("m"))
    groups = written(groups.where("m > 1").select(comp, F.col("best.row").alias("kept")), "groups")
    lost = rows.join(small_or_shuffled(groups, groups.count()), comp).where(F.col(row) != F.col("kept")).select(row)
    lost = written(lost, "near")
    discard(rows, groups)
    return numbered.join(small_or_shuffled(lost, lost.count()), row, "left_anti").select(docs.columns)
