"""Filter interaction audit by decision diagrams: what every order of a set of filters removes, and where.

A document fails some of the filters: its failure mask. Spark counts documents by part and mask (at most 2^n masks with
four kinds of labels a part, added up map-side before they are shuffled). Each part's counts become a decision diagram:
one level for each filter, in the order in which the filters run; at a node the low edge is taken by documents that pass
the level's filter and the high edge by those that fail it. Every node carries the weights of the documents that the
masks below it stand for: all, good, toxic. Nodes with the same level and children are one node, and equal weights are
one leaf.

The diagram of one order becomes that of another by swapping adjacent levels, as in dynamic variable ordering: a node of
the upper level with grandchildren f00, f01, f10, f11 gets children (f00, f10) and (f01, f11); nothing else changes. All
n! orders are visited by n! - 1 swaps. In each, the path of low edges (all filters so far passed) gives the steps: at its
node of a level, the high child's weight is what the filter removes there and the low child's is what is kept.

Defined results: a null text is empty; it has no words, fails A alone, and D, C and B not. A null source is the part ''.
E compares whole texts (SHA-256 and length) with smaller doc_ids table-wide: of rows that share text and doc_id none is
smaller, a null doc_id is neither smaller nor larger. Repeated rows count as they stand. Labels: 1 in any of a doc_id's
rows counts; a document without labels, or without a doc_id, is neither good nor toxic. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_or_shuffled, with_computed, written

FILTERS = "ABCDE"
SIGNS = "#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))

Weight = tuple[int, ...]


class Diagram:
    """A count-weighted decision diagram over masks whose bit i says that filter i fails.

    A node is a number; its level's filter and children stand in `nodes`, its weight in `weight`. Leaves have no
    children. Equal nodes are one."""

    def __init__(self, counts: dict[int, Weight], n: int, zero: Weight) -> None:
        self.order = list(range(n))
        self.nodes: list[tuple[int, int] | None] = []
        self.weight: list[Weight] = []
        self._leaves: dict[Weight, int] = {}
        self._unique: dict[tuple[int, int], int] = {}
        level = [self._leaf(counts.get(self._mask(i, n), zero)) for i in range(1 << n)]
        while len(level) > 1:
            level = [self._node(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        self.root = level[0]

    @staticmethod
    def _mask(path: int, n: int) -> int:
        """The mask of a path from the root, whose first step is the path's highest bit."""
        return sum(1 << i for i in range(n) if path >> (n - 1 - i) & 1)

    def _leaf(self, weight: Weight) -> int:
        if weight not in self._leaves:
            self._leaves[weight] = len(self.nodes)
            self.nodes.append(None)
            self.weight.append(weight)
        return self._leaves[weight]

    def _node(self, low: int, high: int) -> int:
        # a child belongs to one level only, so the pair of children says the level
        if (low, high) not in self._unique:
            self._unique[low, high] = len(self.nodes)
            self.nodes.append((low, high))
            self.weight.append(tuple(a + b for a, b in zip(self.weight[low], self.weight[high], strict=True)))
        return self._unique[low, high]

    def children(self, node: int) -> tuple[int, int]:
        return self.nodes[node]

    def swap(self, i: int) -> None:
        """Exchange levels i and i + 1. Nodes above are rebuilt for their new children, nodes below stay as they are."""

        def moved(node: int, depth: int) -> int:
            if (node, depth) not in done:
                low, high = self.children(node)
                if depth < i:
                    new = self._node(moved(low, depth + 1), moved(high, depth + 1))
                else:
                    (f00, f01), (f10, f11) = self.children(low), self.children(high)
                    new = self._node(self._node(f00, f10), self._node(f01, f11))
                done[node, depth] = new
            return done[node, depth]

        done: dict[tuple[int, int], int] = {}
        self.root = moved(self.root, 0)
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def all_pass(self) -> Iterator[tuple[int, Weight, Weight]]:
        """(filter, weight kept after its level, weight that fails there) along the path of low edges."""
        node = self.root
        for f in self.order:
            low, high = self.children(node)
            yield f, self.weight[low], self.weight[high]
            node = low

    def failing(self) -> Weight:
        """The weight of all masks in which the first level's filter fails."""
        return self.weight[self.children(self.root)[1]]


def adjacent_swaps(n: int) -> Iterator[int]:
    """The places whose swaps with their right neighbours visit every order of n things once, from the first one: the last
    thing walks through each order of the others, to and fro."""
    if n < 2:
        return
    down = True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + 1 if down else step  # the last thing stands in front after it walked down
        down = not down


def audit(counts: dict[int, Weight], filters: str = FILTERS) -> list[dict]:
    """Rows of all orders of one part from its weights (all, good, toxic) by mask."""
    n = len(filters)
    d = Diagram(counts, n, (0, 0, 0))
    steps: list[tuple[list[int], list[tuple[int, Weight, Weight]]]] = []
    shapley, failing, alone = [0] * n, [0] * n, [0] * n

    def visit() -> None:
        path = list(d.all_pass())
        for f, _, gone in path:
            shapley[f] += gone[0]
        first, last = path[0], path[-1]
        failing[first[0]] = d.failing()[0]
        alone[last[0]] = last[2][0]
        steps.append((list(d.order), path))

    visit()
    for i in adjacent_swaps(n):
        d.swap(i)
        visit()
    assert len(steps) == factorial(n)
    return [
        {
            "filter_order": "".join(filters[f] for f in order), "step": k + 1, "kept": kept[0], "removed": gone[0], "redundant": failing[f] - gone[0],
            "unique_fails": alone[f], "good_lost": gone[1], "toxic_lost": gone[2], "shapley": shapley[f],
        }
        for order, path in steps
        for k, (f, kept, gone) in enumerate(path)
    ]


def _measured():
    """A text's failures of A to D as bits, its SHA-256 and its bytes."""

    def of(texts: list[str | None]) -> dict[str, list]:
        out: dict[str, list] = {"mask": [], "sha": [], "n_bytes": []}
        for t in texts:
            t = t or ""
            b = t.encode()
            words = b.split()  # of bytes: at ASCII white space alone
            fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * (len(b) - len(b.translate(None, CAPITALS))) > 2 * len(t), any(c in t for c in SIGNS))
            out["mask"].append(sum(1 << i for i, x in enumerate(fails) if x))
            out["sha"].append(hashlib.sha256(b).digest())
            out["n_bytes"].append(len(b))
        return out

    return of


def failure_masks(docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "source") -> DataFrame:
    """Per row: doc_id, part, mask (bit 0 to 4: fails A to E)."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    rows = written(with_computed(rows, "text", _measured, {"mask": "int", "sha": "binary", "n_bytes": "long"}), "measured")
    # only texts that stand under several doc_ids; a table of its own, so that the join may split a text of very many rows
    shared = rows.groupBy("sha", "n_bytes").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    shared = written(shared, "shared-texts")
    repeats = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    out = rows.join(small_or_shuffled(shared, shared.count()), ["sha", "n_bytes"], "left")
    return out.select("doc_id", "part", (F.col("mask") + F.when(repeats, 16).otherwise(0)).alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic) of masks(doc_id, part, mask) and labels(doc_id, quality, toxic)."""
    one = lambda c: F.max((F.col(c) == 1).cast("int")).alias(c)
    known = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(one("quality"), one("toxic"))
    known = written(known, "labels")
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)).cast("bigint")).alias(c)
    marked = masks.join(small_or_shuffled(known, known.count()), "doc_id", "left")
    return marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), total("quality").alias("good"), total("toxic"))


def filter_orders(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """Per part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley. columns: text, key and part, the names of the columns read of docs."""
    counts = mask_counts(failure_masks(docs, **columns), labels)

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        weights = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(rows["mask"], rows["n"], rows["good"], rows["toxic"], strict=True)}
        return pd.DataFrame(audit(weights)).assign(part=rows["part"].iloc[0])

    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    # a part has at most 32 rows here
    out = counts.groupBy("part").applyInPandas(of_part, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in names))
    return out.select("part", "filter_order", "step", *names)


def _bit(mask: str, letter: str) -> Column | str:
    """SQL: whether the mask has the bit of the filter whose letter the expression gives."""
    return f"({mask} >> (ascii({letter}) - 65)) & 1 = 1"


def filter_orders_sql() -> str:
    """The registered query from its definitions, without diagrams."""
    white = r"[^\x20\x09-\x0D]+"
    return f"""WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{white}') AS w FROM documents),
k AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, CAST(len(w) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INTEGER)
+ 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS INTEGER) + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
+ 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INTEGER) AS mask FROM t LEFT JOIN k USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS f, list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f, sum(n) FILTER (mask & coalesce(before, 0) = 0 AND NOT ({_bit('mask', 'f')})) AS kept, sum(n) FILTER (mask & coalesce(before, 0) = 0 AND {_bit('mask', 'f')}) AS removed,
sum(n) FILTER (mask & coalesce(before, 0) <> 0 AND {_bit('mask', 'f')}) AS redundant, sum(n) FILTER (mask = 1 << (ascii(f) - 65)) AS unique_fails,
sum(good) FILTER (mask & coalesce(before, 0) = 0 AND {_bit('mask', 'f')}) AS good_lost, sum(toxic) FILTER (mask & coalesce(before, 0) = 0 AND {_bit('mask', 'f')}) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, {', '.join(f'CAST(coalesce({c}, 0) AS BIGINT) AS {c}' for c in 'kept removed redundant unique_fails good_lost toxic_lost'.split())},
CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley FROM r"""
