"""Fingerprints, vector codes and filter audits against brute force, on odd rows and on empty tables."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrayloom.llm import filter_audit, fingerprints, vector_codes

from .test_operators import LONG, SCHEMA, WORD, got, rows

MASK = (1 << 64) - 1


def plain_mixed(x):
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * mult) & MASK
    return x ^ (x >> 31)


def plain_sketch(text, scaled=fingerprints.SCALED, words=fingerprints.WORDS):
    """The sketch in whole numbers, shingle by shingle."""
    base, hashes = fingerprints._BASE, []
    for w in WORD.findall(text or ""):
        h = len(w.encode())
        for i, b in enumerate(w.encode()):
            h += (b + 1 + (32 if 65 <= b <= 90 else 0)) * pow(base, i, 1 << 64)
        hashes.append(plain_mixed(h & MASK))
    k = min(words, len(hashes))
    all_ = set()
    for i in range(len(hashes) - k + 1 if k else 0):
        h = k
        for x in hashes[i : i + k]:
            h = (h * base + x) & MASK
        all_.add(plain_mixed(h))
    low = {h for h in all_ if h < (1 << 64) // scaled}
    return low or set(sorted(all_)[:1])


def share(a, b):
    return len(a & b) / min(len(a), len(b)) if a and b else float(a == b)


def plain_fingerprints(table):
    """By the contract: (doc_id, text) in descending order of doc_id, null last, each with its successor."""
    hashes = {t: int(h) for t, h in table["hash"].items()}
    order = sorted(table["rows"], key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1] or ""]))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        new = text[: len(text) - len(text) // 3] + following[: len(text) // 3]
        a, b, c = plain_sketch(text), plain_sketch(new), plain_sketch(following)
        line = ["".join(f"{h:016x}" for h in sorted(s)) for s in (a, b)]
        out.append((str(doc_id), len(text), hashlib.sha256(new.encode()).hexdigest(), *line, round(share(a, b), 9), round(share(a, c), 9)))
    return sorted(out)


def fingerprint_rows(df):
    cols = "n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()
    return sorted((str(r["doc_id"]), *(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in cols)) for r in got(df))


def as_table(df):
    body = F.coalesce("text", F.lit(""))
    return {"rows": [(r["doc_id"], r["text"]) for r in df.collect()], "hash": {r["t"]: r["h"] for r in df.select(body.alias("t"), F.xxhash64(body).alias("h")).distinct().collect()}}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sketch_in_whole_numbers():
    for t in ("", " \n", "One", "a b c d", "a b c d e f g A B C D E", LONG, "x" * 70000 + " y", "ſ K \U0001f600 é É a b c"):
        assert fingerprints.sketch(t).tolist() == sorted(plain_sketch(t))
        assert fingerprints.from_string(fingerprints.to_string(fingerprints.sketch(t))).tolist() == sorted(plain_sketch(t))
    assert fingerprints.sketch("One  two").tolist() == fingerprints.sketch("oNE\ttwo ").tolist()


def test_fingerprints_of_odd_rows(docs, none):
    assert fingerprint_rows(fingerprints.edited_fingerprints(docs)) == plain_fingerprints(as_table(docs))
    assert fingerprints.edited_fingerprints(none).count() == 0
    one = docs.where("doc_id = 9").limit(1)
    assert fingerprint_rows(fingerprints.edited_fingerprints(one)) == plain_fingerprints(as_table(one))


@pytest.mark.parametrize("hot_id", [7, None, 10**6, -5])
def test_fingerprints_of_a_key_that_fills_bins(spark, hot_id):
    """Two thirds of the rows share id and text, in many tasks; others share the id alone."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    table = [(hot_id, "the same words in every row of this id")] * 120 + [(hot_id, t) for t in texts[:20]] + [(i * 3, t) for i, t in enumerate(texts)]
    rng.shuffle(table)
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(7)
    assert fingerprint_rows(fingerprints.edited_fingerprints(df)) == plain_fingerprints(as_table(df))


def test_fingerprints_of_the_tables(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    assert fingerprint_rows(fingerprints.edited_fingerprints(df)) == plain_fingerprints(as_table(df))


def test_fingerprints_merge_and_contain(spark, docs):
    """The merged sketch equals the sketch of all shingles; a part of a text is contained in it, not the other way round."""
    marked = fingerprints.fingerprinted(docs)
    assert set(docs.columns) < set(marked.columns)
    whole = defaultdict(set)
    for r in got(docs):
        for h in fingerprints.shingle_hashes(r["text"] or "").tolist():
            whole[r["source"]].add(h)
    want = {s: {h for h in hs if h < (1 << 64) // 8} or {min(hs)} for s, hs in whole.items()}
    found = defaultdict(set)
    for r in got(fingerprints.merged(marked, "source")):
        found[r["by"]].add(int(r["hash"], 16))
    assert dict(found) == want
    piece = " ".join(LONG.split()[5000:5400])
    few = fingerprints.fingerprinted(spark.createDataFrame([(1, piece), (2, piece + " but " + "none of these words " * 9), (3, "quite other words than those of the long text")], "doc_id long, text string"))
    out = {r["doc_id"]: r["containment"] for r in got(fingerprints.contained(few, "doc_id", fingerprints.merged(marked, "source").where("by = 's1'")))}
    assert out[1] == 1 and 0.8 < out[2] < 1 and out[3] == 0
    a, b = fingerprints.sketch(LONG), fingerprints.sketch(piece)
    assert fingerprints.containment(a, b) == 1 and fingerprints.resemblance(a, b) < 0.05
    again = fingerprints.fingerprinted(marked)
    assert "_fingerprint" in again.columns and again.where("fingerprint <> _fingerprint").count() == 0


def test_containment_estimates():
    """The share of retained hashes is near the share of all shingles."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(5000)]
    for part in (0.2, 0.5, 0.9):
        a = [words[i] for i in rng.integers(0, 5000, 4000)]
        b = a[: int(4000 * part)] + [words[i] for i in rng.integers(0, 5000, 20000)]
        x, y = fingerprints.sketch(" ".join(a)), fingerprints.sketch(" ".join(b))
        assert abs(len(set(x.tolist()) & set(y.tolist())) / len(x) - part) < 0.08


# vector codes


def plain_codes(table, n_parts, n_entries, rounds=2):
    """By the contract, every part against every entry, in Python's whole numbers."""
    kept = [(i, label, [int(np.floor(256 * float(x))) for x in v]) for i, v, label in table if v and len(v) % n_parts == 0 and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    k = len(kept[0][2]) // n_parts
    parts = [[tuple(v[p * k : p * k + k]) for p in range(n_parts)] for _, _, v in kept]
    books = [[x[p] for x in parts[:n_entries]] for p in range(n_parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        of = [defaultdict(list) for _ in books]
        for x in parts:
            for p in range(n_parts):
                of[p][nearest(x[p], books[p])[1]].append(x[p])
        books = [[tuple(sum(c) // len(of[p][e]) for c in zip(*of[p][e], strict=True)) if of[p][e] else c for e, c in enumerate(b)] for p, b in enumerate(books)]
    found = [[nearest(x[p], books[p]) for p in range(n_parts)] for x in parts]
    by = Counter()
    for (_, label, _), f in zip(kept, found, strict=True):
        by[label] += sum(d for d, _ in f)
    h = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted((str(i), "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), by[label], h) for (i, label, _), f in zip(kept, found, strict=True))


VECTORS = "vec_id long, embedding array<float>, label int, v string, d string, code string"


def code_rows(df):
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got(df))


def odd_vectors(n, dim, spread):
    rng = np.random.default_rng(n + dim)
    table = [(int(i), [float(x) for x in (rng.integers(-spread, spread, dim) / 256).astype(np.float32)], [None, 1, 2][i % 3]) for i in rng.permutation(n)]
    nan, inf = float("nan"), float("inf")
    bad = [(1000, None, 1), (1001, [], None), (1002, [nan] * dim, 1), (1003, [inf] + [0.0] * (dim - 1), 1), (1004, [None] + [0.0] * (dim - 1), 1), (-9, [1.0], 2), (2000, [0.5] * (2 * dim), 1)]
    return [*table, *bad, table[0], table[0], (None, [0.25] * dim, None), (5000, [-0.0] * dim, 1), (5001, [1e-40] * dim, 1)]


@pytest.mark.parametrize(("n", "dim", "spread"), [(150, 16, 4), (90, 64, 300), (40, 32, 3), (3, 16, 100)])
def test_vector_codes(spark, n, dim, spread):
    table = odd_vectors(n, dim, spread)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in table], VECTORS).repartition(5)
    assert code_rows(vector_codes.vector_codes(df)) == plain_codes(table, 16, 64)
    assert code_rows(vector_codes.vector_codes(df, n_parts=4, n_entries=7, rounds=3)) == plain_codes(table, 4, 7, 3)


def test_vector_codes_of_huge_components(spark):
    df = spark.createDataFrame([(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [0.0] * 16, None)], "vec_id long, embedding array<float>, label int")
    out = {r["vec_id"]: r["error"] for r in got(vector_codes.vector_codes(df, n_entries=1, rounds=0))}
    assert out == {1: 0, 2: 16 * (2 * vector_codes.LIMIT) ** 2, 3: 16 * vector_codes.LIMIT**2}


def test_vector_codes_without_vectors(spark):
    for table in ([], [(1, None, 1), (2, [1.0], None)]):
        assert vector_codes.vector_codes(spark.createDataFrame(table, "vec_id long, embedding array<float>, label int")).count() == 0
    with pytest.raises(ValueError, match="256"):
        vector_codes.vector_codes(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), n_entries=257)


def test_pivots_prune_and_keep_ties():
    rng = np.random.default_rng(1)
    parts, entries = rng.integers(-200, 200, (3000, 4)), rng.integers(-200, 200, (64, 4))
    entries[40] = entries[3]
    parts[:500] = entries[rng.integers(0, 64, 500)]
    pivots = vector_codes.far_apart(entries, vector_codes.PIVOTS)
    index, best, evaluated = vector_codes.nearest(parts, entries, vector_codes.squared_to_pivots(parts, pivots), pivots)
    all_ = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert (index == all_.argmin(1)).all() and (best == all_.min(1)).all()
    assert evaluated < 0.25 * all_.size


def test_pivot_distances_are_computed_once(spark, sf):
    table, books, pivots, evaluated = vector_codes.trained(spark.read.parquet(f"{sf}/embeddings.parquet"))
    assert table.columns == ["vec_id", "label", "v", "d"] and len(evaluated) == 2
    assert all(e < 0.6 * table.count() * 16 * 64 for e in evaluated)
    r = table.first()
    assert r["d"][:4] == vector_codes.squared_to_pivots(np.array([r["v"][:4]]), pivots[0])[0].tolist()


# filter audit


def plain_audit(table, labels):
    """Every order walked document by document."""
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, t, _ in table:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = defaultdict(list)
    for i, t, s in table:
        t = t or ""
        w = WORD.findall(t)
        fails = {f for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), any(c in "#$%&*|" for c in t), i is not None and i > least[t]), strict=True) if x}
        docs[s or ""].append((i, fails))
    out = []
    for part, all_ in docs.items():
        lines, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = all_
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                kept = [d for d in left if f not in d[1]]
                redundant = sum(f in d[1] for d in all_) - len(gone)
                lines.append((part, "".join(order), k + 1, len(kept), len(gone), redundant, sum(d[1] == {f} for d in all_), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f))
                shapley[f] += len(gone)
                left = kept
        out += [(*x[:-1], shapley[x[-1]]) for x in lines]
    return sorted(out)


def audit_rows(df):
    return sorted(tuple(r[c] for c in "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()) for r in got(df))


LABELS = [(1, 1, 0), (1, 0, 1), (3, None, 1), (6, 1, 1), (9, 1, None), (77, 1, 1), (None, 1, 1), (5, 0, 0)]


def test_filter_orders_of_odd_rows(spark, docs, none):
    extra = [(100 + i, t, "s1", "x") for i, t in enumerate([" ".join(f"w{j}" for j in range(300)), "A " * 300, "a " * 250, "Price: $5 & more", LONG + " end", "x\x0by\x1cz " * 90, "é" * 99 + "ABC"])]
    more = spark.createDataFrame([(i, t, None, s, None, r, "") for i, t, s, r in extra], SCHEMA)
    all_ = docs.unionByName(more)
    labels = spark.createDataFrame([(*x, "s") for x in LABELS], "doc_id long, quality int, toxic int, part string")
    table = [(r["doc_id"], r["text"], r["source"]) for r in all_.collect()]
    assert audit_rows(filter_audit.filter_orders(all_, labels)) == plain_audit(table, LABELS)
    assert filter_audit.filter_orders(none, labels).count() == 0
    assert audit_rows(filter_audit.filter_orders(all_, labels.where("false"))) == plain_audit(table, [])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6])
def test_diagram_of_any_order(n):
    """After every swap the diagram stands for the same masks, and its all-pass path gives what counting gives."""
    rng = random.Random(n)
    counts = {m: (rng.randint(0, 4), rng.randint(0, 2), 0) for m in range(1 << n) if rng.random() < 0.8}
    d, seen = filter_audit.Diagram(counts, n, (0, 0, 0)), set()

    def check():
        seen.add(tuple(d.order))
        for path in range(1 << n):
            node, mask = d.root, 0
            for k, f in enumerate(d.order):
                side = path >> k & 1
                node = d.children(node)[side]
                mask |= side << f
            assert d.weight[node] == counts.get(mask, (0, 0, 0))
        before = 0
        for f, kept, gone in d.all_pass():
            assert gone[0] == sum(c[0] for m, c in counts.items() if not m & before and m >> f & 1)
            before |= 1 << f
            assert kept[0] == sum(c[0] for m, c in counts.items() if not m & before)

    check()
    for i in filter_audit.adjacent_swaps(n):
        d.swap(i)
        check()
    assert len(seen) == len(list(itertools.permutations(range(n))))


def test_diagram_shares_equal_nodes():
    d = filter_audit.Diagram({m: (1, 0, 0) for m in range(32)}, 5, (0, 0, 0))
    assert len(d.nodes) == 6  # one leaf, one node a level
