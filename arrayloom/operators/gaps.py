"""Runs of N, telomere calls and k-mer windows of sequences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrayloom.functions import seqfn

from . import tiles

N_RUN = re.compile("[Nn]+")
#: Letters of a piece of a sequence, and pieces that a task looks at together.
PIECE, PIECES_AT_ONCE = 1 << 20, 256
#: Sequences whose ends are counted at once.
ENDS_AT_ONCE = 256
#: Places of a tile that are cut out at once.
CHUNK = 256
#: Windows of a stretch that is counted by itself; letters that a task counts together.
SPAN, AT_ONCE = 16, 1 << 20


def n_runs(seqs: DataFrame, least_length: int = 0, piece: int = PIECE) -> DataFrame:
    """(seqid, start, end, length): runs of N, 0-based half-open, on sequences of at least least_length.

    Sequences are cut into pieces. A run's place can be had from built-in functions only as a total over the runs before
    it, which is quadratic in a sequence's runs, so a task searches its pieces in Python, each letter once. Runs that
    touch a cut are joined afterwards; sequences of one piece have none."""
    n, kind = F.length("seq"), dict(seqs.dtypes)["seqid"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, PIECES_AT_ONCE):
                b = whole.slice(a, PIECES_AT_ONCE)
                found = [(i, *m.span()) for i, s in enumerate(b.column("letters").to_pylist()) for m in N_RUN.finditer(s)]
                row, start, end = np.array(found, np.int64).reshape(-1, 3).T
                at, size = (b.column(c).to_numpy().astype(np.int64)[row] for c in ("at", "n"))
                cut = ((start == 0) & (at > 0)) | ((end == piece) & (at + piece < size))
                yield pa.RecordBatch.from_arrays([b.column("seqid").take(pa.array(row)), pa.array(at + start), pa.array(at + end), pa.array(cut)], ["seqid", "start", "end", "cut"])

    def runs(rows: DataFrame) -> DataFrame:
        parts = F.transform(F.sequence(F.lit(0), n - 1, F.lit(piece)), lambda i: F.struct(i.alias("at"), F.substring(F.col("seq"), i + 1, F.lit(piece)).alias("letters")))
        rows = rows.where(n > 0).select("seqid", n.alias("n"), F.explode(parts).alias("p")).select("seqid", "n", "p.at", "p.letters")
        return rows.mapInArrow(find, f"seqid {kind}, start long, end long, cut boolean")

    rows = seqs.where(n >= least_length)
    order = Window.partitionBy("seqid").orderBy("start")
    seams = runs(rows.where(n > piece)).where("cut").withColumn("new", F.when(F.lag("end").over(order) == F.col("start"), 0).otherwise(1))
    seams = seams.withColumn("run", F.sum("new").over(order)).groupBy("seqid", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    out = runs(rows).where("NOT cut").select("seqid", "start", "end").unionByName(seams.drop("run"))
    return out.withColumn("length", F.col("end") - F.col("start"))


def gap_summary(gaps: DataFrame, genome: DataFrame) -> DataFrame:
    """By size range, and in total: count, % of gaps, bp, % of the genome(one row, column genome), mean length."""
    n = F.col("length")
    label = F.when(n < 10, "<10").when(n < 100, "10-100").when(n < 1000, "100-1k").otherwise(">1k")
    by = gaps.rollup(label.alias("size_range")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bp"))
    share = lambda part, whole: F.round(100.0 * F.col(part) / whole, 3)
    everything = F.max("n").over(Window.partitionBy(F.lit(1)))  # of the total's row, among five rows at most
    return by.crossJoin(F.broadcast(genome)).select(
        F.coalesce("size_range", F.lit("total")).alias("size_range"), "n", share("n", everything).alias("pgaps"), "bp", share("bp", F.col("genome")).alias("pgenome"), F.round(F.col("bp") / F.col("n"), 3).alias("mean")
    )


def _end_counts(ends: list[str | None], motif: str) -> tuple[list[float], list[int]]:
    """Of each end: share of its places whose 4-mer stands in the doubled motif, and places where the motif stands with one
    mismatch at most. One pass over all ends at once for each letter of the motif, whatever their lengths."""
    k, m = min(4, len(motif)), len(motif)
    cycle = sorted({(motif * 2)[i : i + k] for i in range(2 * m - k + 1)})
    texts = [(e or "").upper().encode("ascii", "replace") for e in ends]
    # a zero behind each end keeps its places apart from the next one's
    b = np.frombuffer(b"".join(t + bytes(m) for t in texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    start = np.cumsum(size + m) - size - m
    at = {x: b == x for x in set(motif.encode())}
    places = max(0, len(b) - m)
    shifted = lambda x, j: at[x][j : j + places]
    covered = np.zeros(places, bool)
    for word in cycle:
        covered |= np.logical_and.reduce([shifted(x, j) for j, x in enumerate(word.encode())])
    wrong = np.zeros(places, np.uint8)
    for j, x in enumerate(motif.encode()):
        wrong += ~shifted(x, j)
    # places of an end at which a whole word still fits
    sums = lambda x: np.r_[0, np.cumsum(x)]
    count = lambda total, n: total[start + np.maximum(size - n + 1, 0)] - total[start]
    c, h = count(sums(covered), k), count(sums(wrong <= 1), m)
    return (c / np.maximum(size, 1)).tolist(), h.tolist()


def _ends_counted(rows: DataFrame, motif: str) -> DataFrame:
    """(seqid, left_share, left_hits, right_share, right_hits) of rows(seqid, left, right)."""
    back = motif.translate(str.maketrans("ACGT", "TGCA"))[::-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, ENDS_AT_ONCE):
                b = whole.slice(i, ENDS_AT_ONCE)
                found = [x for side, m in (("left", back), ("right", motif)) for x in _end_counts(b.column(side).to_pylist(), m)]
                yield pa.RecordBatch.from_arrays([b.column("seqid"), *(pa.array(x, t) for x, t in zip(found, (pa.float64(), pa.int32()) * 2, strict=True))], ["seqid", "left_share", "left_hits", "right_share", "right_hits"])

    kind = dict(rows.dtypes)["seqid"]
    return rows.mapInArrow(count, f"seqid {kind}, left_share double, left_hits int, right_share double, right_hits int")


def _called(ends: DataFrame, share: float, hits: int) -> DataFrame:
    call = lambda c, n: F.when(F.col(c) >= share, "PRESENT").when(F.col(n) >= hits, "PARTIAL").otherwise("ABSENT")
    ends = ends.withColumns({"left_call": call("left_share", "left_hits"), "right_call": call("right_share", "right_hits")})
    t2t = F.when((F.col("left_call") == "PRESENT") & (F.col("right_call") == "PRESENT"), "T2T").otherwise("INCOMPLETE")
    return ends.select("seqid", F.round("left_share", 4).alias("left_share"), "left_hits", "left_call", F.round("right_share", 4).alias("right_share"), "right_hits", "right_call", t2t.alias("status"))


def telomere_calls(seqs: DataFrame, motif: str = "TTAGGG", window: int = 10000, share: float = 0.15, hits: int = 10) -> DataFrame:
    """Per sequence: coverage and call (PRESENT, PARTIAL, ABSENT) of the left end (reverse complement of the motif) and
    of the right end, `window` letters each, and T2T if both are PRESENT. Only the ends leave the sequence."""
    body, n = F.col("seq"), F.length("seq")
    left, right = tiles.slice_of(body, F.lit(0), F.lit(window)), tiles.slice_of(body, F.greatest(n - window, F.lit(0)), F.lit(window))
    return _called(_ends_counted(seqs.select("seqid", left.alias("left"), right.alias("right")), motif), share, hits)


def telomere_calls_of_tiles(tiled: DataFrame, motif: str = "TTAGGG", window: int = 10000, share: float = 0.15, hits: int = 10, size: int = tiles.TILE) -> DataFrame:
    """telomere_calls of sequences that are tiles; a sequence without letters has no row."""
    n = F.col("length")
    spans = F.array(F.struct(F.lit("left").alias("side"), F.lit(0).cast("bigint").alias("start"), F.least(n, F.lit(window)).alias("end")), F.struct(F.lit("right").alias("side"), F.greatest(n - window, F.lit(0)).alias("start"), n.alias("end")))
    spans = tiled.where((F.col("tile") == 0) & (n > 0)).select("seqid", F.inline(spans))
    cut = tiles.cut_spans(spans, tiled, size)
    side = lambda x: F.max(F.when(F.col("side") == x, F.col("bases"))).alias(x)
    return _called(_ends_counted(cut.groupBy("seqid").agg(side("left"), side("right")), motif), share, hits)


def kmer_places(tiled: DataFrame, k: int) -> DataFrame:
    """(seqid, length, i, kmer): every place of sequences that are tiles, with the k letters from there on. Tiles reach k - 1
    letters into the next one (see tiles.overlapping); letters are taken out of pieces of CHUNK places."""
    m = F.length("bases") - (k - 1)
    chunks = F.transform(F.sequence(F.lit(0), m - 1, F.lit(CHUNK)), lambda j: F.struct((F.col("offset") + j).alias("at"), tiles.slice_of(F.col("bases"), j, F.lit(CHUNK + k - 1)).alias("piece")))
    rows = tiled.where(m > 0).select("seqid", "length", F.inline(chunks))
    each = F.transform(F.sequence(F.lit(0), F.length("piece") - k), lambda j: F.struct((F.col("at") + j).alias("i"), F.substring(F.col("piece"), j + 1, F.lit(k)).alias("kmer")))
    return rows.where(F.length("piece") >= k).select("seqid", "length", F.inline(each))


def kmer_profile(seqs: DataFrame, k: int = 17, window: int = 100000, step: int = 25000) -> DataFrame:
    """(seqid, start, end, unique_kmers): distinct k-mers that begin in each sliding window."""
    return kmer_profile_of_tiles(tiles.tiled(seqs), k, window, step)


def _words(text: str, k: int) -> tuple[np.ndarray, int]:
    """A number for the k letters from each place of a text on, equal for equal letters only, and a bound above them."""
    raw = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, code = np.unique(raw, return_inverse=True) if raw.itemsize > 1 else (np.flatnonzero(np.bincount(raw, minlength=256)), raw)
    if raw.itemsize == 1:
        rank = np.zeros(256, np.int64)
        rank[kinds] = np.arange(len(kinds))
        code = rank[raw]
    n, bound = max(0, len(code) - k + 1), 1
    word = np.zeros(n, np.int64)
    for j in range(k):
        if bound * len(kinds) >= 1 << 62:
            kept, word = np.unique(word, return_inverse=True)
            bound = len(kept)
        word, bound = word * len(kinds) + code[j : j + n], bound * len(kinds)
    return word, bound


def _place_before(word: np.ndarray, bound: int) -> np.ndarray:
    """The place before at which the same number stands, -1 without any."""
    n = len(word)
    if bound > 1 << 16 and bound * n < 1 << 63:
        sort = np.sort(word * n + np.arange(n))
        order, value = sort % n, sort // n
    else:
        order = np.argsort(word.astype(np.uint16) if bound <= 1 << 16 else word, kind="stable")
        value = word[order]
    before = np.full(n, -1, np.int64)
    same = np.flatnonzero(value[1:] == value[:-1])
    before[order[same + 1]] = order[same]
    return before


def _distinct_in_windows(texts: list[str], windows: list[int], k: int, window: int, step: int) -> np.ndarray:
    """Distinct k-mers that begin in each of the first windows[i] windows of texts[i], one text behind the other.

    A place counts in a window that holds it if the k-mer's place before it lies in front of the window. So it adds one to a
    range of windows, as a difference at either end."""
    size, n_windows = np.array([len(t) for t in texts], np.int64), np.array(windows, np.int64)
    start, slot = np.cumsum(size) - size, np.cumsum(n_windows + 1) - n_windows - 1
    word, bound = _words("".join(texts), k)
    fits = np.maximum(size - k + 1, 0)
    of = np.repeat(np.arange(len(size)), fits)
    i = np.arange(len(of)) - np.repeat(np.cumsum(fits) - fits, fits)
    # texts lie one behind the other, so a place before in another text means none in this one
    before = np.maximum(_place_before(word, bound)[start[of] + i] - start[of], -1)
    first = np.maximum(np.maximum(before, i - window) // step + 1, 0)
    behind = np.minimum(i // step + 1, n_windows[of])
    some = first < behind
    at, total = slot[of[some]], int((n_windows + 1).sum())
    steps = np.bincount(at + first[some], minlength=total) - np.bincount(at + behind[some], minlength=total)
    # the slot behind the last window of a text ends its sums at zero
    return np.delete(np.cumsum(steps), slot + n_windows)


def kmer_profile_of_tiles(tiled: DataFrame, k: int = 17, window: int = 100000, step: int = 25000) -> DataFrame:
    """kmer_profile of tiles, which may reach into the next one.

    Windows are dealt to stretches of a sequence by their starts. A stretch has all letters its windows reach, SPAN windows and
    one more, so it is counted by itself, and what is shuffled is letters, little more than the sequences hold, whatever the
    number of k-mers and of windows that hold them. A task counts stretches of AT_ONCE letters together."""
    span = -(-SPAN * window // step) * step
    need = span - step + window + k - 1
    n, at, s = F.length("bases"), F.col("offset"), F.col("stretch")
    first = F.greatest(F.floor((at - need) / span) + 1, F.lit(0))
    last = F.least(F.floor((at + n - 1) / span), F.floor((F.col("length") - k) / span))
    dealt = tiled.where((F.col("length") >= k) & (n > 0) & (first <= last)).select("seqid", "length", "offset", "bases", F.explode(F.sequence(first, last)).alias("stretch"))
    lo, hi = F.greatest(at, s * span), F.least(at + n, s * span + need)
    dealt = dealt.where(lo < hi).select("seqid", "stretch", "length", lo.alias("lo"), tiles.slice_of(F.col("bases"), lo - at, hi - lo).alias("piece"))
    names = ["seqid", "start", "end", "unique_kmers"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def counted() -> pa.RecordBatch:
            seqids, stretch, length, texts = zip(*held, strict=True)
            first, length = np.array(stretch, np.int64) * span, np.array(length, np.int64)
            windows = (np.minimum(first + span - step, length - k) - first) // step + 1
            unique = _distinct_in_windows(texts, windows.tolist(), k, window, step)
            of = np.repeat(np.arange(len(windows)), windows)
            start = first[of] + (np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)) * step
            end = np.minimum(start + window, length[of])
            return pa.RecordBatch.from_arrays([pa.array(seqids, kind).take(pa.array(of)), pa.array(start), pa.array(end), pa.array(unique)], names)

        letters, key, parts, behind, kind = 0, None, [], 0, None
        for b in batches:
            kind = b.schema.field("seqid").type
            for seqid, stretch, length, lo, piece in zip(*(b.column(c).to_pylist() for c in ("seqid", "stretch", "length", "lo", "piece")), strict=True):
                if key != (seqid, stretch, length):
                    if parts:
                        held.append((*key, "".join(parts)))
                        letters += len(held[-1][3])
                        if letters >= AT_ONCE:
                            yield counted()
                            held, letters = [], 0
                    key, parts, behind = (seqid, stretch, length), [], lo
                parts.append(piece[behind - lo :])  # what a tile reaches into the next one is there once more
                behind = max(behind, lo + len(piece))
        if parts:
            held.append((*key, "".join(parts)))
            yield counted()

    placed = dealt.repartition("seqid", "stretch").sortWithinPartitions("seqid", "stretch", "length", "lo")
    return placed.mapInArrow(count, f"seqid {dict(tiled.dtypes)['seqid']}, start long, end long, unique_kmers long")


def monomers(arrays: DataFrame) -> DataFrame:
    """(array_id, no, type, length, cut_sequence): arrays(array_id, seq, period) cut by period; a short last one is a tail."""
    n = F.length("seq")
    cut = F.transform(F.sequence(F.lit(0), n - 1, F.col("period")), lambda i: F.substring(F.col("seq"), i + 1, F.col("period")))
    out = arrays.where((n > 0) & (F.col("period") > 0)).select("array_id", "period", F.posexplode(cut).alias("no", "cut_sequence"))
    kind = F.when(F.length("cut_sequence") == F.col("period"), "monomer").otherwise("tail")
    return out.select("array_id", "no", kind.alias("type"), F.length("cut_sequence").alias("length"), "cut_sequence")


def monomer_summary(arrays: DataFrame) -> DataFrame:
    """Of each different array of arrays(array_id, seq, period) with a whole monomer: array_id, n and bp of its whole monomers, the
    first of them, and their lengths in order, as monomers() cuts them; arrays of one array_id and period differ by their letters.

    All whole monomers of an array are as long as its period, so nothing but the first one is cut, and neither monomers nor letters
    of arrays are shuffled: of an array its names, a hash and the first monomer are."""
    whole = arrays.where((F.col("period") > 0) & (F.length("seq") >= F.col("period")))
    n = F.floor(F.length("seq") / F.col("period")).cast("bigint")
    different = whole.select("array_id", F.col("period"), F.xxhash64("seq").alias("_letters"), n.alias("n"), F.substring(F.col("seq"), F.lit(1), F.col("period")).alias("first")).distinct()
    lengths = F.array_join(F.array_repeat(F.col("period").cast("string"), F.col("n").cast("int")), ",")
    return different.select("array_id", "n", (F.col("n") * F.col("period")).cast("bigint").alias("bp"), "first", lengths.alias("lengths"))


def kmer_frequencies(seqs: DataFrame, k: int = 5) -> DataFrame:
    """(seqid, kmer, tf): both strands counted, divided by twice the number of places; k-mers with other letters are left out."""
    at = seqs.withColumn("_n", F.length("seq") - k + 1).where("_n > 0").select("seqid", "_n", F.explode(seqfn.kmers(F.col("seq"), k)).alias("k"))
    both = at.select("seqid", "_n", F.explode(F.array("k", seqfn.revcomp(F.col("k")))).alias("kmer"))
    return both.groupBy("seqid", "kmer").agg((F.count(F.lit(1)) / (2 * F.first("_n"))).alias("tf"))


def canonical_frequencies(seqs: DataFrame, k: int = 5) -> DataFrame:
    """(seqid, kmer, tf): a k-mer and its reverse complement count as the lesser one, divided by the number of places."""
    at = seqs.withColumn("_n", F.length("seq") - k + 1).where("_n > 0").select("seqid", "_n", F.explode(seqfn.kmers(F.col("seq"), k)).alias("k"))
    return at.groupBy("seqid", F.least(F.col("k"), seqfn.revcomp(F.col("k"))).alias("kmer")).agg((F.count(F.lit(1)) / F.first("_n")).alias("tf"))
