"""Telomere repeats at the ends of sequences, inside them, and exact blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import merge_intervals

_COMPLEMENT = str.maketrans("ACGT", "TGCA")


def _letters(seq: str) -> np.ndarray:
    return np.frombuffer(seq.upper().encode("ascii", "replace"), np.uint8)


def near_motif(letters: np.ndarray, motif: str) -> np.ndarray:
    """Whether the motif stands at each place with one mismatch at most."""
    n = len(letters) - len(motif) + 1
    wrong = np.zeros(max(0, n), np.uint8)
    for j, b in enumerate(motif.encode()):
        wrong += letters[j : j + len(wrong)] != b
    return wrong <= 1


def terminal_run(letters: np.ndarray, motif: str) -> int:
    """Repeats one behind the other from the start, N before them skipped."""
    known = np.flatnonzero(letters != ord("N"))
    hits = near_motif(letters[known[0] :], motif)[:: len(motif)] if len(known) else np.zeros(0, bool)
    return int(np.argmin(np.append(hits, False)))


def interstitial(letters: np.ndarray, motif: str, skip: int, least: int) -> list[tuple[int, int, int]]:
    """(start, end, repeats) of runs of at least so many repeats of either strand, away from both ends. A run is read from
    its first hit in steps of the motif; the next one starts behind it."""
    skip = min(skip, len(letters) // 2)
    inner = letters[skip : len(letters) - skip]
    hit = near_motif(inner, motif) | near_motif(inner, motif.translate(_COMPLEMENT)[::-1])
    starts, out, at = np.flatnonzero(hit), [], 0
    while (k := np.searchsorted(starts, at)) < len(starts):
        first = at = int(starts[k])
        while at < len(hit) and hit[at]:
            at += len(motif)
        if (n := (at - first) // len(motif)) >= least:
            out.append((first + skip, at + skip, n))
    return out


def _per_sequence(seqs: DataFrame, rows, schema: str) -> DataFrame:
    """Rows that rows(letters) gives for every sequence, behind its name."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(k, *r) for k, s in zip(b.column("seqid").to_pylist(), b.column("seq").to_pylist(), strict=True) for r in rows(s or "")]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names)

    return seqs.select("seqid", "seq").mapInArrow(run, schema)


def terminal_repeats(seqs: DataFrame, motif: str = "TTAGGG") -> DataFrame:
    """(seqid, left, right): repeats at the start (reverse complement of the motif) and at the end, one mismatch each."""
    back = motif.translate(_COMPLEMENT)[::-1]

    def rows(seq: str) -> list[tuple[int, int]]:
        letters = _letters(seq)
        return [(terminal_run(letters, back), terminal_run(letters[::-1], motif[::-1]))]

    return _per_sequence(seqs, rows, "seqid string, left long, right long")


def interstitial_sites(seqs: DataFrame, motif: str = "TTAGGG", skip: int = 10000, least: int = 10) -> DataFrame:
    """(seqid, start, end, repeats) of telomere repeats inside sequences."""
    return _per_sequence(seqs, lambda seq: interstitial(_letters(seq), motif, skip, least), "seqid string, start long, end long, repeats long")


def exact_blocks(seqs: DataFrame, motif: str = "TTAGGG", repeats: int = 30, flank: int = 50) -> DataFrame:
    """(seqid, start, end, n): stretches of exact repeats of either strand, widened by flank, those that overlap merged."""
    words = [m * repeats for m in (motif.translate(_COMPLEMENT)[::-1], motif)]
    found = re.compile("|".join(words))

    def rows(seq: str) -> list[tuple[int, int]]:
        return [(max(0, m.start() - flank), min(len(seq), m.end() + flank)) for m in found.finditer(seq.upper())]

    return merge_intervals(_per_sequence(seqs, rows, "seqid string, start long, end long"), -1)


def telomere_summary(calls: DataFrame) -> DataFrame:
    """One row of calls(left_call, right_call, status): sequences, T2T, left and right ends present."""
    return calls.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "T2T").alias("t2t"),
        F.count_if(F.col("left_call") == "PRESENT").alias("left_present"), F.count_if(F.col("right_call") == "PRESENT").alias("right_present"),
    )
