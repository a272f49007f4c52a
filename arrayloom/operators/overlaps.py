"""Refinement of overlapping repeats: duplicates, nesting, and merging of similar neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bases as two bits in either case, other bytes -1; 5-mers as numbers and the numbers of their reverse complements.
_CODE = np.full(256, -1, np.int64)
_CODE[list(b"ACGT")] = _CODE[list(b"acgt")] = range(4)
_WORDS = np.arange(4**5)
_BACK = sum((3 - _WORDS // 4**i % 4) * 4 ** (4 - i) for i in range(5))


@lru_cache(maxsize=4096)
def _vector(array: str) -> tuple[np.ndarray, int]:
    """Counts of 5-mers of both strands and the sum of their squares; words with other letters are left out."""
    code = _CODE[np.frombuffer(array.encode("utf-8", "replace"), np.uint8)]
    if len(code) < 5:
        return np.zeros(4**5, np.int64), 0
    words = np.lib.stride_tricks.sliding_window_view(code, 5)
    counts = np.bincount((words @ 4 ** np.arange(4, -1, -1))[words.min(axis=1) >= 0], minlength=4**5)
    counts = counts + counts[_BACK]
    return counts, int(counts @ counts)


def distance(a: str, b: str) -> float:
    """100 x (1 - cosine) of the 5-mer vectors; 100 where one is empty."""
    (x, xx), (y, yy) = _vector(a), _vector(b)
    norm = (xx * yy) ** 0.5
    return 100 * (1 - int(x @ y) / norm) if norm else 100.0


def _gc(s: str) -> float:
    return sum(map(s.upper().count, "GC")) / len(s) if s else 0.0


def merged(a: dict, b: dict) -> dict:
    """Two overlapping repeats, a to the left, as one: match weighted by length, arrays spliced; period, consensus and
    entropy of the one with the better score, b if they tie; everything that follows from these anew."""
    la, lb = a["trf_array_length"], b["trf_array_length"]
    array = a["trf_array"] + b["trf_array"][a["trf_r_ind"] - b["trf_l_ind"] + 1 :]
    if len(array) != b["trf_r_ind"] - a["trf_l_ind"] + 1:
        raise ValueError(f"repeats {a['trf_id']} and {b['trf_id']}: arrays do not fit their places")
    unit = a if (a.get("trf_score") or 0) > (b.get("trf_score") or 0) else b
    match = (a["trf_pmatch"] * la + b["trf_pmatch"] * lb) / (la + lb)
    out = a | {k: unit[k] for k in ("trf_period", "trf_consensus", "trf_entropy")}
    return out | {
        "trf_r_ind": b["trf_r_ind"], "trf_array": array, "trf_array_length": len(array), "trf_pmatch": match, "trf_pvar": 100 - match, "trf_joined": 1,
        "trf_n_copy": len(array) / unit["trf_period"], "trf_array_gc": _gc(array), "trf_consensus_gc": _gc(unit["trf_consensus"] or ""),
    }


def _survivors(left: list[int], right: list[int], match: list[float], row: Callable[[int], dict], cutoff: float, share: float) -> list[tuple[int, dict | None]]:
    """(place, merged row or None) of what stays of repeats sorted by place; row(i) is asked only of repeats that merge or are
    compared by their letters. Repeats that went are taken out of the chain, so later turns do not pass them again."""
    n = len(left)
    follows, out, i = list(range(1, n + 1)), [], 0
    while i < n:
        start, end, best, one, stays = left[i], right[i], match[i], None, True
        last, j = i, follows[i]
        while j < n and left[j] <= end:
            starts, ends, goes = left[j] - start, right[j] - end, False
            if ends <= 0 and not (starts == 0 and ends == 0 and match[j] > best):
                goes = True  # within one, or no better at the same place
            elif starts == 0:
                stays = False  # two holds one, or is better at the same place
            elif (common := end - left[j]) > 0:
                if common / (starts + ends + common) > share or distance((one or row(i))["trf_array"], row(j)["trf_array"]) < cutoff:
                    one, goes = merged(one or row(i), row(j)), True
                    end, best = right[j], one["trf_pmatch"]
            if goes:
                follows[last] = follows[j]
            else:
                last = j
            j = follows[j]
        if stays:
            out.append((i, one))
        i = follows[i]
    return out


def settle(rows: list[dict], cutoff: float = 0.1, share: float = 0.2) -> list[dict]:
    """What stays of repeats sorted by place. Of equal places the better match, the earlier if they tie; a repeat inside
    another goes; of two that overlap in part, similar ones or ones that share enough become one. A repeat that has gone
    is still compared with those after it in its turn."""
    of = lambda c: [r[c] for r in rows]
    return [one or rows[i] for i, one in _survivors(of("trf_l_ind"), of("trf_r_ind"), of("trf_pmatch"), rows.__getitem__, cutoff, share)]


def _settled(rows: pa.Table, cutoff: float, share: float) -> Iterator[pa.RecordBatch]:
    """settle of one island's rows, which become objects only where that is asked for."""
    rows = rows.combine_chunks()
    held: dict[int, dict] = {}

    def row(i: int) -> dict:
        if i not in held:
            if len(held) > 4096:
                held.clear()
            held[i] = rows.slice(i, 1).to_pylist()[0]
        return held[i]

    found = _survivors(*(rows.column(c).to_pylist() for c in ("trf_l_ind", "trf_r_ind", "trf_pmatch")), row, cutoff, share)
    yield from rows.take(pa.array([i for i, one in found if one is None], pa.int64())).to_batches()
    if changed := [one for _, one in found if one is not None]:
        yield pa.RecordBatch.from_pylist(changed, rows.schema)


def refine_overlaps(sat: DataFrame, cutoff: float = 0.1, share: float = 0.2) -> DataFrame:
    """The repeat table without duplicates and nested repeats, similar overlapping ones merged.

    Repeats of a sequence fall into islands where one starts behind the end of all before it; islands never interact, so
    each is settled on its own, as they come in order of their place: a task holds one island. Ties in place are in order of
    trf_id, period and array, so reruns agree."""
    if "trf_joined" not in sat.columns:
        sat = sat.withColumn("trf_joined", F.lit(0))

    def islands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        head, reach = None, 0
        for b in (b for b in batches if b.num_rows):
            names = b.column("trf_head").dictionary_encode()
            code, left, right = names.indices.fill_null(-1).to_numpy(zero_copy_only=False), b.column("trf_l_ind").to_numpy(), b.column("trf_r_ind").to_numpy()
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            before = np.empty(len(code), np.int64)
            opens = np.zeros(len(code), bool)
            for a, z in zip(first.tolist(), [*first[1:].tolist(), len(code)], strict=True):
                name = b.column("trf_head")[a].as_py()
                goes_on = bool(held) and name == head
                upto = np.maximum.accumulate(np.append(reach if goes_on else left[a] - 1, right[a:z]))
                before[a:z] = upto[:-1]
                opens[a:z] = left[a:z] > before[a:z]
                opens[a] |= not goes_on
                head, reach = name, int(upto[-1])
            at = [*np.flatnonzero(opens).tolist(), len(code)]
            if at[0] and held:
                held.append(b.slice(0, at[0]))
            # a repeat alone needs no settling; whether the last one is alone is not known yet
            alone = [a for a, z in zip(at[:-1], at[1:], strict=True) if z == a + 1 and z < len(code)]
            if alone:
                yield b.take(pa.array(alone))
            for a, z in zip(at[:-1], at[1:], strict=True):
                if held:
                    yield from _settled(pa.Table.from_batches(held), cutoff, share)
                    held = []
                if z == len(code):
                    held = [b.slice(a)]
                elif z > a + 1:
                    yield from _settled(pa.Table.from_batches([b.slice(a, z - a)]), cutoff, share)
        if held:
            yield from _settled(pa.Table.from_batches(held), cutoff, share)

    placed = sat.repartition("trf_head").sortWithinPartitions("trf_head", "trf_l_ind", "trf_r_ind", "trf_id", "trf_period", "trf_array")
    return placed.mapInArrow(islands, sat.schema)
