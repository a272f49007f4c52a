"""Islands of overlapping repeats against settling them one sequence at a time, over batches and in any order of the rows."""

import random

from arrayloom.operators import overlaps

NAMES = "project string, trf_id string, trf_head string, trf_l_ind long, trf_r_ind long, trf_period int, trf_n_copy double, trf_pmatch double, trf_pvar double, trf_entropy double, trf_consensus string, trf_array string, trf_array_gc double, trf_consensus_gc double, trf_array_length long"


def _row(head: str, seq: str, l: int, r: int, period: int, match: float) -> tuple:
    return ("p", f"{head}_{l}_{r}", head, l, r, period, (r - l + 1) / period, match, 100 - match, 1.5, seq[l - 1 : l - 1 + period], seq[l - 1 : r], 0.5, 0.5, r - l + 1)


def test_islands_over_batches(spark):
    rng = random.Random(11)
    rows = []
    for head in ("a", "b", "c", "d"):
        seq = "".join(rng.choice("ACGT") for _ in range(3000))
        places = {(l := rng.randint(1, 2900), l + rng.choice([5, 20, 60, 90])) for _ in range(150)}
        rows += [_row(head, seq, l, r, rng.randint(1, 5), float(rng.randint(10, 90))) for l, r in places]
    rng.shuffle(rows)
    names = [n.split()[0] for n in NAMES.split(", ")]
    want = []
    for head in ("a", "b", "c", "d"):
        of = [dict(zip(names, r, strict=True)) for r in rows if r[2] == head]
        want += overlaps.settle(sorted(of, key=lambda r: (r["trf_l_ind"], r["trf_r_ind"], r["trf_id"])))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("1", "7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = overlaps.refine_overlaps(spark.createDataFrame(rows, NAMES)).collect()
            assert sorted((r["trf_id"], r["trf_r_ind"], r["trf_array"], r["trf_pmatch"]) for r in got) == sorted((r["trf_id"], r["trf_r_ind"], r["trf_array"], r["trf_pmatch"]) for r in want)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    """Repeats at one place with one id and equal matches: the same one stays, whichever comes first."""
    seq = "ACGTTGCAACGGTACCATGC" * 5
    rows = [_row("a", seq, 1, 60, period, 50.0) for period in (3, 7, 5)]
    kept = [[r["trf_period"] for r in overlaps.refine_overlaps(spark.createDataFrame(x, NAMES).coalesce(1)).collect()] for x in (rows, rows[::-1], rows[1:] + rows[:1])]
    assert kept == [[3], [3], [3]]
