"""Repeats in reach of gaps against all pairs, and what is shuffled to find them."""

import random

from arrayloom.operators import intervals


def _rows() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(31)
    places = [(rng.choice("abcd"), l, l + rng.choice([0, 1, 30, 900])) for l in [rng.randint(0, 3000) for _ in range(200)]]
    gaps = [(rng.choice("abc"), s, s + rng.choice([1, 40, 500])) for s in [rng.randint(-60, 3000) for _ in range(12)]] + [("a", -30, -5), ("b", -9, 0)]
    return [(f"r{i}", *p) for i, p in enumerate(places)], gaps


def _reached(row: tuple, gaps: list[tuple], reach: int) -> list[tuple]:
    _, seqid, l, r = row
    return [(s, e) for q, s, e in gaps if q == seqid and max(l - reach, 0) < e and s < r + reach]


def test_gaps_in_reach_by_all_pairs(spark):
    rows, gaps = _rows()
    a, g = spark.createDataFrame(rows, "trf_id string, seqid string, l_ind long, r_ind long"), spark.createDataFrame(gaps, 'seqid string, start long, end long')
    for reach in (1, 50):
        near = {r[0]: _reached(r, gaps, reach) for r in rows}
        got = intervals.gap_neighbours(a, g, reach).collect()
        assert {(r["trf_id"], r["start"], r["end"]) for r in got} == {(i, min(l, min(s for s, _ in near[i])), max(r, max(e for _, e in near[i]))) for i, _, l, r in rows if near[i]}
        free = {r["trf_id"] for r in intervals.without_gaps(a, g, reach).collect()}
        assert free == {i for i, q, _, _ in rows if q in {x for x, _, _ in gaps} and not near[i]}


def test_repeats_are_shuffled_twice_at_most(spark):
    """Once by bin and once by id; repeats are not put beside each gap's sequence, and pairs not grouped."""
    rows, gaps = _rows()
    a, g = spark.createDataFrame(rows, "trf_id string, seqid string, l_ind long, r_ind long"), spark.createDataFrame(gaps, 'seqid string, start long, end long')
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = intervals.without_gaps(a, g)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 4  # two sides of two joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
