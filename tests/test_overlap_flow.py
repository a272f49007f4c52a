"""The flow between components of overlaps and of containment joins the overlaps once."""

from arrayloom.operators import similarity
from arrayloom.plans import joins


def test_overlaps_are_joined_once(spark, sf, monkeypatch):
    asked, components = [], similarity.connected_components
    monkeypatch.setattr(similarity, "connected_components", lambda edges: (asked.append(edges), components(edges))[1])
    flow = joins.overlap_flow(spark, sf)
    assert len(asked) == 2
    for edges in asked:
        assert "Join" not in edges._jdf.queryExecution().optimizedPlan().toString()
    loose, tight = ({r["id"]: r["comp"] for r in components(e).collect()} for e in asked)
    want: dict = {}
    for i, c in loose.items():
        want[c, tight.get(i, "SING")] = want.get((c, tight.get(i, "SING")), 0) + 1
    assert {(r["source"], r["target"]): r["value"] for r in flow.collect()} == want
