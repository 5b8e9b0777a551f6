"""What is shuffled on the way to the pieces."""

import pytest

from checks import inputs, queries
from hazline.functions.geometry import edges, segments
from hazline.operators.cuts import boundaries, cut_points
from hazline.operators.overlay import split_at_zones
from hazline.operators.pieces import split_lines
from hazline.session import Stage
from tests.layers import elements_df, zones_df

LINES = {1: [(0, 5), (40, 5), (40, 50)], 2: [(0, 30), (9, 30)], 3: [(3, 3), (33, 3), (33, 33)]}
ZONES = {i: [[(4 * i + 1, 0), (4 * i + 2, 0), (4 * i + 2, 40), (4 * i + 1, 40)]] for i in range(9)}


def _left_side(plan: list[str], at: int) -> str:
    """The first shuffle or grouping below a join on its left side."""
    return next(line for line in plan[at + 1 :] if "Exchange" in line or "Aggregate" in line)


def test_pieces_are_joined_to_attributes_where_they_lie(spark):
    former = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = []

    def save(pieces):
        plans.append(pieces._jdf.queryExecution().executedPlan().toString())
        return pieces

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split_at_zones(elements_df(spark, LINES), zones_df(spark, ZONES), 1, Stage(spark), save=save)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", former)
    plan = plans[0].splitlines()
    joins = [i for i, line in enumerate(plan) if "SortMergeJoin [eid" in line and "Inner" in line]
    assert any("Aggregate" in _left_side(plan, i) for i in joins)


@pytest.mark.parametrize("chunk", [2, 65_536])
def test_cuts_need_not_bring_their_segment(spark, chunk):
    """Lengths and vertices are the same, in one group or in chunks of a few rows."""
    stage = Stage(spark)
    seg, edge = segments(elements_df(spark, LINES)), edges(zones_df(spark, ZONES))
    cuts = cut_points(seg, boundaries(edge), 10.0)
    rows = split_lines(seg, cuts, stage, chunk_rows=chunk).orderBy("eid", "piece_no").collect()
    length = {1: 85.0, 2: 9.0, 3: 60.0}
    for eid, total in length.items():
        own = [r for r in rows if r.eid == eid]
        assert abs(sum(r.length for r in own) - total) < 1e-9
        assert all(a.geom[-1] == b.geom[0] for a, b in zip(own, own[1:]))


def test_replaced_output_needs_no_intersections(spark, monkeypatch):
    """ear_output_replace reads the pieces only."""

    def refuse(*_):
        raise AssertionError("intersections computed")

    monkeypatch.setattr(inputs, "intersect", refuse)
    for cache in (inputs._SPLITS, inputs._OVERLAYS):
        cache.clear()
    rows = queries.QUERIES["ear_output_replace"](spark, "/root/testdata/sf0.001")
    assert rows.select("study_id").distinct().count() == 2
