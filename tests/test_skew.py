"""Hot keys: a third of all elements in one place, and one element that crosses most zones."""

import random

from hazline.functions.geometry import edges, explode_cells, segments
from hazline.operators.cuts import boundaries, cut_points, dense_cells
from tests import brute
from tests.layers import assert_same, elements_df, engine_overlay, zones_df


def hot_layers():
    rng = random.Random(11)

    def square(x, y, r):
        return [[(x, y), (x + r, y), (x + r, y + r), (x, y + r)]]

    zones = {i: square(rng.randrange(0, 400, 3), rng.randrange(0, 400, 3), 12) for i in range(40)}
    zones |= {100 + i: square(200, 200, 10) for i in range(20)}  # copies of one zone
    lines = {
        i: [(x := rng.randrange(400), y := rng.randrange(400)), (x + 9, y + 4)] for i in range(60)
    }
    lines |= {100 + i: [(195, 203), (215, 207)] for i in range(30)}  # copies of one line
    lines[500] = [(x, (x * 7) % 400) for x in range(0, 400, 5)]  # crosses most zones
    return lines, zones


def test_hot_place_and_hot_element(spark):
    lines, zones = hot_layers()
    assert_same(engine_overlay(spark, lines, zones), brute.overlay(lines, zones))


def test_copies_of_a_zone_are_one_boundary(spark):
    _, zones = hot_layers()
    edge = edges(zones_df(spark, zones))
    assert boundaries(edge).count() < edge.count() - 4 * 18


def test_cells_of_usual_size_are_not_refined(spark):
    _, zones = hot_layers()
    cells = explode_cells(edges(zones_df(spark, zones)), 5.0)
    assert dense_cells(cells) is None  # below the absolute limit


def test_skewed_join_is_split(spark):
    """Adaptive execution splits the hot cell of the cell join; thresholds fit the small data."""
    lines, zones = hot_layers()
    copies = {k * 1000 + i: v for i, v in lines.items() for k in range(1, 6)}
    copies |= {10**6 + i: [(195, 203), (215, 207)] for i in range(3000)}
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    former = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        seg = segments(elements_df(spark, copies).repartition(16))
        cuts = cut_points(seg, boundaries(edges(zones_df(spark, zones))), 12.0).distinct()
        rows = cuts.collect()
        plan = cuts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in former.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    hot = {(r.eid, r.sn, r.t) for r in rows if r.eid >= 10**6}
    assert len(hot) == 3000 * len({(sn, t) for _, sn, t in hot})
