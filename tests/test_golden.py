"""Hand-made lines against an L-shaped zone, and boundary cases."""

import pytest

from hazline.operators.overlay import intersect, split_at_zones
from hazline.session import Stage
from tests import brute
from tests.layers import assert_same, elements_df, engine_overlay, zones_df

L_SHAPE = {1: [[(-20, -20), (20, -20), (20, 0), (0, 0), (0, 20), (-20, 20), (-20, -20)]]}

# line, lengths of its pieces, those inside the closed zone
GOLDEN = {
    1: ([(-30, 10), (30, 10)], [10, 20, 30], [20]),
    2: ([(-30, -10), (30, -10)], [10, 40, 10], [40]),
    3: ([(10, -30), (10, 30)], [10, 20, 30], [20]),
    4: ([(-5, 25), (25, -5)], [7.071, 28.284, 7.071], []),
    5: ([(-15, -15), (-5, -5)], [14.142], [14.142]),
    6: ([(-30, -20), (30, -20)], [10, 40, 10], [40]),
    7: ([(-30, 20), (10, 20)], [10, 20, 10], [20]),
    8: ([(-30, -10), (0, -10), (30, -10)], [10, 40, 10], [40]),
    9: ([(-25, 35), (35, -25)], [21.213, 14.142, 14.142, 14.142, 21.213], [14.142, 14.142]),
    10: ([(100, 100), (110, 100)], [10], []),
}


@pytest.mark.parametrize("cell_size", [None, 3.0, 40.0])
def test_golden_lines(spark, cell_size):
    found = engine_overlay(spark, {k: v[0] for k, v in GOLDEN.items()}, L_SHAPE, cell_size)
    for eid, (_, lengths, inner) in GOLDEN.items():
        pieces = [found[k] for k in sorted(found) if k[0] == eid]
        assert [round(p[0], 3) for p in pieces] == lengths, eid
        assert [round(p[0], 3) for p in pieces if p[1]] == inner, eid


BOUNDARY_ZONES = {
    1: [
        [(0, 0), (40, 0), (40, 40), (0, 40), (0, 0)],
        [(10, 10), (30, 10), (30, 30), (10, 30), (10, 10)],
    ],
    2: [[(20, -10), (60, -10), (60, 20), (20, 20)]],  # overlaps zone 1, ring not closed
    3: [[(100, 0), (110, 0), (110, 10), (100, 10)], [(120, 0), (130, 0), (130, 10), (120, 10)]],
}
BOUNDARY_LINES = {
    1: [(-5, 20), (45, 20)],  # through a hole
    2: [(-5, 5), (70, 5)],  # two overlapping zones
    3: [(-10, 20), (0, 20)],  # ends on a boundary
    4: [(0, 20), (-10, 20)],  # starts on a boundary: no empty first piece
    5: [(-10, 5), (-10, 5), (0, 5), (0, 5), (5, 5)],  # repeated vertices, cut on a vertex
    6: [(95, 5), (140, 5)],  # zone of two parts
    7: [(0, 0), (40, 0), (40, 40)],  # along the boundary, around a corner
    8: [(10, 10), (10, 10)],  # no length: no piece
    9: [(10, 15), (30, 25)],  # inside the hole, from rim to rim
    10: [(15, 15), (20, 20)],  # inside the hole, up to a corner of zone 2
    11: [(20, 20), (20, -20)],  # along the side of zone 2 and through zone 1
}


@pytest.mark.parametrize("cell_size", [None, 7.0, 1000.0])
def test_boundary_cases(spark, cell_size):
    found = engine_overlay(spark, BOUNDARY_LINES, BOUNDARY_ZONES, cell_size)
    assert_same(found, brute.overlay(BOUNDARY_LINES, BOUNDARY_ZONES))
    assert min(n for e, n in found if e == 4) == 0
    assert not [e for e, _ in found if e == 8]


@pytest.mark.parametrize("frequency", [0.0, None])
def test_zone_without_events_cuts_but_gives_no_row(spark, frequency):
    stage = Stage(spark)
    lines, areas = elements_df(spark, {1: GOLDEN[1][0]}), zones_df(spark, L_SHAPE, frequency)
    split = split_at_zones(lines, areas, 1, stage)
    assert split.ear.count() == 3
    assert intersect(split, areas, stage).count() == 0


def test_null_and_short_geometry_give_no_piece(spark):
    found = engine_overlay(spark, {1: None, 2: [], 3: [(0, 0)], 4: [(0, 0), (1, 0)]}, L_SHAPE)
    assert set(found) == {(4, 0)}


def test_empty_layers(spark):
    assert engine_overlay(spark, {}, L_SHAPE) == {}
    assert_same(
        engine_overlay(spark, {1: [(0, 0), (1, 0)]}, {}),
        brute.overlay({1: [(0, 0), (1, 0)]}, {}),
    )
