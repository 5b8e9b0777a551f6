"""Coordinate tolerance: sevenths of whole numbers give the pieces of the whole numbers."""

import pytest
from pyspark.sql import functions as F

from hazline.operators.overlay import intersect, split_at_zones
from hazline.session import Stage
from hazline.sources import fixtures
from tests import brute
from tests.layers import assert_same, elements_df, engine_overlay, zones_df
from tests.test_random import random_layers


def scaled(points, by):
    return [(x / by, y / by) for x, y in points]


@pytest.mark.parametrize("seed,cell_size", [(1, None), (2, 0.7), (3, 10.0)])
def test_sevenths_give_the_same_pieces(spark, seed, cell_size):
    lines, zones = random_layers(seed)
    found = engine_overlay(
        spark,
        {k: scaled(v, 7) for k, v in lines.items()},
        {k: [scaled(ring, 7) for ring in rings] for k, rings in zones.items()},
        cell_size,
        tolerance=1e-9,
    )
    exact = brute.overlay(lines, zones)
    # an exact piece shorter than the tolerance would be merged; these layers have none
    assert min(length for length, _, _ in exact.values()) > 7e-6
    assert_same(found, {k: (n / 7, hit, scaled(v, 7)) for k, (n, hit, v) in exact.items()})


def pieces_of(spark, lines, zones, tolerance):
    stage = Stage(spark)
    areas = zones_df(spark, zones)
    split = split_at_zones(elements_df(spark, lines), areas, 1, stage, tolerance=tolerance)
    hits = {}
    for r in intersect(split, areas, stage).collect():
        hits.setdefault((r.element_id, r.piece_no), set()).add(r.hazardzone_feature_id)
    found = {}
    for r in split.ear.orderBy("element_id", "piece_no").collect():
        found.setdefault(r.element_id, []).append((round(r.element_size, 3), hits.get((r.element_id, r.piece_no), set())))
    return found


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]


def test_rules_of_the_tolerance(spark):
    zones = {1: [SQUARE], 2: [[(10.04, 0), (20, 0), (20, 10), (10.04, 10)]]}  # a gap of 0.04
    lines = {
        1: [(-5, 5), (25, 5)],  # both borders in the gap are one cut
        2: [(-5, 5), (0.05, 5), (5, 5)],  # a cut near a vertex moves onto it
        3: [(-5, 5), (-0.03, 5)],  # ends short of the border: no cut at an end, and no piece
        4: [(5, 10.05), (5, 12), (30, 12)],  # starts just outside
        5: [(-5, 0.02), (15, -0.02)],  # along the border
        6: [(0.02, -5), (0.02, 15)],  # along another, to corners
        7: [(-5, 9), (-0.05, 9), (0.02, 9), (0.09, 9), (5, 9)],  # vertices closer than the tolerance are one place
        8: [(5, 5), (5.01, 5)],  # shorter than the tolerance: stays whole
        9: [(9.98, 5), (10.03, 5), (10.05, 5)],  # so does one that crosses
        10: [(5, 5), (9.95, 5), (10.01, 5)],  # vertices near the end are the end
    }
    found = pieces_of(spark, lines, zones, 0.1)
    assert found[1] == [(5, set()), (10, {1}), (10, {2}), (5, set())]
    assert found[2] == [(5.05, set()), (4.95, {1})]
    assert found[3] == [(4.97, set())]
    assert found[4] == [(26.95, set())]
    assert [(round(n, 1), hit) for n, hit in found[5]] == [(5, set()), (10, {1}), (5, {2})]
    assert found[6] == [(5, set()), (10, {1}), (5, set())]
    assert found[7] == [(4.95, set()), (5.05, {1})]
    assert found[8] == [(0.01, {1})]
    assert [n for n, _ in found[9]] == [0.07] and [n for n, _ in found[10]] == [5.01]


def test_no_false_pieces_where_borders_are_shared(spark):
    zones = {1: [[(0, 0), (3, 0), (3, 3), (0, 3)]], 2: [[(3, 0), (6, 0), (6, 3), (3, 3)]]}
    lines = {i: [(0, 0.1 * i), (6, 0.05 * i + 1)] for i in range(25)}
    areas = fixtures.sevenths(elements_df(spark, lines), zones_df(spark, zones).withColumn(
        "geom", F.transform("geom", lambda r: F.concat(r, F.array(r[0]))))
    )[0]
    assert areas.count() == 25
    moved = {k: [[(x / 7 + 0.1, y / 7 + 0.1) for x, y in ring] for ring in rings] for k, rings in zones.items()}
    moved[3] = [[((x + 0.7) / 7, (y + 0.7) / 7) for x, y in zones[2][0]]]  # zone 2, rounded otherwise
    shifted = {k: [((x + 0.7) / 7, (y + 0.7) / 7) for x, y in line] for k, line in lines.items()}
    found = pieces_of(spark, shifted, moved, 1e-6)
    assert all(n > 1e-3 for each in found.values() for n, _ in each)
    assert all(hit != {2} and hit != {3} for each in found.values() for _, hit in each)


def test_zero_tolerance_is_exact(spark):
    zones = {1: [SQUARE], 2: [[(10.04, 0), (20, 0), (20, 10), (10.04, 10)]]}
    assert [n for n, _ in pieces_of(spark, {1: [(-5, 5), (25, 5)]}, zones, 0.0)[1]] == [5, 10, 0.04, 9.96, 5]
