"""Equal cuts meet in the task that found them."""

import random

import pytest

from hazline.functions.geometry import edges, segments
from hazline.operators import cuts as operator
from hazline.operators.cuts import boundaries, cut_points, merged_cuts
from tests.layers import elements_df, zones_df


def _layers(spark):
    """Lines through corners shared by many zones, along borders, and with vertices on them."""
    rng = random.Random(5)
    zones = {
        i: [[(x := 10 * (i % 8), y := 10 * (i // 8)), (x + 10, y), (x + 10, y + 10), (x, y + 10)]]
        for i in range(64)
    }
    lines = {1: [(0, 0), (80, 80)], 2: [(0, 30), (80, 30)], 3: [(5, 5), (10, 5), (20, 10), (75, 10)]}
    lines |= {10 + i: [(rng.randrange(81), rng.randrange(81)) for _ in range(6)] for i in range(40)}
    return segments(elements_df(spark, lines)), boundaries(edges(zones_df(spark, zones)))


@pytest.mark.parametrize("dense", [512, 3])
@pytest.mark.parametrize("size", [3.0, 10.0, 100.0])
def test_equal_cuts_are_merged_without_a_shuffle(spark, monkeypatch, size, dense):
    monkeypatch.setattr(operator, "DENSE_CELL", dense)
    seg, boundary = _layers(spark)
    found = cut_points(seg, boundary, size, cells=True)
    merged = merged_cuts(found)

    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert shuffles(merged) == shuffles(found)
    rows = [tuple(r) for r in merged.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == {(r.eid, r.sn, r.t) for r in cut_points(seg, boundary, 1000.0).collect()}


def test_tasks_follow_the_pairs_tried(spark, monkeypatch):
    seg, boundary = _layers(spark)
    expected = {(r.eid, r.sn, r.t) for r in cut_points(seg, boundary, 10.0).collect()}
    monkeypatch.setattr(operator, "TASK_PAIRS", 50)
    found = merged_cuts(cut_points(seg, boundary, 10.0, cells=True))
    assert found.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(expected) and set(rows) == expected
