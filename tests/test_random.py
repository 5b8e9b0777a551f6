"""Random whole-number layers against exact arithmetic, for several cell sizes and chunkings."""

import random

import pytest

from hazline.functions.geometry import edges
from hazline.operators import cuts, tessellate
from tests import brute
from tests.layers import assert_same, engine_overlay, zones_df


def random_layers(seed, n_lines=80, n_zones=15, span=60):
    rng = random.Random(seed)

    def place():
        return rng.randint(-span, span), rng.randint(-span, span)

    zones = {}
    for zid in range(n_zones):
        if rng.random() < 0.5:  # any polygon, also one that crosses itself
            zones[zid] = [[place() for _ in range(rng.randint(3, 8))]]
        else:  # rectangle with a hole, on round coordinates so that boundaries coincide
            x, y = rng.randrange(-60, 40, 10), rng.randrange(-60, 40, 10)
            w, h = rng.choice([10, 20, 40]), rng.choice([10, 20, 40])
            zones[zid] = [
                [(x, y), (x + w, y), (x + w, y + h), (x, y + h)],
                [(x + 2, y + 2), (x + w - 2, y + 2), (x + w - 2, y + h - 2), (x + 2, y + h - 2)],
            ]
    borders = [e for rings in zones.values() for e in brute.ring_edges(rings)]
    lines = {}
    for eid in range(n_lines):
        line = [place()]
        for _ in range(rng.randint(1, 6)):
            kind = rng.random()
            if kind < 0.3:
                line.append((line[-1][0], rng.randint(-span, span)))
            elif kind < 0.5:
                line.extend(rng.choice(borders))  # runs along a boundary
            else:
                line.append(place())
        lines[eid] = line
    return lines, zones


@pytest.mark.parametrize("seed,cell_size", [(1, None), (2, 4.7), (3, 10.0), (1, 200.0)])
def test_overlay_equals_exact_arithmetic(spark, seed, cell_size):
    lines, zones = random_layers(seed)
    assert_same(engine_overlay(spark, lines, zones, cell_size), brute.overlay(lines, zones))


@pytest.mark.parametrize("seed,chunk", [(4, 1), (5, 2), (6, 7)])
def test_long_elements_in_chunks(spark, seed, chunk):
    lines, zones = random_layers(seed)
    assert_same(engine_overlay(spark, lines, zones, 9.0, chunk_rows=chunk), brute.overlay(lines, zones))


def test_large_zone_with_inner_blocks_of_several_levels(spark):
    zones = {
        1: [[(0, 0), (500, 30), (480, 400), (250, 200), (20, 390)]],
        2: [[(100, 50), (400, 60), (380, 160)]],
    }
    lines = {
        i: [(7 * i - 50, -20), (5 * i + 30, 180), (450 - 3 * i, 420)] for i in range(80)
    }
    assert_same(engine_overlay(spark, lines, zones, 3.0), brute.overlay(lines, zones))


@pytest.mark.parametrize("listed", [4096, 2])
def test_dense_cells_are_refined(spark, monkeypatch, listed):
    monkeypatch.setattr(cuts, "DENSE_CELL", 3)
    monkeypatch.setattr(cuts, "MOST_DENSE", listed)
    lines, zones = random_layers(7)
    assert_same(engine_overlay(spark, lines, zones, 23.0), brute.overlay(lines, zones))


def test_zone_of_fine_detail_lies_on_a_finer_grid(spark):
    saw = [(x, 40 + 2 * (x % 2)) for x in range(0, 60)] + [(59, 20), (0, 20)]
    zones = {
        1: [[(-200, -150), (250, -180), (300, 200), (-180, 220)]],
        2: [saw],
        3: [[(30, 30), (31, 30), (31, 31), (30, 31)]],
    }
    grids = edges(zones_df(spark, zones)).selectExpr(f"{tessellate.fine_grid(100.0)} AS g")
    assert grids.distinct().count() == 3
    lines = {i: [(-20, 3 * i - 10), (25, 41), (80, 60 - 4 * i)] for i in range(25)}
    assert_same(engine_overlay(spark, lines, zones, 100.0), brute.overlay(lines, zones))
