"""Long lines in chunks of bounded size: lengths add up, wherever the chunks' borders lie."""

import pytest
from pyspark.sql import functions as F

from hazline.functions.geometry import edges, segments
from hazline.operators import pieces
from hazline.operators.cuts import boundaries, cut_points
from hazline.session import Stage
from tests import brute
from tests.layers import assert_same, elements_df, engine_overlay, zones_df


@pytest.mark.parametrize("chunk", [1, 3])
def test_piece_lengths_add_up_for_every_number_of_rows(spark, chunk):
    lines = {n: [(0, 10 * n), (n, 10 * n)] for n in range(2, 201)}
    zones = {1: [[(1, -5), (4, -5), (4, 2100), (1, 2100)]], 2: [[(20, -5), (49, -5), (49, 2100), (20, 2100)]]}
    assert_same(engine_overlay(spark, lines, zones, 1.0, chunk_rows=chunk), brute.overlay(lines, zones))


@pytest.mark.parametrize("cell_size,chunk", [(1.0, 5), (50.0, 100), (None, 65_536)])
def test_one_long_line_among_small_zones(spark, cell_size, chunk):
    lines = {1: [(0, 0), (3136, 0)], 2: [(0, 5), (1664, 5), (1664, 900)]}
    zones = {
        1: [[(64, -3), (128, -3), (128, 3), (64, 3)]],
        2: [[(1000, -3), (1010, -3), (1010, 8), (1000, 8)]],
    } | {
        10 + i: [[(9 * i, 300), (9 * i + 1, 300), (9 * i + 1, 301), (9 * i, 301)]] for i in range(60)
    }
    assert_same(engine_overlay(spark, lines, zones, cell_size, chunk_rows=chunk), brute.overlay(lines, zones))


def test_chunks_hold_a_bounded_number_of_rows(spark):
    """All cuts in one segment, next to a line of many segments."""
    lines = {1: [(0, 5), (4000, 5), (4000, 6)], 2: [(x, 20 + x % 2) for x in range(700)], 3: [(0, 30), (9, 30)]}
    zones = {i: [[(3 * i + 1, 0), (3 * i + 2, 0), (3 * i + 2, 10), (3 * i + 1, 10)]] for i in range(900)}
    stage = Stage(spark)
    seg, edge = segments(elements_df(spark, lines)), edges(zones_df(spark, zones))
    cuts = stage.put("cuts", cut_points(seg, boundaries(edge), 5.0))
    assert {r.eid for r in pieces.long_elements(seg, cuts, 50).collect()} == {1, 2}
    rows = pieces.chunked_rows(pieces._rows(seg, cuts), stage, 50).groupBy("eid", "chunk").count().collect()
    held = {(r.eid, r.chunk): r["count"] for r in rows}
    assert max(held.values()) == 50 and sum(n for (e, _), n in held.items() if e in (1, 2)) > 2500
    split = pieces.split_lines(seg, cuts, stage, chunk_rows=50)
    found = {r.eid: (r.n, r.length) for r in split.groupBy("eid").agg(F.count("*").alias("n"), F.sum("length").alias("length")).collect()}
    assert found[1][0] == 1801 and abs(found[1][1] - 4001) < 1e-6 and found[3] == (1, 9.0)
