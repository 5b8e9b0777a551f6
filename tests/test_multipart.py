"""Lines of several parts, and element ids of any size."""

from pyspark.sql import types as T

from hazline.operators import quality
from hazline.operators.extent import overlap_of_extents
from hazline.operators.overlay import intersect, split_at_zones
from hazline.operators.risk import element_layer, element_summary
from hazline.schema import RINGS
from hazline.session import Stage
from hazline.sources import fixtures
from tests import brute
from tests.layers import ELEMENT, points, zones_df
from tests.test_random import random_layers

MULTI = T.StructType([*ELEMENT.fields[:-1], T.StructField("geom", RINGS)])


def multipart_df(spark, elements):
    rows = [
        (eid, "EV", f"R{eid}", 100.0, 10.0, 30.0, None if parts is None else [points(p) for p in parts])
        for eid, parts in elements.items()
    ]
    return spark.createDataFrame(rows, MULTI)


def test_parts_are_split_each_on_its_own(spark):
    lines, zones = random_layers(9)
    lines = list(lines.values())
    ids = [2**50 + 3, -1, 2**62, 0, -(2**62), 7]
    elements = {eid: lines[5 * i : 5 * i + 5] for i, eid in enumerate(ids)}
    stage, areas = Stage(spark), zones_df(spark, zones)
    split = split_at_zones(multipart_df(spark, elements), areas, 1, stage)
    hits = {}
    for r in intersect(split, areas, stage).collect():
        hits.setdefault((r.element_id, r.piece_no), set()).add(r.hazardzone_feature_id)
    found = {(r.element_id, r.piece_no): r for r in split.ear.collect()}
    want = {}
    for eid, parts in elements.items():
        number = 0
        for part, line in enumerate(parts):
            for _, (length, inside, vertices) in sorted(brute.overlay({0: line}, zones).items()):
                want[eid, number] = part, length, inside, vertices
                number += 1
    assert found.keys() == want.keys()
    for key, (part, length, inside, vertices) in want.items():
        row = found[key]
        assert row.part_no == part and abs(row.element_size - length) < 1e-6
        assert hits.get(key, set()) == inside and len(row.geom) == len(vertices)
        short = -(2**43) <= key[0] < 2**43
        assert row.element_feature_id == (key[0] * 2**20 + key[1] if short else None)
    # the layer is joined by (element_id, piece_no)
    types = fixtures.element_types(spark), fixtures.process_types(spark)
    rows = intersect(split, areas, stage)
    layer = element_layer(split.ear, element_summary(rows, *types)).collect()
    assert {(r.element_id, r.piece_no): r.n_zones or 0 for r in layer} == {k: len(w[2]) for k, w in want.items()}


def test_empty_and_missing_parts(spark):
    elements = {1: None, 2: [], 3: [[], [(0, 0)]], 4: [None, [(0, 0), (4, 0)], [(1, 1), (1, 1)], [(9, 0), (9, 4), (9, 4)]]}
    lines, zones = multipart_df(spark, elements), zones_df(spark, {1: [[(2, -1), (20, -1), (20, 1), (2, 1)]]})
    found = split_at_zones(lines, zones, 1, Stage(spark)).ear.orderBy("piece_no").collect()
    assert [(r.element_id, r.piece_no, r.part_no, r.element_size) for r in found] == [
        (4, 0, 0, 2.0), (4, 1, 0, 2.0), (4, 2, 2, 1.0), (4, 3, 2, 3.0)
    ]
    quality.require_layers(lines, zones)
    counts = {r.layer: r for r in quality.validation_counts(lines, zones).collect()}
    assert (counts["elements"].n_null_geometry, counts["elements"].n_too_short) == (1, 2)
    report = quality.input_report(lines, zones, fixtures.element_types(spark), fixtures.process_types(spark))
    assert {r.check_name: r.n_rows for r in report.collect()}["elements_without_line"] == 3
    kept, _ = overlap_of_extents(lines, zones)
    assert [r.element_id for r in kept.collect()] == [4]
