"""Small layers from Python literals, and the engine's result in the shape of brute.overlay."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.operators.overlay import intersect, split_at_zones
from hazline.schema import ELEMENT_FIELDS, LINE, RINGS, ZONE_FIELDS
from hazline.session import Stage

ELEMENT = T.StructType(
    [
        T.StructField("element_id", T.LongType()),
        *[T.StructField(n, t) for n, t in ELEMENT_FIELDS.items()],
        T.StructField("geom", LINE),
    ]
)
ZONE = T.StructType(
    [
        T.StructField("zone_id", T.LongType()),
        *[T.StructField(n, t) for n, t in ZONE_FIELDS.items()],
        T.StructField("geom", RINGS),
    ]
)


def points(vertices):
    return None if vertices is None else [(float(x), float(y)) for x, y in vertices]


def elements_df(spark, elements, **attributes):
    row = {
        "elementtype_code": "EV",
        "route_code": "R1",
        "aadt_passenger": 100.0,
        "aadt_goods": 10.0,
        "diversion_time": 30.0,
        **attributes,
    }
    rows = [(eid, *row.values(), points(line)) for eid, line in elements.items()]
    return spark.createDataFrame(rows, ELEMENT)


def zones_df(spark, zones, frequency=100.0):
    rows = [
        (zid, 1, frequency, None, None, [points(ring) for ring in rings])
        for zid, rings in zones.items()
    ]
    return spark.createDataFrame(rows, ZONE)


def engine_overlay(spark, elements, zones, cell_size=None, **options):
    stage = Stage(spark)
    lines, areas = elements_df(spark, elements), zones_df(spark, zones)
    split = split_at_zones(lines, areas, 1, stage, cell_size, **options)
    rows = stage.put("rows", intersect(split, areas, stage))
    assert rows.count() == rows.select("element_id", "piece_no", "hazardzone_feature_id").distinct().count()
    hits = (
        rows.groupBy("element_feature_id")
        .agg(F.collect_set("hazardzone_feature_id").alias("zones"))
        .collect()
    )
    hit = {r[0]: set(r[1]) for r in hits}
    found = {}
    for r in split.ear.collect():
        assert r.element_feature_id == r.element_id * 2**20 + r.piece_no
        found[r.element_id, r.piece_no] = (
            r.element_size,
            hit.get(r.element_feature_id, set()),
            [(p.x, p.y) for p in r.geom],
        )
    return found


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for key, (length, zones, vertices) in expected.items():
        assert abs(found[key][0] - length) < 1e-6, key
        assert found[key][1] == zones, key
        assert len(found[key][2]) == len(vertices), (key, found[key][2], vertices)
        for (x, y), (ex, ey) in zip(found[key][2], vertices):
            assert abs(x - ex) < 1e-6 and abs(y - ey) < 1e-6, key
