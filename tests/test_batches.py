"""The overlay in batches: together they give the rows of the whole, and leave nothing on disk."""

import os
import random

import pytest
from pyspark.sql import functions as F

from checks import inputs
from checks.queries import QUERIES
from hazline.operators import batches as operator
from hazline.operators.batches import overlay_batches
from hazline.operators.overlay import intersect, split_at_zones
from hazline.operators.quality import PAIR_COLUMNS, load_report
from hazline.session import Stage, shuffles_dropped
from hazline.sources.fixtures import element_types, process_types
from tests.layers import elements_df, zones_df

# what a search adds up in another order may differ in the last digit
PIECE = ["element_id", "piece_no", "part_no", "route_code", "round(element_size, 6) AS size", "size(geom) AS n"]


def _layers(spark):
    """Lines over a plane, one heap of lines and zones, a line across all, ids that repeat far apart, rows without id or line."""
    rng = random.Random(3)

    def square(x, y, r):
        return [[(x, y), (x + r, y), (x + r, y + r), (x, y + r)]]

    def line(x, y):
        return [(x, y), (x + rng.randrange(1, 40), y + rng.randrange(-20, 20)), (x + 50, y + 3)]

    lines = {i: line(rng.randrange(1000), rng.randrange(100)) for i in range(60)}
    lines |= {100 + i: line(500 + i % 3, 40 + i % 5) for i in range(30)}
    lines |= {200: [(-50, 50), (1100, 51)], 201: None, 202: [(5, 5)], None: line(30, 40)}
    elements = elements_df(spark, lines).unionByName(
        elements_df(spark, {3: line(900, 50), 4: line(20, 50)}, route_code=None, diversion_time=5.0)
    )
    zones = {i: square(rng.randrange(1000), rng.randrange(100), rng.choice([5, 20, 60])) for i in range(60)}
    zones |= {100 + i: square(510, 30, 20 + i) for i in range(20)}
    areas = zones_df(spark, zones).unionByName(zones_df(spark, {None: square(20, 20, 60), 2: square(950, 20, 40)}))
    areas = areas.unionByName(zones_df(spark, {300: square(0, 0, 90), 2: square(10, 20, 40)}, 0.5))
    stage = Stage(spark)
    return stage.put("elements", elements), stage.put("zones", areas.unionByName(zones_df(spark, {301: square(0, 40, 20)}, 0.0)))


def _rows(tables):
    return sorted(str(tuple(r)) for table in tables for r in table.collect())


@pytest.fixture(scope="module")
def data(spark):
    elements, zones = _layers(spark)
    stage = Stage(spark)
    split = split_at_zones(elements, zones, 1, stage)
    return elements, zones, split, stage.put("rows", intersect(split, zones, stage))


@pytest.mark.parametrize("limit,least", [(10**9, 1), (1300, 7)])
def test_batches_add_up_to_the_whole(spark, data, monkeypatch, limit, least):
    elements, zones, split, rows = data
    monkeypatch.setattr(operator, "BATCH_PAIRS", limit)
    pieces, pairs, folders = [], [], []
    with Stage(spark) as stage:
        for part, found in overlay_batches(elements, zones, 1, stage):
            folders.append(part.pieces.inputFiles()[0])
            pieces += _rows([part.ear.selectExpr(*PIECE)])
            pairs += _rows([found.withColumn("element_size", F.round("element_size", 6))])
            left = [f for f in folders if os.path.exists(f.removeprefix("file://"))]
            assert left == folders[-1:]
    assert len(folders) >= least
    assert sorted(pieces) == _rows([split.ear.selectExpr(*PIECE)])
    assert sorted(pairs) == _rows([rows.withColumn("element_size", F.round("element_size", 6))]) != []


def test_columns_that_are_not_read_are_not_searched(spark, data):
    _, zones, split, rows = data
    few = intersect(split, zones, Stage(spark), columns=PAIR_COLUMNS)
    assert set(few.columns) == set(PAIR_COLUMNS)
    assert _rows([few]) == _rows([rows.select(*few.columns)])
    assert "aadt_goods" not in few._jdf.queryExecution().executedPlan().toString()


def test_the_load_report_stores_no_intersections(spark, data, monkeypatch):
    elements, zones, split, rows = data
    folder = f"own rows of {__name__}"
    monkeypatch.setitem(inputs._LAYERS, inputs._key(spark, folder), inputs.Layers(elements, zones, "", ""))
    monkeypatch.setattr(operator, "BATCH_PAIRS", 2500)
    written, real = [], Stage.write
    monkeypatch.setattr(Stage, "write", lambda stage, name, df: written.append(name) or real(stage, name, df))
    report = _rows([QUERIES["load_report"](spark, folder)])
    assert written.count("pieces") >= 3 and "intersections" not in written
    assert report == _rows([load_report(split.ear, rows, element_types(spark), process_types(spark))])
    status = QUERIES["load_status"](spark, folder).first()
    assert (status.max_severity, status.success) == (0, True)


def test_shuffles_are_dropped_at_the_end_of_a_query(spark):
    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(blocks.apply(i).getName().startswith("shuffle_") for i in range(blocks.size()))

    before = files()
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(name, None)
    with shuffles_dropped(spark):
        Stage(spark).put("rows", spark.range(1000).groupBy(F.expr("id % 10")).count())
        assert files() <= before
    assert spark.conf.get(name, None) == setting


def _written(spark, data, monkeypatch, folder):
    """Own rows as a data folder, and the names and columns of the tables that queries over it store."""
    elements, zones, *_ = data
    monkeypatch.setitem(inputs._LAYERS, inputs._key(spark, folder), inputs.Layers(elements, zones, "", ""))
    written, real = [], Stage.write
    monkeypatch.setattr(Stage, "write", lambda stage, name, df: written.append((name, df.columns)) or real(stage, name, df))
    return written


def test_what_is_only_counted_has_no_geometry(spark, data, monkeypatch):
    folder = f"counted rows of {__name__}"
    written = _written(spark, data, monkeypatch, folder)
    assert QUERIES["load_report"](spark, folder).count() == 8
    pieces = [columns for name, columns in written if name == "pieces"]
    assert pieces and not any("geom" in columns for columns in pieces)


@pytest.mark.parametrize("name", ["ear_pieces", "ear_geometry", "split_at_elements"])
def test_pieces_that_are_read_once_are_not_stored(spark, data, monkeypatch, name):
    folder = f"{name} of {__name__}"
    written = _written(spark, data, monkeypatch, folder)
    pieces = QUERIES[name](spark, folder)
    assert pieces.count() >= data[2].ear.count()
    assert "pieces" not in [each for each, _ in written] and "cuts" in [each for each, _ in written]
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert ("collect_list" in plan) == (name == "ear_geometry")
    if name == "ear_pieces":
        own = ["element_id", "piece_no", "route_code", "round(element_size, 3) AS size"]
        assert _rows([pieces.selectExpr(*own)]) == _rows([data[2].ear.selectExpr(*own)])


def test_ear_output_replace_stores_pieces_in_the_store_only(spark, data, monkeypatch):
    folder = f"ear rows of {__name__}"
    written = _written(spark, data, monkeypatch, folder)
    ear = QUERIES["ear_output_replace"](spark, folder)
    assert "pieces" not in [name for name, _ in written]
    own = ["study_id", "element_id", "piece_no", "route_code", "round(element_size, 3) AS size"]
    once = data[2].ear.selectExpr(*own)
    assert _rows([ear.selectExpr(*own)]) == _rows([once, once.withColumn("study_id", F.lit(2))])


def test_piece_lengths_are_added_up_as_pieces_are_cut(spark, data, monkeypatch):
    folder = f"lengths of {__name__}"
    written = _written(spark, data, monkeypatch, folder)
    assert QUERIES["piece_length"](spark, folder).count() > 0
    assert "pieces" not in [name for name, _ in written]


def test_steps_of_the_overlay_drop_their_shuffles(spark, data):
    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(blocks.apply(i).getName().startswith("shuffle_") for i in range(blocks.size()))

    elements, zones, *_ = data
    before = files()
    intersect(split_at_zones(elements, zones, 1, Stage(spark)), zones, Stage(spark))
    assert files() <= before
