"""Elements given by a row per part."""

from pyspark.sql import functions as F

from checks import queries
from hazline.functions.geometry import segments, segments_of_parts
from hazline.schema import LINE
from hazline.session import Stage
from hazline.sources import fixtures


def test_rows_of_parts_give_the_segments_of_whole_lines(spark):
    def line(*xs):
        return [(float(x), 0.0) for x in xs]

    rows = [(n % 3, n, line(n, n, n + 1, n + 3)) for n in range(300)]
    rows += [(0, 1000, line(5)), (1, 1001, None), (0, 1002, line(7, 8)), (9, 1, line(1, 1))]
    parts = spark.createDataFrame(rows, f"element_id bigint, part_key bigint, geom {LINE.simpleString()}")
    held = F.array_sort(F.collect_list(F.struct("part_key", "geom")))
    whole = parts.groupBy("element_id").agg(F.transform(held, lambda p: p["geom"]).alias("geom"))
    expected = segments(whole)
    found = segments_of_parts(parts.repartition(7), Stage(spark)).select(*expected.columns)
    assert found.schema.simpleString() == expected.schema.simpleString()
    assert sorted(found.collect()) == sorted(expected.collect()) and found.count() == 601


def test_no_row_holds_a_long_element(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("all parts in one row")

    monkeypatch.setattr(fixtures, "long_elements", refuse)
    rows = queries.QUERIES["ear_long_elements"](spark, "/root/testdata/sf0.001")
    assert rows.select("element_id").distinct().count() == 27
