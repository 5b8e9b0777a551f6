"""Field binding, input kinds and validity counts."""

import pytest

from hazline.operators.mapping import MappingError, bind_fields, text_to_int
from hazline.operators.quality import InputError, require_layers, validation_counts
from hazline.schema import ZONE_FIELDS
from hazline.sources.tables import bind_elements, bind_zones
from tests.layers import elements_df, zones_df

SQUARE = {1: [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]}


def test_rename_ignores_case_and_hides_the_rest(spark):
    user = zones_df(spark, SQUARE).selectExpr(
        "zone_id AS FID", "'7' AS Proc", "event_frequency AS PERIOD", "1 AS other", "geom"
    )
    bound = bind_zones(user, {"processtype_id": "PROC", "event_frequency": "period"}, "fid")
    assert bound.columns == ["zone_id", "geom", *ZONE_FIELDS]
    row = bound.first()
    assert (row.processtype_id, row.event_frequency, row.freq_interval_plus) == (7, 100.0, None)


def test_all_missing_fields_are_named_together(spark):
    user = zones_df(spark, SQUARE).drop("processtype_id", "geom")
    with pytest.raises(MappingError, match="geom, processtype_id"):
        bind_zones(user)


def test_columns_that_differ_in_case_only(spark):
    user = spark.sql("SELECT 1 AS Route, 2 AS ROUTE")
    with pytest.raises(MappingError, match="differ only in case"):
        bind_fields(user, {"route_code": ZONE_FIELDS["processtype_id"]}, {"route_code": "route"})


def test_unknown_target(spark):
    with pytest.raises(MappingError, match="unknown"):
        bind_elements(elements_df(spark, {}), {"no_such_field": "x"})


def test_text_to_int(spark):
    rows = spark.sql("SELECT explode(array('12', 'x', '', NULL)) AS v").select(text_to_int("v"))
    assert [r[0] for r in rows.collect()] == [12, None, None, None]


def test_both_layers_are_checked_before_failing(spark):
    with pytest.raises(InputError, match="hazard zones.*elements"):
        require_layers(spark.sql("SELECT 'a' AS geom"), spark.sql("SELECT 1 AS id"))
    require_layers(elements_df(spark, {}), zones_df(spark, {}))


def test_validity_counts(spark):
    elements = elements_df(spark, {1: None, 2: [(0, 0)], 3: [], 4: [(0, 0), (1, 1)]})
    zones = zones_df(spark, {1: SQUARE[1], 2: [[(0, 0), (1, 0), (1, 1)]], 3: [[(0, 0), (1, 0)]]})
    rows = {r.layer: r for r in validation_counts(elements, zones).collect()}
    assert rows["elements"][1:] == (4, 1, 2, 0)
    assert rows["zones"][1:] == (3, 0, 1, 2)
