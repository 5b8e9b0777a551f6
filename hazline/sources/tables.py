"""Readers of the input layers and parameter tables."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from hazline.operators.mapping import bind_fields
from hazline.schema import (
    ELEMENT_FIELDS,
    ELEMENT_TYPE,
    OPTIONAL_FIELDS,
    PROCESS_TYPE,
    ZONE_FIELDS,
)


def bind_zones(df: DataFrame, mapping: Mapping[str, str] | None = None, zone_id_col="zone_id",
               geom_col="geom") -> DataFrame:
    """Zone layer with its user fields renamed to the target fields."""
    return bind_fields(
        df, ZONE_FIELDS, mapping, OPTIONAL_FIELDS, {"zone_id": zone_id_col, "geom": geom_col}
    )


def bind_elements(df: DataFrame, mapping: Mapping[str, str] | None = None,
                  element_id_col="element_id", geom_col="geom") -> DataFrame:
    """Element layer with its user fields renamed to the target fields."""
    return bind_fields(
        df, ELEMENT_FIELDS, mapping, (), {"element_id": element_id_col, "geom": geom_col}
    )


def read_zones(spark: SparkSession, path: str, mapping=None, zone_id_col="zone_id",
               geom_col="geom") -> DataFrame:
    return bind_zones(spark.read.parquet(path), mapping, zone_id_col, geom_col)


def read_elements(spark: SparkSession, path: str, mapping=None, element_id_col="element_id",
                  geom_col="geom") -> DataFrame:
    return bind_elements(spark.read.parquet(path), mapping, element_id_col, geom_col)


def read_process_type(spark: SparkSession, path: str) -> DataFrame:
    return bind_fields(spark.read.parquet(path), {f.name: f.dataType for f in PROCESS_TYPE})


def read_element_type(spark: SparkSession, path: str) -> DataFrame:
    return bind_fields(spark.read.parquet(path), {f.name: f.dataType for f in ELEMENT_TYPE})
