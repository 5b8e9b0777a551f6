"""Inputs of the registered queries.

Layers and the overlay are stored once per application and data folder, as the study
tables of a real installation are: queries about summaries, layers and the store start
from the stored overlay, queries about the overlay itself always compute it.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazline.operators.batches import overlay_batches
from hazline.operators.overlay import Split, intersect, split_at_zones, unstored
from hazline.session import Stage, shuffles_dropped
from hazline.sinks.store import StudyStore
from hazline.sources import fixtures
from hazline.sources.tables import read_element_type, read_process_type

STUDY_ID = 1

_PARAMETERS: dict[str, tuple[str, str]] = {}
_LAYERS: dict[tuple, "Layers"] = {}
_SPLITS: dict[tuple, tuple[Split, Stage]] = {}
_OVERLAYS: dict[tuple, "Overlay"] = {}
_STORES: dict[tuple, StudyStore] = {}


@dataclass(frozen=True)
class Layers:
    elements: DataFrame
    zones: DataFrame
    elements_path: str
    zones_path: str


@dataclass(frozen=True)
class Overlay:
    split: Split
    intersections: DataFrame


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    return spark.sparkContext.applicationId, sf_dir


def parameters(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Element and process types, read from the Parquet tables of an installation."""
    app = spark.sparkContext.applicationId
    if app not in _PARAMETERS:
        stage = Stage(spark)
        _PARAMETERS[app] = (
            stage.write("element_type", fixtures.element_types(spark)),
            stage.write("process_type", fixtures.process_types(spark)),
        )
    element_type, process_type = _PARAMETERS[app]
    return read_element_type(spark, element_type), read_process_type(spark, process_type)


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    key = _key(spark, sf_dir)
    if key not in _LAYERS:
        stage = Stage(spark)
        with shuffles_dropped(spark):
            elements = stage.write("elements", fixtures.raw_elements(spark, sf_dir))
            zones = stage.write("zones", fixtures.zones(spark, sf_dir))
        _LAYERS[key] = Layers(
            spark.read.parquet(elements), spark.read.parquet(zones), elements, zones
        )
    return _LAYERS[key]


def fresh_split(spark: SparkSession, sf_dir: str, **options) -> tuple[Split, Stage]:
    data, stage = layers(spark, sf_dir), Stage(spark)
    return split_at_zones(data.elements, data.zones, STUDY_ID, stage, **options), stage


def fresh_intersections(spark: SparkSession, sf_dir: str, min_size: float = 0.0) -> DataFrame:
    split, stage = fresh_split(spark, sf_dir, geometry=False)
    return intersect(split, layers(spark, sf_dir).zones, stage, min_size)


def stored_split(spark: SparkSession, sf_dir: str) -> tuple[Split, Stage]:
    """The stored pieces, for queries that read no intersections."""
    key = _key(spark, sf_dir)
    if key not in _SPLITS:
        _SPLITS[key] = fresh_split(spark, sf_dir)
    return _SPLITS[key]


def found_split(spark: SparkSession, sf_dir: str) -> Split:
    """The pieces, for queries that read them once: cut as they are read, or the stored ones."""
    key = _key(spark, sf_dir)
    return _SPLITS[key][0] if key in _SPLITS else fresh_split(spark, sf_dir, save=unstored)[0]


def overlay(spark: SparkSession, sf_dir: str) -> Overlay:
    key = _key(spark, sf_dir)
    if key not in _OVERLAYS:
        split, stage = stored_split(spark, sf_dir)
        rows = intersect(split, layers(spark, sf_dir).zones, stage)
        _OVERLAYS[key] = Overlay(split, stage.put("intersections", rows))
    return _OVERLAYS[key]


def found_intersections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersections of the stored pieces, for queries that read them once: found as they are read, or the stored ones."""
    key = _key(spark, sf_dir)
    if key in _OVERLAYS:
        return _OVERLAYS[key].intersections
    split, stage = stored_split(spark, sf_dir)
    return intersect(split, layers(spark, sf_dir).zones, stage)


def overlay_parts(spark: SparkSession, sf_dir: str, columns: list[str]) -> Iterator[tuple[Split, DataFrame]]:
    """Pieces and intersections for queries that only count them: the stored ones, or one batch after the other."""
    key = _key(spark, sf_dir)
    if key in _OVERLAYS:
        yield _OVERLAYS[key].split, _OVERLAYS[key].intersections
        return
    data = layers(spark, sf_dir)
    with Stage(spark) as stage:
        yield from overlay_batches(data.elements, data.zones, STUDY_ID, stage, columns, geometry=False)


def counted(
    spark: SparkSession, sf_dir: str, columns: list[str], *counts: Callable[[Split, DataFrame], DataFrame]
) -> list[DataFrame]:
    """Each of the counts of all parts of the overlay, one below the other; columns: those read of the intersections."""
    stage = Stage(spark)
    paths, schemas = [[] for _ in counts], []
    for split, rows in overlay_parts(spark, sf_dir, columns):
        found = [count(split, rows) for count in counts]
        schemas = [each.schema for each in found]
        for written, each in zip(paths, found):
            written.append(stage.write("counts", each))
    return [spark.read.schema(schema).parquet(*each) for schema, each in zip(schemas, paths)]


def stored(spark: SparkSession, sf_dir: str) -> StudyStore:
    """Store with two studies; the second holds the rows of the first with twice the goods traffic."""
    key = _key(spark, sf_dir)
    if key not in _STORES:
        store = StudyStore(spark, f"{Stage(spark).root}/store")
        rows = found_intersections(spark, sf_dir)
        for number in (STUDY_ID, STUDY_ID + 1):
            store.initiate_study(f"study {number}", "zones", "elements", study_id=number)
            own = rows.withColumn("study_id", F.lit(number).cast("bigint"))
            own = own.withColumn("aadt_goods", F.col("aadt_goods") * (number - STUDY_ID + 1))
            store.append_import(own)
            store.import_results(number)
            rows = store.intersections(STUDY_ID)
        _STORES[key] = store
    return _STORES[key]
