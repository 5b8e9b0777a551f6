"""The overlay: elements split at zone boundaries, and the piece-zone intersection table."""

from collections.abc import Callable, Collection
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazline.functions.geometry import edges, segments, segments_of_parts
from hazline.operators.cuts import boundaries, cut_points
from hazline.operators import grid
from hazline.operators.pairs import piece_zone_pairs, repeated_elements
from hazline.operators.pieces import CHUNK_ROWS, PIECE_BITS, piece_id, split_lines
from hazline.schema import ELEMENT_FIELDS, INTERSECTION, ZONE_FIELDS
from hazline.session import Stage, shuffles_dropped, spread

EAR_FIELDS = ["study_id", "element_feature_id", *ELEMENT_FIELDS]
PIECE_KEY = ["element_id", "piece_no"]


@dataclass(frozen=True)
class Split:
    """Pieces with attributes, stored unless split unstored; the columns h_* describe an inner point of the piece."""

    pieces: DataFrame
    edge: DataFrame
    cell_size: float
    tolerance: float = 0.0

    @property
    def ear(self) -> DataFrame:
        geom = ["geom"] if "geom" in self.pieces.columns else []
        return self.pieces.select(*EAR_FIELDS, *PIECE_KEY, "part_no", "element_size", *geom)


def split_at_zones(
    elements: DataFrame,
    zones: DataFrame,
    study_id: int,
    stage: Stage,
    cell_size: float | None = None,
    split_at_elements: bool = False,
    geometry: bool = True,
    piece_bits: int = PIECE_BITS,
    save: Callable[[DataFrame], DataFrame] | None = None,
    tolerance: float = 0.0,
    chunk_rows: int = CHUNK_ROWS,
    parts: DataFrame | None = None,
) -> Split:
    """Splits the elements at the boundaries of all zones, those without events included.

    Coordinates nearer to each other than the tolerance are one place (see operators.cuts).

    With parts, rows (element_id, part_key, geom), the lines come from there and not from elements.

    The pieces are materialised once, by save (which returns the stored table) or in stage. Shuffle files go
    at the end of each step.
    """
    save = save or partial(stage.put, "pieces")
    with shuffles_dropped(stage.spark):
        seg = segments(elements) if parts is None else stage.put("segments", segments_of_parts(parts, stage))
        edge = edges(zones)
        size = float(cell_size or grid.cell_size(seg, edge))
        boundary = stage.put("boundaries", boundaries(edge, seg if split_at_elements else None))
        cuts = cut_points(seg, boundary, size, tolerance)
        attributes = elements.select(
            F.col("element_id").cast("bigint").alias("eid"), *ELEMENT_FIELDS
        )
        pieces = split_lines(seg, cuts, stage, geometry, chunk_rows, attributes)
        with_attributes = (
            pieces.withColumn("study_id", F.lit(study_id).cast("bigint"))
            .withColumn("element_feature_id", piece_id(bits=piece_bits))
            .withColumnsRenamed({"eid": "element_id", "length": "element_size"})
        )
        return Split(save(with_attributes), edge, size, tolerance)


def unstored(pieces: DataFrame) -> DataFrame:
    """As save of split_at_zones: for pieces that are read once. They are cut as they are read, with the columns read."""
    return pieces


def intersect(
    split: Split, zones: DataFrame, stage: Stage, min_size: float = 0.0, columns: Collection[str] | None = None
) -> DataFrame:
    """One row per (piece, zone) of positive size and event frequency, in the import schema.

    With columns, the same rows with these columns of the schema: the search carries no others.

    The zone filter goes below the pair search: such zones cut lines but give no rows. Rows come out of
    the search complete: none is shuffled.
    """
    schema = [f for f in INTERSECTION if columns is None or f.name in columns]
    names = {f.name for f in schema}
    of_zone = [c for c in ZONE_FIELDS if c in names]
    active = zones.where("event_frequency > 0").select(
        F.col("zone_id").cast("bigint").alias("zid"), *of_zone
    )
    with shuffles_dropped(stage.spark):
        # one row per edge before cells are listed: a zone with most of the edges is no task of its own
        edge = stage.put(
            "edges", spread(edges(zones.where("event_frequency > 0")), "zid", "ring", "k")
        )
        sized = split.pieces.where(
            (F.col("element_size") > 0) & (F.col("element_size") >= F.lit(float(min_size)))
        )
        # attributes go through the search with the points and zones, linear in both, not after the pairs
        fields = [c for c in dict.fromkeys([*EAR_FIELDS, "element_size"]) if c in names and c not in PIECE_KEY]
        fields = [*PIECE_KEY, *fields]
        twice = stage.put("repeated", repeated_elements(split.pieces))
        by_zone = active.withColumn("zone_row", F.monotonically_increasing_id())
        once = sized if twice.isEmpty() else sized.join(twice, "element_id", "left_anti")
        rows = piece_zone_pairs(
            once, edge, split.cell_size, stage, fields, split.tolerance, by_zone, twice
        ).drop("zone_row")
        if not twice.isEmpty():  # their pieces share keys, so attributes follow for the pairs found
            others = sized.join(twice, "element_id", "left_semi")
            pairs = piece_zone_pairs(
                others, edge, split.cell_size, stage, PIECE_KEY, split.tolerance, twice=twice
            )
            again = pairs.join(others.select(*fields), PIECE_KEY).join(active, "zid")
            rows = rows.unionByName(again)
    return rows.withColumnRenamed("zid", "hazardzone_feature_id").select(
        *[F.col(f.name).cast(f.dataType) for f in schema]
    )
