"""Restriction of both layers to the overlap of their extents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazline.functions.geometry import bbox, parts_of


def _extent(df: DataFrame, points) -> DataFrame:
    return df.select(bbox(points).alias("b")).agg(
        F.min("b.xmin").alias("xmin"),
        F.min("b.ymin").alias("ymin"),
        F.max("b.xmax").alias("xmax"),
        F.max("b.ymax").alias("ymax"),
    )


def overlap_of_extents(elements: DataFrame, zones: DataFrame, geom="geom"):
    """(elements, zones) without the features whose bounding box misses the common extent.

    Features are kept whole. The common extent is four numbers, taken once.
    """
    line = F.flatten(F.expr(parts_of(elements, geom)))
    sides = _extent(elements, line).unionByName(_extent(zones, F.flatten(geom)))
    box = sides.agg(
        F.max("xmin").alias("xmin"),
        F.max("ymin").alias("ymin"),
        F.min("xmax").alias("xmax"),
        F.min("ymax").alias("ymax"),
        F.count("xmin").alias("n"),
    ).first()

    def meets(points):
        if box["n"] < 2 or box["xmin"] > box["xmax"] or box["ymin"] > box["ymax"]:
            return F.lit(False)
        b = bbox(points)
        return (
            (b["xmin"] <= box["xmax"])
            & (b["xmax"] >= box["xmin"])
            & (b["ymin"] <= box["ymax"])
            & (b["ymax"] >= box["ymin"])
        )

    return elements.where(meets(line)), zones.where(meets(F.flatten(geom)))
