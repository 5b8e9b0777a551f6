"""Choice of the grid on which segments and edges meet."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cell_size(seg: DataFrame, edge: DataFrame) -> float:
    """Mean extent over all segments and edges.

    With this size the cell lists hold a small constant times the input rows,
    whichever side is the larger. One aggregate row reaches the driver.
    """
    extent = F.expr("greatest(abs(x2 - x1), abs(y2 - y1))").alias("ext")
    row = seg.select(extent).unionByName(edge.select(extent)).agg(F.avg("ext").alias("mean")).first()
    return float(row["mean"] or 1.0)
