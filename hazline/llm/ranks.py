"""Positions of rows in a given order, for groups of any size.

Rows are range-partitioned by group and order, so a group with a third of all rows is spread like
any other; each partition is numbered on its own, and the counts of the partitions before it are
added: a row per group and partition that holds some of it.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazline.llm.common import Stage


def positions(stage: Stage, name: str, rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with `at` (0 to n - 1 within their group, in the order, NULLs first) and n.

    Rows equal in all of group and order take their positions in any order. The group must not be
    NULL, and rows must not have columns named at, n, line or part.
    """
    held = stage.put(
        name,
        rows.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("line", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id()),
    )
    runs = held.groupBy(group, "part").agg(F.min("line").alias("first"), F.count("*").alias("n_run"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        group,
        "part",
        "first",
        F.coalesce(F.sum("n_run").over(before), F.lit(0)).alias("past"),
        F.sum("n_run").over(Window.partitionBy(group)).alias("n"),
    )
    at = (F.col("line") - F.col("first") + F.col("past")).alias("at")
    return held.join(starts, [group, "part"]).select(*rows.columns, at, "n")
