"""Zones, elements and parameters derived from the star-schema test tables.

Elements are polylines walked through the line items of an order, zones are L-shaped
hexagons around a place given by the part. Coordinates are whole numbers on a plane of
400,000 by 400,000.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazline.schema import ELEMENT_TYPE, LINE, PROCESS_TYPE

# Fixed values of the fixture.
PROCESS_TYPES = [
    (1, 0.5, 12.5, 3000.0),
    (2, 2.0, 40.0, 9000.0),
    (3, 7.0, 150.0, 25000.0),
]
ELEMENT_TYPES = [
    ("EV", 200.0, 600.0),
    ("RV", 180.0, 550.0),
    ("FV", 150.0, 500.0),
    ("KV", 120.0, 450.0),
]
CORNERS = [(-2, -2), (2, -2), (2, 0), (0, 0), (0, 2), (-2, 2)]


def process_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROCESS_TYPES, PROCESS_TYPE)


def element_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ELEMENT_TYPES, ELEMENT_TYPE)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(element_id, geom) per order with line items, single vertices included.

    Line items are merged per (order, line number) before anything is clustered by
    order, so an order holds no more rows than there are line numbers.
    """
    steps = (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.min("l_partkey").alias("pk"), F.min("l_suppkey").alias("sk"))
    )
    walk = (
        Window.partitionBy("l_orderkey")
        .orderBy("l_linenumber")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    vertices = steps.select(
        "l_orderkey",
        "l_linenumber",
        (
            F.expr("(l_orderkey * 7919) % 400000")
            + F.sum(F.expr("(pk * 131) % 1201 - 600")).over(walk)
        )
        .cast("double")
        .alias("x"),
        (
            F.expr("(l_orderkey * 104729) % 400000")
            + F.sum(F.expr("(sk * 197 + l_linenumber * 389) % 1201 - 600")).over(walk)
        )
        .cast("double")
        .alias("y"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "x", "y")))
    return vertices.groupBy(F.col("l_orderkey").alias("element_id")).agg(
        F.transform(ordered, lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
        .cast(LINE)
        .alias("geom")
    )


def raw_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as elements, also those with no line (NULL) or a single vertex."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("element_id"),
        F.expr(
            "element_at(array('EV', 'RV', 'FV', 'KV', 'JB'), CAST(left(o_orderpriority, 1) AS INT))"
        ).alias("elementtype_code"),
        F.expr("concat('R', o_custkey % 100)").alias("route_code"),
        F.expr("CAST(floor(o_totalprice / 50) AS DOUBLE)").alias("aadt_passenger"),
        F.expr("CAST(floor(o_totalprice / 400) AS DOUBLE)").alias("aadt_goods"),
        F.expr("CAST(10 + 15 * ((o_custkey % 100) % 7) AS DOUBLE)").alias("diversion_time"),
    )
    return orders.join(lines(spark, sf_dir), "element_id", "left")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "p_partkey AS zone_id",
        "CAST(p_size % 3 + 1 AS INT) AS processtype_id",
        "CAST(element_at(array(0, 20, 100, 333, 1000), CAST(p_partkey % 5 + 1 AS INT)) AS DOUBLE)"
        " AS event_frequency",
        "CAST((p_partkey * 6151) % 400000 AS DOUBLE) AS cx",
        "CAST((p_partkey * 15485863) % 400000 AS DOUBLE) AS cy",
        "CAST(300 + 35 * p_size AS DOUBLE) AS r",
    )
    ring = F.array(
        *[
            F.struct(
                (F.col("cx") + F.col("r") * a).alias("x"), (F.col("cy") + F.col("r") * b).alias("y")
            )
            for a, b in CORNERS + CORNERS[:1]
        ]
    )
    interval = F.floor(F.col("event_frequency") / 5).cast("double")
    return part.select(
        "zone_id",
        "processtype_id",
        "event_frequency",
        interval.alias("freq_interval_plus"),
        interval.alias("freq_interval_minus"),
        F.array(ring).alias("geom"),
    )


def multipart_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One element per customer, whose parts are the lines of its orders.

    Odd customers have ids beyond 2^50, even ones negative ids.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey")
    parts = orders.join(
        lines(spark, sf_dir).withColumnRenamed("element_id", "o_orderkey"), "o_orderkey", "left"
    )
    ordered = F.array_sort(F.collect_list(F.when(F.col("geom").isNotNull(), F.struct("o_orderkey", "geom"))))
    return parts.groupBy("o_custkey").agg(ordered.alias("parts"), F.count("*").alias("n")).select(
        F.expr("if(o_custkey % 2 = 1, 1125899906842624 + o_custkey, -o_custkey)").alias("element_id"),
        F.lit("EV").alias("elementtype_code"),
        F.expr("concat('R', o_custkey % 100)").alias("route_code"),
        F.col("n").cast("double").alias("aadt_passenger"),
        F.lit(1.0).alias("aadt_goods"),
        F.lit(30.0).alias("diversion_time"),
        F.transform("parts", lambda p: p["geom"]).alias("geom"),
    )


def long_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven elements with a part per order, and twenty of one segment across the plane."""
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey")
    parts = keys.join(lines(spark, sf_dir).withColumnRenamed("element_id", "o_orderkey"), "o_orderkey")
    ordered = F.array_sort(F.collect_list(F.struct("o_orderkey", "geom")))
    winding = parts.groupBy(F.expr("-1 - o_custkey % 7").alias("element_id")).agg(
        F.transform(ordered, lambda p: p["geom"]).alias("geom")
    )
    y = "CAST(20000 * id + 10 AS DOUBLE)"
    straight = spark.range(20).selectExpr(
        "1152921504606846976 + id AS element_id",
        f"array(array(named_struct('x', 0D, 'y', {y}), named_struct('x', 400000D, 'y', {y}))) AS geom",
    )
    return winding.unionByName(straight).selectExpr(
        "element_id",
        "'EV' AS elementtype_code",
        "'R1' AS route_code",
        "1D AS aadt_passenger",
        "1D AS aadt_goods",
        "30D AS diversion_time",
        "geom",
    )


def long_element_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The rows of long_elements without geometry, and a row (element_id, part_key, geom) per part."""
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey")
    orders = keys.join(lines(spark, sf_dir).withColumnRenamed("element_id", "o_orderkey"), "o_orderkey")
    winding = orders.selectExpr("-1 - o_custkey % 7 AS element_id", "o_orderkey AS part_key", "geom")
    y = "CAST(20000 * id + 10 AS DOUBLE)"
    straight = spark.range(20).selectExpr(
        "1152921504606846976 + id AS element_id",
        "0L AS part_key",
        f"array(named_struct('x', 0D, 'y', {y}), named_struct('x', 400000D, 'y', {y})) AS geom",
    )
    parts = winding.unionByName(straight)
    elements = parts.select("element_id").distinct().selectExpr(
        "element_id",
        "'EV' AS elementtype_code",
        "'R1' AS route_code",
        "1D AS aadt_passenger",
        "1D AS aadt_goods",
        "30D AS diversion_time",
    )
    return elements, parts


def sevenths(elements: DataFrame, zones: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both layers with a seventh of their coordinates, and a neighbour (of negative id) in each
    zone's notch, whose shared borders are computed in another way and differ in the last bits."""
    line = F.transform("geom", lambda p: F.struct((p["x"] / 7).alias("x"), (p["y"] / 7).alias("y")))
    ring = F.transform(
        "geom",
        lambda r: F.transform(r, lambda p: F.struct((p["x"] / 7).alias("x"), (p["y"] / 7).alias("y"))),
    )
    # the fourth corner of the ring is the zone's centre, the second lies 2 r to its right
    centre, right = F.col("geom")[0][3], F.col("geom")[0][1]
    r = (right["x"] - centre["x"]) / 2 / 7
    corners = [(0, 0), (2, 0), (2, 2), (0, 2)]
    notch = F.array(
        *[
            F.struct((centre["x"] / 7 + r * a).alias("x"), (centre["y"] / 7 + r * b).alias("y"))
            for a, b in corners
        ]
    )
    neighbours = zones.withColumn("zone_id", -F.col("zone_id")).withColumn("geom", F.array(notch))
    return (
        elements.withColumn("geom", line),
        zones.withColumn("geom", ring).unionByName(neighbours),
    )
