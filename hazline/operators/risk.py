"""Frequencies and costs per element and per route.

The formulas are this engine's own: expected yearly cost = frequency of an event times
its cost. They are kept in this one module so that others can replace them.

Lookups carry no broadcast hint: Spark broadcasts a parameter table while its size is
under spark.sql.autoBroadcastJoinThreshold and shuffles it (splitting hot keys) beyond.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ELEMENT_KEY = ["study_id", "element_id", "piece_no"]
ROUTE_KEY = ["study_id", "route_code"]
CODES = ["elementtype_code", "processtype_id"]


def with_parameters(pairs: DataFrame, element_type: DataFrame, process_type: DataFrame) -> DataFrame:
    """Left lookups: a row without parameters keeps NULLs."""
    return pairs.join(element_type, "elementtype_code", "left").join(
        process_type, "processtype_id", "left"
    )


def code_counts(pairs: DataFrame, *measures: Column) -> DataFrame:
    """Rows of the pairs, and further measures, by the codes that are looked up; one read of the pairs."""
    return pairs.groupBy(*CODES).agg(F.count("*").alias("n_rows"), *measures)


def orphans(pairs: DataFrame, element_type: DataFrame, process_type: DataFrame) -> DataFrame:
    """Codes that occur in the pairs but have no parameters, with their number of rows."""
    return orphans_of(code_counts(pairs), element_type, process_type)


def orphans_of(counts: DataFrame, element_type: DataFrame, process_type: DataFrame) -> DataFrame:
    """The orphans from code_counts, of the whole or of parts that add up to it."""

    def missing(lookup, params, key):
        found = counts.groupBy(key).agg(F.sum("n_rows").alias("n_rows"))
        return found.join(params, key, "left_anti").select(
            F.lit(lookup).alias("lookup"), F.col(key).cast("string").alias("code"), "n_rows"
        )

    return missing("element_type", element_type, "elementtype_code").unionByName(
        missing("process_type", process_type, "processtype_id")
    )


def event_costs(pairs: DataFrame, element_type: DataFrame, process_type: DataFrame) -> DataFrame:
    """Frequency and expected yearly costs of each (piece, zone); event_frequency is in years."""
    period = "event_frequency"
    plus, minus = "freq_interval_plus", "freq_interval_minus"
    priced = with_parameters(pairs, element_type, process_type).selectExpr(
        "*",
        f"1 / nullif({period}, 0) AS freq",
        f"1 / nullif({period} + coalesce({plus}, 0), 0) AS freq_low",
        f"if({period} - coalesce({minus}, 0) > 0, 1 / ({period} - coalesce({minus}, 0)), NULL)"
        " AS freq_high",
        "closure_days * (aadt_passenger * vot_passenger + aadt_goods * vot_goods)"
        " * diversion_time / 60 AS closure_event",
        "repair_per_m * element_size AS repair_event",
    )
    event = "(closure_event + repair_event + reopening_cost)"
    return priced.selectExpr(
        *pairs.columns,
        "freq",
        "freq * closure_event AS closure",
        "freq * repair_event AS repair",
        "freq * reopening_cost AS reopening",
        f"freq * {event} AS total",
        f"freq_low * {event} AS total_low",
        f"freq_high * {event} AS total_high",
    )


def element_summary(
    pairs: DataFrame, element_type: DataFrame, process_type: DataFrame
) -> DataFrame:
    """Closure, repair and reopening cost per element piece, summed over its zones.

    (piece, zone) is unique in pairs, so the number of zones is the number of rows.
    """
    return (
        event_costs(pairs, element_type, process_type)
        .groupBy(*ELEMENT_KEY)
        .agg(
            F.first("element_feature_id").alias("element_feature_id"),
            F.sum("freq").alias("hazard_frequency"),
            F.sum("closure").alias("closure_cost"),
            F.sum("repair").alias("repair_cost"),
            F.sum("reopening").alias("reopening_cost"),
            F.sum("total").alias("total_cost"),
            F.sum("total_low").alias("total_cost_low"),
            F.sum("total_high").alias("total_cost_high"),
            F.count("hazardzone_feature_id").alias("n_zones"),
        )
    )


def route_summary(pairs: DataFrame, element_type: DataFrame, process_type: DataFrame) -> DataFrame:
    """Closure frequency and costs per route.

    An event on one zone closes a route once, however many pieces it hits; repair adds
    up over the pieces. Both groupings combine before they shuffle, so a route or zone
    with most of the rows is spread over all tasks first.
    """
    per_zone = (
        event_costs(pairs, element_type, process_type)
        .groupBy(*ROUTE_KEY, "hazardzone_feature_id")
        .agg(
            F.max("freq").alias("freq"),
            F.max("closure").alias("closure"),
            F.sum("repair").alias("repair"),
            F.max("reopening").alias("reopening"),
        )
    )
    costs = (
        per_zone.groupBy(*ROUTE_KEY)
        .agg(
            F.sum("freq").alias("closure_frequency"),
            F.sum("closure").alias("closure_cost"),
            F.sum("repair").alias("repair_cost"),
            F.sum("reopening").alias("reopening_cost"),
            F.count("*").alias("n_zones"),
        )
        .withColumn(
            "total_cost", F.col("closure_cost") + F.col("repair_cost") + F.col("reopening_cost")
        )
    )
    counts = pairs.groupBy(*ROUTE_KEY).agg(
        F.countDistinct("element_id", "piece_no").alias("n_elements")
    )
    same = (costs["study_id"].eqNullSafe(counts["study_id"])) & (
        costs["route_code"].eqNullSafe(counts["route_code"])
    )
    return costs.join(counts, same).select(
        costs["study_id"], costs["route_code"], *costs.columns[2:], "n_elements"
    )


def element_layer(ear: DataFrame, summary: DataFrame) -> DataFrame:
    """All pieces with their element measures; NULL where no zone hits the piece."""
    return ear.join(summary.drop("element_feature_id"), ELEMENT_KEY, "left")


def route_layer(ear: DataFrame, summary: DataFrame) -> DataFrame:
    """All pieces with the measures of their route; NULL where no zone hits the route."""
    return ear.join(summary, ROUTE_KEY, "left")
