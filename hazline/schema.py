"""Target schemas of the tables the engine reads and writes."""

from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
LINE = T.ArrayType(POINT)
RINGS = T.ArrayType(T.ArrayType(POINT))

ELEMENT_FIELDS = {
    "elementtype_code": T.StringType(),
    "route_code": T.StringType(),
    "aadt_passenger": T.DoubleType(),
    "aadt_goods": T.DoubleType(),
    "diversion_time": T.DoubleType(),
}

ZONE_FIELDS = {
    "processtype_id": T.IntegerType(),
    "event_frequency": T.DoubleType(),
    "freq_interval_plus": T.DoubleType(),
    "freq_interval_minus": T.DoubleType(),
}
OPTIONAL_FIELDS = {"freq_interval_plus", "freq_interval_minus"}

INTERSECTION = T.StructType(
    [
        T.StructField("study_id", T.LongType()),
        T.StructField("element_feature_id", T.LongType()),
        T.StructField("hazardzone_feature_id", T.LongType()),
        *[T.StructField(n, t) for n, t in ELEMENT_FIELDS.items()],
        *[T.StructField(n, t) for n, t in ZONE_FIELDS.items()],
        T.StructField("element_size", T.DoubleType()),
        # the key of the piece; element_feature_id is NULL where they do not fit one number
        T.StructField("element_id", T.LongType()),
        T.StructField("piece_no", T.LongType()),
    ]
)

STUDY = T.StructType(
    [
        T.StructField("study_id", T.LongType()),
        T.StructField("study_name", T.StringType()),
        T.StructField("hazardzone_dataset_filepath", T.StringType()),
        T.StructField("element_dataset_filepath", T.StringType()),
        T.StructField("study_description", T.StringType()),
    ]
)

DATASET = T.StructType(
    [
        T.StructField("study_id", T.LongType()),
        T.StructField("dataset_type", T.StringType()),
        T.StructField("dataset_filepath", T.StringType()),
        T.StructField("dataset_description", T.StringType()),
    ]
)

CURRENT = T.StructType(
    [
        T.StructField("study_id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

PROCESS_TYPE = T.StructType(
    [
        T.StructField("processtype_id", T.IntegerType()),
        T.StructField("closure_days", T.DoubleType()),
        T.StructField("repair_per_m", T.DoubleType()),
        T.StructField("reopening_cost", T.DoubleType()),
    ]
)

ELEMENT_TYPE = T.StructType(
    [
        T.StructField("elementtype_code", T.StringType()),
        T.StructField("vot_passenger", T.DoubleType()),
        T.StructField("vot_goods", T.DoubleType()),
    ]
)
