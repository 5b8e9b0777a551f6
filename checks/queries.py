"""Registered queries: Spark side, each with its SQL counterpart where there is one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as sql
from checks.inputs import (
    STUDY_ID,
    counted,
    found_intersections,
    found_split,
    fresh_intersections,
    fresh_split,
    layers,
    overlay,
    parameters,
    stored,
)
from checks.numbers import fixed
from hazline.functions.geometry import edges, segments
from hazline.operators import quality, risk
from hazline.operators.cuts import boundaries, cut_points, merged_cuts
from hazline.operators.extent import overlap_of_extents
from hazline.operators.grid import cell_size
from hazline.operators.mapping import text_to_int
from hazline.operators.overlay import intersect, split_at_zones, unstored
from hazline.operators.pairs import piece_zone_pairs
from hazline.plans.study import run_study
from hazline.schema import ELEMENT_FIELDS
from hazline.session import Stage
from hazline.sinks.store import StudyStore
from hazline.sources import fixtures
from hazline.sources.tables import bind_elements, bind_zones, read_elements, read_zones

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: fixed(name, n) for name, n in digits.items()})


def _store(spark) -> StudyStore:
    return StudyStore(spark, f"{Stage(spark).root}/store")


ES_DIGITS = dict(
    hazard_frequency=6,
    closure_cost=2,
    repair_cost=2,
    reopening_cost=2,
    total_cost=2,
    total_cost_low=2,
    total_cost_high=2,
)
RS_DIGITS = dict(
    closure_frequency=6, closure_cost=2, repair_cost=2, reopening_cost=2, total_cost=2
)
EAR = [
    "element_feature_id",
    "element_id",
    "piece_no",
    "elementtype_code",
    "route_code",
    "aadt_passenger",
    "aadt_goods",
    "diversion_time",
    "element_size",
]


# sources and projections


@query(sql.INPUT + """
SELECT CAST(zid AS BIGINT) AS zone_id, 0 AS ring, CAST(k AS INTEGER) AS k,
  CAST(qx AS DOUBLE) AS x1, CAST(qy AS DOUBLE) AS y1,
  CAST(px AS DOUBLE) AS x2, CAST(py AS DOUBLE) AS y2
FROM edge""")
def zones_scan(spark, sf_dir):
    return edges(read_zones(spark, layers(spark, sf_dir).zones_path)).select(
        F.col("zid").alias("zone_id"), "ring", "k", "x1", "y1", "x2", "y2"
    )


@query(sql.INPUT + """
SELECT eid AS element_id, CAST(sn AS INTEGER) AS segment_no, CAST(n_seg AS INTEGER) AS n_segments,
  CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
  CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2
FROM seg""")
def elements_scan(spark, sf_dir):
    return segments(read_elements(spark, layers(spark, sf_dir).elements_path)).select(
        F.col("eid").alias("element_id"),
        F.col("sn").alias("segment_no"),
        F.col("n_seg").alias("n_segments"),
        "x1",
        "y1",
        "x2",
        "y2",
    )


@query(sql.INPUT + """
SELECT 'elements' AS layer, count(*) AS n_rows,
  count(*) FILTER (n_vertex IS NULL) AS n_null_geometry,
  count(*) FILTER (n_vertex < 2) AS n_too_short, CAST(0 AS BIGINT) AS n_unclosed
FROM raw_element
UNION ALL SELECT 'zones', count(*), 0, 0, 0 FROM zone""")
def input_validation(spark, sf_dir):
    elements, zones = fixtures.raw_elements(spark, sf_dir), fixtures.zones(spark, sf_dir)
    quality.require_layers(elements, zones)
    return quality.validation_counts(elements, zones)


@query(sql.INPUT + """
SELECT CAST(zid AS BIGINT) AS zone_id, processtype_id, event_frequency,
  CAST(NULL AS DOUBLE) AS freq_interval_plus, CAST(NULL AS DOUBLE) AS freq_interval_minus
FROM zone""")
def field_mapping(spark, sf_dir):
    user = fixtures.zones(spark, sf_dir).selectExpr(
        "zone_id AS FID_Zones",
        "CAST(processtype_id AS STRING) AS ProcType",
        "event_frequency AS RETURN_PERIOD",
        "'not shown' AS remark",
        "geom AS Shape",
    )
    bound = bind_zones(
        user, {"processtype_id": "PROCTYPE", "event_frequency": "return_period"}, "fid_zones",
        "SHAPE",
    )
    return bound.drop("geom")


@query(sql.INPUT + """
SELECT element_id, elementtype_code, route_code, aadt_passenger, aadt_goods, diversion_time
FROM raw_element""")
def field_mapping_elements(spark, sf_dir):
    user = fixtures.raw_elements(spark, sf_dir).selectExpr(
        "element_id AS OBJECTID",
        "elementtype_code AS VegKat",
        "route_code AS Strekning",
        "aadt_passenger AS AADT",
        "aadt_goods AS AADT_Goods",
        "diversion_time AS DIVERSION_TIME",
        "'not shown' AS remark",
        "geom",
    )
    mapping = {"elementtype_code": "vegkat", "route_code": "strekning", "aadt_passenger": "aadt"}
    return bind_elements(user, mapping, "objectid").drop("geom")


SHIFT = 200000


def _moved(elements):
    line = F.expr(f"transform(geom, p -> named_struct('x', p.x + {SHIFT}, 'y', p.y))")
    return elements.withColumn("geom", line)


@query(sql.INPUT + f""",
moved AS (SELECT element_id, xmin + {SHIFT} AS xmin, ymin, xmax + {SHIFT} AS xmax, ymax
  FROM raw_element WHERE n_vertex > 0),
box AS (
  SELECT greatest(e.xmin, z.xmin) AS xmin, greatest(e.ymin, z.ymin) AS ymin,
    least(e.xmax, z.xmax) AS xmax, least(e.ymax, z.ymax) AS ymax
  FROM (SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
        FROM moved) e,
       (SELECT min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax
        FROM zbox) z)
SELECT 'element' AS layer, element_id AS feature_id FROM moved m, box b
WHERE m.xmin <= b.xmax AND m.xmax >= b.xmin AND m.ymin <= b.ymax AND m.ymax >= b.ymin
UNION ALL SELECT 'zone', CAST(zid AS BIGINT) FROM zbox m, box b
WHERE m.xmin <= b.xmax AND m.xmax >= b.xmin AND m.ymin <= b.ymax AND m.ymax >= b.ymin""")
def extent_overlap(spark, sf_dir):
    data = layers(spark, sf_dir)
    elements, zones = overlap_of_extents(_moved(data.elements), data.zones)
    return elements.select(
        F.lit("element").alias("layer"), F.col("element_id").alias("feature_id")
    ).unionByName(zones.select(F.lit("zone").alias("layer"), F.col("zone_id").alias("feature_id")))


# overlay


@query(sql.split_sql() + f"""
SELECT eid AS element_id, CAST(sn AS INTEGER) AS segment_no, {sql.fixed("t", "t", 9)} FROM cut""")
def split_cuts(spark, sf_dir):
    data = layers(spark, sf_dir)
    seg, edge = segments(data.elements), edges(data.zones)
    cuts = cut_points(seg, boundaries(edge), cell_size(seg, edge), cells=True)
    return (
        merged_cuts(cuts)
        .select(F.col("eid").alias("element_id"), F.col("sn").alias("segment_no"), "t")
        .withColumn("t", fixed("t", 9))
    )


@query(sql.split_sql() + f"SELECT {sql.EAR_COLUMNS}, CAST(1 AS BIGINT) AS study_id {sql.FROM_EAR}")
def ear_pieces(spark, sf_dir):
    split, _ = fresh_split(spark, sf_dir, save=unstored)
    return _rounded(split.ear.select("study_id", *EAR), element_size=3)


@query(sql.split_sql() + f"""
SELECT p.eid AS element_id, p.n_pieces, {sql.fixed("p.len", "pieces_length", 3)},
  {sql.fixed("s.len", "element_length", 3)}
FROM (SELECT eid, count(*) AS n_pieces, sum(len) AS len FROM piece GROUP BY eid) p
JOIN (SELECT eid, sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))) AS len
      FROM seg GROUP BY eid) s ON s.eid = p.eid""")
def piece_length(spark, sf_dir):
    split, _ = fresh_split(spark, sf_dir, geometry=False, save=unstored)
    pieces = split.pieces.groupBy("element_id").agg(
        F.count("*").alias("n_pieces"), F.sum("element_size").alias("pieces_length")
    )
    length = F.sum(F.expr("sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"))
    whole = (
        segments(layers(spark, sf_dir).elements)
        .groupBy(F.col("eid").alias("element_id"))
        .agg(length.alias("element_length"))
    )
    return _rounded(pieces.join(whole, "element_id"), pieces_length=3, element_length=3)


@query(sql.split_sql() + f""",
corner_of AS (
  SELECT eid, pno, sn, t1 AS t, x1 + t1 * (x2 - x1) AS x, y1 + t1 * (y2 - y1) AS y FROM stretch
  UNION ALL
  SELECT eid, pno, sn, t2, x1 + t2 * (x2 - x1), y1 + t2 * (y2 - y1) FROM (
    SELECT *, row_number() OVER (PARTITION BY eid, pno ORDER BY sn DESC, t1 DESC) AS n
    FROM stretch) WHERE n = 1)
SELECT eid * 1048576 + CAST(pno AS BIGINT) AS element_feature_id,
  CAST(row_number() OVER (PARTITION BY eid, pno ORDER BY sn, t) - 1 AS INTEGER) AS vertex_no,
  {sql.fixed("x", "x", 3)}, {sql.fixed("y", "y", 3)}
FROM corner_of""")
def ear_geometry(spark, sf_dir):
    split, _ = fresh_split(spark, sf_dir, save=unstored)
    vertices = split.ear.select("element_feature_id", F.posexplode("geom").alias("vertex_no", "p"))
    return vertices.select("element_feature_id", "vertex_no", "p.*").transform(_rounded, x=3, y=3)


@query(sql.OVERLAY + """
SELECT eid * 1048576 + pno AS element_feature_id, CAST(zid AS BIGINT) AS hazardzone_feature_id
FROM pair""")
def element_hazard_pairs(spark, sf_dir):
    split, stage = fresh_split(spark, sf_dir, geometry=False)
    pairs = piece_zone_pairs(
        split.pieces, split.edge, split.cell_size, stage, ["element_feature_id"]
    )
    return pairs.withColumnRenamed("zid", "hazardzone_feature_id")


@query(sql.OVERLAY + f"SELECT CAST(1 AS BIGINT) AS study_id, {sql.INTER_COLUMNS} FROM inter")
def intersection_table(spark, sf_dir):
    return _rounded(fresh_intersections(spark, sf_dir), element_size=3)


MIN_SIZE = 500


@query(
    sql.OVERLAY
    + f"SELECT CAST(1 AS BIGINT) AS study_id, {sql.INTER_COLUMNS} FROM inter WHERE len >= {MIN_SIZE}"
)
def intersection_min_size(spark, sf_dir):
    return _rounded(fresh_intersections(spark, sf_dir, MIN_SIZE), element_size=3)


@query(sql.split_sql(True) + f"SELECT {sql.EAR_COLUMNS} {sql.FROM_EAR}")
def split_at_elements(spark, sf_dir):
    split, _ = fresh_split(spark, sf_dir, split_at_elements=True, save=unstored)
    return _rounded(split.ear.select(*EAR), element_size=3)


# Fixed value of the fixture: far above rounding, below all segments and zones.
TOLERANCE = 0.01


def _sevenths(spark, sf_dir, **options):
    data, stage = layers(spark, sf_dir), Stage(spark)
    elements, zones = fixtures.sevenths(data.elements, data.zones)
    zones = stage.put("zones", zones)
    split = split_at_zones(elements, zones, STUDY_ID, stage, geometry=False, tolerance=TOLERANCE, **options)
    return split, zones, stage


@query(sql.split_sql(source=sql.SEVENTHS, tolerance=TOLERANCE) + f"""
SELECT {sql.EAR_COLUMNS}, p.len < {TOLERANCE} AS is_short {sql.FROM_EAR}""")
def ear_fractional(spark, sf_dir):
    """Fractional coordinates with shared borders: within the tolerance there are no false pieces."""
    split, _, _ = _sevenths(spark, sf_dir, save=unstored)
    short = (F.col("element_size") < TOLERANCE).alias("is_short")
    return _rounded(split.ear.select(*EAR, short), element_size=3)


@query(sql.split_sql(source=sql.SEVENTHS, tolerance=TOLERANCE) + sql.near_pairs(TOLERANCE) + """
SELECT eid AS element_id, pno AS piece_no, CAST(zid AS BIGINT) AS hazardzone_feature_id FROM inter""")
def intersection_fractional(spark, sf_dir):
    """Pieces along a shared border lie in the zones on both of its sides."""
    split, zones, stage = _sevenths(spark, sf_dir)
    columns = ["element_id", "piece_no", "hazardzone_feature_id"]
    return intersect(split, zones, stage, columns=columns).select(*columns)


def _multipart(spark, sf_dir, **options):
    stage = Stage(spark)
    elements = stage.put("elements", fixtures.multipart_elements(spark, sf_dir))
    zones = layers(spark, sf_dir).zones
    return split_at_zones(elements, zones, STUDY_ID, stage, **options), zones, stage


@query(sql.split_sql(source=sql.MULTIPART) + f"""
SELECT {sql.EAR_COLUMNS}, s.part_no {sql.FROM_EAR} JOIN (
  SELECT DISTINCT t.eid, CAST(t.pno AS BIGINT) AS pno, CAST(g.part_no AS INTEGER) AS part_no
  FROM stretch t JOIN seg g ON g.eid = t.eid AND g.sn = t.sn) s ON s.eid = p.eid AND s.pno = p.pno""")
def ear_multipart(spark, sf_dir):
    """Lines of several parts, with ids of any size: a part is never joined to the next one."""
    split, _, _ = _multipart(spark, sf_dir, save=unstored)
    return _rounded(split.ear.select(*EAR, "part_no"), element_size=3)


@query(sql.split_sql(source=sql.MULTIPART) + sql.PAIRS + f"SELECT {sql.INTER_COLUMNS} FROM inter")
def intersection_multipart(spark, sf_dir):
    split, zones, stage = _multipart(spark, sf_dir)
    return _rounded(intersect(split, zones, stage).drop("study_id"), element_size=3)


@query(sql.split_sql(source=sql.LONG) + f"SELECT {sql.EAR_COLUMNS} {sql.FROM_EAR}")
def ear_long_elements(spark, sf_dir):
    """Lines of thousands of segments, and straight ones cut by many zones, numbered in chunks of 64 rows."""
    stage = Stage(spark)
    elements, parts = fixtures.long_element_parts(spark, sf_dir)
    elements, parts = stage.put("elements", elements), stage.put("parts", parts)
    zones = layers(spark, sf_dir).zones
    split = split_at_zones(elements, zones, STUDY_ID, stage, chunk_rows=64, parts=parts, save=unstored)
    return _rounded(split.ear.select(*EAR), element_size=3)


# lookups, summaries and layers


@query(sql.OVERLAY + sql.parameters() + """
SELECT i.fid AS element_feature_id, CAST(i.zid AS BIGINT) AS hazardzone_feature_id,
  i.elementtype_code, i.processtype_id, CAST(t.vot_passenger AS DOUBLE) AS vot_passenger,
  CAST(t.vot_goods AS DOUBLE) AS vot_goods, p.closure_days, p.repair_per_m, p.reopening_cost
FROM inter i LEFT JOIN element_type t USING (elementtype_code)
  LEFT JOIN process_type p USING (processtype_id)""")
def import_lookup(spark, sf_dir):
    return risk.with_parameters(
        found_intersections(spark, sf_dir), *parameters(spark)
    ).select(
        "element_feature_id",
        "hazardzone_feature_id",
        "elementtype_code",
        "processtype_id",
        "vot_passenger",
        "vot_goods",
        "closure_days",
        "repair_per_m",
        "reopening_cost",
    )


@query(sql.OVERLAY + sql.parameters(without=2) + """
SELECT 'element_type' AS lookup, elementtype_code AS code, count(*) AS n_rows FROM inter
WHERE elementtype_code NOT IN (SELECT elementtype_code FROM element_type) GROUP BY elementtype_code
UNION ALL
SELECT 'process_type', CAST(processtype_id AS VARCHAR), count(*) FROM inter
WHERE processtype_id NOT IN (SELECT processtype_id FROM process_type) GROUP BY processtype_id""")
def lookup_orphans(spark, sf_dir):
    element_type, process_type = parameters(spark)
    (counts,) = counted(spark, sf_dir, risk.CODES, lambda _, rows: risk.code_counts(rows))
    return risk.orphans_of(counts, element_type, process_type.where("processtype_id <> 2"))


@query(sql.RISK + f"""
SELECT CAST(1 AS BIGINT) AS study_id, eid AS element_id, pno AS piece_no, fid AS element_feature_id,
  {sql.ES_COLUMNS} FROM es""")
def element_summary(spark, sf_dir):
    """Of one study of several in the store."""
    summary = stored(spark, sf_dir).element_summary(STUDY_ID, *parameters(spark))
    return _rounded(summary, **ES_DIGITS)


@query(sql.RISK + f"SELECT CAST(1 AS BIGINT) AS study_id, route_code, {sql.RS_COLUMNS} FROM rs")
def route_summary(spark, sf_dir):
    """Of one study of several in the store."""
    summary = stored(spark, sf_dir).route_summary(STUDY_ID, *parameters(spark))
    return _rounded(summary, **RS_DIGITS)


@query(sql.RISK + f"""
SELECT {sql.EAR_COLUMNS}, {sql.ES_COLUMNS} {sql.FROM_EAR} LEFT JOIN es ON es.fid = p.fid""")
def element_summary_layer(spark, sf_dir):
    base = overlay(spark, sf_dir)
    summary = risk.element_summary(base.intersections, *parameters(spark))
    layer = risk.element_layer(base.split.ear.select("study_id", *EAR), summary)
    return _rounded(layer.drop("study_id"), element_size=3, **ES_DIGITS)


@query(sql.RISK + f"""
SELECT {sql.EAR_COLUMNS}, {sql.RS_COLUMNS} {sql.FROM_EAR}
LEFT JOIN rs ON rs.route_code = e.route_code""")
def route_summary_layer(spark, sf_dir):
    base = overlay(spark, sf_dir)
    summary = risk.route_summary(base.intersections, *parameters(spark))
    layer = risk.route_layer(base.split.ear.select("study_id", *EAR), summary)
    return _rounded(layer.drop("study_id"), element_size=3, **RS_DIGITS)


@query(sql.OVERLAY + sql.parameters(closure_days_factor=2.0) + sql.COSTS + f"""
SELECT CAST(1 AS BIGINT) AS study_id, route_code, {sql.RS_COLUMNS} FROM rs""")
def what_if_parameters(spark, sf_dir):
    """Route summary after an edit of a parameter table, over the stored overlay."""
    element_type, process_type = parameters(spark)
    edited = process_type.withColumn("closure_days", F.col("closure_days") * 2)
    pairs = overlay(spark, sf_dir).intersections
    return _rounded(risk.route_summary(pairs, element_type, edited), **RS_DIGITS)


# store


@query(sql.split_sql() + f"""
SELECT CAST(s.study_id AS BIGINT) AS study_id, {sql.EAR_COLUMNS} {sql.FROM_EAR}
CROSS JOIN (VALUES (1), (2)) s(study_id)""")
def ear_output_replace(spark, sf_dir):
    """A second run of study 1 replaces its rows and leaves study 2 as it is."""
    store = _store(spark)
    store.write_ear(found_split(spark, sf_dir).ear.withColumn("study_id", F.lit(2).cast("bigint")))
    # the pieces are stored once for all: study 2 holds the rows that study 1 is to get
    ear = store.ear(2).withColumn("study_id", F.lit(STUDY_ID).cast("bigint"))
    store.write_ear(ear.withColumn("route_code", F.lit("former run")))
    store.write_ear(ear)
    return _rounded(store.ear().select("study_id", *EAR), element_size=3)


@query(sql.OVERLAY + f"""
SELECT CAST(1 AS BIGINT) AS study_id, {sql.INTER_COLUMNS} FROM inter
UNION ALL BY NAME
SELECT * REPLACE (CAST(NULL AS DOUBLE) AS freq_interval_plus,
    CAST(NULL AS DOUBLE) AS freq_interval_minus)
FROM (SELECT CAST(2 AS BIGINT) AS study_id, {sql.INTER_COLUMNS} FROM inter)""")
def import_append(spark, sf_dir):
    """Rows come in by name: a missing field is NULL, an unknown one is ignored."""
    rows = found_intersections(spark, sf_dir)
    store = _store(spark)
    store.append_import(rows.withColumn("remark", F.lit("ignored")))
    second = store.import_table(STUDY_ID).withColumn("study_id", F.lit(2).cast("bigint")).drop(
        "freq_interval_plus", "freq_interval_minus"
    )
    store.append_import(second.toDF(*[c.upper() for c in second.columns]))
    return _rounded(store.import_table(), element_size=3)


@query(sql.OVERLAY + f"""
SELECT CAST(1 AS BIGINT) AS study_id, {sql.INTER_COLUMNS} FROM inter WHERE len >= {MIN_SIZE}
UNION ALL BY NAME
SELECT CAST(2 AS BIGINT) AS study_id, {sql.INTER_COLUMNS} FROM inter""")
def import_replace(spark, sf_dir):
    """A second import of study 1, with a minimum size, replaces the first one."""
    rows = found_intersections(spark, sf_dir)
    store = _store(spark)
    for number in (1, 2):
        store.initiate_study(f"study {number}", "zones", "elements", study_id=number)
        store.append_import(rows.withColumn("study_id", F.lit(number).cast("bigint")))
        store.import_results(number)
        rows = store.intersections(number)
    rows = rows.withColumn("study_id", F.lit(1).cast("bigint"))
    store.initiate_study("study 1, second run", "zones", "elements", study_id="1")
    store.append_import(rows.where(F.col("element_size") >= MIN_SIZE))
    store.import_results(1)
    return _rounded(store.intersections(), element_size=3)


@query("""
WITH first AS (
  SELECT n_nationkey + 1 AS study_id, n_name AS study_name, count(c_custkey) AS n
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name),
second AS (
  SELECT n_nationkey + 1 AS study_id, n_name || ' again' AS study_name, count(*) AS n
  FROM nation JOIN supplier ON s_nationkey = n_nationkey
  GROUP BY n_nationkey, n_name),
rows AS (
  SELECT study_id, study_name, n || ' customers' AS study_description FROM first
    WHERE study_id NOT IN (SELECT study_id FROM second)
  UNION ALL SELECT study_id, study_name, n || ' suppliers' FROM second
  UNION ALL SELECT max(study_id) + 1, 'next free id', NULL FROM first)
SELECT CAST(study_id AS BIGINT) AS study_id, study_name, 'zones' AS hazardzone_dataset_filepath,
  'elements' AS element_dataset_filepath, study_description
FROM rows""")
def study_upsert(spark, sf_dir):
    """Studies per nation; those with suppliers come a second time, one without id."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    text_id = text_to_int(F.expr("CAST(n_nationkey + 1 AS STRING)"))

    def studies(rows, count, name, what):
        return rows.groupBy("n_nationkey", "n_name").agg(count.alias("n")).select(
            text_id.alias("study_id"),
            F.concat("n_name", F.lit(name)).alias("study_name"),
            F.lit("zones").alias("hazardzone_dataset_filepath"),
            F.lit("elements").alias("element_dataset_filepath"),
            F.concat("n", F.lit(what)).alias("study_description"),
        )

    store = _store(spark)
    first = nation.join(customers, F.expr("c_nationkey = n_nationkey"), "left")
    store.register(studies(first, F.count("c_custkey"), "", " customers"))
    second = nation.join(suppliers, F.expr("s_nationkey = n_nationkey"))
    store.register(studies(second, F.count("*"), " again", " suppliers"))
    store.initiate_study("next free id", "zones", "elements", study_id="not a number")
    return store.studies()


@query("""
WITH kind(dataset_type) AS (VALUES ('hazard'), ('element')),
first AS (SELECT n_nationkey + 1 AS study_id, dataset_type, n_name AS path
  FROM nation CROSS JOIN kind),
second AS (SELECT DISTINCT n_nationkey + 1 AS study_id, 'element' AS dataset_type,
    n_name || '/v2' AS path
  FROM nation JOIN supplier ON s_nationkey = n_nationkey)
SELECT CAST(study_id AS BIGINT) AS study_id, dataset_type, path AS dataset_filepath,
  CAST(NULL AS VARCHAR) AS dataset_description
FROM (SELECT * FROM first ANTI JOIN second USING (study_id, dataset_type)
      UNION ALL SELECT * FROM second)""")
def dataset_replace(spark, sf_dir):
    """One dataset per study and type; a further one of the same type replaces it."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    store = _store(spark)
    store.put_datasets(
        nation.selectExpr(
            "n_nationkey + 1 AS study_id",
            "explode(array('hazard', 'element')) AS dataset_type",
            "n_name AS dataset_filepath",
        )
    )
    store.put_datasets(
        nation.join(suppliers, F.expr("s_nationkey = n_nationkey"), "left_semi").selectExpr(
            "n_nationkey + 1 AS study_id",
            "'element' AS dataset_type",
            "concat(n_name, '/v2') AS dataset_filepath",
        )
    )
    return store.datasets()


REPORT = """,
report(check_name, is_error, n_rows) AS (
  SELECT 'rows_imported', false, count(*) FROM inter
  UNION ALL SELECT 'return_period_below_1', false,
    count(*) FILTER (event_frequency < 1) FROM inter
  UNION ALL SELECT 'route_missing', false, count(*) FILTER (route_code IS NULL) FROM inter
  UNION ALL SELECT 'key_missing', true,
    count(*) FILTER (fid IS NULL OR zid IS NULL) FROM inter
  UNION ALL SELECT 'piece_id_overflow', false,
    count(*) FILTER (pno >= 1048576 OR eid < -8796093022208 OR eid >= 8796093022208) FROM piece
  UNION ALL SELECT 'route_with_two_diversion_times', false, count(*) FROM (
    SELECT route_code FROM element JOIN piece ON element_id = eid
    GROUP BY route_code HAVING count(DISTINCT diversion_time) > 1)
  UNION ALL SELECT 'element_type_without_parameters', false, count(*) FROM inter
    WHERE elementtype_code NOT IN (SELECT elementtype_code FROM element_type)
  UNION ALL SELECT 'process_type_without_parameters', false, count(*) FROM inter
    WHERE processtype_id NOT IN (SELECT processtype_id FROM process_type)),
graded AS (SELECT check_name,
  CAST(CASE WHEN is_error AND n_rows > 0 THEN 1 ELSE 0 END AS INTEGER) AS severity,
  CAST(n_rows AS BIGINT) AS n_rows FROM report)
"""


def _report(spark, sf_dir):
    of_pieces, of_pairs = counted(
        spark,
        sf_dir,
        quality.PAIR_COLUMNS,
        lambda split, _: quality.piece_counts(split.ear),
        lambda _, rows: quality.pair_counts(rows),
    )
    return quality.load_report_of(of_pieces, of_pairs, *parameters(spark))


INPUT_REPORT = """,
line AS (
  SELECT CASE WHEN route_code <> 'R3' THEN element_id END AS id,
    element_id IN (SELECT eid FROM seg) AS has_line
  FROM raw_element CROSS JOIN (VALUES (1), (2)) AS v(n) WHERE n = 1 OR route_code = 'R7'),
report(check_name, is_error, n_rows) AS (
  SELECT 'elements_read', false, count(*) FROM line
  UNION ALL SELECT 'elements_without_id', false, count(*) FILTER (id IS NULL) FROM line
  UNION ALL SELECT 'elements_without_line', false, count(*) FILTER (NOT has_line) FROM line
  UNION ALL SELECT 'element_id_repeated', true, count(*) FROM (
    SELECT id FROM line WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)
  UNION ALL SELECT 'zones_read', false, count(*) FROM zone
  UNION ALL SELECT 'zones_without_id', false, 0
  UNION ALL SELECT 'zones_without_area', false, 0
  UNION ALL SELECT 'zone_id_repeated', true, 0
  UNION ALL SELECT 'element_type_repeated', true, 1
  UNION ALL SELECT 'process_type_repeated', true, 0),
failed(check_name, n_rows) AS (
  SELECT 'cast_failed_aadt_goods', count(*) FILTER (aadt_goods >= 100) FROM raw_element
  UNION ALL SELECT 'cast_failed_aadt_passenger', 0
  UNION ALL SELECT 'cast_failed_diversion_time', 0)
SELECT check_name, CAST(CASE WHEN is_error AND n_rows > 0 THEN 1 ELSE 0 END AS INTEGER) AS severity,
  CAST(n_rows AS BIGINT) AS n_rows FROM report
UNION ALL SELECT check_name, 0, CAST(n_rows AS BIGINT) FROM failed"""


@query(sql.INPUT + INPUT_REPORT)
def input_report(spark, sf_dir):
    """All orders, one route twice and one without ids, text in a field of numbers, a type given twice."""
    raw = fixtures.raw_elements(spark, sf_dir)
    number = F.when(F.col("route_code") != "R3", F.col("element_id"))
    lines = raw.unionByName(raw.where("route_code = 'R7'")).withColumn("element_id", number)
    kinds, processes = parameters(spark)
    kinds = kinds.unionByName(kinds.where("elementtype_code = 'EV'"))
    text = raw.withColumn(
        "aadt_goods", F.expr("if(aadt_goods >= 100, 'many', CAST(aadt_goods AS STRING))")
    )
    return quality.input_report(
        bind_elements(lines), bind_zones(fixtures.zones(spark, sf_dir)), kinds, processes
    ).unionByName(quality.failed_casts(text, ELEMENT_FIELDS))


@query(sql.OVERLAY + sql.parameters() + REPORT + "SELECT * FROM graded")
def load_report(spark, sf_dir):
    return _report(spark, sf_dir)


@query(sql.OVERLAY + sql.parameters() + REPORT + """
SELECT max(severity) AS max_severity, max(severity) = 0 AS success FROM graded""")
def load_status(spark, sf_dir):
    return quality.load_status(_report(spark, sf_dir))


@query(sql.RISK + f"""
SELECT {sql.EAR_COLUMNS}, {sql.RS_COLUMNS} {sql.FROM_EAR}
LEFT JOIN rs ON rs.route_code = e.route_code""")
def study_run(spark, sf_dir):
    """A whole study from layer files to the route layer."""
    data = layers(spark, sf_dir)
    result = run_study(
        spark,
        _store(spark),
        "whole study",
        data.zones_path,
        data.elements_path,
        *parameters(spark),
        extent=None,
    )
    layer = result.route_layer.drop("study_id", "geom", "part_no")
    return _rounded(layer, element_size=3, **RS_DIGITS)


@query(sql.split_sql(source=sql.extent_sql(SHIFT)) + sql.PAIRS + """
SELECT check_name, CAST(n_rows AS BIGINT) AS n_rows FROM (
  SELECT 'elements_read' AS check_name, count(*) AS n_rows FROM raw_element
  UNION ALL SELECT 'elements_unusable', count(*) FILTER (element_id NOT IN (SELECT eid FROM seg0)) FROM raw_element
  UNION ALL SELECT 'elements_kept', count(*) FROM element
  UNION ALL SELECT 'elements_outside_extent', (SELECT count(DISTINCT eid) FROM seg0) - (SELECT count(*) FROM element)
  UNION ALL SELECT 'zones_read', count(*) FROM zone0
  UNION ALL SELECT 'zones_kept', count(*) FROM zone
  UNION ALL SELECT 'zones_outside_extent', (SELECT count(*) FROM zone0) - (SELECT count(*) FROM zone)
  UNION ALL SELECT 'rows_imported', count(*) FROM inter)""")
def study_run_extent(spark, sf_dir):
    """A whole study in the common extent of shifted elements and zones: what its report counts."""
    data, stage = layers(spark, sf_dir), Stage(spark)
    result = run_study(
        spark, _store(spark), "shifted", data.zones_path, stage.write("moved", _moved(data.elements)), *parameters(spark)
    )
    names = [f"{layer}_{what}" for layer in ("elements", "zones") for what in ("read", "kept", "outside_extent")]
    return result.report.where(F.col("check_name").isin([*names, "elements_unusable", "rows_imported"])).drop("severity")
