"""Vertex arrays to segments and edges, bounding boxes, lengths and grid cells.

Geometry is two-dimensional: a line is array<struct<x,y>>, a polygon is an array
of rings. Holes and further parts are further rings (even-odd rule).
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell lists are widened by this share of a cell, so that rounding can only add cells.
CELL_SLACK = 1e-6


def _distinct_steps(points: Column) -> Column:
    """Vertices without those that repeat their predecessor."""
    return F.filter(
        points,
        lambda p, i: (i == 0)
        | (p["x"] != F.get(points, i - 1)["x"])
        | (p["y"] != F.get(points, i - 1)["y"]),
    )


def is_multipart(df: DataFrame, geom="geom") -> bool:
    """Whether lines are arrays of parts rather than single vertex arrays."""
    return isinstance(df.schema[geom].dataType.elementType, T.ArrayType)


def parts_of(df: DataFrame, geom="geom") -> str:
    """SQL for the parts of each line, NULL parts left out; NULL where there is no geometry."""
    if is_multipart(df, geom):
        return f"filter({geom}, part -> part IS NOT NULL)"
    return f"if({geom} IS NULL, NULL, array({geom}))"


def segments(elements: DataFrame, id_col="element_id", geom="geom") -> DataFrame:
    """One row per segment of positive length: eid, n_seg, sn, part_no, x1..y2.

    sn is dense from 0 over all parts of a line; part_first and part_last mark the ends of a
    part. The geometry lies in one row, so numbering needs no shuffle.
    """
    parts = F.transform(F.expr(parts_of(elements, geom)), _distinct_steps)
    of_part = F.transform(
        "parts",
        lambda pts, part: F.transform(
            F.slice(pts, F.lit(1), F.greatest(F.size(pts) - 1, F.lit(0))),
            lambda p, i: F.struct(
                part.cast("int").alias("part_no"),
                (i == 0).alias("part_first"),
                (i == F.size(pts) - 2).alias("part_last"),
                p["x"].alias("x1"),
                p["y"].alias("y1"),
                F.get(pts, i + 1)["x"].alias("x2"),
                F.get(pts, i + 1)["y"].alias("y2"),
            ),
        ),
    )
    lines = elements.select(F.col(id_col).cast("bigint").alias("eid"), parts.alias("parts")).select(
        "eid", F.flatten(of_part).alias("segs")
    )
    # per-element values first, so that the vertex array is not copied to every segment
    return lines.select("eid", F.size("segs").alias("n_seg"), F.posexplode("segs").alias("sn", "seg")).select(
        "eid", "n_seg", "sn", "seg.*"
    )


def segments_of_parts(parts: DataFrame, stage) -> DataFrame:
    """The rows of segments() from a row per part (element_id, part_key, geom), in order of part_key.

    For elements with more parts than one row should hold. The parts are range-partitioned and
    numbered within each partition, and the counts of the partitions before are added, so no group
    grows with an element.
    """
    held = stage.put(
        "parts",
        parts.where("geom IS NOT NULL")
        .withColumn("pts", _distinct_steps(F.col("geom")))
        .withColumn("n", F.greatest(F.size("pts") - 1, F.lit(0)))
        .select(F.col("element_id").cast("bigint").alias("eid"), "part_key", "pts", "n")
        .repartitionByRange("eid", "part_key")
        .sortWithinPartitions("eid", "part_key")
        .withColumn("line", F.monotonically_increasing_id())
        .withColumn("run", F.spark_partition_id()),
    )
    runs = held.groupBy("eid", "run").agg(F.count("*").alias("n_parts"), F.sum("n").alias("n_segs"))
    all_runs = Window.partitionBy("eid")
    before = all_runs.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    past = runs.select(
        "eid",
        "run",
        F.coalesce(F.sum("n_parts").over(before), F.lit(0)).alias("past_parts"),
        F.coalesce(F.sum("n_segs").over(before), F.lit(0)).alias("past_segs"),
        F.sum("n_segs").over(all_runs).alias("n_seg"),
    )
    here = Window.partitionBy("eid", "run").orderBy("line")
    sooner = here.rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        held.withColumn("parts_here", F.row_number().over(here) - 1)
        .withColumn("segs_here", F.coalesce(F.sum("n").over(sooner), F.lit(0)))
        .join(past, ["eid", "run"])
        .select(
            "eid",
            F.col("n_seg").cast("int").alias("n_seg"),
            (F.col("past_segs") + F.col("segs_here")).alias("first"),
            (F.col("past_parts") + F.col("parts_here")).cast("int").alias("part_no"),
            "pts",
            "n",
        )
    )
    steps = F.expr(
        "transform(slice(pts, 1, n), (p, i) -> named_struct('part_first', i = 0, 'part_last', i = n - 1,"
        " 'x1', p.x, 'y1', p.y, 'x2', get(pts, i + 1).x, 'y2', get(pts, i + 1).y))"
    )
    return (
        numbered.where("n > 0")
        .select("eid", "n_seg", "first", "part_no", F.posexplode(steps).alias("i", "seg"))
        .select("eid", "n_seg", F.expr("CAST(first + i AS INT) AS sn"), "part_no", "seg.*")
    )


def edges(zones: DataFrame, id_col="zone_id", geom="geom") -> DataFrame:
    """One row per ring edge of positive length: zid, edge_mean, ring, k, x1..y2.

    Open rings are closed. edge_mean is the mean extent of the zone's edges.
    """
    extents = (
        f"flatten(transform({geom}, r -> transform(r, (p, i) -> greatest("
        "abs(get(r, (i + 1) % size(r)).x - p.x), abs(get(r, (i + 1) % size(r)).y - p.y)))))"
    )
    total = f"aggregate({extents}, 0D, (total, e) -> total + e)"
    ring = zones.select(
        F.col(id_col).cast("bigint").alias("zid"),
        F.col(geom).alias("rings"),
        F.expr(f"{total} / size(flatten({geom}))").alias("edge_mean"),
    ).select("zid", "edge_mean", F.posexplode("rings").alias("ring", "pts"))
    rows = F.transform(
        "pts",
        lambda p, i: F.struct(
            i.alias("k"),
            p["x"].alias("x1"),
            p["y"].alias("y1"),
            F.get(F.col("pts"), (i + 1) % F.size("pts"))["x"].alias("x2"),
            F.get(F.col("pts"), (i + 1) % F.size("pts"))["y"].alias("y2"),
        ),
    )
    return ring.select("zid", "edge_mean", "ring", F.inline(rows)).where("x1 <> x2 OR y1 <> y2")


def bbox(points: Column) -> Column:
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def dbl(value: float) -> str:
    """SQL literal of type double; a plain 1.5 would be a decimal."""
    return f"{float(value)!r}D"


def x_at(y: str) -> str:
    """x where the line through (x1,y1),(x2,y2) has the given y, kept inside the segment."""
    return (
        f"greatest(least(x1, x2), least(greatest(x1, x2), "
        f"x1 + (({y}) - y1) * (x2 - x1) / nullif(y2 - y1, 0)))"
    )


def _columns_in_row(g: str, eps: str) -> tuple[str, str]:
    """First and last grid column the segment meets within grid row gy."""
    lo = f"greatest(least(y1, y2), gy * {g} - {eps})"
    hi = f"least(greatest(y1, y2), (gy + 1) * {g} + {eps})"
    left = f"coalesce(least({x_at(lo)}, {x_at(hi)}), least(x1, x2))"
    right = f"coalesce(greatest({x_at(lo)}, {x_at(hi)}), greatest(x1, x2))"
    return (
        f"floor((if(y1 = y2, least(x1, x2), {left}) - {eps}) / {g})",
        f"floor((if(y1 = y2, greatest(x1, x2), {right}) + {eps}) / {g})",
    )


def explode_rows(df: DataFrame, cell: str, slack: float = 0.0) -> DataFrame:
    """One row per grid row met by the segment: adds gy and the column range gx_a..gx_b.

    cell is the cell size, a SQL literal or column. With slack, cells within that distance
    count as met.
    """
    eps = f"greatest({cell} * {dbl(CELL_SLACK)}, {dbl(slack)})"
    first = f"floor((least(y1, y2) - {eps}) / {cell})"
    last = f"floor((greatest(y1, y2) + {eps}) / {cell})"
    span = df.withColumn("gy", F.expr(f"explode(sequence({first}, {last}))"))
    gx_a, gx_b = _columns_in_row(cell, eps)
    return span.withColumn("gx_a", F.expr(gx_a)).withColumn("gx_b", F.expr(gx_b))


def explode_cells(df: DataFrame, size: float, slack: float = 0.0) -> DataFrame:
    """One row per grid cell met by the segment (gx, gy); linear in the segment's length."""
    return (
        explode_rows(df, dbl(size), slack)
        .withColumn("gx", F.expr("explode(sequence(gx_a, gx_b))"))
        .drop("gx_a", "gx_b")
    )


def explode_sub_cells(df: DataFrame, size: float, slack: float = 0.0) -> DataFrame:
    """Replaces cell (gx, gy) by the 2^k by 2^k cells of it that the segment meets."""
    cell, eps = f"({dbl(size)} / shiftleft(1, k))", dbl(max(size * CELL_SLACK, slack))
    rows = (
        df.withColumnsRenamed({"gx": "bx", "gy": "by"})
        .withColumn("lo", F.expr(f"greatest(floor((least(y1, y2) - {eps}) / {cell}), shiftleft(by, k))"))
        .withColumn(
            "hi",
            F.expr(f"least(floor((greatest(y1, y2) + {eps}) / {cell}), shiftleft(by + 1, k) - 1)"),
        )
        .where("lo <= hi")
        .withColumn("gy", F.expr("explode(sequence(lo, hi))"))
    )
    gx_a, gx_b = _columns_in_row(cell, eps)
    return (
        rows.withColumn("lo", F.expr(f"greatest({gx_a}, shiftleft(bx, k))"))
        .withColumn("hi", F.expr(f"least({gx_b}, shiftleft(bx + 1, k) - 1)"))
        .where("lo <= hi")
        .withColumn("gx", F.expr("explode(sequence(lo, hi))"))
        .drop("lo", "hi", "bx", "by")
    )
