"""Where boundaries cut the element segments, exactly or within a coordinate tolerance.

With a tolerance, a boundary cuts a segment that it meets or misses by no more than it. Where
one runs along the other within the tolerance, the boundary's ends cut, not the ill-conditioned
crossing. Cuts within the tolerance of a vertex move onto it, cuts that follow each other within
it along a segment are one (the first), and vertices that follow each other within it are one
place; at an element's or part's end such a place gives no cut. So no piece is shorter than the
tolerance unless its part is.
"""

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazline.functions.geometry import CELL_SLACK, dbl, explode_cells, explode_sub_cells

# A cell with more boundaries than this is refined.
DENSE_CELL = 512
# Up to so many dense cells are a broadcast list, more are joined like any table.
MOST_DENSE = 4096
_MAX_REFINEMENT = 12
# Pairs of a segment and a boundary tried by one task.
TASK_PAIRS = 10_000_000

_KEY = ["qx", "qy", "px", "py"]

# r = segment direction, s = edge direction
_CROSS = "(x2 - x1) * (py - qy) - (y2 - y1) * (px - qx)"
_T = "((qx - x1) * (py - qy) - (qy - y1) * (px - qx)) / nullif(d, 0)"
_U = "((qx - x1) * (y2 - y1) - (qy - y1) * (x2 - x1)) / nullif(d, 0)"
_LINE = "(qx - x1) * (y2 - y1) - (qy - y1) * (x2 - x1) = 0"
_RR = "((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
_T_Q = f"((qx - x1) * (x2 - x1) + (qy - y1) * (y2 - y1)) / {_RR}"
_LINE_Q = "((qx - x1) * (y2 - y1) - (qy - y1) * (x2 - x1))"
_LINE_P = "((px - x1) * (y2 - y1) - (py - y1) * (x2 - x1))"
_EDGE_A = "((x1 - qx) * (py - qy) - (y1 - qy) * (px - qx))"
_EDGE_B = "((x2 - qx) * (py - qy) - (y2 - qy) * (px - qx))"
_SS = "((px - qx) * (px - qx) + (py - qy) * (py - qy))"
_T_P = f"((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / {_RR}"


def boundaries(edge: DataFrame, seg: DataFrame | None = None) -> DataFrame:
    """Distinct boundary geometries q-p, whatever number of zones or elements share them.

    owner_lo/owner_hi are the least and greatest element a geometry belongs to, NULL
    for zone edges: a segment is cut by every zone edge, and by another element's
    segment but never by its own element's.
    """
    swap = "(x1 > x2 OR (x1 = x2 AND y1 > y2))"
    ends = [
        f"if({swap}, x2, x1) AS qx",
        f"if({swap}, y2, y1) AS qy",
        f"if({swap}, x1, x2) AS px",
        f"if({swap}, y1, y2) AS py",
    ]
    lines = edge.selectExpr(*ends, "true AS is_zone", "CAST(NULL AS BIGINT) AS owner")
    if seg is not None:
        lines = lines.unionByName(seg.selectExpr(*ends, "false AS is_zone", "eid AS owner"))
    return lines.groupBy(*_KEY).agg(
        F.max("is_zone").alias("is_zone"),
        F.min("owner").alias("owner_lo"),
        F.max("owner").alias("owner_hi"),
    )


def dense_cells(cells: DataFrame) -> DataFrame | None:
    """(gx, gy, k) of the cells to be refined 2^k by 2^k, None where there are none."""
    counts = cells.groupBy("gx", "gy").agg(F.count("*").alias("n"))
    level = F.ceil(F.log2(F.col("n") / DENSE_CELL) / 2) + 2
    dense = counts.where(F.col("n") > DENSE_CELL).select(
        "gx", "gy", F.least(level, F.lit(_MAX_REFINEMENT)).cast("int").alias("k")
    )
    few = dense.limit(MOST_DENSE + 1).collect()
    if len(few) > MOST_DENSE:
        return dense
    return F.broadcast(cells.sparkSession.createDataFrame(few, dense.schema)) if few else None


def _refine(cells: DataFrame, dense: DataFrame, size: float, slack: float) -> DataFrame:
    return explode_sub_cells(
        cells.join(dense, ["gx", "gy"], "left").withColumn(
            "k", F.coalesce("k", F.lit(0))
        ),
        size,
        slack,
    )


def _dealt(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame, list[str], int]:
    """Both sides, the columns that deal hot cells, and the tasks for all pairs to be tried.

    A cell of more pairs than a task is to try is dealt by element, its boundaries to every share.
    """
    key = ["gx", "gy"]
    counts = [
        cells.groupBy(*key).agg(F.count("*").cast("double").alias(name))
        for cells, name in ((left, "n_left"), (right, "n_right"))
    ]
    shares = F.ceil(F.col("n_left") * F.col("n_right") / TASK_PAIRS)
    pairs = counts[0].join(counts[1], key).withColumn("shares", shares)
    row = pairs.agg(F.sum(F.expr("n_left * n_right")).alias("n"), F.max("shares").alias("most")).first()
    tasks = ceil((row["n"] or 0.0) / TASK_PAIRS)
    if (row["most"] or 1) == 1:
        return left, right, [], tasks
    hot = pairs.where("shares > 1").select(*key, "shares")
    left, right = (cells.join(hot, key, "left") for cells in (left, right))
    share = F.expr("coalesce(pmod(hash(eid), shares), 0)")
    each = F.expr("explode(sequence(0L, coalesce(shares - 1, 0L)))")
    left, right = left.withColumn("share", share), right.withColumn("share", each)
    return left.drop("shares"), right.drop("shares"), ["share"], tasks


def _in_own_cell(size: float) -> str:
    """Whether the cell is the one in which the cut lies; both sides are listed there.

    Cuts off their boundary's box, where a line runs so near to parallel that rounding moves them,
    are taken wherever they are found.
    """
    x, y = ("if(t = 1, {0}2, {0}1 + t * ({0}2 - {0}1))".format(c) for c in "xy")
    cell, eps = f"({dbl(size)} / shiftleft(1, k))", dbl(size * CELL_SLACK / 2)
    stray = (
        f"NOT ({x} BETWEEN qx - {eps} AND px + {eps}"
        f" AND {y} BETWEEN least(qy, py) - {eps} AND greatest(qy, py) + {eps})"
    )
    return f"(floor({x} / {cell}) = gx AND floor({y} / {cell}) = gy) OR {stray}"


def _exact_hits(met: DataFrame, size: float) -> DataFrame:
    return (
        met.withColumn("d", F.expr(_CROSS))
        .where(f"(d <> 0 AND {_T} BETWEEN 0 AND 1 AND {_U} BETWEEN 0 AND 1) OR (d = 0 AND {_LINE})")
        .withColumn("t", F.expr(f"explode(if(d <> 0, array({_T}), array({_T_Q}, {_T_P})))"))
        # the start of a further part is one by itself, and lies elsewhere
        .where("t BETWEEN 0 AND 1 AND (t < 1 OR NOT part_last)")
        .where(_in_own_cell(size))
    )


def _near_hits(met: DataFrame, tolerance: float) -> DataFrame:
    """Hits within the tolerance; those near a vertex lie on it, the rest are one per place."""
    tol = dbl(tolerance)
    near_q, near_p = (f"abs({line}) <= {tol} * len" for line in (_LINE_Q, _LINE_P))
    along = (
        f"(({near_q} AND {near_p})"
        f" OR (abs({_EDGE_A}) <= {tol} * edge_len AND abs({_EDGE_B}) <= {tol} * edge_len))"
    )
    crossing = f"if({_U} * edge_len BETWEEN -{tol} AND edge_len + {tol}, {_T}, NULL)"
    hit = (
        met.withColumn("d", F.expr(_CROSS))
        .withColumn("len", F.expr(f"sqrt({_RR})"))
        .withColumn("edge_len", F.expr(f"sqrt({_SS})"))
        .withColumn(
            "t",
            F.expr(
                f"explode(if({along}, array(if({near_q}, {_T_Q}, NULL), if({near_p}, {_T_P}, NULL)),"
                f" array({crossing})))"
            ),
        )
        .where(f"t * len BETWEEN -{tol} AND len + {tol}")
        .withColumn("t", F.expr(f"if(t * len <= {tol}, 0D, if((1 - t) * len <= {tol}, 1D, t))"))
    )
    # the first cut of each stretch of a tolerance's length, then of each run of such cuts
    columns = [c for c in hit.columns if c in _SEGMENT or c == "len"]
    first = hit.groupBy(*columns, F.floor(F.col("t") * F.col("len") / tolerance).alias("place")).agg(
        F.min("t").alias("t"), F.max("t").alias("t_last")
    )
    line = Window.partitionBy("eid", "sn").orderBy("t")
    gap = (F.col("t") - F.lag("t_last").over(line)) * F.col("len")
    inner = F.col("t").between(F.lit(1e-300), F.lit(1 - 2**-53))
    runs = first.where(inner).withColumn("gap", gap).where(F.col("gap").isNull() | (F.col("gap") > tolerance))
    ends = first.where(~inner)
    return ends.unionByName(runs.drop("gap"))


def _anchors(seg: DataFrame, tolerance: float) -> DataFrame:
    """Vertices that follow others within the tolerance: (eid, sn, anchor), NULL for no cut."""
    short = seg.withColumn("len", F.expr(f"sqrt({_RR})")).where(F.col("len") <= tolerance)
    order = Window.partitionBy("eid", "part_no").orderBy("sn")
    run = Window.partitionBy("eid", "part_no", "run")
    runs = short.withColumn("run", F.col("sn") - F.row_number().over(order)).select(
        "eid",
        "sn",
        F.min("sn").over(run).alias("first"),
        (F.max("part_last").over(run) | F.max("part_first").over(run)).alias("at_end"),
    )
    anchor = F.when(~F.col("at_end"), F.col("first")).alias("anchor")
    after = runs.select("eid", (F.col("sn") + 1).alias("sn"), anchor)
    before = runs.where("sn = first AND at_end").select("eid", "sn", anchor)
    return after.unionByName(before)


_CELL = ["gx", "gy", "k"]
_TASK = [*_CELL, "share"]
_SEGMENT = ["eid", "n_seg", "sn", "part_no", "x1", "y1", "x2", "y2"]


def cut_points(
    seg: DataFrame,
    boundary: DataFrame,
    size: float,
    tolerance: float = 0.0,
    cells: bool = False,
) -> DataFrame:
    """Cuts (eid, sn, t) with 0 <= t < 1, at the segment that starts at or holds the cut.

    Both sides meet on the grid cell, an equality key. A cell that holds many boundaries is
    refined until its cells are as full as others, so the pairs tried stay in proportion to the
    segments. Without a tolerance a cut is taken in the cell in which it lies, so equal cuts,
    where several boundaries meet a line in one place, are found in one cell; the caller merges
    them. With cells, the rows tell that cell, and merged_cuts needs no further shuffle.
    """
    left = explode_cells(seg.select(*_SEGMENT, "part_last"), size, tolerance)
    right = explode_cells(
        boundary.withColumnsRenamed({"qx": "x1", "qy": "y1", "px": "x2", "py": "y2"}),
        size,
        tolerance,
    )
    key = ["gx", "gy"]
    dense = dense_cells(right)
    left, right, share, tasks = _dealt(left, right)
    if dense is not None:
        left, right = (_refine(cells, dense, size, tolerance) for cells in (left, right))
        key = _CELL
    key = [*key, *share]
    if tasks > int(seg.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        left, right = (cells.repartition(tasks, *key) for cells in (left, right))
    right = right.withColumnsRenamed({"x1": "qx", "y1": "qy", "x2": "px", "y2": "py"})
    # Both sides grow with the data, and an exploded side is larger than the planner thinks:
    # sort-merge, whose hot cells adaptive execution splits.
    tol = dbl(tolerance)
    met = left.join(right.hint("merge"), key).where(
        f"least(x1, x2) <= px + {tol} AND greatest(x1, x2) >= qx - {tol}"
        f" AND least(y1, y2) <= greatest(qy, py) + {tol}"
        f" AND greatest(y1, y2) >= least(qy, py) - {tol}"
        " AND (is_zone OR owner_lo <> eid OR owner_hi <> eid)"
    )
    if dense is None:
        met = met.withColumn("k", F.lit(0))
    if not share:
        met = met.withColumn("share", F.lit(0))
    own = _TASK if cells and not tolerance else []
    hit = _near_hits(met, tolerance) if tolerance else _exact_hits(met, size)
    # t = 1 is the start of the next segment; neither end of the element is a cut.
    cuts = hit.selectExpr(
        "eid",
        "n_seg",
        "if(t = 1, sn + 1, sn) AS sn",
        "if(t = 1, 0D, t) AS t",
        *[f"if(t = 1, NULL, {c}) AS {c}" for c in ("part_no", "x1", "y1", "x2", "y2")],
        *own,
    ).where("sn < n_seg AND (sn > 0 OR t > 0)")
    if not tolerance:
        return cuts
    near = _anchors(seg, tolerance)
    moved = cuts.where("t = 0").join(near.withColumn("moved", F.lit(True)), ["eid", "sn"], "left")
    return cuts.where("t > 0").unionByName(
        moved.where("moved IS NULL OR anchor > 0").selectExpr(
            "eid",
            "n_seg",
                "if(moved, anchor, sn) AS sn",
            "t",
            *[f"if(moved, NULL, {c}) AS {c}" for c in ("part_no", "x1", "y1", "x2", "y2")],
        )
    )


def merged_cuts(cuts: DataFrame) -> DataFrame:
    """(eid, sn, t) of each cut once.

    Equal cuts lie in one cell, on which they were joined: they meet in the task that found them,
    and the cuts, which grow with the product of both layers, are not shuffled.
    """
    task = [c for c in _TASK if c in cuts.columns]
    return cuts.select(*task, "eid", "sn", "t").distinct().select("eid", "sn", "t")
