"""Elements split at their cuts: numbering, lengths and geometry of the pieces.

Segment starts and cuts are the rows of a line. An element of usual size is numbered in one
group. One with more than chunk_rows rows is numbered in chunks of that many rows, whether they
are segments or cuts: its rows are range-partitioned, ranked by the counts of the partitions
before, and cut into chunks by rank; each chunk carries where the next one starts, and piece
numbers add up the cuts of the chunks before. Both kinds go through one plan.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazline.session import Stage

# Fixed layout of the short piece id: source id in the high bits, piece number below.
PIECE_BITS = 20
# Rows of one element that are numbered in one group.
CHUNK_ROWS = 65_536

_LEN = "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
_HEAD = ["h_t", "h_x1", "h_y1", "h_x2", "h_y2"]
_SEGMENT = ["part_no", "x1", "y1", "x2", "y2"]
_VALUES = [*_SEGMENT, "cut"]
_KEY = ["eid", "chunk"]
# The middle of a piece's longest stretch stands for the piece: farthest from any boundary.
_INNER = (
    f"struct((t2 - t) * {_LEN} AS len, -sn AS sn, -t AS at, (t + t2) / 2 AS h_t,"
    " x1 AS h_x1, y1 AS h_y1, x2 AS h_x2, y2 AS h_y2)"
)


def _rows(seg: DataFrame, cuts: DataFrame) -> DataFrame:
    """Segment starts and cuts; a further part of a line starts a piece like a cut."""
    columns = ["eid", "sn", "part_no", "x1", "y1", "x2", "y2"]
    part = "CAST(part_first AND sn > 0 AS INT) AS cut"
    return seg.selectExpr(*columns, "0D AS t", part).unionByName(
        cuts.selectExpr(*columns, "t", "1 AS cut")
    )


def long_elements(seg: DataFrame, cuts: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Elements (eid) with more rows than a chunk."""
    cut = cuts.groupBy("eid").agg(F.count("*").alias("n_cut"), F.max("n_seg").alias("n_seg"))
    line = seg.where((F.col("sn") == 0) & (F.col("n_seg") > chunk_rows))
    both = cut.unionByName(line.select("eid", F.lit(0).cast("bigint").alias("n_cut"), "n_seg"))
    rows = both.groupBy("eid").agg((F.sum("n_cut") + F.max("n_seg")).alias("n_rows"))
    return rows.where(F.col("n_rows") > chunk_rows).select("eid")


def _merged(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key, "sn", "t").agg(*[F.max(c).alias(c) for c in _VALUES])


def chunked_rows(rows: DataFrame, stage: Stage, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows with their chunk, from 1, of at most chunk_rows, and t_end, where its last one ends."""
    line = ["eid", "sn", "t"]
    held = stage.put(
        "long_rows",
        _merged(rows, "eid")
        .repartitionByRange(*line)
        .sortWithinPartitions(*line)
        .withColumn("line", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id()),
    )
    # a row per element and partition that holds some of it
    before = Window.partitionBy("eid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        held.groupBy("eid", "part")
        .agg(F.min("line").alias("first"), F.count("*").alias("n"))
        .select("eid", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("past"))
    )
    rank = F.col("line") - F.col("first") + F.col("past")
    ranked = held.join(runs, ["eid", "part"]).withColumn("chunk", 1 + F.floor(rank / chunk_rows))
    # a row per chunk
    following = F.lead("here").over(Window.partitionBy("eid").orderBy("chunk"))
    borders = (
        ranked.groupBy(*_KEY)
        .agg(F.min(F.struct("sn", "t")).alias("here"))
        .select(*_KEY, following.alias("next"))
    )
    t_end = F.when(F.col("next.sn") == F.col("sn"), F.col("next.t")).otherwise(F.lit(1.0))
    return ranked.join(borders, _KEY).select(*_KEY, "sn", "t", *_VALUES, t_end.alias("t_end"))


def _sub_segments(rows: DataFrame) -> DataFrame:
    """Stretches t..t2 of segments between neighbouring cuts and vertices.

    lp counts the cuts of the chunk up to the stretch. A cut lies on the segment whose start comes
    before it in the chunk; only where that start is in a former chunk it has to bring its segment
    along. One shuffle, on the chunk.
    """
    line = Window.partitionBy(*_KEY).orderBy("sn", "t")
    past = line.rowsBetween(Window.unboundedPreceding, 0)
    same = F.lead("sn").over(line) == F.col("sn")
    own = F.struct(*_SEGMENT)
    start = F.last(F.when(F.col("t") == 0, own), ignorenulls=True).over(past)
    return (
        rows.withColumn("lp", F.sum("cut").over(past))
        .withColumn("t2", F.coalesce(F.when(same, F.lead("t").over(line)), "t_end"))
        .withColumn("segment", F.coalesce(start, own))
        .drop(*_SEGMENT)
        .select("*", "segment.*")
        .drop("segment")
    )


def _parts(sub: DataFrame, geometry: bool) -> DataFrame:
    """One row per piece and chunk: length, longest stretch, stretches."""
    measures = [
        F.sum(F.expr(f"(t2 - t) * {_LEN}")).alias("length"),
        F.max("part_no").alias("part_no"),
        F.max(F.expr(_INNER)).alias("inner"),
    ]
    if geometry:
        stretch = F.expr(
            "struct(sn, t, x1 + t * (x2 - x1) AS x, y1 + t * (y2 - y1) AS y,"
            " if(t2 = 1, x2, x1 + t2 * (x2 - x1)) AS xe, if(t2 = 1, y2, y1 + t2 * (y2 - y1)) AS ye)"
        )
        measures.append(F.collect_list(stretch).alias("stretches"))
    return sub.groupBy(*_KEY, "lp").agg(*measures)


def _joined_chunks(parts: DataFrame, geometry: bool) -> DataFrame:
    """Numbers the pieces of chunked elements across chunks and joins what a chunk border split."""
    order = Window.partitionBy("eid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = (
        parts.groupBy(*_KEY)
        .agg(F.max("lp").alias("n"))
        .select(*_KEY, F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    )
    measures = [
        F.sum("length").alias("length"),
        F.max("part_no").alias("part_no"),
        F.max("inner").alias("inner"),
    ]
    if geometry:
        measures.append(F.flatten(F.collect_list("stretches")).alias("stretches"))
    return (
        parts.join(offset, _KEY)
        .withColumn("piece_no", F.col("lp") + F.col("before"))
        .groupBy("eid", "piece_no")
        .agg(*measures)
    )


def split_lines(
    seg: DataFrame,
    cuts: DataFrame,
    stage: Stage,
    geometry: bool = True,
    chunk_rows: int = CHUNK_ROWS,
    attributes: DataFrame | None = None,
) -> DataFrame:
    """Pieces (eid, piece_no from 0 over all parts, part_no, length, inner-point columns h_*, geom).

    Those of an element of usual size come from one shuffle, by eid; attributes, rows by eid, are
    joined to them where they lie.
    """
    cuts = stage.put("cuts", cuts)
    long = stage.put("long_elements", long_elements(seg, cuts, chunk_rows))
    # all rows of an element meet, so a cut need not carry its segment
    bare = cuts.withColumns({c: F.lit(None).cast(cuts.schema[c].dataType) for c in _SEGMENT})
    whole = _rows(*(side.join(long, "eid", "left_anti") for side in (seg, bare)))
    whole = _merged(whole.repartition("eid"), "eid").withColumn("chunk", F.lit(0))
    single = _parts(_sub_segments(whole.withColumn("t_end", F.lit(1.0))), geometry)
    rows = _rows(*(side.join(long, "eid", "left_semi") for side in (seg, cuts)))
    chunks = chunked_rows(rows, stage, chunk_rows)
    parts = stage.put("long_parts", _parts(_sub_segments(chunks.repartition(*_KEY)), geometry))
    single = single.withColumnRenamed("lp", "piece_no").drop("chunk")
    both = [single, _joined_chunks(parts, geometry)]
    if attributes is not None:
        both = [side.join(attributes, "eid") for side in both]
    pieces = both[0].unionByName(both[1])
    pieces = pieces.select("*", *[f"inner.{name}" for name in _HEAD]).drop("inner")
    if not geometry:
        return pieces
    ordered = pieces.withColumn("stretches", F.array_sort("stretches"))
    vertices = F.transform(
        "stretches", lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"))
    )
    last = F.element_at("stretches", -1)
    end = F.array(F.struct(last["xe"].alias("x"), last["ye"].alias("y")))
    return ordered.withColumn("geom", F.concat(vertices, end)).drop("stretches")


def piece_id(source="eid", number="piece_no", bits: int = PIECE_BITS):
    """element_feature_id: a short number for one column; NULL where id_overflow() holds.

    (element_id, piece_no) is the key of a piece, whatever their range.
    """
    short = F.shiftleft(F.col(source).cast("bigint"), bits) + F.col(number)
    return F.when(~id_overflow(source, number, bits), short.cast("bigint"))


def id_overflow(source="element_id", number="piece_no", bits: int = PIECE_BITS):
    """Whether element id and piece number do not fit one number."""
    return (
        (F.col(number) >= F.lit(1 << bits))
        | (F.col(source) < F.lit(-(1 << (63 - bits))))
        | (F.col(source) >= F.lit(1 << (63 - bits)))
    )
