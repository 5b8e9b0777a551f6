"""Shards that all hold the mixture of the whole: proportional stratified interleaving.

Rows of each source get a seeded random order; the row of rank r among n rows stands at
(2r - 1) / 2n on a common line from 0 to 1, and the line is cut into pieces of equally many
rows. So any shard holds each source's rows within one of its share, and row counts differ
by one at most (the `rows` law).

Ranks in a source and on the common line come from range partitionings (`ranks`), so neither
a large source nor many small ones, whose rows share few places on the line, end up in one task;
rows at one place follow their draw. Texts travel in no shuffle.

NULL sources form a source of their own, NULL texts count as no bytes, rows that repeat an
id are ordered by checksum and size and get a slot each, an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazline.llm.common import Stage
from hazline.llm.ranks import positions

def shard_rows(
    spark: SparkSession,
    docs: DataFrame,
    shards: int,
    seed: int = 1,
    stage: Stage | None = None,
    size: Column | None = None,
) -> DataFrame:
    """doc_id, source, size, text_crc32, shard (from 0) and slot (gapless from 0 within it)."""
    if shards < 1:
        raise ValueError("at least one shard")
    stage = stage or Stage(spark)
    text = F.col("text").cast("string")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")).alias("stratum"),
        (size if size is not None else F.coalesce(F.octet_length(text), F.lit(0)) + 1)
        .cast("long")
        .alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("draw", F.xxhash64(F.lit(seed), "stratum", "doc_id", "text_crc32"))
    ties = ["draw", "doc_id", "text_crc32", "size"]
    own = positions(stage, "own", stage.put("slim", slim), "stratum", ties)
    place = ((2 * F.col("at") + 1) / (2 * F.col("n"))).alias("place")
    line = own.select(*slim.columns, place, F.lit(0).alias("line_no"))
    placed = positions(stage, "line", line, "line_no", ["place", "draw", "stratum", *ties[1:]])
    # in integers: shard k starts at row ceil(k * n / shards)
    shard = F.expr(f"(at * {shards}L) div n")
    start = F.expr(f"(shard * n + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        F.when(F.col("stratum") != "-", F.expr("substr(stratum, 2)")).alias("source"),
        "size",
        "text_crc32",
        F.col("shard").cast("int").alias("shard"),
        (F.col("at") - start).alias("slot"),
    )
