"""Small helpers of the operators: tables, stages, Arrow batches, CRCs."""

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import cache, wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.session import Stage

__all__ = ["SLICE", "Stage", "bigint", "lean", "read", "shared", "slices", "texts", "utf8"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as a long, text with NULL read as empty, and the columns asked for; others are left behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def utf8(text) -> bytes:
    """Bytes of a text as Spark holds it."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def bigint(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


# bytes of text that are encoded in one step
SLICE = 6 << 20


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20):
    """Row ranges of a batch that hold about `limit` bytes of a column each, so that
    work space per step does not follow the batch; a longer text is a step of its own."""
    array = batch.column(column)
    lengths = pc.binary_length(array).fill_null(0).to_pylist()
    start = size = 0
    for row, length in enumerate(lengths):
        if size and size + length > limit:
            yield start, row
            start, size = row, 0
        size += length
    if start < len(lengths):
        yield start, len(lengths)


@cache
def _trim() -> Callable | None:
    """The C library's call that gives freed memory back, None where it has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def release() -> None:
    """Gives freed memory back to the system; allocators keep it for a process otherwise."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def lean(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A function for mapInArrow whose task leaves no freed memory behind: a worker outlives its tasks
    and stages, and stands idle beside those that need none."""

    @wraps(run)
    def whole(batches):
        yield from run(batches)
        release()

    return whole


_SHARED: dict[str, dict] = {}


def shared(kind: str, key, make: Callable):
    """What `make` makes, once per key and worker process. Caches of one kind at a time: those of
    another, left by a former step, are dropped."""
    if kind not in _SHARED:
        _SHARED.clear()
        release()
    held = _SHARED.setdefault(kind, {})
    if key not in held:
        held[key] = make()
    return held[key]
