"""Token ids as length-delimited binary records with a separate offset index.

A record is `length (u64) | masked crc of the length | payload | masked crc of the payload`,
all little-endian, where the payload is the document id (i64), the width of an id in bytes
(u8: 2 where every id of the record is below 2^16, else 4) and its token ids. The masked checksum is `rotate_right(crc32, 15) + 0xA282EAD8` modulo 2^32, so that a checksum
stored inside data that is itself checksummed does not defeat the outer one.

Writing: rows are range-partitioned by document id, so files follow each other in that
order, and each task streams one file to the shared folder. A file's name is new for each
attempt and the index alone says which files count: a task that is lost, or runs twice,
leaves a file that no index row names. The index goes through Spark's own commit.

Reading: index rows in any order are dealt by file, read at their offsets and verified; a
damaged record raises. A reader that wants shuffled records shuffles the index.

Empty and NULL texts are the end id alone; a NULL document id sorts first and is stored as
the smallest long; rows that repeat an id are written one after another; an empty table
gives an empty index.
"""

import uuid
import zlib
from struct import Struct, error

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.llm.common import SLICE, Stage, bigint, slices, texts
from hazline.llm.tokens import shared_encoder

# Fixed values of the file format.
MASK_DELTA = 0xA282EAD8
NO_ID = -(1 << 63)
LENGTH, CRC, DOC = Struct("<Q"), Struct("<I"), Struct("<qB")

INDEX = T.StructType(
    [
        bigint("doc_id"),
        T.StructField("file", T.StringType()),
        T.StructField("part", T.IntegerType()),
        bigint("at"),
        bigint("size"),
        bigint("before"),
        bigint("n_tokens"),
    ]
)
RECORDS = T.StructType(
    [
        bigint("doc_id"),
        T.StructField("part", T.IntegerType()),
        bigint("before"),
        bigint("n_tokens"),
        bigint("ids_crc32"),
        T.StructField("ids", T.BinaryType()),
    ]
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = LENGTH.pack(len(payload))
    return b"".join((length, CRC.pack(masked(length)), payload, CRC.pack(masked(payload))))


def unframe(data: bytes) -> bytes:
    """Payload of one record; ValueError where lengths or checksums do not hold."""
    try:
        (size,), (head,) = LENGTH.unpack_from(data), CRC.unpack_from(data, 8)
        if head != masked(data[:8]) or len(data) != size + 16:
            raise ValueError("damaged record length")
        payload = data[12:-4]
        if CRC.unpack_from(data, 12 + size)[0] != masked(payload):
            raise ValueError("damaged record")
    except error as short:
        raise ValueError("record cut off") from short
    return payload


def payload_of(doc: int | None, ids: bytes | np.ndarray) -> bytes:
    """ids: little-endian unsigned 32-bit integers."""
    values = np.frombuffer(ids, "<u4")
    width = 2 if values.max(initial=0) < 1 << 16 else 4
    return DOC.pack(NO_ID if doc is None else doc, width) + values.astype(f"<u{width}").tobytes()


def parts_of(payload: bytes) -> tuple[int | None, bytes]:
    doc, width = DOC.unpack_from(payload)
    values = np.frombuffer(payload, f"<u{width}", offset=DOC.size)
    return None if doc == NO_ID else doc, values.astype("<u4").tobytes()


def _open(folder: str):
    """File system and path of a folder's URI, with the scheme as Arrow names it."""
    from pyarrow import fs

    scheme, rest = folder.split(":", 1)
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


def whole_uri(stage: Stage) -> str:
    """The stage's folder with its scheme, as Spark resolves it: a path without one may lie in a store."""
    marker = stage.put("place", stage.spark.range(1))
    return marker.inputFiles()[0].rsplit("/", 2)[0]


def write_records(
    docs: DataFrame, folder: str, tokenizer: str, split: str, end_id: int, partitions: int
) -> DataFrame:
    """Index rows of the files written; evaluate once and store (`write_indexed` does)."""

    def run(batches):
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        encoder = shared_encoder(tokenizer, split)
        at = before = 0
        out = None
        try:
            for batch in batches:
                for first, last in slices(batch, limit=SLICE):
                    piece = batch.slice(first, last - first)
                    rows = {field.name: [] for field in INDEX}
                    ids, bounds = encoder.encode_column(piece.column("text"), end_id)
                    bounds = bounds.tolist()
                    frames = []
                    for row, doc in enumerate(piece.column("doc_id").to_pylist()):
                        body = ids[bounds[row] : bounds[row + 1]]
                        data = frame(payload_of(doc, body))
                        frames.append(data)
                        values = (doc, name, part, at, len(data), before, len(body))
                        for key, value in zip(rows, values, strict=True):
                            rows[key].append(value)
                        at, before = at + len(data), before + len(body)
                    out = out or store.open_output_stream(f"{root}/{name}")
                    out.write(b"".join(frames))
                    yield pa.RecordBatch.from_pydict(rows, schema=_arrow(INDEX))
        finally:
            if out:
                out.close()

    placed = texts(docs).repartitionByRange(partitions, "doc_id", F.xxhash64("text"))
    return placed.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(run, INDEX)


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def write_indexed(
    spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, split: str, end_id: int
) -> DataFrame:
    """Writes record files and the offset index under `folder`; returns the stored index."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stage = Stage(spark, folder)
    records = f"{whole_uri(stage)}/records"
    index = write_records(docs, records, tokenizer, split, end_id, partitions)
    return stage.put("index", index).withColumn("folder", F.lit(records))


def read_records(index: DataFrame, ids: bool = True) -> DataFrame:
    """Reads and verifies the records that index rows name, each file's in order of offset."""

    def run(batches):
        name = None
        source = None
        for batch in batches:
            rows = {field.name: [] for field in RECORDS}
            held = 0
            columns = ("folder", "file", "part", "at", "size", "before")
            for folder, file, part, at, size, before in zip(
                *(batch.column(c).to_pylist() for c in columns), strict=True
            ):
                if (folder, file) != name:
                    if source:
                        source.close()
                    store, root = _open(folder)
                    source, name = store.open_input_file(f"{root}/{file}"), (folder, file)
                source.seek(at)
                doc, body = parts_of(unframe(source.read(size)))
                values = (
                    doc,
                    part,
                    before,
                    len(body) // 4,
                    zlib.crc32(body),
                    body if ids else None,
                )
                for key, value in zip(rows, values, strict=True):
                    rows[key].append(value)
                held += len(body) if ids else 0
                if held > 1 << 22:
                    yield pa.RecordBatch.from_pydict(rows, schema=_arrow(RECORDS))
                    rows, held = {field.name: [] for field in RECORDS}, 0
            yield pa.RecordBatch.from_pydict(rows, schema=_arrow(RECORDS))
        if source:
            source.close()

    dealt = index.repartition("folder", "file").sortWithinPartitions("folder", "file", "at")
    return dealt.mapInArrow(run, RECORDS)


def token_starts(index: DataFrame) -> DataFrame:
    """Ids before each file, in order of document id: one row per file."""
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    past = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("part", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("base"))


def record_digest(index: DataFrame) -> DataFrame:
    """Per record, as read back: doc_id, start, n_tokens, ids_crc32."""
    rows = read_records(index, ids=False).join(token_starts(index), "part")
    return rows.select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
