"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by A (byte-level BPE, tokenizers library) and B (piece BPE with byte
fallback, sentencepiece). Both lists of token end offsets ascend, and their common offsets cut
the tokens into groups. They are found by galloping intersection: the shorter list drives, and
its ends are sought in the longer one by steps that double from where the search stands, then by
binary search in the last step. Many ends are sought at a time: every 32nd gallops, from where
the block before ended, and those between two of them are halved in from the two. Texts of a batch
lie end to end, so their lists are searched as one; a text's end is common to both. The rank of a
common end in either list is the last token of a group there;
differences of ranks give how many tokens each side has in the group (the overlap range).

Every group ends with one token of A and one of B that end together: a link. Counts of linked id
pairs are taken over the whole corpus by Spark: links are added up per text, then per pair, and
joined back. There are at most as many pairs as ids of A times ids of B, however many texts, and
the planner broadcasts the counts only while they are below its size threshold.

A reads a space before the text and B adds one, so both spell space + text; special tokens'
spellings are ordinary text. NULL and empty texts have no tokens, nor have texts whose bytes one
side does not give back. Rows that repeat an id or a text are counted and returned as often as
they come; an empty table gives no rows.
"""

import re
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.llm.common import Stage, bigint, slices, texts
from hazline.llm.tokens import byte_values, shared_encoder

BLOCK, STEP = 256, 32
# a pair of ids as one number: id of A above, id of B below
PAIR_BITS = 32
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

ALIGNED = T.StructType(
    [
        bigint("row"),
        *map(bigint, "doc_id n_a n_b n_groups n_links".split()),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.LongType())),
    ]
)
GROUPS = T.StructType(
    [
        bigint("doc_id"),
        *map(bigint, "group start end a_first a_size b_first b_size".split()),
    ]
)


def _halve(keys: np.ndarray, long: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Rank of the first value not below each key, which lies between low and high."""
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        under = (long[np.minimum(middle, len(long) - 1)] < keys) & open_
        low, high = np.where(under, middle + 1, low), np.where(under, high, middle)
    return low


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the common values of two ascending lists: in the short one and in the long one.

    Every STEPth key gallops; the keys between two of them lie between their ranks.
    """
    if not len(short) or not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    leaders = short[STEP - 1 :: STEP]
    led = np.zeros(len(leaders), np.int64)
    at = 0
    for first in range(0, len(leaders), BLOCK):
        keys = leaders[first : first + BLOCK]
        low = np.full(len(keys), at)
        reach = np.ones(len(keys), np.int64)
        seeking = np.arange(len(keys))
        while len(seeking):  # double the step while the value there is still below the key
            ahead = low[seeking] + reach[seeking]
            below = ahead <= len(long)
            below[below] = long[ahead[below] - 1] < keys[seeking[below]]
            seeking = seeking[below]
            low[seeking] += reach[seeking]
            reach[seeking] *= 2
        led[first : first + BLOCK] = _halve(keys, long, low, np.minimum(low + reach, len(long)))
        at = int(led[min(first + BLOCK, len(led)) - 1])
    group = np.arange(len(short)) // STEP
    ranks = _halve(short, long, np.append(0, led)[group], np.append(led, len(long))[group])
    inside = ranks < len(long)
    inside[inside] = long[ranks[inside]] == short[inside]
    hits = np.flatnonzero(inside)
    return hits, ranks[hits]


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in a and in b of the ends they share; the shorter list drives."""
    if len(a) <= len(b):
        return gallop(a, b)
    in_b, in_a = gallop(b, a)
    return in_a, in_b


@dataclass
class Tokens:
    """Tokens of a batch of texts end to end: ids of A and B with row bounds, and their common ends."""

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    in_a: np.ndarray  # ranks of the tokens that end groups
    in_b: np.ndarray
    ends: np.ndarray  # byte offsets there, from the batch's start
    bounds: np.ndarray  # groups of each row


def _filtered(ids: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(bounds)
    kept = ids[np.repeat(keep, sizes)] if not keep.all() else ids
    return kept, np.concatenate([[0], np.cumsum(np.where(keep, sizes, 0))])


class Aligner:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = shared_encoder(path_a, "leading_space", plain_specials=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        entries = sorted(self.a.model.get_vocab(with_added_tokens=False).items(), key=lambda e: e[1])
        a_bytes = [b""] * (entries[-1][1] + 1)
        for entry, number in entries:
            a_bytes[number] = byte_values(entry)
        b_bytes = [self._piece(n) for n in range(self.b.get_piece_size())]
        self.a_bytes, self.b_bytes = (pa.array(x, pa.binary()) for x in (a_bytes, b_bytes))
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in each]) for each in (a_bytes, b_bytes))
        # decimal ids with what follows them: A "," or "|", B "," or ";"
        spelt = [f"{n}{mark}".encode() for mark in ",|" for n in range(len(a_bytes))]
        spelt += [f"{n}{mark}".encode() for mark in ",;" for n in range(len(b_bytes))]
        self.spelt = pa.array(spelt, pa.binary())

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        byte = _BYTE_PIECE.fullmatch(piece)
        if byte and self.b.is_byte(number):
            return bytes([int(byte[1], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(self, column: pa.Array) -> Tokens:
        """Both sides' tokens of each text; a text that one side does not give back has none."""
        column = pc.fill_null(column, "")
        spaced = pc.binary_join_element_wise("", column, " ")
        a, a_bounds = self.a.encode_column(spaced)
        lists = self.b.encode(column.to_pylist(), num_threads=1)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        b_bounds = np.concatenate([[0], np.cumsum(sizes)])
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(b_bounds[-1]))

        text, at = _bytes(spaced)
        keep = np.diff(at) > 1
        for ids, bounds, table, width in (
            (a, a_bounds, self.a_bytes, self.a_sizes),
            (b, b_bounds, self.b_bytes, self.b_sizes),
        ):
            spelt, _ = _bytes(table.take(pa.array(ids)))
            own = np.concatenate([[0], np.cumsum(width[ids])])[bounds]
            keep &= np.diff(own) == np.diff(at)
            for row in np.flatnonzero(keep):
                keep[row] = np.array_equal(text[at[row] : at[row + 1]], spelt[own[row] : own[row + 1]])
        a, a_bounds = _filtered(a.astype(np.int64), a_bounds, keep)
        b, b_bounds = _filtered(b, b_bounds, keep)
        ends = np.cumsum(self.a_sizes[a])
        in_a, in_b = common_ends(ends, np.cumsum(self.b_sizes[b]))
        bounds = np.searchsorted(in_a, a_bounds)  # the last token of a text ends a group
        return Tokens(a, b, a_bounds, b_bounds, in_a, in_b, ends[in_a], bounds)

    def spell(self, t: Tokens) -> list[bytes]:
        """Groups of each text as "a1,a2|b1;a3|b2,b3"."""
        code = np.zeros(len(t.a) + len(t.b), np.int64)
        last_a, last_b = np.zeros(len(t.a), bool), np.zeros(len(t.b), bool)
        last_a[t.in_a] = last_b[t.in_b] = True
        # each group has its A tokens first, so a token stands after those of earlier groups
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before = np.concatenate([[0], t.in_b + 1])
        code[np.arange(len(t.a)) + before[group_a]] = t.a + last_a * len(self.a_bytes)
        code[np.arange(len(t.b)) + (t.in_a + 1)[group_b]] = (
            2 * len(self.a_bytes) + t.b + last_b * len(self.b_bytes)
        )
        data, at = _bytes(self.spelt.take(pa.array(code)))
        at = at[t.a_bounds + t.b_bounds]
        return [data[x : max(x, y - 1)].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values end to end, and where each begins and ends."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int32, len(values) + 1, 4 * values.offset).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


_SHARED: dict[tuple, Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process."""
    if (path_a, path_b) not in _SHARED:
        _SHARED[path_a, path_b] = Aligner(path_a, path_b)
    return _SHARED[path_a, path_b]


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    sizes = np.fromiter(map(len, arrays), np.int64, len(arrays))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int64), *arrays])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64)))


def overlap_ranges(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per group: byte range, first token and number of tokens on either side."""
    schema = _arrow(GROUPS)

    def run(batches):
        both = _aligner(path_a, path_b)
        for batch in batches:
            for first, last in slices(batch):
                part = batch.slice(first, last - first)
                t = both.tokens(part.column("text"))
                n = np.diff(t.bounds)
                row = np.repeat(np.arange(len(n)), n)
                start = np.concatenate([[0], t.ends[:-1]])[: len(t.ends)]
                base = start[np.minimum(t.bounds[:-1], max(0, len(start) - 1))][row] if len(row) else start
                columns = [np.arange(len(row)) - t.bounds[:-1][row], start - base, t.ends - base]
                for ranks, bounds in ((t.in_a, t.a_bounds), (t.in_b, t.b_bounds)):
                    size = np.diff(ranks, prepend=-1)
                    columns += [ranks - size + 1 - bounds[:-1][row], size]
                arrays = [part.column("doc_id").take(pa.array(row)), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return texts(docs).mapInArrow(run, GROUPS)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: token and group counts, the groups' digest, and its linked pairs with their number.

    row numbers the rows of one evaluation: store the result before it is used twice.
    """
    schema = _arrow(ALIGNED)

    def run(batches):
        both = _aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, last in slices(batch, limit=3 << 20):
                part = batch.slice(first, last - first)
                t = both.tokens(part.column("text"))
                n = np.diff(t.bounds)
                spelt = both.spell(t)
                link = (t.a[t.in_a] << PAIR_BITS) | t.b[t.in_b]
                counted = [
                    np.unique(link[x:y], return_counts=True)
                    for x, y in zip(t.bounds[:-1], t.bounds[1:], strict=True)
                ]
                columns = [
                    pa.array(np.arange(number, number + len(part))),
                    part.column("doc_id"),
                    *(pa.array(x) for x in (np.diff(t.a_bounds), np.diff(t.b_bounds), n, n)),
                    pa.array([sha256(x).hexdigest() if x else "" for x in spelt]),
                    *(_lists([each[i] for each in counted]) for i in (0, 1)),
                ]
                number += len(part)
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return texts(docs).mapInArrow(run, ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, count, best) over the corpus; best: no pair of the same id of B has a higher count."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1)).alias("b")
    counts = counts.select("pair", "count", b)
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align_corpus(
    spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, stage: Stage | None = None
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    stage = stage or Stage(spark)
    rows = stage.put("aligned", align(docs, path_a, path_b))
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )
    counts = stage.put("counts", pair_counts(links))
    sums = (
        links.join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return (
        rows.drop("pairs", "times")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            "n_a",
            "n_b",
            "n_groups",
            "n_links",
            F.coalesce("n_best", zero).alias("n_best"),
            F.coalesce("count_sum", zero).alias("count_sum"),
            "groups_sha256",
        )
    )
