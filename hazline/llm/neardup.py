"""Near-duplicate classes: BagMinHash signatures, banding, exact check of multiset overlap.

A text is a bag of shingles of five words with their counts (a text of fewer words is a single
shingle). Similarity is weighted Jaccard: summed minima over summed maxima of the counts.

Signatures: each shingle owns independent Poisson processes over the weight levels [0, 1),
[1, 2), [2, 4), [4, 8) and so on, each of a rate in proportion to its width. A point has a time,
a register and a level; a shingle of count w keeps the points with level below w, so two bags
see the same points of a process as far as both counts reach. A register holds its earliest
time; registers of two bags agree with probability equal to their similarity. Points are
drawn in order of time and only until all registers are filled, which takes about
m (ln m + 3) points a text, however long it is. Levels beyond a count are met in the topmost range
only, so at most half of the points are drawn in vain.

Classes: equal texts are one node. Nodes that agree in a whole band of registers are a bucket. Each
member is compared with the bucket's head, the node that meets most others; what passes is linked and
connected. Members of buckets that still hold several components are looked at again: a prefix
filter over their rarest shingles finds every pair across components that can be similar enough, so the
result is that of comparing all pairs of each bucket, without making them. Similarity is
checked on whole texts in integers.

One row per row comes back. Texts without words are alike only if equal. NULL texts count as empty,
NULL ids stay NULL and rank last as class id, rows that repeat an id get their text's class.
"""

import hashlib
import re
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.llm.common import Stage, bigint, lean, slices, texts, utf8
from hazline.llm.words import ODD, mixed, shared_hashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SHINGLE = 5
BANDS, ROWS = 32, 5
# Links that one task of the component search takes, and the fewest tasks of it.
TASK_LINKS, LEAST_TASKS = 20_000, 8

SIGNED = T.StructType(
    [
        bigint("doc_id"),
        T.StructField("node", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def bags(docs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, shingle hash and count of each distinct shingle of each text."""
    words = list(map(WORDS.findall, docs))
    hashes = shared_hashes().of(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    n = np.where(sizes > 0, np.maximum(sizes - SHINGLE + 1, 1), 0)
    doc = np.repeat(np.arange(len(docs)), n)
    first = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    last = np.repeat(starts + sizes, n)
    value = np.full(len(first), ODD)
    for k in range(SHINGLE):
        inside = first + k < last
        at = np.where(inside, first + k, 0)
        value = np.where(inside, mixed(value * ODD + hashes[at] if len(hashes) else value), value)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(fresh)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, docs: int, m: int) -> np.ndarray:
    """docs x m registers: the earliest time of any kept point (infinite for an empty bag)."""
    sig = np.full(docs * m, np.inf)
    # level ranges: number 0 is [0, 1), number k is [2^(k-1), 2^k)
    ranges = 1 + np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0)
    owner = np.repeat(np.arange(len(doc)), ranges)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(ranges) - ranges, ranges)
    width = np.where(number > 1, 2.0 ** (number - 1), 1.0)
    low = np.where(number > 0, width, 0.0)
    low[number == 1] = 1.0
    seed = mixed(shingle[owner] + ODD * number.astype(np.uint64))
    weight, home = count[owner].astype(np.float64), doc[owner]
    rate = m * width
    total = np.bincount(doc, count, docs)
    horizon = (np.log(m) + 3) / np.maximum(total, 1)
    time, drawn = np.zeros(len(owner)), np.zeros(len(owner), np.uint64)
    unit = 2.0**-53

    def advance(at):
        drawn[at] += np.uint64(1)
        step = mixed(seed[at] + ODD * drawn[at])
        time[at] -= np.log(((step >> np.uint64(11)) + np.float64(0.5)) * unit) / rate[at]

    advance(np.arange(len(owner)))
    live = np.arange(len(owner))
    while len(live):
        now = live[time[live] <= horizon[home[live]]]
        while len(now):
            place = mixed(seed[now] ^ (ODD * (drawn[now] + np.uint64(1 << 40))))
            register = ((place >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            level = low[now] + width[now] * ((place & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
            kept = level < weight[now]
            np.minimum.at(sig, home[now][kept] * m + register[kept].astype(np.int64), time[now][kept])
            advance(now)
            now = now[time[now] <= horizon[home[now]]]
        open_docs = np.isinf(sig.reshape(docs, m)).any(axis=1)
        live = live[open_docs[home[live]]]
        horizon = np.where(open_docs, horizon * 2, horizon)
    return sig.reshape(docs, m)


def banded(sig: np.ndarray) -> np.ndarray:
    """docs x bands: a hash of each band's registers."""
    bits = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS)
    out = np.full((len(sig), BANDS), ODD)
    for row in range(ROWS):
        out = mixed(out * ODD + bits[:, :, row])
    return out.view(np.int64)


def sign(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for first, last in slices(batch):
                piece = batch.slice(first, last - first)
                words = piece.column("text").to_pylist()
                doc, shingle, count = bags(words)
                rows = list(banded(signatures(doc, shingle, count, len(words), BANDS * ROWS)))
                held = np.bincount(doc, minlength=len(words)) > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array([hashlib.md5(utf8(text)).digest() for text in words], pa.binary()),
                        pa.array([r if h else [] for r, h in zip(rows, held, strict=True)], pa.list_(pa.int64())),
                    ],
                    schema=schema,
                )

    return texts(docs).mapInArrow(lean(run), SIGNED)


def overlaps(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Summed minima and maxima of the shingle counts of each pair of texts."""
    n = len(left)
    doc, shingle, count = bags(left + right)
    total = np.bincount(doc, count, 2 * n).astype(np.int64)
    pair = np.where(doc < n, doc, doc - n)
    order = np.lexsort((shingle, pair))
    pair, shingle, count = pair[order], shingle[order], count[order]
    same = (pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1])
    least = np.minimum(count[1:], count[:-1])[same]
    both = np.bincount(pair[1:][same], least, n).astype(np.int64)
    return both, total[:n] + total[n:] - both


def verified(pairs: DataFrame, words: DataFrame, tenths: int) -> DataFrame:
    """Pairs (a, b) whose similarity is tenths / 10 or more."""

    def run(batches):
        for batch in batches:
            for first, last in slices(batch, "text_a"):
                piece = batch.slice(first, last - first)
                least, most = overlaps(piece.column("text_a").to_pylist(), piece.column("text_b").to_pylist())
                alike = pa.array(10 * least >= tenths * most)
                yield piece.select(["a", "b"]).filter(alike)

    one = words.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = words.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b")
    return both.mapInArrow(lean(run), "a binary, b binary")


def components(stage: Stage, links: DataFrame) -> DataFrame:
    """node, root of every linked node, by alternating large-star and small-star steps.

    A step is as many tasks as the links need, so a small graph is no file per shuffle partition.
    """
    tasks = max(LEAST_TASKS, ceil(links.count() / TASK_LINKS))

    def put(name: str, rows: DataFrame) -> DataFrame:
        return stage.put(name, rows.coalesce(tasks))

    edges = put("edges", links.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = put("large", large.where("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        edges = put("small", small.where("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def shingle_rows(nodes: DataFrame) -> DataFrame:
    """node, token, size: a row for each occurrence of each shingle of a node's text."""
    schema = pa.schema([("node", pa.binary()), ("token", pa.int64()), ("size", pa.int64())])

    def run(batches):
        for batch in batches:
            for first, last in slices(batch, limit=1 << 18):
                piece = batch.slice(first, last - first)
                doc, shingle, count = bags(piece.column("text").to_pylist())
                owner, of = np.repeat(doc, count), np.repeat(shingle, count)
                turn = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                token = mixed(of + ODD * turn.astype(np.uint64)).view(np.int64)
                size = np.bincount(owner, minlength=len(piece))[owner]
                node = piece.column("node").take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([node, pa.array(token), pa.array(size)], schema=schema)

    return nodes.select("node", "text").mapInArrow(lean(run), "node binary, token long, size long")


def across_components(stage: Stage, open_nodes: DataFrame, words: DataFrame, tenths: int) -> DataFrame:
    """Pairs (a, b) of open nodes of different components that can be similar enough, by prefix filter.

    With shingles in order of rarity, two bags of similarity t share one within the first
    n - ceil(t n) + 1 of each, and what follows it must be able to make up the overlap needed.
    """
    rows = stage.put("tokens", shingle_rows(open_nodes.select("node").join(words, "node")))
    common = rows.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    ranked = rows.join(common, "token", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    order = Window.partitionBy("node").orderBy("n", "token")
    ranked = ranked.withColumn("pos", F.row_number().over(order))
    ranked = ranked.where(f"n > 1 AND pos <= size - (size * {tenths} + 9) div 10 + 1")
    ranked = stage.put("prefixes", ranked.join(open_nodes, "node").select("token", "node", "root", "size", "pos"))
    one = ranked.select("token", *[F.col(c).alias("a_" + c) for c in ("node", "root", "size", "pos")])
    two = ranked.select("token", *[F.col(c).alias("b_" + c) for c in ("node", "root", "size", "pos")])
    rest = "least(a_size - a_pos, b_size - b_pos) + 1"
    pairs = one.join(two, "token").where(
        f"a_node < b_node AND a_root <> b_root AND ({rest}) * {10 + tenths} >= {tenths} * (a_size + b_size)"
    )
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def node_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """One text for each node asked for: node, text."""
    rows = texts(docs).withColumn("node", F.unhex(F.md5(F.col("text").cast("binary"))))
    picked = rows.join(nodes.select("node", F.col("least").alias("own_id")), "node")
    picked = picked.where(F.col("doc_id").eqNullSafe(F.col("own_id")))
    return picked.select("node", "doc_id", "text").dropDuplicates(["node"]).select("node", "text")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, tenths: int = 8, stage: Stage | None = None
) -> DataFrame:
    """doc_id, class_id (the class's smallest doc_id), class_rows, n_texts, n_links (pairs of
    different texts of the class that were compared and found alike), and the digests (node of the
    text, root of the class) of every row."""
    stage = stage or Stage(spark)
    signed = stage.put("signed", sign(docs))
    nodes = signed.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("bands").alias("bands")
    )
    nodes = stage.put("nodes", nodes)
    banded_nodes = nodes.select("node", F.posexplode("bands").alias("band", "code"))
    sizes = banded_nodes.groupBy("band", "code").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage.put("shared", banded_nodes.join(sizes, ["band", "code"]))
    # the node that meets the most others heads a bucket: the text the others are copies of
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    heads = shared.join(met, "node").groupBy("band", "code").agg(F.max(F.struct("met", "node"))["node"].alias("head"))
    pairs = shared.join(heads, ["band", "code"]).where("node <> head")
    pairs = stage.put("pairs", pairs.select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())
    used = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    words = stage.put("words", node_texts(docs, nodes.select("node", "least").join(used, "node")))
    links = stage.put("links", verified(pairs, words, tenths))
    parts = stage.put("parts", components(stage, links))

    # members of buckets that still hold several components
    placed = shared.join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("band", "code").agg(F.min("root").alias("one"), F.max("root").alias("other"))
    several = several.where("one <> other").select("band", "code")
    open_nodes = stage.put("open", placed.join(several, ["band", "code"]).select("node", "root").distinct())
    done = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    across = across_components(stage, open_nodes, words, tenths).join(done, ["a", "b"], "left_anti")
    more = stage.put("more", verified(across, words, tenths))
    if not more.isEmpty():
        parts = stage.put("parts", components(stage, links.union(more)))

    held = links.union(more).select(F.col("a").alias("node")).join(parts, "node")
    held = held.groupBy("root").agg(F.count("*").alias("n_links"))
    classes = nodes.select("node", "least", "copies").join(parts, "node", "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    named = classes.groupBy("root").agg(
        F.min("least").alias("class_id"), F.sum("copies").alias("class_rows"), F.count("*").alias("n_texts")
    )
    named = named.join(held, "root", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    named = classes.select("node", "root").join(named, "root")
    return signed.select("doc_id", "node").join(named, "node").select(
        "doc_id", "class_id", "class_rows", "n_texts", "n_links", "node", "root"
    )


def keep_one(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows of docs without all but one of each class: the row of the smallest doc_id."""
    found = near_duplicates(spark, docs, **options)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    kept = found.groupBy("root").agg(F.min(order).alias("row")).select(
        F.col("row.node").alias("kept_node"), F.col("row.doc_id").alias("kept_id")
    )
    # columns by number, so that no name of the user's meets those of the keys
    inner = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    own, text = (F.col(f"c{docs.columns.index(name)}").cast("string") for name in ("doc_id", "text"))
    keyed = inner.withColumn("kept_node", F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    keyed = keyed.withColumn("kept_key", F.coalesce(own, F.lit("-")))
    kept = kept.select("kept_node", F.coalesce(F.col("kept_id").cast("string"), F.lit("-")).alias("kept_key"))
    # repeated rows of one id and text come down to one here, on the keys of the join
    one = keyed.join(kept, ["kept_node", "kept_key"]).dropDuplicates(["kept_node", "kept_key"])
    return one.select(inner.columns).toDF(*docs.columns)
