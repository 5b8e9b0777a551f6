"""Merkle manifest of a dataset: a hash tree per source, and one over the sources' roots.

Leaves of a source ascend by document id (NULL first; equal ids by leaf). While a tree has more
than one node, every three consecutive nodes become their hash. A tree of any size is built in
blocks of 3^height leaves: each block is one aligned subtree, and its root is a leaf of the next
round, so three or four rounds serve any corpus and no task holds more than a block. The
sources' roots, ordered by source, are the leaves of the last tree, built alike.

A block is stored in van Emde Boas layout: the tree is cut at half its height into a top tree
and bottom trees, stored one after the other, each cut again in the same way. `addresses` gives
the place of each node by arithmetic alone, for building and for looking up siblings, so a path
from leaf to root touches few cache lines whatever their size.

Proofs run the other way: the siblings above a block's root are found once per block, in the
block above it, and each document's proof is those in its own block followed by them. Every
proof is folded again from the document's leaf as it is now, and the result held against the root.

Positions come from a range partitioning by tree and order (`ranks`), so one source with a third
of all rows is spread like any other data. Texts are hashed where they are read and never shuffled.

NULL fields hash as "-", an empty text as "0:", so they differ. Rows that repeat an id are leaves
of their own. A source with one row is its own subroot; a table with one row its own root. An
empty table gives no rows.
"""

from functools import cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.llm.common import Stage, bigint
from hazline.llm.ranks import positions

ARITY, HEIGHT, DIGEST = 3, 6, 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

BLOCK = T.StructType(
    [
        T.StructField("tree", T.StringType()),
        bigint("block"),
        bigint("n"),
        T.StructField("height", T.IntegerType()),
        T.StructField("root", T.BinaryType()),
        T.StructField("nodes", T.BinaryType()),
    ]
)
TAIL = T.StructType(
    [
        T.StructField("tree", T.StringType()),
        bigint("at"),
        T.StructField("tail", T.BinaryType()),
        T.StructField("subroot", T.BinaryType()),
    ]
)
PROVEN = T.StructType(
    [bigint("doc_id")]
    + [T.StructField(n, T.BinaryType()) for n in ("digest", "subroot", "proof", "folded")]
)


# layout


def _size(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes at a depth (0 is the root) of a full tree with so many levels of nodes."""
    place = np.zeros(len(index), np.int64)
    index = np.array(index, np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        bottom = levels - top
        below = ARITY ** (depth - top)
        place += _size(top) + index // below * _size(bottom)
        index, depth, levels = index % below, depth - top, bottom
    return place


@cache
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """Places of all nodes of each level, leaves (level 0) first."""
    return tuple(
        address(height + 1, height - level, np.arange(ARITY ** (height - level)))
        for level in range(height + 1)
    )


def height_of(n: int) -> int:
    """Levels above n leaves until one node is left."""
    height = 0
    while n > 1:
        n, height = -(-n // ARITY), height + 1
    return height


def combine(digests: list[bytes]) -> bytes:
    """Hash of nodes, joined as lower-case hexadecimal text."""
    return sha256(b"".join(digests).hex().encode()).digest()


def build(leaves: list[bytes], height: int) -> tuple[bytes, bytes]:
    """Nodes in van Emde Boas layout, and the root; missing nodes of the last run stay zero."""
    nodes = bytearray(_size(height + 1) * DIGEST)
    level = leaves
    for number, places in enumerate(addresses(height)):
        if number:
            level = [combine(level[i : i + ARITY]) for i in range(0, len(level), ARITY)]
        for place, digest in zip(places[: len(level)].tolist(), level, strict=True):
            nodes[place * DIGEST : (place + 1) * DIGEST] = digest
    return bytes(nodes), level[0]


def siblings(nodes: bytes, n: int, height: int, leaf: int) -> bytes:
    """Steps from a leaf to the root: per level the place in the run, the run's length and the others."""
    steps = []
    for places in addresses(height)[:-1]:
        first = leaf - leaf % ARITY
        run = min(ARITY, n - first)
        steps.append(bytes((leaf - first, run)))
        for other in range(first, first + run):
            if other != leaf:
                at = int(places[other]) * DIGEST
                steps.append(nodes[at : at + DIGEST])
        leaf, n = leaf // ARITY, -(-n // ARITY)
    return b"".join(steps)


def walk(steps: bytes):
    """(place, other nodes of the run) of each step."""
    at = 0
    while at < len(steps):
        place, run = steps[at], steps[at + 1]
        at += 2
        yield place, [steps[at + i * DIGEST : at + (i + 1) * DIGEST] for i in range(run - 1)]
        at += (run - 1) * DIGEST


def proof_digest(steps: bytes) -> bytes:
    return combine([node for _, others in walk(steps) for node in others])


def fold(leaf: bytes, steps: bytes) -> bytes:
    for place, others in walk(steps):
        leaf = combine([*others[:place], leaf, *others[place:]])
    return leaf


# tables


def _field(name: str, value: Column | None = None) -> Column:
    text = (F.col(name) if value is None else value).cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_hash(text: Column | None = None) -> Column:
    """Hash of a document's fields, with another text where one is given."""
    parts = [_field(name, text if name == "text" else None) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def _grouped(batches, keys: tuple[str, ...]):
    """Rows of consecutive equal keys as (key, list of column dicts' values), across batches."""
    key, held = None, []
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in keys]
        own = list(zip(*columns, strict=True))
        edges = [i for i in range(1, len(own)) if own[i] != own[i - 1]]
        for first, last in zip([0, *edges], [*edges, len(own)], strict=True):
            if first == last:
                continue
            if held and own[first] != key:
                yield key, held
                held = []
            key = own[first]
            held.append(batch.slice(first, last - first))
    if held:
        yield key, held


def _values(held: list[pa.RecordBatch], name: str) -> list:
    return [value for batch in held for value in batch.column(name).to_pylist()]


def build_blocks(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Blocks of nodes (tree, at, n of the tree, digest): one row each, with its stored subtree."""
    rows = nodes.withColumn("block", F.floor(F.col("at") / ARITY**height).cast("long"))
    schema = _arrow(BLOCK)

    def run(batches):
        for (tree, block), held in _grouped(batches, ("tree", "block")):
            leaves, total = _values(held, "digest"), held[0].column("n")[0].as_py()
            # the only block of its tree ends at the tree's root
            own = height_of(total) if total <= ARITY**height else height
            stored, root = build(leaves, own)
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "tree": tree,
                        "block": block,
                        "n": len(leaves),
                        "height": own,
                        "root": root,
                        "nodes": stored,
                    }
                ],
                schema=schema,
            )

    dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    return dealt.select("tree", "block", "n", "digest").mapInArrow(run, BLOCK)


def forest(stage: Stage, name: str, nodes: DataFrame, height: int = HEIGHT) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of stored blocks, and the roots (tree, root) of all trees."""
    rounds, roots = [], []
    width = ARITY**height
    while True:
        blocks = stage.put(f"{name}-{len(rounds)}", build_blocks(nodes, height))
        rounds.append(blocks)
        counts = blocks.groupBy("tree").agg(F.count("*").alias("n_tree"), F.max("root").alias("root"))
        counts = stage.put(f"{name}-counts", counts)
        roots.append(counts.where("n_tree = 1").select("tree", "root"))
        more = counts.where("n_tree > 1").select("tree", F.col("n_tree").alias("n"))
        if more.isEmpty():
            return rounds, reduce(DataFrame.unionByName, roots)
        nodes = blocks.join(more.withColumnRenamed("n", "total"), "tree").select(
            "tree", F.col("block").alias("at"), F.col("total").alias("n"), F.col("root").alias("digest")
        )
        if len(rounds) * height > 64:
            raise RuntimeError(f"more than {width} ** {len(rounds)} leaves")


def _tails(blocks: DataFrame, tails: DataFrame) -> DataFrame:
    """Steps from each leaf of the blocks to the root of all: (tree, at, tail)."""
    schema = _arrow(TAIL)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                first = row["block"] * row["width"]
                steps = [siblings(row["nodes"], row["n"], row["height"], i) for i in range(row["n"])]
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": [row["tree"]] * row["n"],
                        "at": [first + i for i in range(row["n"])],
                        "tail": [step + row["tail"] for step in steps],
                        "subroot": [row["subroot"]] * row["n"],
                    },
                    schema=schema,
                )

    joined = blocks.join(tails.withColumnRenamed("at", "block"), ["tree", "block"])
    return joined.mapInArrow(run, TAIL)


def _block_tails(stage: Stage, name: str, rounds: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """Tails of the blocks of the first round, given those (tree, tail, subroot) of the trees' roots."""
    width = F.lit(ARITY**height).cast("long").alias("width")
    top = tops.select("tree", F.lit(0).cast("long").alias("at"), "tail", "subroot")
    below = None
    for number in reversed(range(len(rounds))):
        blocks = rounds[number].select("*", width)
        # trees whose last round this is start from their root's tail
        known = top
        if below is not None:
            known = top.join(below.select("tree").distinct(), "tree", "left_anti").unionByName(below)
        if number == 0:
            return known
        below = stage.put(f"{name}-tails-{number}", _tails(blocks, known))
    raise RuntimeError("no rounds")


def _prove(leaves: DataFrame, blocks: DataFrame, height: int) -> DataFrame:
    """Each leaf with the digest of its proof and the root folded from its current hash.

    A block's row comes first, its leaves follow; both are dealt by (tree, block).
    """
    schema = _arrow(PROVEN)
    width = ARITY**height

    def run(batches):
        nodes = tail = subroot = None
        n = own = 0
        columns = ("at", "n", "height", "nodes", "tail", "subroot", "doc_id", "digest", "current")
        for batch in batches:
            rows = {field.name: [] for field in PROVEN}
            for values in zip(*(batch.column(name).to_pylist() for name in columns), strict=True):
                if values[0] < 0:
                    _, n, own, nodes, tail, subroot = values[:6]
                    continue
                at, doc, digest, current = values[0], *values[6:]
                steps = siblings(nodes, n, own, at % width) + tail
                made = (doc, digest, subroot, proof_digest(steps), fold(current, steps))
                for key, value in zip(rows, made, strict=True):
                    rows[key].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    own = leaves.select(
        "tree",
        F.floor(F.col("at") / width).cast("long").alias("block"),
        "at",
        *[F.lit(None).cast(kind).alias(name) for name, kind in (("n", "long"), ("height", "int"))],
        *[F.lit(None).cast("binary").alias(name) for name in ("nodes", "tail", "subroot")],
        "doc_id",
        "digest",
        "current",
    )
    first = blocks.select(
        "tree",
        "block",
        F.lit(-1).cast("long").alias("at"),
        "n",
        "height",
        "nodes",
        "tail",
        "subroot",
        F.lit(None).cast("long").alias("doc_id"),
        *[F.lit(None).cast("binary").alias(name) for name in ("digest", "current")],
    )
    dealt = first.unionByName(own).repartition("tree", "block")
    return dealt.sortWithinPartitions("tree", "block", "at").mapInArrow(run, PROVEN)


def manifest(
    spark: SparkSession,
    docs: DataFrame,
    now: Column | None = None,
    height: int = HEIGHT,
    stage: Stage | None = None,
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row.

    now is the text as it is at verification (by default the text itself): leaves and siblings
    come from the text as it was, and folded_root starts from the leaf of now.
    """
    stage = stage or Stage(spark)
    leaf = leaf_hash()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # NULL before all others, the empty name included
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        leaf.alias("digest"),
        (leaf if now is None else leaf_hash(now)).alias("current"),
    )
    rows = stage.put("hashed", rows)
    placed = positions(stage, "placed", rows, "tree", ["doc_id", "digest", "current"])
    leaves = stage.put("leaves", placed)
    rounds, subroots = forest(stage, "source", leaves.select("tree", "at", "n", "digest"), height)

    names = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    ordered = stage.put("sources", positions(stage, "names", names, "tree", ["name"]))
    upper, roots = forest(stage, "sources", ordered.select("tree", "at", "n", "digest"), height)
    top = roots.select("root").collect()  # one row, none for an empty table
    root = F.lit(top[0][0].hex() if top else None).cast("string")
    empty = F.lit(b"")
    above = _block_tails(stage, "sources", upper, roots.select("tree", empty.alias("tail"), empty.alias("subroot")), height)
    width = F.lit(ARITY**height).cast("long").alias("width")
    above = stage.put("above", _tails(upper[0].select("*", width), above)).select("at", "tail")
    tops = ordered.join(above, "at").select(F.col("name").alias("tree"), "tail", F.col("digest").alias("subroot"))
    tails = _block_tails(stage, "source", rounds, stage.put("tops", tops), height)

    blocks = rounds[0].join(tails.withColumnRenamed("at", "block"), ["tree", "block"])
    folded = F.lower(F.hex("folded"))
    return _prove(leaves, blocks, height).select(
        "doc_id",
        F.lower(F.hex("digest")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        root.alias("root"),
        F.lower(F.hex("proof")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == root).alias("verified"),
    )
