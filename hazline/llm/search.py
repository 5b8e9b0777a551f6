"""Exact top-k by integer inner product: a ball tree per shard, searched by branch and bound.

Vectors become integers first, so scores are exact and ties are real ties. Rows are dealt to
shards of bounded size by a hash of their id. Every task holds one shard at a time: a tree of
balls (centre, radius) over it. Queries stream past in blocks. A node's upper bound for query
q is q.centre + |q| radius; the block is split by which child promises more, and queries whose
k-th score beats a node's bound leave it.

Each query first meets only the shard that its own id falls in; the k-th score found there is
shared with all other shards as its starting bound. Queries travel to each shard as rows, so
neither side is broadcast or collected.

Vectors that are NULL or hold a NULL or non-finite component take no part, nor do NULL ids;
vectors meet only those of their own length. A query's own row is no candidate, other rows of its
id are. Rows that repeat an id are answered each (query_copy counts them, in order of their
vectors). Scores are exact in any range: by floating point where products stay below 2^52, by
64-bit integers, or by integers of any size; a component or score that a long cannot hold raises.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.llm.common import Stage, bigint

LEAF = 128
HITS = T.StructType([bigint("query_row"), bigint("vec_id"), bigint("score")])
LOWEST = 1 - (1 << 63)  # no score: what is not above it does not fit


def products(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Inner products of whole-number rows as longs, exactly, and which of them no long holds."""
    peak = [int(np.abs(side.astype(np.float64)).max(initial=0)) + 1 for side in (left, right)]
    most = peak[0] * peak[1] * max(1, left.shape[1])
    if most < 1 << 52:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64), None
    if most < 1 << 62:
        return left @ right.T, None
    exact = left.astype(object) @ right.T.astype(object)
    beyond = (exact <= LOWEST) | (exact >= 1 << 63)
    return np.where(beyond, 0, exact).astype(np.int64), beyond.astype(bool)


class BallTree:
    """Balls over whole-number points; rows number the points, ids name them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.nodes: list[tuple] = []  # centre, its norm, radius, first, last, children
        order = np.arange(len(ids))
        self.root = self._build(order, 0, len(ids))
        self.rows, self.ids, self.points = rows[order], ids[order], points[order]  # whole numbers

    def _build(self, order: np.ndarray, first: int, last: int) -> int:
        own = self.points[order[first:last]]
        centre = own.mean(axis=0)
        far = ((own - centre) ** 2).sum(axis=1)
        radius = float(np.sqrt(far.max()))
        children = None
        if last - first > LEAF and radius > 0:
            one = own[far.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            side = own @ (other - one)
            cut = (last - first) // 2
            order[first:last] = order[first:last][np.argsort(side, kind="stable")]
            children = (
                self._build(order, first, first + cut),
                self._build(order, first + cut, last),
            )
        self.nodes.append((centre, float(np.sqrt(centre @ centre)), radius, first, last, children))
        return len(self.nodes) - 1

    def search(self, query_rows: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int):
        """Best (score, id) pairs of a block of queries that reach their bounds."""
        best = np.full((len(queries), k), LOWEST, np.int64)
        owner = np.full((len(queries), k), np.iinfo(np.int64).max)
        floor = bounds.astype(np.int64)
        spans = queries.astype(np.float64)
        norm = np.sqrt((spans**2).sum(axis=1))

        def above(node, rows):
            """Upper bound of the products, with room for the rounding of its terms."""
            centre, length, radius = self.nodes[node][:3]
            top = spans[rows] @ centre + norm[rows] * radius
            return top + 1 + 1e-9 * norm[rows] * (length + radius)

        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, rows = stack.pop()
            rows = rows[above(node, rows) >= floor[rows]]
            if not len(rows):
                continue
            first, last, children = self.nodes[node][3:]
            if children:
                ahead = above(children[0], rows) >= above(children[1], rows)
                for near, far, part in (
                    (children[0], children[1], rows[ahead]),
                    (children[1], children[0], rows[~ahead]),
                ):
                    stack += [(far, part), (near, part)]
                continue
            scores, beyond = products(queries[rows], self.points[first:last])
            others = self.rows[first:last][None, :] != query_rows[rows][:, None]
            if beyond is not None and (beyond & others).any():
                raise OverflowError("an inner product does not fit a long")
            good = (scores >= floor[rows][:, None]) & others
            row, column = np.nonzero(good)
            if not len(row):
                continue
            hit = np.unique(row)
            old = np.repeat(hit, k)
            every = np.concatenate([old, row])
            value = np.concatenate([best[rows[hit]].ravel(), scores[row, column]])
            name = np.concatenate([owner[rows[hit]].ravel(), self.ids[first:last][column]])
            order = np.lexsort((name, -value, every))
            every, value, name = every[order], value[order], name[order]
            place = np.arange(len(every)) - np.searchsorted(every, every)
            keep = place < k
            best[rows[every[keep]], place[keep]] = value[keep]
            owner[rows[every[keep]], place[keep]] = name[keep]
            floor[rows[hit]] = np.maximum(floor[rows[hit]], best[rows[hit], k - 1])
        return best, owner


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and components floor(scale * x) as longs; rows that take no part are left out."""
    parts = F.col("embedding").cast("array<double>")
    finite = ~F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fault = F.raise_error(F.lit("a component does not fit a long after scaling"))
    whole = F.transform(
        parts, lambda x: F.when(F.abs(x * scale) < 2.0**63, F.floor(x * scale)).otherwise(fault.cast("long"))
    )
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _search(rows: DataFrame, k: int) -> DataFrame:
    """rows: shard, is_query, row, vec_id, v, bound; candidates of a shard come first."""

    def run(batches):
        shard = tree = None
        held: list[tuple] = []

        def matrix(batch, picked):
            lists = batch.column("v").take(picked)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(len(picked), -1)

        for batch in batches:
            shards = batch.column("shard").to_numpy(zero_copy_only=False)
            query = batch.column("is_query").to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            own = batch.column("row").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(shards) != 0) | (np.diff(query.astype(int)) != 0)) + 1
            for first, last in zip([0, *edges], [*edges, len(ids)], strict=True):
                if first == last:
                    continue
                if shards[first] != shard:
                    shard, tree, held = shards[first], None, []
                points = matrix(batch, pa.array(range(first, last)))
                if not query[first]:
                    held.append((own[first:last], ids[first:last], points))
                    continue
                if tree is None:
                    if not held:
                        continue
                    tree = BallTree(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held = []
                bound = batch.column("bound").slice(first, last - first).to_numpy(zero_copy_only=False)
                best, owner = tree.search(own[first:last], points, bound, k)
                row, place = np.nonzero(best > LOWEST)
                columns = own[first:last][row], owner[row, place], best[row, place]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=[f.name for f in HITS])

    dealt = rows.repartition("shard").sortWithinPartitions("shard", "is_query", "vec_id")
    return dealt.mapInArrow(run, HITS)


def top_k(
    spark: SparkSession,
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    shard_rows: int = 8192,
    stage: Stage | None = None,
) -> DataFrame:
    """query_id, query_copy, rank, vec_id, score of the k best other rows for each query row."""
    stage = stage or Stage(spark)
    rows = integers(vectors, scale).withColumn("row", F.monotonically_increasing_id())
    rows = stage.put("vectors", rows)
    shards = max(1, -(-rows.count() // shard_rows))
    home = F.pmod(F.xxhash64(F.col("vec_id"), F.size("v")), F.lit(shards))
    rows = rows.withColumn("home", home).withColumn("space", F.size("v").cast("long"))
    lowest = F.lit(LOWEST).cast("long")

    def dealt(df, shard, query, bound):
        number = (F.col("space") * shards + shard).alias("shard")
        return df.select(number, F.lit(query).alias("is_query"), "row", "vec_id", "v", bound.alias("bound"))

    queries = rows.where(is_query)
    candidates = dealt(rows, F.col("home"), False, lowest)
    at_home = dealt(queries, F.col("home"), True, lowest)
    first = stage.put("first", _search(candidates.union(at_home), k))
    if shards > 1:
        shared = first.groupBy(F.col("query_row").alias("row")).agg(
            F.min("score").alias("least"), F.count("*").alias("n")
        )
        shared = shared.select("row", F.when(F.col("n") >= k, F.col("least")).alias("found"))
        away = queries.join(shared, "row", "left").withColumn(
            "to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
        )
        away = dealt(away.where("to <> home"), F.col("to"), True, F.coalesce("found", lowest))
        first = first.union(_search(candidates.union(away), k))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    copies = F.row_number().over(Window.partitionBy("vec_id").orderBy("v"))
    names = queries.select(
        F.col("row").alias("query_row"),
        F.col("vec_id").alias("query_id"),
        copies.cast("int").alias("query_copy"),
    )
    return ranked.join(names, "query_row").select(
        "query_id", "query_copy", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
