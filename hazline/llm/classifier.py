"""Quality scores by logistic regression on hashed word n-grams, trained with FTRL-proximal.

Tokens are words and runs of marks; features are hashed unigrams and bigrams over all tokens
of the whole text, with one feature shared by all bigrams that repeat a token. A feature's value
is its count over the square root of the number of n-grams, so a score is a sparse dot
product: the sum of the weights hit, scaled, plus the bias.

Training reads at most `max_rows` labelled documents (those of the smallest seeded hash of
their id; a documented bound), in an order given by that hash, and updates one coordinate-wise
FTRL-proximal learner in one task. Weights are 4 bytes for each of 2^bits features, whatever
the corpus, and travel with the scoring function.

Labels that are NULL are not used; of a document's several labels the smallest counts. Without
rows of both classes the score is the share of label 1 (0.5 without rows). Empty and NULL
texts get the bias alone. Rows with repeated ids are all scored.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.llm.common import bigint, slices, texts
from hazline.llm.words import ODD, mixed, shared_hashes

TOKEN = re.compile(r"\w+|[^\w\s]+")
FEATURES = T.StructType(
    [bigint("draw"), T.StructField("label", T.IntegerType()), T.StructField("hits", T.BinaryType())]
)
MODEL = T.StructType([T.StructField("weights", T.BinaryType()), T.StructField("bias", T.DoubleType())])


def ngrams(docs: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all n-grams, document after document, and each document's count."""
    tokens = list(map(TOKEN.findall, docs))
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    one = shared_hashes().of(tokens)
    shift = np.uint64(64 - bits)
    doc = np.repeat(np.arange(len(docs)), sizes)
    pair = doc[1:] == doc[:-1]
    two = mixed(one[:-1] * ODD + one[1:])
    two[one[:-1] == one[1:]] = ODD
    both = np.concatenate([mixed(one), two[pair]]) >> shift
    owner = np.concatenate([doc, doc[1:][pair]])
    order = np.argsort(owner, kind="stable")
    return both[order].astype(np.int64), np.bincount(owner, minlength=len(docs))


class Ftrl:
    """Follow the regularised leader, per coordinate, with L1 and L2 penalties; 0 is the bias."""

    def __init__(self, size: int, alpha=0.3, beta=1.0, l1=0.02, l2=0.1):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        held = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -held / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        margin = float(np.clip(w @ value, -35, 35))
        gradient = (1 / (1 + math.exp(-margin)) - label) * value
        n = self.n[at]
        step = (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha
        self.z[at] += gradient - step * w
        self.n[at] = n + gradient**2


def train(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, bits=18, max_rows=8000, epochs=3
) -> tuple[np.ndarray, float]:
    """Weights and bias from labelled documents for which `usable` (over doc_id) holds.

    Of several labels of an id the least counts, of several texts the one of the least digest, so
    the same tables give the same weights however they are partitioned.
    """
    marked = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    marked = marked.where(F.col("label").isin(0, 1) & usable).groupBy("doc_id")
    marked = marked.agg(F.min("label").alias("label"))
    marked = marked.withColumn("draw", F.xxhash64(F.lit(7), "doc_id"))
    sample = marked.orderBy("draw").limit(max_rows)  # rows of ids and labels, bounded

    def features(batches):
        for batch in batches:
            for first, last in slices(batch):
                piece = batch.slice(first, last - first)
                hits, sizes = ngrams(piece.column("text").to_pylist(), bits)
                cuts = np.cumsum(sizes)[:-1]
                parts = [part.astype("<u4").tobytes() for part in np.split(hits, cuts)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("draw"), piece.column("label"), pa.array(parts, pa.binary())],
                    names=["draw", "label", "hits"],
                )

    digest = F.md5(F.col("text").cast("binary")).alias("digest")
    used = texts(docs).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "draw", "label")
    used = used.agg(F.min(F.struct(digest, "text")).alias("least"))
    rows = used.select("least.text", "draw", "label").mapInArrow(features, FEATURES)

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("draw", "ascending")])
        marks = table.column("label").to_pylist()
        model = Ftrl(1 << bits)
        documents = []
        for data in table.column("hits").to_pylist():
            at, count = np.unique(np.frombuffer(data, "<u4"), return_counts=True)
            value = count / math.sqrt(max(1, len(data) // 4))
            documents.append((np.append(0, at.astype(np.int64) + 1), np.append(1.0, value)))
        share = sum(marks) / len(marks)
        if 0 < share < 1:
            for turn in range(epochs):
                for row in np.random.default_rng(turn).permutation(len(marks)):
                    model.learn(*documents[row], marks[row])
            weights = model.weights()
        else:
            weights = np.zeros((1 << bits) + 1)
            weights[0] = 35.0 if share else -35.0
        return pa.table({"weights": [weights[1:].astype("<f4").tobytes()], "bias": [float(weights[0])]})

    fitted = rows.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(fit, MODEL).collect()
    if not fitted:
        return np.zeros(1 << bits, "<f4"), 0.0
    return np.frombuffer(fitted[0].weights, "<f4"), fitted[0].bias


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """doc_id and score of every row."""
    bits = int(len(weights)).bit_length() - 1

    def run(batches):
        for batch in batches:
            for first, last in slices(batch):
                piece = batch.slice(first, last - first)
                hits, sizes = ngrams(piece.column("text").to_pylist(), bits)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                total = np.bincount(owner, weights[hits].astype(np.float64), len(sizes))
                margin = np.clip(bias + total / np.sqrt(np.maximum(sizes, 1)), -35, 35)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(1 / (1 + np.exp(-margin)))],
                    names=["doc_id", "score"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == part


def classify(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, label="quality", threshold=0.7
) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from labels of rows that are not held out."""
    weights, bias = train(docs, labels, label, ~held_out(F.col("doc_id")))
    return score(docs, weights, bias).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
