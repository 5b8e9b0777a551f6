"""Documents to training windows: rules, near-duplicates, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of `documents`; the last returns packed pieces with their token ids.
No stage's result can be expressed in SQL, so ORACLE_SQL is None; tests/llm holds the
brute-force versions.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazline.llm.common import Stage, read
from hazline.llm.disclosure import sanitise
from hazline.llm.mixing import mix
from hazline.llm.neardup import keep_one
from hazline.llm.packing import pack
from hazline.llm.rules import quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _carried(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*[F.col("carried_" + name).alias(name) for name in names])


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules(spark, docs, carry=tuple(COLUMNS))
    return _carried(judged.where("kept"), COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return keep_one(spark, docs.select(COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data generalised and disclosing terms removed."""
    return sanitise(spark, docs.select(COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to tempered source weights; small sources repeat, within four passes."""
    return _carried(mix(spark, docs, carry=tuple(COLUMNS)), COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens."""
    return pack(
        docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"), split="drop_space", end_id=1
    )


STAGES = [
    ("quality rules", rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixture", mixture),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stage = read(spark, sf_dir, "documents"), Stage(spark)
    for name, step in STAGES[:-1]:
        docs = stage.put(name.replace(" ", "-"), step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
