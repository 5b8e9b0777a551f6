"""Registered queries of this package and their SQL counterparts."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazline.llm.alignment import align_corpus
from hazline.llm.classifier import classify
from hazline.llm.common import read
from hazline.llm.disclosure import BASE, protect
from hazline.llm.manifest import manifest
from hazline.llm.mixing import mix
from hazline.llm.neardup import near_duplicates
from hazline.llm.packing import pack
from hazline.llm.records import record_digest, write_indexed
from hazline.llm.rules import quality_rules
from hazline.llm.search import top_k
from hazline.llm.sharding import shard_rows
from hazline.llm.substrings import remove_repeats
from hazline.llm.urlrules import judge_urls
from hazline.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


@query()
def op1_substrings(spark, sf_dir):
    """Bytes of all documents without 100-byte strings that start earlier as well."""
    return remove_repeats(spark, read(spark, sf_dir, "documents"), length=100, kept=False).drop("kept")


@query()
def op2_quality(spark, sf_dir):
    """Quality of all documents, learnt from the labels of three of four parts of them."""
    return classify(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op3_rules(spark, sf_dir):
    """Repetition counts and divergence from language references, for all documents."""
    return quality_rules(spark, read(spark, sf_dir, "documents"))


@query()
def op4_records(spark, sf_dir):
    """Token ids of all documents as framed records, read back through the offset index."""
    index = write_indexed(
        spark,
        read(spark, sf_dir, "documents"),
        shared_dir(spark),
        tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
        split="leading_space",
        end_id=0,
    )
    return record_digest(index)


@query()
def op5_near_duplicates(spark, sf_dir):
    """The near-duplicate class of every document."""
    return near_duplicates(spark, read(spark, sf_dir, "documents")).drop("node", "root")


@query()
def op6_disclosure(spark, sf_dir):
    """Personal data and disclosing terms in all documents."""
    counts = ["n_" + kind for kind in BASE]
    found = protect(spark, read(spark, sf_dir, "documents"))
    return found.select("doc_id", *counts, "base_sha256", "spans")


@query()
def op7_mixing(spark, sf_dir):
    """All documents drawn to tempered source weights, within four passes of a source."""
    return mix(spark, read(spark, sf_dir, "documents"))


@query()
def op8_packing(spark, sf_dir):
    """All documents cut and packed into windows of 2048 tokens."""
    pieces = pack(
        read(spark, sf_dir, "documents"),
        tokenizer=public_tokenizers.path("word_bpe_49k.json"),
        split="drop_space",
        end_id=1,
        ids=False,
    )
    return pieces.drop("ids")


SEARCH_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS n, vec_id,
    list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
),
query AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v) AS copy FROM whole WHERE vec_id % 50 = 0
),
scored AS (
  SELECT q.n, q.copy, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1),
         lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM query q JOIN whole c ON q.n <> c.n AND len(q.v) = len(c.v)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, copy::INTEGER AS query_copy, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


@query(SEARCH_SQL)
def op9_search(spark, sf_dir):
    """The five rows of highest inner product for every fiftieth vector, over all others."""
    return top_k(spark, read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op10_sharding(spark, sf_dir):
    """All documents in eight shards of equally many rows, each with the mixture of sources."""
    rows = shard_rows(spark, read(spark, sf_dir, "documents"), shards=8)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


@query()
def op11_alignment(spark, sf_dir):
    """Groups, links and corpus-wide link counts of two tokenizers over all documents."""
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_corpus(spark, read(spark, sf_dir, "documents"), *paths)


# The rules that the query applies.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]

URL_SQL = """
WITH rules(rule, host, path, verdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
rests AS (
  SELECT row_number() OVER () AS n, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests),
best AS (
  SELECT p.n, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (n)
"""


@query(URL_SQL)
def op12_url_filters(spark, sf_dir):
    """Host, path, longest rule and verdict of the url of every page."""
    return judge_urls(spark, read(spark, sf_dir, "pages"), URL_RULES)


# crc32 of a decimal id, bit by bit; tampering, as in the query, deletes line ends of even ones
MERKLE_SQL = """
WITH RECURSIVE crcs AS (
  SELECT DISTINCT doc_id, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
      lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)) AS crc
  FROM documents),
fields AS (
  SELECT d.doc_id, d.source,
    CASE WHEN xor(c.crc, 4294967295::BIGINT) % 2 = 0 THEN replace(d.text, chr(10), '') ELSE d.text END AS now,
    d.text,
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id::VARCHAR, '-') ||
    coalesce(strlen(d.source) || ':' || d.source, '-') ||
    coalesce(strlen(d.lang) || ':' || d.lang, '-') ||
    coalesce(strlen(d.n_chars::VARCHAR) || ':' || d.n_chars::VARCHAR, '-') AS head
  FROM documents d JOIN crcs c ON c.doc_id IS NOT DISTINCT FROM d.doc_id),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
      sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS current FROM fields)),
up AS (
  SELECT source, 0 AS lvl, pos AS i, leaf AS h FROM leaves
  UNION ALL
  SELECT source, lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM up) WHERE n > 1 GROUP BY source, lvl, i // 3),
subs AS (
  SELECT source, arg_max(h, lvl) AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos
  FROM up GROUP BY source),
top AS (
  SELECT 0 AS lvl, pos AS i, subroot AS h FROM subs
  UNION ALL
  SELECT lvl + 1, i // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY lvl, i // 3),
root AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS height FROM top),
heights AS (SELECT source, max(lvl) AS height FROM up GROUP BY source),
low AS (
  SELECT l.doc_id, l.leaf, l.source, 0 AS lvl, l.pos AS i, l.current AS h, '' AS proof FROM leaves l
  UNION ALL
  SELECT w.doc_id, w.leaf, w.source, w.lvl + 1, w.i // 3,
    sha256(string_agg(CASE WHEN u.i = w.i THEN w.h ELSE u.h END, '' ORDER BY u.i)),
    w.proof || coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i <> w.i), '')
  FROM low w JOIN heights t ON t.source IS NOT DISTINCT FROM w.source AND w.lvl < t.height
    JOIN up u ON u.source IS NOT DISTINCT FROM w.source AND u.lvl = w.lvl AND u.i // 3 = w.i // 3
  GROUP BY w.doc_id, w.leaf, w.source, w.lvl, w.i, w.h, w.proof),
high AS (
  SELECT w.doc_id, w.leaf, s.subroot, 0 AS lvl, s.pos AS i, w.h, w.proof
  FROM low w JOIN heights t ON t.source IS NOT DISTINCT FROM w.source AND w.lvl = t.height
    JOIN subs s ON s.source IS NOT DISTINCT FROM w.source
  UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.lvl + 1, w.i // 3,
    sha256(string_agg(CASE WHEN u.i = w.i THEN w.h ELSE u.h END, '' ORDER BY u.i)),
    w.proof || coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i <> w.i), '')
  FROM high w JOIN root r ON w.lvl < r.height JOIN top u ON u.lvl = w.lvl AND u.i // 3 = w.i // 3
  GROUP BY w.doc_id, w.leaf, w.subroot, w.lvl, w.i, w.h, w.proof)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM high JOIN root ON lvl = height
"""


@query(MERKLE_SQL)
def op13_manifest(spark, sf_dir):
    """Leaf, roots, proof and verification of every document; even ids' texts have lost their line ends."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest(spark, read(spark, sf_dir, "documents"), now)
