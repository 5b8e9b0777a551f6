"""Personal data: patterns, and terms that reveal them by corpus co-occurrence.

Protected entities are e-mail addresses, IP addresses, card and phone numbers, and secrets (keys
and passwords). A term near an entity (within `reach` words) can disclose it: over the whole
corpus, the pointwise mutual information of term and entity is compared with the information
content of the entity, and a term that reveals `threshold` of it or more becomes a span of its
own wherever it stands in a document that holds the entity, near it or not. Evidence counts
only if it comes from `support` different texts or more. Document frequencies are taken over
all documents.

A word is a run of letters, digits and underscores (Unicode) of any length, in lower case: short
names, handles, customer and account numbers are words as they stand; a hyphen, dot or
apostrophe parts words, and a run of a script without spaces is one word. Words that touch an entity are
no terms and do not count towards `reach`; the words of anything else, such as a URL, do.

Entities are compared in one spelling: e-mail addresses in lower case, card and phone numbers
by their digits. Secrets are known forms of keys (`SECRET`); add others there.

Only documents with entities give (entity, term) pairs, in proportion to their entities. Words
are counted in the whole corpus only where a filter of fixed size (2^20 bits) says
that they may be such a term; what it lets through in vain is dropped by the join that
follows. Spans of terms are found in the same way, by a filter (2^24 bits) of the disclosing
pairs that is asked for each entity of a document and each word of it. Counting uses hashes of terms and entities; spans come from the text itself.

NULL and empty texts have no spans; rows that repeat an id are treated one by one; with an empty
table there is nothing to count.
"""

import hashlib
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazline.llm.common import Stage, bigint, lean, slices, texts, utf8

# The patterns of the four base kinds, and of secrets.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(
    r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
    r"|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    r"|\b(?:password|passwd|secret|token|api_key)=[^\s]+"
)
SECRET_SIGNS = ("AKIA", "=", "gh", "xox", "sk_live_", "eyJ", "PRIVATE KEY")
BASE = ("email", "ip", "card", "phone")
WORD = re.compile(r"\w+")
BITS = 20
PAIR_BITS = 24

FOUND = T.StructType(
    [
        bigint("doc_id"),
        bigint("text_key"),
        *(bigint("n_" + kind) for kind in BASE),
        T.StructField("base_spans", T.StringType()),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("secrets", T.StringType()),
        T.StructField(
            "near",
            T.ArrayType(T.StructType([bigint("entity"), bigint("term")])),
        ),
        T.StructField("entities", T.ArrayType(T.LongType())),
    ]
)
MARKS = "doc_id long, text_key long, entity long, term long, places array<struct<first: int, last: int>>"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each '@' so that long runs without one cost nothing."""
    spans, past, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            past = domain.end()
            spans.append((start, past))
        at = text.find("@", max(at + 1, past))
    return spans


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {"email": emails(text) if "@" in text else [], "ip": [], "card": [], "phone": []}
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out["phone"].append(m.span())
    return out


def listed(kind: str, spans) -> list[str]:
    return [f"{kind}:{first}:{last}" for first, last in spans]


def key(text: str) -> int:
    return xxhash.xxh64_intdigest(utf8(text)) - (1 << 63)


def secret_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in SECRET.finditer(text)] if any(s in text for s in SECRET_SIGNS) else []


def entity_key(kind: str, text: str) -> int:
    """The entity whatever its spelling."""
    if kind == "email":
        text = text.lower()
    elif kind in ("card", "phone"):
        text = "".join(c for c in text if "0" <= c <= "9")
    return key(f"{kind}:{text}")


def entities_of(text: str) -> list[tuple[int, int, int]]:
    """(first, last, entity) of all base spans and secrets, in order."""
    spans = {**base_spans(text), "secret": secret_spans(text)}
    found = {(a, b, entity_key(kind, text[a:b])) for kind, own in spans.items() for a, b in own}
    return sorted(found)


def free_words(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Words of the text that touch none of the (sorted) spans."""
    out, at, past = [], 0, 0
    for a, b in (m.span() for m in WORD.finditer(text)):
        while at < len(spans) and spans[at][0] < b:
            past = max(past, spans[at][1])
            at += 1
        if past <= a:
            out.append((a, b))
    return out


def near_terms(text: str, found: list[tuple[int, int, int]], reach: int) -> set[tuple[int, int]]:
    """(entity, term) of the `reach` words before and after each entity, however far they stand."""
    words = free_words(text, [(a, b) for a, b, _ in found])
    starts = [a for a, _ in words]
    terms = [key(text[a:b].lower()) for a, b in words]
    out = set()
    for first, _, entity in found:
        at = bisect_left(starts, first)  # no free word starts within the entity
        out.update((entity, term) for term in terms[max(0, at - reach) : at + reach])
    return out


def find(docs: DataFrame, reach: int) -> DataFrame:
    """Spans of entities in every text, and the terms near them."""
    schema = pa.schema(
        [(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in FOUND.fields[:-2]]
        + [
            (
                "near",
                pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64())])),
            ),
            ("entities", pa.list_(pa.int64())),
        ]
    )

    def run(batches):
        for batch in batches:
            for first, last in slices(batch):
                piece = batch.slice(first, last - first)
                rows = []
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    spans = base_spans(text)
                    base = [s for kind in BASE for s in listed(kind, spans[kind])]
                    secret = secret_spans(text)
                    every = entities_of(text) if secret or any(spans.values()) else []
                    near = sorted(near_terms(text, every, reach)) if every else []
                    rows.append(
                        {
                            "doc_id": doc,
                            "text_key": key(text),
                            **{"n_" + kind: len(spans[kind]) for kind in BASE},
                            "base_spans": ",".join(base),
                            "base_sha256": hashlib.sha256(",".join(base).encode()).hexdigest(),
                            "secrets": ",".join(listed("secret", secret)),
                            "near": [{"entity": e, "term": t} for e, t in near],
                            "entities": sorted({entity for *_, entity in every}),
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return texts(docs).mapInArrow(lean(run), FOUND)


def hash_filter(hashes: DataFrame, column: str, n_bits: int) -> bytes:
    """Bits of hashes: at most 2^(n_bits - 6) words of 64 bits reach the driver, whatever the corpus."""
    bit = F.expr(f"({column}) & {(1 << n_bits) - 1}L").alias("at")
    cells = hashes.select(bit).selectExpr("at div 64 AS cell", "shiftleft(1L, int(at % 64)) AS bit")
    cells = cells.groupBy("cell").agg(F.bit_or("bit").alias("word"))
    bits = np.zeros(1 << (n_bits - 6), np.uint64)
    for cell, word in cells.collect():
        bits[cell] = word & 0xFFFFFFFFFFFFFFFF
    return bits.tobytes()


def term_counts(docs: DataFrame, bits: bytes) -> DataFrame:
    """Documents in which each term that passes the filter occurs: term, n."""

    def run(batches):
        cells = np.frombuffer(bits, np.uint64)
        mask = (1 << BITS) - 1
        known: dict[str, int | None] = {}
        held = 0  # characters of known
        seen: Counter = Counter()

        def made():
            found = pa.RecordBatch.from_pydict({"term": list(seen), "n": list(seen.values())}, schema=schema)
            seen.clear()
            return found

        schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])
        for batch in batches:
            for first, last in slices(batch):
                for text in batch.column("text").slice(first, last - first).to_pylist():
                    # lower case word by word, as for the terms: it can change what is a word
                    own = {w.lower() for w in set(WORD.findall(text))}
                    for word in [w for w in own if w not in known]:
                        h = key(word)
                        held += len(word)
                        at = h & mask
                        known[word] = h if int(cells[at >> 6]) >> (at & 63) & 1 else None
                    seen.update(map(known.__getitem__, own))
                if len(known) > 400_000 or held > 8_000_000:
                    known.clear()
                    held = 0
            del seen[None]
            yield made()

    rows = texts(docs).select("text").mapInArrow(lean(run), "term long, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


def disclosing(
    docs: DataFrame, found: DataFrame, stage: Stage, threshold: float, support: int
) -> DataFrame:
    """entity, term pairs whose mutual information reaches the threshold."""
    pairs = found.select("text_key", F.explode("near").alias("x")).select("text_key", "x.entity", "x.term")
    # texts first, so that a group of copies is one row of evidence per pair; a row holds a pair once
    per_text = pairs.groupBy("entity", "term", "text_key").agg(F.count("*").alias("n"))
    both = per_text.groupBy("entity", "term").agg(F.count("*").alias("texts"), F.sum("n").alias("n_both"))
    both = stage.put("pairs", both.where(F.col("texts") >= support))
    own = found.select(F.explode("entities").alias("entity")).groupBy("entity")
    own = own.agg(F.count("*").alias("n_entity"))
    terms = term_counts(docs, hash_filter(both, "term", BITS))
    total = docs.count()
    joined = both.join(own, "entity").join(terms, "term")
    information = F.log(F.lit(float(max(total, 1))) / F.col("n_entity"))
    mutual = F.log(F.lit(float(max(total, 1))) * F.col("n_both") / (F.col("n_entity") * F.col("n")))
    return joined.where((information > 0) & (mutual >= threshold * information)).select("entity", "term")


def marks(docs: DataFrame, bits: bytes) -> DataFrame:
    """Entities and words of a text that may be disclosing pairs, with all places of the word."""
    schema = pa.schema(
        [
            *((name, pa.int64()) for name in ("doc_id", "text_key", "entity", "term")),
            ("places", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
        ]
    )

    def run(batches):
        cells = np.frombuffer(bits, np.uint64)
        mask = np.int64((1 << PAIR_BITS) - 1)
        for batch in batches:
            for first, last in slices(batch):
                piece = batch.slice(first, last - first)
                rows = []
                for doc, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    every = entities_of(text)
                    if not every:
                        continue
                    places = defaultdict(list)
                    for a, b in free_words(text, [(a, b) for a, b, _ in every]):
                        places[text[a:b].lower()].append({"first": a, "last": b})
                    words = list(places)
                    terms = np.array([key(word) for word in words], np.int64)
                    text_key = key(text)
                    for entity in sorted({entity for *_, entity in every}):
                        at = (terms ^ np.int64(entity)) & mask
                        maybe = cells[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
                        for n in np.flatnonzero(maybe):
                            rows.append((doc, text_key, entity, int(terms[n]), places[words[n]]))
                columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

    return texts(docs).mapInArrow(lean(run), MARKS)


def protect(
    spark: SparkSession,
    docs: DataFrame,
    reach: int = 6,
    threshold: float = 0.9,
    support: int = 3,
    stage: Stage | None = None,
) -> DataFrame:
    """doc_id, text_key, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row."""
    stage = stage or Stage(spark)
    found = stage.put("found", find(docs, reach))
    strong = stage.put("strong", disclosing(docs, found, stage, threshold, support))
    maybe = marks(docs, hash_filter(strong, "entity ^ term", PAIR_BITS))
    hits = maybe.join(strong, ["entity", "term"]).select("doc_id", "text_key", F.explode("places").alias("x"))
    hits = hits.select("doc_id", "text_key", "x.first", "x.last").distinct()
    told = hits.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("told")
    )
    told = told.select(
        F.col("doc_id").alias("told_id"),
        F.col("text_key").alias("told_key"),
        F.array_join(
            F.transform("told", lambda x: F.concat_ws(":", F.lit("term"), x["first"], x["last"])), ","
        ).alias("told"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("told_id")) & (F.col("text_key") == F.col("told_key"))
    spans = F.concat_ws(
        ",", *[F.when(F.col(c) != "", F.col(c)) for c in ("base_spans", "secrets", "told")]
    )
    return found.join(told, same, "left").select(
        "doc_id", "text_key", *["n_" + kind for kind in BASE], "base_sha256", spans.alias("spans")
    )


def replace_spans(text: str, spans: str) -> str:
    """The text with entities generalised to their kind and disclosing terms removed."""
    parts = [s.split(":") for s in spans.split(",")] if spans else []
    rank = {kind: n for n, kind in enumerate((*BASE, "secret", "term"))}
    cuts = sorted(((int(a), -int(b), rank[kind], kind) for kind, a, b in parts))
    out, past = [], 0
    for first, last, _, kind in cuts:
        if first < past:  # overlaps a span already replaced: stretch that one
            past = max(past, -last)
            continue
        out += [text[past:first], "[...]" if kind == "term" else f"[{kind}]"]
        past = -last
    return "".join(out) + text[past:]


def sanitise(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows of docs with their texts sanitised and n_chars, where there, made to fit."""
    spans = protect(spark, docs, **options).where(F.col("spans") != "").select(
        F.col("doc_id").alias("span_id"), F.col("text_key").alias("span_key"), "spans"
    ).distinct()

    # columns by number, so that no name of the user's meets those of the keys
    inner = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    text_at, own_id = (docs.columns.index(name) for name in ("text", "doc_id"))
    field = inner.schema[text_at]

    def keys(batches):
        for batch in batches:
            found = [key(text or "") for text in batch.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "own_key"])

    def run(batches):
        for batch in batches:
            rows = zip(batch.column(text_at).to_pylist(), batch.column("spans").to_pylist(), strict=True)
            made = [replace_spans(t, s) if t and s else t for t, s in rows]
            old = batch.schema.field(text_at)
            yield batch.drop_columns(["spans"]).set_column(text_at, old, pa.array(made, old.type))

    keyed = inner.mapInArrow(lean(keys), T.StructType([*inner.schema.fields, bigint("own_key")]))
    same = F.col(f"c{own_id}").cast("long").eqNullSafe(F.col("span_id")) & (F.col("own_key") == F.col("span_key"))
    joined = keyed.join(spans, same, "left").select(*inner.columns, "spans")
    clean = joined.mapInArrow(lean(run), inner.schema)
    if "n_chars" in docs.columns:
        count = f"c{docs.columns.index('n_chars')}"
        clean = clean.withColumn(count, F.length(field.name).cast(docs.schema["n_chars"].dataType))
    return clean.toDF(*docs.columns)
