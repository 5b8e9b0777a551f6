"""The pipeline's stages, each on its own, against plain versions of what they must do."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from hazline.llm import classifier
from hazline.llm.mixing import exponent, tempered

SF_DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def columns(frame):
    assert frame.columns == pipeline.COLUMNS
    return [tuple(row) for row in frame.collect()]


def as_rows(rows):
    return [tuple(r[:5]) for r in rows]


def test_rules_keep_what_passes_and_change_nothing(spark, docs, rows):
    kept = Counter(columns(pipeline.rules(spark, docs, "")))
    assert not kept - Counter(as_rows(rows))
    for row in rows:
        words = WORDS.findall(row[1] or "")
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        repeated = set()
        for i in range(len(words) - 7):
            if windows[tuple(words[i : i + 8])] > 1:
                repeated.update(range(i, i + 8))
        if len(words) < 20 or 100 * len(repeated) > 30 * len(words):
            assert as_rows([row])[0] not in kept
    assert kept


def test_one_of_each_near_duplicate_class_stays(spark, docs, rows):
    bags = []
    for _, text, *_ in rows:
        w = WORDS.findall(text or "")
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or (both and 10 * both >= 8 * sum((bags[i] | bags[j]).values())):
                x, y = sorted((root[i], root[j]))
                root = [x if r == y else r for r in root]
    classes = defaultdict(list)
    for row, r in zip(as_rows(rows), root, strict=True):
        classes[r].append(row)
    kept = columns(pipeline.near_duplicates(spark, docs, ""))
    assert len(kept) == len(classes)
    least = {min(row[0] for row in own if row[0] is not None) if any(row[0] is not None for row in own) else None for own in classes.values()}
    assert {row[0] for row in kept} == least and set(kept) <= set(as_rows(rows))


def test_personal_data_goes_and_all_else_stays(spark, docs, rows):
    clean = columns(pipeline.personal_data(spark, docs, ""))
    assert Counter(r[0] for r in clean) == Counter(r[0] for r in rows)
    before = defaultdict(set)
    for r in rows:
        before[r[0]].add(r[1])
    for doc, text, *_ , n_chars in clean:
        assert text in before[doc] or "[" in text
        assert n_chars == (None if text is None else len(text))
        for sign in ("me.x@mail.example.com", "+1 (555) 123-4567"):
            assert sign not in (text or "")
    assert any("[email] or [phone]" in (r[1] or "") for r in clean)


def test_mixture_meets_the_weights(spark):
    words = {"a": 30, "b": 60, None: 20}
    sizes = {"a": 600, "b": 150, None: 50}
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(words[s])), "en", s, 0) for i, s in enumerate(s for s in sizes for _ in range(sizes[s]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    drawn = columns(pipeline.mixture(spark, docs, ""))
    assert set(drawn) <= set(as_rows(rows))
    tokens = {s: sizes[s] * words[s] for s in sizes}
    total = sum(tokens.values())
    names = list(tokens)
    t = exponent([tokens[s] for s in names], total, 4, 0.95)
    weights = dict(zip(names, tempered([tokens[s] for s in names], t), strict=True))
    times = Counter(drawn)
    for s in names:
        own = {row: n for row, n in times.items() if row[3] == s}
        share = sum(n * len(row[1].split()) for row, n in own.items()) / total
        assert share == pytest.approx(weights[s], abs=0.05)
        # whole passes, then part of one more
        counts = {n for n in own.values()} | ({0} if len(own) < sizes[s] else set())
        assert max(counts) - min(counts) <= 1 and max(counts) <= 4


def test_packing_holds_every_id_once(spark, docs, rows):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = pipeline.packing(spark, docs.select(pipeline.COLUMNS), "").collect()
    want = Counter()
    for doc, text, *_ in rows:
        want.update((doc, i) for i in [*plain.encode(text or "", add_special_tokens=False).ids, 1])
    found = Counter()
    windows = Counter()
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(ids) == p.length
        found.update((p.doc_id, int(i)) for i in ids)
        windows[p.sequence_id] += p.length
    assert found == want and max(windows.values()) <= 2048


def test_stages_take_empty_tables(spark, empty):
    docs = empty.select(pipeline.COLUMNS)
    for name, step in pipeline.STAGES:
        out = step(spark, docs, "")
        assert out.count() == 0, name
        if name != "packing":
            assert out.columns == pipeline.COLUMNS


def test_run_applies_the_stages_in_order(spark):
    pieces = pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["quality rules", "near-duplicates", "personal data", "mixture", "packing"]
    judged = columns(pipeline.rules(spark, docs, SF_DIR))
    alone = {r[0] for r in columns(pipeline.near_duplicates(spark, pipeline.rules(spark, docs, SF_DIR), SF_DIR))}
    packed = {r.doc_id for r in pieces.select("doc_id").distinct().collect()}
    assert packed <= alone <= {r[0] for r in judged} and len(packed) > 50
    lengths = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in lengths) <= 2048


# training, step by step


def test_training_is_plain_follow_the_regularised_leader():
    rng = np.random.default_rng(2)
    model = classifier.Ftrl(16)
    z, n = [0.0] * 17, [0.0] * 17
    for _ in range(300):
        at = np.unique(rng.integers(0, 17, 5))
        value, label = rng.random(len(at)) + 0.1, int(rng.integers(0, 2))
        weight = {}
        for i in at:
            held = max(abs(z[i]) - model.l1, 0) * (1 if z[i] > 0 else -1)
            weight[i] = -held / ((model.beta + n[i] ** 0.5) / model.alpha + model.l2)
        margin = sum(weight[i] * x for i, x in zip(at, value, strict=True))
        error = 1 / (1 + np.exp(-margin)) - label
        for i, x in zip(at, value, strict=True):
            g = error * x
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / model.alpha
            z[i] += g - sigma * weight[i]
            n[i] += g * g
        model.learn(at, value, label)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)
