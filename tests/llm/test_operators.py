"""Each operator against a plain version of its rule, on awkward rows and on empty tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hazline.llm import classifier, disclosure, mixing, neardup, packing, records, rules, search, sharding, substrings
from hazline.llm.suffixes import common_prefix_reaches, suffix_array, words_of
from hazline.llm.tokens import Encoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def data(text):
    return (text or "").encode()


@pytest.mark.parametrize("path,split", [(BYTE, "leading_space"), (WORD, "drop_space")])
def test_ids_equal_those_of_whole_texts(rows, path, split):
    texts = [r[1] or "" for r in rows] + ["a \n b", " a", "a  ", "don't we're ' s", "İstanbul ΑΣ µª", "  ", "foo,bar. baz,"]
    own = Encoder(path, split, entries=50)
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    for _ in range(2):
        assert own.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in whole]


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(0)
    for _ in range(60):
        text = np.append(rng.integers(0, 4, rng.integers(1, 90)), 0).astype(np.int16)
        words = words_of(text)
        array = suffix_array(text, words, 20)
        keys = [tuple(np.append(text[i : i + 20], np.zeros(20, int))[:20]) for i in array]
        assert sorted(array) == list(range(len(text))) and keys == sorted(keys)
        same = common_prefix_reaches(words, array, 9)
        assert all(same[i] == (keys[i][:9] == keys[i - 1][:9]) for i in range(1, len(array)))


@pytest.mark.parametrize("hot", [64, 0])
def test_substrings(spark, docs, rows, hot):
    first = {}
    for doc, text, *_ in rows:
        b = data(text)
        for i in range(len(b) - 99):
            at = (-1 if doc is None else doc, i)
            first[b[i : i + 100]] = min(first.get(b[i : i + 100], at), at)
    want = []
    for doc, text, *_ in rows:
        b = data(text)
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if first[b[i : i + 100]] < (-1 if doc is None else doc, i):
                gone[i : i + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        want.append((doc, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    got = substrings.remove_repeats(spark, docs, hot=hot).drop("kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_rules_base(spark, docs, rows):
    want = Counter()
    for doc, text, *_ in rows:
        words = WORDS.findall(text or "")
        grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
        lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
        symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        want[doc, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed] += 1
    got = rules.quality_rules(spark, docs).collect()
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)


def plain_verdicts(rows, common=12):
    """(doc, lang): kept and both distances, in plain Python."""

    def apart(p, q):
        p, q = ([v / max(sum(x), 1) for v in x] for x in (p, q))
        half = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
        total = sum(v * np.log2(v / h) for x in (p, q) for v, h in zip(x, half, strict=True) if v > 0)
        return np.sqrt(max(total / 2, 0))

    said = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for name in {("all",), ("all",) if lang is None else ("of", lang)}:
            said[name].update(WORDS.findall(text))
    top = {k: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:common]] for k, c in said.items()}

    def histograms(text, name):
        words, chars = WORDS.findall(text), "".join(WORDS.findall(text))
        marks = len(re.findall(r"[!-/:-@\[-`{-~]", chars)) - len(re.findall(r"[#*$%&|<>]", chars))
        bins = [len(re.findall(x, chars)) for x in ("[A-Z]", "[0-9]", r"[#*$%&|<>]")] + [marks]
        hits = [words.count(w) for w in top[name]]
        return [*bins, len(chars) - sum(bins)], [*hits, len(words) - sum(hits)]

    def summed(good):
        made = {}
        for name in top:
            own = [text for text, lang in good if name == ("all",) or ("of", lang) == name]
            if len(own) >= 10 and sum(len(WORDS.findall(t)) for t in own) >= 5000:
                made[name] = [np.sum(x, axis=0) for x in zip(*(histograms(t, name) for t in own), strict=True)]
        return made

    def judge(refs):
        out = []
        for _, text, lang, *_ in rows:
            name = ("of", lang) if ("of", lang) in refs else ("all",)
            one, two = (apart(p, q) for p, q in zip(histograms(text, name), refs[name], strict=True))
            words = WORDS.findall(text)
            out.append((one, two, (sum(map(len, words)) >= 200 and one > 0.25) or (len(words) >= 40 and two > 0.35)))
        return out

    passing = [len(WORDS.findall(r[1])) >= 20 for r in rows]  # the rows have no repeated windows
    first = summed([(r[1], r[2]) for r, ok in zip(rows, passing, strict=True) if ok])
    near = [(r[1], r[2]) for r, ok, j in zip(rows, passing, judge(first), strict=True) if ok and not j[2]]
    second = judge({("all",): first[("all",)], **summed(near)})
    return {(r[0], r[2]): (ok and not far, a, b) for r, ok, (a, b, far) in zip(rows, passing, second, strict=True)}


def test_rules_verdict(spark, docs):
    rng = np.random.default_rng(3)

    def text(n, kind, share=0.5):
        often = [f"{kind}{c}" for c in "abcdefghij"]
        return " ".join(often[rng.integers(10)] if rng.random() < share else f"{kind}w{chr(97 + x % 26)}{chr(97 + x // 26)}" for x in rng.integers(0, 600, n))

    def junk(n):
        return " ".join(f"{x}%X#{x * 7 % 1000}" for x in rng.integers(0, 10**6, n))

    made = [(text(700 + i, "e"), "en") for i in range(60)] + [(text(800, "f"), "fr") for i in range(55)]
    # garbage without a language, and the only text under a tag, also a long one
    made += [(junk(80), None) for _ in range(12)] + [(junk(60), "qq"), (junk(5100), "long"), (text(90, "f"), "few"), (text(15, "e"), "few")]
    # prose without a language, and under tags that stand for something inside
    made += [(text(100, "e"), lang) for lang in (None, None, "*", "*", "", "", "l", "len")]
    # a language of two halves that both stand off from their sum: nothing is left for a second reference
    made += [(text(600, "u" if i % 2 else "v", 1), "halves") for i in range(12)]
    rows = [(i, t, lang, "s", 0, "", 0) for i, (t, lang) in enumerate(made)]
    want = plain_verdicts(rows)
    found = rules.quality_rules(spark, spark.createDataFrame(rows, docs.schema).repartition(3)).collect()
    assert len(found) == len(rows)
    got = {(r.doc_id, rows[r.doc_id][2]): r for r in found}
    for place, (kept, one, two) in want.items():
        assert got[place].kept == kept, place
        assert abs(got[place].class_distance - one) < 1e-9 and abs(got[place].word_distance - two) < 1e-9, place
    of = defaultdict(set)
    for (_, lang), r in got.items():
        of[lang].add(r.kept)
    assert of["en"] == of["fr"] == {True} and of["qq"] == of["long"] == of["halves"] == {False}
    assert not any(got[i, None].kept for i in range(115, 127))


def test_records_round_trip(spark, docs, rows, tmp_path):
    index = records.write_indexed(spark, docs, str(tmp_path), BYTE, "leading_space", 0)
    plain = Tokenizer.from_file(BYTE)
    want = sorted(
        ((-1 if d is None else d), np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
        for d, t, *_ in rows
    )
    got = sorted(((-1 if r.doc_id is None else r.doc_id), bytes(r.ids)) for r in records.read_records(index).collect())
    assert got == want
    starts = sorted((r.start, r.n_tokens) for r in records.record_digest(index).collect())
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
    file = next(tmp_path.rglob("*.rec"))
    broken = bytearray(file.read_bytes())
    broken[20] ^= 1
    with pytest.raises(ValueError):
        records.unframe(bytes(broken[: int.from_bytes(broken[:8], "little") + 16]))


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 9, 60), rng.integers(0, 9, 60)
    doc = np.repeat([0, 1], 60)
    shingle = np.tile(np.arange(60, dtype=np.uint64) + np.uint64(5), 2)
    count = np.concatenate([a, b])
    used = count > 0
    sig = neardup.signatures(doc[used], shingle[used], count[used], 2, 8192)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_near_duplicates(spark, empty):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 500, 120)]
    texts = ["", None, "one", "one", " ".join(base)]
    for n in range(40):
        words = list(base)
        for at in rng.integers(0, 120, 1 + n % 5):
            words[at] = f"new{n}x{at}"
        texts.append(" ".join(words))
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 500, 50 + n)) for n in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bags = []
    for t in texts:
        w = WORDS.findall(t or "")
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if (texts[i] or "") == (texts[j] or "") or (both and 10 * both >= 8 * sum((bags[i] | bags[j]).values())):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark, frame).collect()}
    assert got == dict(enumerate(root))
    assert neardup.keep_one(spark, frame).count() == len(set(root))


def test_disclosure_base_and_terms(spark, docs, rows):
    found = disclosure.protect(spark, docs).collect()
    assert len(found) == len(rows)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) < 256 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and disclosure.luhn(re.sub(r"\D", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.findall("[0-9]", m)) <= 15),
    )
    odd = ["a@b.c_d@e.f", "x@@y.z", "a@b", "..@-.-@q.w", "1.2.3.4.5.6.7.8", "0001.2.3.004", "+1 555 123 4567+1", "4111-1111-1111-1111 2"]
    for text in [r[1] or "" for r in rows] + odd:
        spans = disclosure.base_spans(text)
        assert {k: [m.span() for m in re.finditer(p, text) if ok(m[0])] for k, p, ok in kinds} == spans
    told = [(n, f"filler{n} words{n} go zanzibarian me.x@mail.example.com here{n}", "en", "s", 0, "", 0) for n in range(6)]
    frame = spark.createDataFrame([*told, *[(50 + n, f"plain text{n} go here", "en", "s", 0, "", 0) for n in range(60)]], docs.schema)
    clean = {r.doc_id: r.text for r in disclosure.sanitise(spark, frame).collect()}
    assert clean[0] == "filler0 words0 go [...] [email] here0" and clean[50] == "plain text0 go here"


def test_disclosing_terms_go_in_the_whole_text(spark, docs):
    far = " ".join(["plain text"] * 20)
    told = [(n, f"zanzibarian me.x@mail.example.com {far} Zanzibarian here{n}", "en", "s", 0, "", 0) for n in range(6)]
    # the term away from the address alone, before it, and without the address
    told += [(6, f"zanzibarian {far} me.x@mail.example.com", "en", "s", 0, "", 0)]
    told += [(7, "the zanzibarian alone", "en", "s", 0, "", 0)]
    frame = spark.createDataFrame([*told, *[(50 + n, f"plain text here {n}", "en", "s", 0, "", 0) for n in range(600)]], docs.schema)
    clean = {r.doc_id: r.text for r in disclosure.sanitise(spark, frame).collect()}
    assert all(clean[n] == f"[...] [email] {far} [...] here{n}" for n in range(6))
    assert clean[6] == f"[...] {far} [email]" and clean[7] == "the zanzibarian alone"


def test_terms_of_any_length_at_any_stretch(spark, docs):
    url = "https://x.example/" + "z" * 200
    told = [(n, f"my Li user_47 {url} a {n} 1.2.3.4, +1 555 123 4567 ok 4711 b{n}", "en", "s", 0, "", 0) for n in range(6)]
    plain = [(50 + n, f"my a ok https x example text{n}", "en", "s", 0, "", 0) for n in range(600)]
    frame = spark.createDataFrame([*told, *plain], docs.schema)
    clean = {r.doc_id: r.text for r in disclosure.sanitise(spark, frame, reach=8).collect()}
    shown = "https://x.example/[...] a {0} [ip], [phone] ok [...] b{0}"
    assert all(clean[n] == "my [...] [...] " + shown.format(n) for n in range(6)) and clean[50] == plain[0][1]


@pytest.mark.parametrize("blocks", [16, None])
def test_mixing_meets_weights(spark, blocks):
    sizes = {"a": 4000, "b": 400, "c": 20}
    rows = [(i, " ".join(["w"] * 10), s) for s, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn = mixing.mix(spark, frame, max_repeats=4, target_entropy=None, blocks=blocks).collect()
    got = Counter(r.source for r in drawn)
    t = mixing.exponent([40000, 4000, 200], 44200, 4, None)
    want = mixing.tempered([n / 44200 for n in (40000, 4000, 200)], t)
    for source, share in zip("abc", want, strict=True):
        assert abs(got[source] * 10 - share * 44200) <= 10
    assert got["c"] <= 80 and max(Counter((r.source, r.doc_id) for r in drawn).values()) <= 4


def test_exponent_meets_target_entropy():
    def share(sizes, t):
        return mixing.entropy(mixing.tempered([n / sum(sizes) for n in sizes], t)) / np.log(len(sizes))

    for sizes in ([100, 90, 110, 95], [200, 100, 100, 100, 100], [1000, 999]):
        t = mixing.exponent(sizes, sum(sizes), 4, 0.95)
        assert share(sizes, 1) > 0.95 and t > 1 and share(sizes, t) == pytest.approx(0.95)
    # the limit of passes ends it before the target: the large source is at the limit
    sizes = [110, 100, 100]
    t = mixing.exponent(sizes, 310, 1.2, 0.5)
    weights = mixing.tempered([n / 310 for n in sizes], t)
    assert t > 1 and share(sizes, t) > 0.5 and weights[0] * 310 / 110 == pytest.approx(1.2) and weights[0] * 310 / 110 <= 1.2
    # nothing to be done: equal sources, one source, a budget beyond the limit
    assert mixing.exponent([5, 5], 10, 4, 0.9) == 1 and mixing.exponent([5, 7], 120, 4, 0.9) == 1
    assert mixing.exponent([5], 5, 4, 0.9) == 0 and mixing.exponent([900, 100], 1000, 5.5, None) == 0


def test_packing_holds_each_id_once(spark, docs, rows):
    plain = Tokenizer.from_file(WORD)
    want = Counter()
    for d, t, *_ in rows:
        want[d, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    pieces = packing.pack(docs.coalesce(1), WORD, "drop_space", 1, capacity=256, group_windows=16).collect()
    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append((p.offset, p.length))
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length
    for parts in windows.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 256
    assert sum(p.length for p in pieces) == sum(len(ids) // 4 * n for (_, ids), n in want.items())
    held = defaultdict(set)
    for p in pieces:
        held[p.doc_id].add((p.start, bytes(p.ids)))
    for doc, ids in want:
        at = 0
        while at < len(ids) // 4:
            step = next(len(b) // 4 for s, b in held[doc] if s == at and ids[4 * at :].startswith(b))
            at += step


def test_differencing_balances():
    at, sums = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(sums) == [14, 16] and sum(sums) == 30
    at, sums = packing.difference(list(range(1, 200)), 7)
    assert sums.max() - sums.min() <= 5 and [sum(i + 1 for i in np.flatnonzero(at == w)) for w in range(7)] == list(sums)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(400)]
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0]), (502, [float("nan")] * 5), (503, [1.0, 2.0]), (None, [1.0] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = search.top_k(spark, frame, F.col("vec_id") % 50 == 0, k=5, scale=2, shard_rows=90).collect()
    points = {i: [int(2 * x) for x in v] for i, v in rows[:400]}
    want = set()
    for q in range(0, 400, 50):
        best = sorted((-sum(a * b for a, b in zip(points[q], points[i], strict=True)), i) for i in points if i != q)[:5]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == want
    assert {r.query_copy for r in got} == {1}


def test_shards(spark, docs, rows):
    got = sharding.shard_rows(spark, docs, 4).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(s) for s in by.values()]
    assert len(got) == len(rows) and max(counts) - min(counts) <= 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len(data(t)) + 1, zlib.crc32(data(t))) for d, t, *_ in rows
    )


def test_classifier_learns(spark, empty):
    good = [(i, f"alpha beta gamma number{i % 7} delta") for i in range(150)]
    bad = [(200 + i, f"alpha!! beta!! gamma!! number{i % 7}!!") for i in range(150)]
    extra = [(500, None), (501, ""), (None, "alpha")]
    frame = spark.createDataFrame(good + bad + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in good + bad] + [(500, None)], "doc_id long, quality int")
    got = classifier.classify(spark, frame, labels).collect()
    assert len(got) == 303
    assert all(r.predicted == (r.doc_id < 200) for r in got if r.doc_id is not None and r.doc_id < 500)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 for r in got)
    none = classifier.classify(spark, frame, labels.where("doc_id < 0")).collect()
    assert {r.score for r in none} == {0.5}


def test_empty_tables_give_no_rows(spark, empty, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    frames = [
        substrings.remove_repeats(spark, empty),
        classifier.classify(spark, empty, labels),
        rules.quality_rules(spark, empty),
        records.record_digest(records.write_indexed(spark, empty, str(tmp_path), BYTE, "leading_space", 0)),
        neardup.near_duplicates(spark, empty),
        disclosure.protect(spark, empty),
        mixing.mix(spark, empty),
        packing.pack(empty, WORD, "drop_space", 1),
        search.top_k(spark, vectors, F.col("vec_id") % 50 == 0),
        sharding.shard_rows(spark, empty, 8),
    ]
    assert [f.count() for f in frames] == [0] * 10
