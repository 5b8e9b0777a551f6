"""Token alignment, url rules and the dataset manifest against plain versions of their rules."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import connect, normal
from hazline.llm import alignment, manifest, queries, urlrules
from hazline.llm.tokens import byte_values

BYTE, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SF_DIR = "/root/testdata/sf0.001"


# alignment

ends = st.lists(st.integers(1, 400), unique=True).map(sorted)


@settings(max_examples=200, deadline=None)
@given(ends, ends)
def test_galloping_finds_common_values(a, b):
    in_a, in_b = alignment.common_ends(np.array(a, np.int64), np.array(b, np.int64))
    want = sorted(set(a) & set(b))
    assert [a[i] for i in in_a] == want and [b[i] for i in in_b] == want


def test_galloping_crosses_blocks():
    rng = np.random.default_rng(3)
    a, b = (np.unique(rng.integers(0, 60_000, n)) for n in (9_000, 40_000))
    in_a, in_b = alignment.common_ends(a, b)
    assert (a[in_a] == np.intersect1d(a, b)).all() and (b[in_b] == a[in_a]).all()


def plain_alignment(texts):
    """(n_a, n_b, links, groups text) of each text, token by token."""
    a_model = Tokenizer.from_file(BYTE)
    a_model.encode_special_tokens = True
    vocab = {i: byte_values(t) for t, i in a_model.get_vocab(with_added_tokens=False).items()}
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    out = []
    for text in texts:
        want = b" " + (text or "").encode()
        a = a_model.encode(want.decode(), add_special_tokens=False).ids
        b = b_model.encode(text or "")
        spelt = []
        for n in b:
            piece = b_model.id_to_piece(n)
            byte = re.fullmatch(r"<0x(..)>", piece)
            spelt.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        if not text or b"".join(vocab[i] for i in a) != want or b"".join(spelt) != want:
            out.append((0, 0, [], ""))
            continue
        groups, links, i, j, left, right = [], [], 0, 0, 0, 0
        start = 0, 0
        while i < len(a):
            left += len(vocab[a[i]])
            i += 1
            while right < left:
                right += len(spelt[j])
                j += 1
            if left == right:
                groups.append(",".join(map(str, a[start[0] : i])) + "|" + ",".join(map(str, b[start[1] : j])))
                links.append((a[i - 1], b[j - 1]))
                start = i, j
        out.append((len(a), len(b), links, ";".join(groups)))
    return out


def test_alignment(spark, docs, rows):
    own = [(r[0], r[1]) for r in rows]
    plain = plain_alignment([text for _, text in own])
    counts = Counter(link for _, _, links, _ in plain for link in links)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    want = Counter(
        (doc, n_a, n_b, len(links), len(links), sum(counts[x] == highest[x[1]] for x in links),
         sum(counts[x] for x in links), sha256(spelt.encode()).hexdigest() if n_a else "")
        for (doc, _), (n_a, n_b, links, spelt) in zip(own, plain, strict=True)
    )
    found = alignment.align_corpus(spark, docs, BYTE, PIECE)
    assert Counter(map(tuple, found.collect())) == want
    assert any(n_a != n_b for n_a, n_b, *_ in plain) and sum(n_a == 0 for n_a, *_ in plain) >= 2


def test_overlap_ranges_tile_the_text(spark, docs, rows):
    found = defaultdict(list)
    for r in alignment.overlap_ranges(docs.where("doc_id in (13, 18)"), BYTE, PIECE).collect():
        found[r.doc_id].append(r)
    texts = {r[0]: r[1] for r in rows}
    for doc, groups in found.items():
        groups.sort(key=lambda g: g.group)
        assert groups[0].start == 0 and groups[-1].end == len(texts[doc].encode()) + 1
        for one, two in zip(groups, groups[1:]):
            assert (one.end, one.a_first + one.a_size, one.b_first + one.b_size) == (two.start, two.a_first, two.b_first)
    assert len(found) == 2


def test_special_spellings_are_text(spark):
    docs = spark.createDataFrame([(1, "<|endoftext|> <s> <unk>"), (2, "a▁b"), (3, "x  y")], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.align_corpus(spark, docs, BYTE, PIECE).collect()}
    assert found[1].n_a > 3 and found[2].n_a == 0 and found[2].groups_sha256 == "" and found[3].n_links > 0


# url rules

URLS = [
    "http://example.org/es/1?x", "https://A.Example.ORG/en/12#t", "http://example.org", "http://org/", "http://forg/x",
    "http://x.com/fr/", "http://x.com/fr", "com://com/de/1", None, "", "no scheme", "://", "http://u@example.org:80/es/",
    "http://a..org/", "http://x.net/de/://y.org/", "http://.org/\n/x", "http://example.org/es", "ftp://y.example.org/en/1",
]


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    hits = []
    for rule, verdict in rules:
        rule_host, slash, tail = rule.partition("/")
        rule_host = rule_host.lower()
        if rule_host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + tail):
            hits.append((rule_host.count("."), len(slash + tail), verdict, rule))
    best = max(hits, default=(0, 0, default, None))
    return host, path, best[3], best[2]


MORE_RULES = [*queries.URL_RULES, ("com", "block"), ("x.com/", "allow"), ("x.com/", "block"), ("", "block"), ("/es/", "block"),
              ("org/es/very/long/path", "allow"), ("a..org/", "block"), ("example.org/e", "allow"), ("net/de/:", "block")]


@pytest.mark.parametrize("limit", [100, 0])
@pytest.mark.parametrize("rules", [queries.URL_RULES, MORE_RULES])
def test_url_rules(spark, rules, limit):
    rows = [(i % 7 or None, url, f"h{i}", "r") for i, url in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    found = urlrules.judge_urls(spark, pages, rules, max_broadcast=limit, carry=("host",))
    want = Counter((page, *plain_verdict(url, rules), host) for page, url, host, _ in rows)
    assert Counter(map(tuple, found.collect())) == want


def test_url_rules_from_a_table(spark):
    pages = spark.createDataFrame([(1, "http://a.x.org/b")], "page_id long, url string")
    table = spark.createDataFrame([("x.org/b", "block"), (None, "allow")], "rule string, verdict string")
    for limit in (0, 9):
        assert urlrules.judge_urls(spark, pages, table, max_broadcast=limit).first().verdict == "block"
    with pytest.raises(ValueError, match="neither"):
        urlrules.judge_urls(spark, pages, table.withColumn("verdict", F.lit("deny")))
    assert urlrules.judge_urls(spark, pages.limit(0), queries.URL_RULES).count() == 0


# manifest


def plain_up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha256("".join(last[i : i + 3]).encode()).hexdigest() for i in range(0, len(last), 3)])
    return levels


def plain_path(levels, at):
    steps = []
    for level in levels[:-1]:
        first = at - at % 3
        run = level[first : first + 3]
        steps.append((at % 3, run[: at % 3] + run[at % 3 + 1 :]))
        at //= 3
    return steps


def plain_manifest(rows):
    def leaf(r, text):
        fields = [r[0], r[3], r[2], r[4], text]
        return sha256(b"".join(b"-" if f is None else b"%d:%s" % (len(str(f).encode()), str(f).encode()) for f in fields)).hexdigest()

    by_source = defaultdict(list)
    for r in rows:
        even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        now = r[1].replace("\n", "") if even and r[1] is not None else r[1]
        by_source[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, now), r[0]))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for held in by_source.values():
        held.sort()
    trees = {s: plain_up([x[2] for x in by_source[s]]) for s in order}
    top = plain_up([trees[s][-1][0] for s in order])
    for at, s in enumerate(order):
        for i, (_, _, own, now, doc) in enumerate(by_source[s]):
            steps = plain_path(trees[s], i) + plain_path(top, at)
            folded = now
            for place, others in steps:
                folded = sha256("".join([*others[:place], folded, *others[place:]]).encode()).hexdigest()
            proof = sha256("".join(x for _, others in steps for x in others).encode()).hexdigest()
            yield doc, own, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]


def test_layout_is_van_emde_boas():
    for height in range(7):
        places = np.concatenate(manifest.addresses(height))
        assert sorted(places) == list(range(len(places)))
    # top tree first, then each bottom tree in one stretch: height 3 is 2 levels over nine of 2
    root, one, leaves = manifest.addresses(3)[3], manifest.addresses(3)[2], manifest.addresses(3)[0]
    assert root[0] == 0 and sorted([*root, *one]) == [0, 1, 2, 3]
    bottoms = [sorted([*manifest.addresses(3)[1][i : i + 1], *leaves[3 * i : 3 * i + 3]]) for i in range(9)]
    assert bottoms == [list(range(4 + 4 * i, 8 + 4 * i)) for i in range(9)]


@pytest.mark.parametrize("height", [1, 6])
def test_manifest(spark, docs, rows, height):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    want = Counter(plain_manifest(rows))
    found = manifest.manifest(spark, docs, now, height=height)
    assert Counter(map(tuple, found.collect())) == want
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)


def test_manifest_of_many_sources_and_long_ones(spark):
    rows = [(i, f"t{i}\n", None, None if i % 3 == 0 else f"s{i % 40}", i) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = manifest.manifest(spark, docs, height=2)
    plain = [(*r[:1], None, *r[2:]) for r in rows]
    assert Counter(r.verified for r in found.collect()) == {True: 700}
    assert {r.root for r in found.collect()} == {r[3] for r in plain_manifest(rows)} != {r[3] for r in plain_manifest(plain)}


def test_manifest_of_one_row_and_none(spark, docs, empty):
    one = manifest.manifest(spark, docs.where("doc_id = 13")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified
    assert one.proof_sha256 == sha256(b"").hexdigest()
    assert manifest.manifest(spark, empty).count() == 0
    assert alignment.align_corpus(spark, empty, BYTE, PIECE).count() == 0


@pytest.mark.parametrize("name", ["op9_search", "op12_url_filters", "op13_manifest"])
def test_query_equals_sql(spark, name):
    ours = normal(queries.QUERIES[name](spark, SF_DIR).toPandas())
    theirs = normal(connect(SF_DIR).execute(queries.ORACLES[name]).df())
    assert list(ours.columns) == list(theirs.columns) and len(ours) == len(theirs)
    assert ((ours == theirs) | (ours.isna() & theirs.isna())).all(axis=None)
