"""URL allow and block rules by a trie over reversed host labels and path segments.

A rule is a host and the beginning of a path ("example.org/en/1"). It fits its host and all
subdomains, where the url's path starts with the rule's, letter by letter: "/en/1" fits
"/en/12". Of the rules that fit, the one with most host labels wins, then the one with the
longest path; where the same entry is both allowed and blocked, block wins.

In the trie, labels are walked from the last ("org", "example"); each label node may hold a
second trie over whole path segments, whose nodes hold the rules' last, unfinished segments
by length. A url is judged in one walk per label node that holds paths. The trie is built once
and broadcast: rules are given by people, and `max_broadcast` bounds them. More rules (from a
table of any size) are met by equality joins instead: each distinct (host, path) lists its host
suffixes and path beginnings of lengths in use, so work grows with the urls and not with the rules.

The host is what follows the first "://" up to "/", "?", "#" or the end, with A-Z in lower
case; ports and user names stay part of it, so rules fit only hosts without them. The path goes
on up to "?" or "#". A url that is NULL, empty or without "://" has an empty host and path and
fits no rule. A rule without a "/" has an empty path and fits every path
of its host. A rule with an empty host fits nothing. What no rule fits gets the default verdict.
Rows with equal or NULL page ids are rows like any other; an empty table gives no rows.
"""

import string
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE = "rule string, verdict string"
LOWER = string.ascii_lowercase
UPPER = string.ascii_uppercase


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _parts(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


class RuleTrie:
    """Rules by reversed host labels, then by path segments.

    A node is [labels, paths]; a path node is [segments, ends], where ends maps the length of an
    unfinished segment to {text: (verdict, rule)}.
    """

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: list = [{}, None]
        for rule, verdict in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict of {rule} is {verdict}, not allow or block")
            host, path = _parts(rule)
            if not host:
                continue
            node = self.root
            for label in reversed(host.split(".")):
                node = node[0].setdefault(label, [{}, None])
            if node[1] is None:
                node[1] = [{}, {}]
            at = node[1]
            *whole, last = path.split("/")
            for segment in whole:
                at = at[0].setdefault(segment, [{}, {}])
            ends = at[1].setdefault(len(last), {})
            ends[last] = max((verdict, rule), ends.get(last, (verdict, rule)))

    def hosts(self, host: str) -> Iterator[list]:
        """Path tries of the host and its parents, the longest host first."""
        found, node = [], self.root
        for label in reversed(host.split(".")) if host else ():
            node = node[0].get(label)
            if node is None:
                break
            if node[1] is not None:
                found.append(node[1])
        return reversed(found)

    @staticmethod
    def longest(node: list, path: str) -> tuple[str, str] | None:
        """The rule with the longest beginning of the path."""
        best, start = None, 0
        while True:
            end = path.find("/", start)
            segment = path[start:] if end < 0 else path[start:end]
            for length in sorted(node[1], reverse=True):
                hit = node[1][length].get(segment[:length]) if length <= len(segment) else None
                if hit:
                    best = hit
                    break
            if end < 0 or segment not in node[0]:
                return best
            node, start = node[0][segment], end + 1

    def judge(self, host: str, path: str) -> tuple[str, str] | None:
        for node in self.hosts(host):
            hit = self.longest(node, path)
            if hit:
                return hit
        return None


def _by_trie(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    trie = spark.sparkContext.broadcast(RuleTrie(rules))

    @F.pandas_udf("verdict string, rule string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = map(trie.value.judge, host, path)
        return pd.DataFrame([hit or (None, None) for hit in found], columns=["verdict", "rule"])

    return pages.withColumn("found", judge("host", "path")).select("*", "found.*").drop("found")


def _by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by equality joins, for any number of rules."""
    at = F.locate("/", F.col("rule"))
    host = F.when(at > 0, F.substring("rule", F.lit(1), at - 1)).otherwise(F.col("rule"))
    path = F.when(at > 0, F.substring("rule", at, F.length("rule"))).otherwise(F.lit(""))
    entries = (
        rules.select(F.translate(host, UPPER, LOWER).alias("rule_host"), path.alias("rule_path"), "rule", "verdict")
        .where("rule_host <> ''")
        .groupBy("rule_host", "rule_path")
        .agg(F.max(F.struct("verdict", "rule")).alias("entry"))
    )
    # path lengths of each host's rules: a row per host
    lengths = entries.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("sizes"))
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    urls = pages.select("host", "path").distinct().where("host <> ''")
    tried = (
        urls.select("*", F.posexplode(suffix).alias("n_cut", "rule_host"))
        .join(lengths, "rule_host")
        .select("host", "path", "n_cut", "rule_host", F.explode("sizes").alias("size"))
        .where("size <= length(path)")
        .withColumn("rule_path", F.expr("substring(path, 1, size)"))
    )
    # fewest labels cut off, then the longest path
    best = F.max(F.struct(-F.col("n_cut"), F.col("size"), F.col("entry"))).alias("best")
    hits = tried.join(entries, ["rule_host", "rule_path"]).groupBy("host", "path").agg(best)
    found = hits.select("host", "path", "best.entry.rule", "best.entry.verdict")
    return pages.join(found, ["host", "path"], "left")


def judge_urls(
    spark: SparkSession,
    pages: DataFrame,
    rules: Iterable[tuple[str, str]] | DataFrame,
    default: str = "allow",
    max_broadcast: int = 100_000,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """page_id, host, path, rule, verdict of every row; columns to carry come back as carried_<name>.

    rules: (rule, verdict) pairs or a table (rule, verdict). Up to max_broadcast rules travel as
    a trie; more are joined.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select(
        "page_id",
        host.alias("host"),
        path.alias("path"),
        *[F.col(f"`{name}`").alias("carried_" + name) for name in carry],
    )
    if isinstance(rules, DataFrame):
        rules = rules.select("rule", "verdict").where("rule IS NOT NULL")
        faults = rules.where("coalesce(verdict NOT IN ('allow', 'block'), true)")
        if not faults.isEmpty():
            raise ValueError("a verdict is neither allow nor block")
        held = rules.limit(max_broadcast + 1).collect()
        few = [tuple(row) for row in held] if len(held) <= max_broadcast else None
    else:
        pairs = list(rules)
        few = pairs if len(pairs) <= max_broadcast else None
        rules = None if few is not None else spark.createDataFrame(pairs, RULE)
    judged = _by_join(rows, rules) if few is None else _by_trie(spark, rows, few)
    order = ["page_id", "host", "path", "rule", "verdict", *["carried_" + name for name in carry]]
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default))).select(*order)
