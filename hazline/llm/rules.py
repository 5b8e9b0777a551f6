r"""Quality rules: repetition counts, and divergence of histograms from language references.

All in DataFrame functions. Texts are read twice: once to count the words of each language,
once to judge; what follows works on a stored table of counts. Columns to carry along come
back as carried_<name>.

Base: `base_failed` for fewer than 20 words, or over 30 % of words in 8-word windows that occur
twice or more in the text. Divergence: a text's histogram of character classes (capitals,
digits, symbols, marks, the rest) and of the commonest words of its language (and all others)
are compared with those of the language, summed over all texts that pass the base, and again over those
of them that the first references do not reject. The distance is the square root of the Jensen-Shannon divergence in bits, from 0 to 1. A distance
counts only where the text is long enough for its histogram: `min_chars`, `min_words`.

References are one row per language. A language has one only if the texts it sums are
`min_reference_texts` (10) or more and hold `min_reference_words` (5,000) or more words, so that no text is
compared with little but itself. A text whose language is NULL or has no reference is compared with the
whole corpus: with the commonest words of all texts, and all texts that pass. If those that are left for
the second comparison are too few even for that, the first one's reference of the whole corpus holds.
NULL and empty texts have no words and fail the base; rows that
repeat an id are judged one by one; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazline.llm.common import Stage

SYMBOLS = "#*$%&|<>"
WINDOW = 8
ALL = "*"  # key of the reference over the whole corpus; those of languages begin with "l"


def _number_of(text: Column, characters: str) -> Column:
    """Characters of a class; what lies between them goes in whole runs."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", ""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _windows(codes: str) -> Column:
    n = F.size(codes) - (WINDOW - 1)
    # word by word: a slice would copy the whole array for each window
    spans = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.xxhash64(*[F.get(codes, i + k) for k in range(WINDOW)]),
    )
    return F.when(n > 0, spans).otherwise(F.array().cast("array<bigint>"))


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds codes (hashes of the words), rare, word_chars, n_words, n_symbols, n_dup_lines and
    n_repeat_words to rows with a text. rare is the text without what no class of characters counts."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = (
        docs.withColumn("words", words_of(text))
        .withColumn("lines", lines)
        .withColumn("rare", F.regexp_replace(text, r"[a-z\x20\x09-\x0D]+", ""))
        .withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("spans", _windows("codes"))
    )
    repeated = F.size(F.array_distinct("spans")) < F.size("spans")
    pairs = F.sort_array(F.transform("spans", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    counted = counted.withColumn("pairs", F.when(repeated, pairs))
    twice = F.transform(
        "pairs",
        lambda x, i: F.when(
            (F.get("pairs", i - 1)["h"] == x["h"]) | (F.get("pairs", i + 1)["h"] == x["h"]), x["i"]
        ),
    )
    counted = counted.withColumn("at", F.sort_array(F.array_compact(twice)))
    # a window adds its words up to the start of the next repeated window
    gain = F.transform(
        "at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW)))
    )
    counted = counted.withColumn(
        "n_repeat_words", F.coalesce(F.aggregate(gain, F.lit(0), lambda a, x: a + x), F.lit(0))
    )
    return counted.select(
        *docs.columns,
        "codes",
        "rare",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _number_of(F.col("rare"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.col("n_repeat_words").cast("long").alias("n_repeat_words"),
    )


def common_words(docs: DataFrame, common: int) -> DataFrame:
    """language, ref_words: the commonest words of each language, and of all texts as language ALL."""
    # explode_outer, as explode would have the optimizer split every text once more for a filter
    said = docs.select("language", F.explode_outer(F.split("text", r"[\x20\x09-\x0D]+")).alias("word"))
    counts = said.where("word <> ''").groupBy("language", "word").agg(F.count("*").alias("n"))
    counts = counts.select(F.explode(F.array("language", F.lit(ALL))).alias("language"), "word", "n")
    counts = counts.where("language IS NOT NULL").groupBy("language", "word").agg(F.sum("n").alias("n"))
    part = F.pmod(F.xxhash64("word"), F.lit(64)).alias("part")
    entry = F.struct((-F.col("n")).alias("less"), "word").alias("entry")
    # the first few of each of 64 parts of a language's words, then of those: no group is large
    order = Window.partitionBy("language", "part").orderBy("entry")
    top = counts.select("language", part, entry).withColumn("place", F.row_number().over(order))
    top = top.where(F.col("place") <= common).select("language", "entry")
    each = top.groupBy("language").agg(F.sort_array(F.collect_list("entry")).alias("top"))
    return each.select("language", F.transform(F.slice("top", 1, common), lambda x: x["word"]).alias("ref_words"))


def with_histograms(counted: DataFrame, refs: DataFrame, common: int) -> DataFrame:
    """Adds classes, hits and any_hits (of the commonest words of the language and of all) and base_failed."""
    rare = F.col("rare")
    marks = _number_of(rare, r"!-/:-@\[-`{-~") - F.col("n_symbols")
    listed = [_number_of(rare, r"\p{Lu}"), _number_of(rare, "0-9"), F.col("n_symbols"), marks]

    def hits(codes: str) -> Column:
        # one lambda for all words: written out word by word, the code gets too large to be compiled
        found = F.transform(codes, lambda c: (F.size("codes") - F.size(F.array_remove("codes", c))).cast("double"))
        filled = F.concat(found, F.array_repeat(F.lit(0.0), F.lit(common) - F.size(codes)))
        return F.coalesce(filled, F.array_repeat(F.lit(0.0), common))

    refs = refs.select("language", F.transform("ref_words", lambda w: F.xxhash64(w)).alias("ref_codes"))
    overall = refs.where(F.col("language") == ALL).select(
        F.col("ref_codes").alias("any_codes"), F.lit(1).alias("one")
    )
    bound = counted.join(refs, "language", "left").withColumn("one", F.lit(1))
    bound = bound.join(overall, "one", "left")  # a single row
    return bound.select(
        *counted.columns,
        F.array(*[x.cast("double") for x in listed]).alias("classes"),
        hits("ref_codes").alias("hits"),
        hits("any_codes").alias("any_hits"),
        (
            (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
        ).alias("base_failed"),
    ).drop("codes", "rare")


def _closed(counts: str, total: str) -> Column:
    """A histogram with what its bins leave of the total as the last bin."""
    rest = F.col(total) - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.concat(counts, F.array(F.greatest(rest.cast("double"), F.lit(0.0))))


def references(judged: DataFrame, common: int) -> DataFrame:
    """Summed histograms of the texts that pass the base, per language and over all (as ALL), with
    their numbers of texts and words."""
    good = judged.where(~F.col("base_failed"))
    width = {"closed_classes": 5, "closed_hits": common + 1, "closed_any_hits": common + 1}
    sums = [
        F.sum(F.get(name, F.lit(i))).alias(f"{name}_{i}") for name, n in width.items() for i in range(n)
    ]
    size = [F.count("*").alias("n_texts"), F.sum("n_words").alias("ref_n_words")]
    languages = good.groupBy("language").agg(*size, *sums)
    every = languages.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in languages.columns[1:]])
    every = every.withColumn("language", F.lit(ALL))

    def listed(rows: DataFrame, words: str) -> DataFrame:
        return rows.select(
            "language",
            "n_texts",
            F.col("ref_n_words").alias("n_words"),
            *[
                F.array(*[F.col(f"{name}_{i}").cast("double") for i in range(width[name])]).alias(made)
                for name, made in (("closed_classes", "ref_classes"), (words, "ref_hits"))
            ],
        )

    return listed(languages.where("language IS NOT NULL"), "closed_hits").unionByName(
        listed(every, "closed_any_hits")
    )


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length (counts), in [0, 1]."""
    zero = F.lit(0.0)
    sums = [F.greatest(F.aggregate(x, zero, lambda a, v: a + v), F.lit(1.0)) for x in (p, q)]
    p, q = (F.zip_with(x, F.array_repeat(n, F.size(x)), lambda v, w: v / w) for x, n in zip((p, q), sums, strict=True))

    def term(a, b):
        half = (a + b) / 2
        return F.when(a > 0, a * F.log2(a / half)).otherwise(zero) + F.when(
            b > 0, b * F.log2(b / half)
        ).otherwise(zero)

    total = F.aggregate(F.zip_with(p, q, term), zero, lambda a, v: a + v)
    return F.sqrt(F.greatest(total / 2, zero))


def quality_rules(
    spark: SparkSession,
    docs: DataFrame,
    stage: Stage | None = None,
    common: int = 12,
    min_chars: int = 200,
    min_words: int = 40,
    max_class_distance: float = 0.25,
    max_word_distance: float = 0.35,
    min_reference_texts: int = 10,
    min_reference_words: int = 5000,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, counts of the base, distances, base_failed, kept and the carried columns of each row."""
    stage = stage or Stage(spark)
    carried = [F.col(name).alias("carried_" + name) for name in carry]
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.concat(F.lit("l"), F.col("lang").cast("string")).alias("language"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *carried,
    )
    refs = stage.put("words", common_words(slim.select("language", "text"), common))
    judged = with_histograms(base_counts(slim), refs, common).drop("text")
    judged = stage.put("judged", judged)
    judged = judged.withColumn("closed_classes", _closed("classes", "word_chars"))
    judged = judged.withColumn("closed_hits", _closed("hits", "n_words"))
    judged = judged.withColumn("closed_any_hits", _closed("any_hits", "n_words"))
    enough = (F.col("n_texts") >= min_reference_texts) & (F.col("n_words") >= min_reference_words)

    def compared(refs, overall):
        own = refs.where(enough & (F.col("language") != ALL)).drop("n_texts", "n_words")
        overall = overall.select(
            F.col("ref_classes").alias("any_ref_classes"), F.col("ref_hits").alias("any_ref_hits"), F.lit(1).alias("one")
        )
        both = judged.join(own, "language", "left").withColumn("one", F.lit(1))
        both = both.join(overall, "one", "left").drop("one")  # a single row
        alone = F.col("ref_hits").isNull()
        both = both.withColumn("said", F.when(alone, F.col("closed_any_hits")).otherwise(F.col("closed_hits")))
        for name in ("ref_classes", "ref_hits"):
            both = both.withColumn(name, F.coalesce(name, "any_" + name))
        for kind, column, ref in (("class", "closed_classes", "ref_classes"), ("word", "said", "ref_hits")):
            apart = distance(F.col(column), F.col(ref))
            both = both.withColumn(kind + "_distance", F.coalesce(apart, F.lit(0.0)))
        return both

    far = (F.col("word_chars") >= min_chars) & (F.col("class_distance") > max_class_distance)
    far |= (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance)
    # once more against references without the texts that stand off, which blur them
    first = stage.put("first", references(judged, common))
    overall = first.where(F.col("language") == ALL)
    near = compared(first, overall).where(~far).select(judged.columns)
    second = stage.put("second", references(near, common))
    left = second.where(enough & (F.col("language") == ALL)).withColumn("step", F.lit(2))
    overall = left.unionByName(overall.withColumn("step", F.lit(1))).orderBy(F.desc("step")).limit(1)
    bound = compared(second, overall)
    return bound.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"),
        "class_distance",
        "word_distance",
        *[F.col("carried_" + name) for name in carry],
    )
