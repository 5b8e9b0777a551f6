"""Temperature mixing of sources, realised as budgeted permutations of blocks.

A source's weight is its token share to the power t, normalised. t is bisected: entropy rises
and so does the repetition of small sources as t falls from 1 (natural shares) to 0 (equal
ones). The exponent taken is the smallest that keeps each source within `max_repeats` passes
and, if a target entropy is given (as a share of the largest possible, log of the number of
sources), the entropy at or below it. Where natural shares have more entropy than that, t goes
beyond 1, and large sources are the ones that repeat. Where no t can hold both, the limit of
passes comes first: t is then the largest that keeps it, with the entropy as near to the target as that
allows. Where no t keeps the limit (a budget of more than `max_repeats` times all tokens), t is 1.
Sources of equal sizes have equal weights at every t; t is 1 where they miss the target.

A source's documents fall into blocks by a seeded hash of their id. With its budget of tokens a
source is gone through in as many whole passes as fit, and one more pass that stops: blocks
come in a seeded order of each pass, blocks that fit are taken whole, and in the block where
the budget ends documents are taken in seeded order while they fit. Budgets are met to
within one document. Only block totals are summed in order, never a source's documents. The number
of blocks follows the square root of the number of documents, so that neither the list of a source's
blocks nor a block that is gone through document by document becomes a large task.

All in DataFrame functions. The table of sources (one row each) is read by the driver for the
bisection. Tokens are words unless a column says otherwise. NULL sources are a source of
their own; documents without tokens cost nothing and come once with each pass of their
source; a source without any token is passed once; rows that repeat an id lie in one block
and each count; an empty table gives no rows.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazline.llm.common import Stage
from hazline.llm.rules import words_of


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def tempered(shares: list[float], t: float) -> list[float]:
    top = max(shares)
    raw = [(s / top) ** t for s in shares]
    return [r / sum(raw) for r in raw]


def exponent(
    tokens: list[int], budget: float, max_repeats: float, target_entropy: float | None, steps: int = 60
) -> float:
    """Smallest exponent within the repetition limit and the target entropy; else as the module says."""
    shares = [n / sum(tokens) for n in tokens]
    limit = None if target_entropy is None else target_entropy * math.log(len(tokens))

    def repeated(t):  # within the limit of passes; holds on an interval around 1, or nowhere
        weights = tempered(shares, t)
        return max(w * budget / n for w, n in zip(weights, tokens, strict=True)) <= max_repeats

    def reached(t):  # holds from some t on
        return limit is None or entropy(tempered(shares, t)) <= limit

    def border(low, high, wanted):
        """The two sides of the place where `wanted` turns from false (at low) to true (at high)."""
        for _ in range(steps):
            middle = (low + high) / 2
            low, high = (low, middle) if wanted(middle) else (middle, high)
        return low, high

    if not repeated(1.0):
        return 1.0
    if reached(1.0):
        both = lambda t: repeated(t) and reached(t)
        return 0.0 if both(0.0) else border(0.0, 1.0, both)[1]
    if min(tokens) == max(tokens):
        return 1.0
    low, high = 1.0, 2.0
    while repeated(high) and not reached(high) and high < 1e12:
        low, high = high, 2 * high
    place = border(low, high, lambda t: not repeated(t) or reached(t))[1]
    return place if repeated(place) else border(low, high, lambda t: not repeated(t))[0]


def mix(
    spark: SparkSession,
    docs: DataFrame,
    tokens: Column | None = None,
    budget: int | None = None,
    max_repeats: float = 4.0,
    target_entropy: float | None = 0.95,
    blocks: int | None = None,
    seed: int = 1,
    carry: tuple[str, ...] = (),
    stage: Stage | None = None,
) -> DataFrame:
    """doc_id, source, pass_no, block, block_rank, n_tokens and carried_<name> of each drawn row.

    budget: tokens in all (those of the input where None). blocks: per source, at most
    (twice the square root of the number of rows where None).
    """
    stage = stage or Stage(spark)
    if blocks is None:
        blocks = 2 * math.isqrt(docs.count()) + 1
    counted = F.size(words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")).alias("stratum"),
        F.coalesce((tokens if tokens is not None else counted).cast("long"), F.lit(0)).alias("n_tokens"),
        *[F.col(name).alias("carried_" + name) for name in carry],
    ).withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "stratum", "doc_id"), F.lit(blocks)))
    # one pass counts; what is carried along is read again by the join that draws
    sums = slim.groupBy("stratum", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    sums = stage.put("blocks", sums)
    held = sums.groupBy("stratum").agg(F.sum("block_tokens").alias("n")).collect()
    held = sorted((row.stratum, int(row.n)) for row in held)
    filled = [(name, n) for name, n in held if n > 0]
    wanted = {name: 0.0 for name, _ in held}
    if filled:
        sizes = [n for _, n in filled]
        total = float(budget if budget is not None else sum(sizes))
        t = exponent(sizes, total, max_repeats, target_entropy)
        weights = tempered([n / sum(sizes) for n in sizes], t)
        wanted |= {name: w * total for (name, _), w in zip(filled, weights, strict=True)}
    plan = [
        (name, int(wanted[name] // n) if n else 1, int(wanted[name] % n) if n else 0)
        for name, n in held
    ]
    plan = spark.createDataFrame(plan, "stratum string, passes int, rest long")
    drawn = sums.join(plan, "stratum").withColumn(
        "pass_no", F.explode(F.sequence(F.lit(0), F.col("passes")))
    )
    order = Window.partitionBy("stratum", "pass_no").orderBy(
        F.xxhash64(F.lit(seed), "stratum", "pass_no", "block"), "block"
    )
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    drawn = drawn.withColumn("block_rank", F.row_number().over(order) - 1)
    drawn = drawn.withColumn("before", F.coalesce(F.sum("block_tokens").over(upto), F.lit(0)))
    # room: None for a block taken whole, else the tokens of it that still fit
    last = F.col("pass_no") == F.col("passes")
    fits = F.col("before") + F.col("block_tokens") <= F.col("rest")
    room = F.when(last & ~fits, F.col("rest") - F.col("before"))
    drawn = drawn.withColumn("room", room).where("room IS NULL OR room > 0").where(~last | (F.col("rest") > 0))
    drawn = stage.put(
        "drawn", drawn.select("stratum", "block", "pass_no", "block_rank", "room")
    )
    out = ["doc_id", "source", "pass_no", "block", "block_rank", "n_tokens"]
    out += ["carried_" + name for name in carry]
    whole = slim.join(drawn.where("room IS NULL").drop("room"), ["stratum", "block"]).select(out)
    split = slim.join(drawn.where("room IS NOT NULL"), ["stratum", "block"])
    inside = Window.partitionBy("stratum").orderBy(
        F.xxhash64(F.lit(seed), "pass_no", "doc_id"), "doc_id", "n_tokens"
    )
    split = split.withColumn("upto", F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return whole.unionByName(split.where(F.col("upto") <= F.col("room")).select(out))
