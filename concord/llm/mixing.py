"""Mixing sources to target weights by temperature.

A source with a share p of all tokens gets the weight p^a, normalised. Bisection finds the exponent a in [0, 1]: the
largest one at which the weights' entropy reaches a target, raised where needed so that no source is repeated
more than ``max_repeats`` times within the token budget. Each round halves the interval eight times with one aggregate over
the sources, so there may be any number of them.

The weights are realised block by block. A hash deals each source's documents to 4096 blocks. A pass over a source is
a permutation of its blocks; whole passes use all of them, and the last, partial pass takes blocks in order until the
budget ends inside one block, of which the first documents are taken. Only that block is ordered row by row, and
only its own documents, so no task ever sorts a source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged, text_or_empty

TARGET_ENTROPY = 0.95
MAX_REPEATS = 4.0
ROUNDS, PARTS = 5, 256
MAX_PASSES = 1 << 20
BROADCAST_SOURCES = 50_000


def n_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _sums(shares: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent a, the sums of p^a and of p^a ln p over all sources: each share meets all exponents, and one aggregate adds up."""
    met = shares.select("p", F.explode(F.array(*[F.lit(a) for a in exponents])).alias("a"))
    power = F.pow(F.col("p"), F.col("a"))
    return {r.a: (r.z, r.s) for r in met.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.ln("p")).alias("s")).collect()}


def choose_exponent(sources: DataFrame, budget: int, total: int, target_entropy: float, max_repeats: float) -> float:
    """The exponent for (source, tokens > 0), to six digits.

    Both limits hold up to some point: the entropy falls as a rises, and repeats fall as 1 - a falls. If no exponent keeps
    the repeats (a budget of more than ``max_repeats`` times all tokens), it is 1: natural shares repeat the sources evenly,
    which is the least that the most repeated one can get.
    """
    shares = sources.select((F.col("tokens") / F.lit(total)).alias("p"))
    n, least = shares.agg(F.count("*"), F.min("p")).first()
    if not n:
        return 1.0

    def even(a, z, s):
        return math.log(z) - a * s / z >= target_entropy * math.log(n)

    def few(a, z, _):
        return budget / (total * z) * least ** (a - 1) <= max_repeats

    spans = {even: (0.0, 1.0), few: (0.0, 1.0)}  # of a, and of 1 - a
    for _ in range(ROUNDS):
        grid = {f: [lo + (hi - lo) * k / PARTS for k in range(1, PARTS)] for f, (lo, hi) in spans.items()}
        points = [(f, x, x if f is even else 1 - x) for f, xs in grid.items() for x in xs]
        sums = _sums(shares, sorted({a for *_, a in points}))
        for f, (lo, hi) in spans.items():
            good = [x for g, x, a in points if g is f and f(a, *sums[a])]
            bad = [x for g, x, a in points if g is f and not f(a, *sums[a])]
            spans[f] = (max(good, default=lo), min(bad, default=hi))
    return round(max(spans[even][0], 1 - spans[few][0]), 6)


def plan_weights(sources: DataFrame, budget: int | None = None, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, tokens, exponent, weight, target) from (source, tokens).

    target_entropy is a fraction of the largest possible entropy, ln(number of sources with tokens). Without a
    budget, as many tokens are dealt as there are. Sources without tokens get nothing.
    """
    known = sources.where("tokens > 0")
    total = known.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    exponent = choose_exponent(known, budget, total, target_entropy, max_repeats)
    power = F.pow(F.col("tokens") / F.lit(total), F.lit(exponent))
    whole = known.agg(F.sum(power)).first()[0] or 1.0
    weight = F.round(power / F.lit(whole), 9)
    return known.select("source", "tokens", F.lit(exponent).alias("exponent"), weight.alias("weight"), F.floor(weight * F.lit(budget)).cast("long").alias("target"))


def mix(docs: DataFrame, budget: int | None = None, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each time a document is dealt: doc_id, source, tokens, epoch, block, block_rank, weight, and the columns ``keep``.

    block_rank is the block's place in the permutation of that epoch (pass), from 1. A source's tokens add up to
    its target or less by under one document. Null sources are one source named ''. Documents without words
    go with their block; a source of such documents only is not dealt. Repeated rows are dealt each. Texts of any length
    count whole; columns not named are ignored. Empty in, empty out. A budget that deals a source more than MAX_PASSES times is refused, as its result
    would have a row for each time.
    """
    sized = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), n_tokens(text_or_empty()).alias("tokens"), *keep)
    place = F.md5(F.concat_ws(":", F.lit(seed), "doc_id"))
    sized = staged(sized.withColumn("place", place).withColumn("block", F.substring("place", 1, 3)), "mix-documents")
    blocks = staged(sized.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    sources = staged(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    plan = plan_weights(sources, budget, target_entropy, max_repeats).withColumn("passes", F.expr("target div tokens"))
    plan = staged(plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("tokens")), "mix-plan")
    if (plan.agg(F.max("passes")).first()[0] or 0) > MAX_PASSES:
        raise ValueError(f"the budget deals a source more than {MAX_PASSES} times")
    each = plan.select("source", "weight", "passes", "rest")
    epochs = blocks.join(F.broadcast(each) if sources.count() <= BROADCAST_SOURCES else each, "source")
    epochs = epochs.select("*", F.explode(F.sequence(F.lit(0), F.col("passes").cast("int"))).alias("epoch"))
    # a window here holds at most 4096 rows
    order = Window.partitionBy("source", "epoch").orderBy(F.md5(F.concat_ws(":", F.lit(seed), "source", "epoch", "block")), "block")
    dealt = epochs.withColumn("block_rank", F.row_number().over(order)).withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    room = F.when(F.col("epoch") < F.col("passes"), F.col("tokens")).otherwise(F.least("tokens", F.col("rest") - F.coalesce("before", F.lit(0))))
    dealt = staged(dealt.withColumn("room", room).where("room > 0 or (room = 0 and tokens = 0)").select("source", "block", "epoch", "block_rank", "weight", F.col("tokens").alias("block_tokens"), "room"), "mix-dealt")
    met = sized.join(dealt, ["source", "block"])
    whole = met.where("room = block_tokens")
    inside = Window.partitionBy("source", "block", "epoch").orderBy("place", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    cut = met.where("room < block_tokens").withColumn("upto", F.sum("tokens").over(inside)).where("upto <= room").drop("upto")
    return whole.unionByName(cut).select("doc_id", "source", "tokens", "epoch", "block", "block_rank", "weight", *keep)
