"""Temperature mixing of sources, in DataFrame operations alone.

A source with token share p gets weight p**a / sum(p**a).  The exponent a in [0, 1] is
bisected: with a target entropy, the largest a whose weights reach it; with a repetition
limit, the smallest a at which no source is read more often than the limit.  A target entropy
has a limit beside it (``at_most``), so that no tiny source is repeated without end: where
both can't be had, the limit wins.  Each pass over the per-source totals tries 31 inner points
of the interval, five halvings at once.

The weights are realised as blocks: block e of a source is a seeded permutation of all its
rows; as many whole blocks as the budget gives, then one block cut where the next row would
pass the source's share.  No permutation is sorted as a whole: rows are bucketed by hash and
only counts per bucket are summed up (``common.ranked``).

A null source is a source of its own; null and empty texts have 0 tokens and come along in
every block (the cut block, up to the cut).  Sources without tokens have weight 0 and come
once.  Repeated rows are separate rows.  An empty table gives an empty result.  Other columns
are ignored by ``mix`` and kept as they are by ``mixed_rows``, whatever their names, as long
as these don't begin with two underscores.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from textloom.llm import common

WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Target:
    """Give ``entropy`` (share of its maximum, log of the number of sources) or ``repeats``."""

    entropy: float | None = None
    repeats: float | None = None
    budget: float = 1.0
    """Tokens to draw, as a multiple of the tokens there are."""
    seed: int = 11
    at_most: float = 4.0
    """Times that a source is read at most where the target is an entropy (never below the budget)."""


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def source_key(source: str = "source") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def totals(rows: DataFrame) -> DataFrame:
    """__g, source_tokens, source_rows and the token share p of each source."""
    per = common.table(rows.groupBy("__g").agg(F.sum("n_tokens").alias("source_tokens"), F.count(F.lit(1)).alias("source_rows")), "mix-totals")
    whole = per.agg(F.sum("source_tokens")).first()[0] or 0
    return per.withColumn("p", F.col("source_tokens") / F.lit(float(max(whole, 1))))


def exponent(per: DataFrame, target: Target, passes: int = 8) -> float:
    """Bisected on the driver over a few numbers a point; the sources stay distributed."""
    if (target.entropy is None) == (target.repeats is None):
        raise ValueError("give a target entropy or a repetition limit")
    per = per.filter("p > 0").select(F.log("p").alias("lp"))
    n = per.count()
    if n < 2:
        return 1.0

    def least(limit: float) -> float:
        """The smallest exponent at which no source is read more often; it is read less as a rises."""
        return _bisect(per, passes, lambda x: target.budget * math.exp(x["most"]) / x["z"] <= limit + 1e-12)

    if target.repeats is not None:
        return least(target.repeats)
    goal = target.entropy * math.log(n) - 1e-12
    # entropy falls as a rises: the largest a that reaches it is where falling short begins
    reached = _bisect(per, passes, lambda x: math.log(x["z"]) - x["s"] / x["z"] < goal, below=True)
    return max(reached, least(max(target.at_most, target.budget)))


def _bisect(per: DataFrame, passes: int, holds: Callable[[Row], bool], below: bool = False) -> float:
    """Where ``holds`` turns from false to true in [0, 1]: the upper end of the last interval, or
    (``below``) the lower one; 0 if it holds throughout, 1 if nowhere."""
    low, high = 0.0, 1.0
    for _ in range(passes):
        points = [low + (high - low) * i / 32 for i in range(33)]
        at = per.select("lp", F.explode(F.array(*(F.lit(a) for a in points))).alias("a"))
        power = F.exp(F.col("a") * F.col("lp"))
        got = {r["a"]: r for r in at.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.col("a") * F.col("lp")).alias("s"), F.max((F.col("a") - 1) * F.col("lp")).alias("most")).collect()}
        first = next((i for i, a in enumerate(points) if holds(got[a])), 33)
        if first in (0, 33):
            return low if first == 0 else high
        low, high = points[first - 1], points[first]
    return low if below else high


def weighted(per: DataFrame, target: Target) -> DataFrame:
    """Adds exponent, weight, whole_blocks and cut_tokens (the share left for the cut block)."""
    a = exponent(per, target)
    z = per.filter("p > 0").agg(F.sum(F.exp(F.lit(a) * F.log("p"))), F.sum("source_tokens")).first()
    norm, whole = float(z[0] or 1.0), float(z[1] or 0)
    share = F.when(F.col("p") > 0, F.exp(F.lit(a) * F.log("p")) / F.lit(norm)).otherwise(F.lit(0.0))
    per = per.withColumn("exponent", F.lit(a)).withColumn("weight", share).withColumn("goal", F.col("weight") * F.lit(whole * target.budget))
    blocks = F.when(F.col("p") > 0, F.floor(F.col("goal") / F.col("source_tokens") + F.lit(1e-9))).otherwise(F.lit(1)).cast("int")
    per = per.withColumn("whole_blocks", blocks)
    return common.table(per.withColumn("cut_tokens", F.when(F.col("p") > 0, F.greatest(F.lit(0), F.floor(F.col("goal") - F.col("whole_blocks") * F.col("source_tokens") + F.lit(1e-6)))).otherwise(F.lit(0)).cast("long")), "mix-weights")


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", tokens().alias("n_tokens"), F.crc32(common.utf8()).alias("__c")).withColumn("__g", source_key())


def block_key(seed: int, block: Column) -> Column:
    return F.xxhash64(F.lit(seed), block, F.col("doc_id"), F.col("__c"))


def permute(rows: DataFrame, seed: int) -> DataFrame:
    """Adds row_in_block and tokens_before for the rows of each (source, block)."""
    rows = rows.withColumn("__h", block_key(seed, F.col("block"))).withColumn("__b", common.bucket_of(F.col("__h"), common.slots_of(F.col("source_rows"))))
    got = common.ranked(rows, ["__g", "block"], "__b", ["__h", "doc_id", "__c"], "row_in_block", carry="n_tokens")
    return got.withColumnRenamed("row_in_block_n_tokens", "tokens_before").drop("__b")


def mix(docs: DataFrame, target: Target) -> DataFrame:
    """Each drawn row: doc_id, source, n_tokens, block, row_in_block, tokens_before, weight, exponent."""
    rows = common.table(prepared(docs), "mix-rows")
    per = weighted(totals(rows), target)
    keep = per.select("__g", "weight", "exponent", "whole_blocks", "cut_tokens", "source_rows")
    drawn = common.attach(rows, keep, "__g").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("whole_blocks"))))
    drawn = permute(drawn, target.seed)
    inside = (F.col("block") < F.col("whole_blocks")) | (F.col("tokens_before") + F.col("n_tokens") <= F.col("cut_tokens")) & (F.col("cut_tokens") > 0)
    return drawn.filter(inside).select("doc_id", "source", "n_tokens", "block", "row_in_block", "tokens_before", "weight", "exponent")


def mixed_rows(docs: DataFrame, target: Target) -> DataFrame:
    """The rows of ``docs``, each as often as it is drawn; texts are never shuffled.

    Only the cut block needs places; it comes down to one hash per source, below which rows
    are in.  Rows that tie with the first one left out are left out with it.
    """
    rows = common.table(prepared(docs), "mix-rows")
    per = weighted(totals(rows), target)
    cut = common.attach(rows, per.filter("cut_tokens > 0").select("__g", "whole_blocks", "cut_tokens", "source_rows"), "__g").withColumnRenamed("whole_blocks", "block")
    cut = permute(cut, target.seed)
    out = cut.filter(F.col("tokens_before") + F.col("n_tokens") > F.col("cut_tokens")).groupBy("__g").agg(F.min("__h").alias("__stop"))
    plan = per.select("__g", F.col("whole_blocks").alias("__whole"), F.col("cut_tokens").alias("__cut")).join(out, "__g", "left")
    got = docs.withColumns({"__g": source_key(), "__c": F.crc32(common.utf8())})
    got = common.attach(got, common.table(plan, "mix-cuts"), "__g")
    partial = (F.col("__cut") > 0) & (F.col("__stop").isNull() | (block_key(target.seed, F.col("__whole")) < F.col("__stop")))
    times = F.col("__whole") + F.when(partial, 1).otherwise(0)
    got = got.withColumn("__n", times).filter("__n > 0").withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return got.select(*docs.columns)
