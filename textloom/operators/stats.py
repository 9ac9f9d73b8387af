"""Frequencies and distribution statistics.  Windows run over vocabulary-sized tables only.

Null and empty token arrays count nothing, null keys are a group of their own, ties are
ordered by token, repeated rows count each, and an empty table gives no rows (one row of
nulls where a result is one row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.tables import settled


def token_frequency(rows: DataFrame, keys: list[str], tokens: str = "tokens", per_row: bool = False) -> DataFrame:
    """Occurrences (or, ``per_row``, rows) of each token by ``keys``; null and empty arrays count nothing.

    ``explode_outer`` and a filter on the token: with ``explode`` Spark would infer a filter on
    the array and evaluate the tokenising behind it a second time.
    """
    source = F.array_distinct(tokens) if per_row else F.col(tokens)
    return rows.select(*keys, F.explode_outer(source).alias("token")).filter("token IS NOT NULL").groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("n"))


def zero_filled(freq: DataFrame, inventory: DataFrame) -> DataFrame:
    """Counts over a fixed inventory of tokens (a vocabulary), 0 where unseen."""
    return inventory.join(freq, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def distribution(freq: DataFrame, keys: list[str]) -> DataFrame:
    """types, total, mean, median, sd, cv, entropy (bits), its share of the maximum, Gini."""
    w = Window.partitionBy(*keys)
    x = freq.withColumn("__t", F.sum("n").over(w)).withColumn("__k", F.count(F.lit(1)).over(w)).withColumn("__i", F.row_number().over(w.orderBy("n", "token")))
    p = F.col("n") / F.col("__t")
    x = x.groupBy(*keys).agg(
        F.max("__k").alias("types"), F.max("__t").alias("total"), F.avg("n").alias("__m"), F.percentile("n", F.lit(0.5)).alias("__md"), F.stddev_pop("n").alias("__s"),
        F.sum(F.when(F.col("n") > 0, -p * F.log2(p)).otherwise(0.0)).alias("__h"), F.sum(F.col("__i") * F.col("n")).alias("__ix"),
    )
    some = F.col("total") > 0
    zero = F.lit(0.0)
    gini = F.greatest(zero, 2.0 * F.col("__ix") / (F.col("types") * F.col("total")) - (F.col("types") + 1) / F.col("types"))
    return x.select(
        *keys, "types", "total", F.round("__m", 4).alias("mean"), F.col("__md").alias("median"), F.round("__s", 4).alias("sd"), F.when(some, F.round(F.col("__s") / F.col("__m"), 4)).otherwise(zero).alias("cv"),
        F.round("__h", 6).alias("entropy"), F.when(some & (F.col("types") > 1), F.round(F.col("__h") / F.log2("types"), 6)).otherwise(zero).alias("entropy_share"), F.when(some, F.round(gini, 6)).otherwise(zero).alias("gini"),
    )


def divergence(p: DataFrame, q: DataFrame, keys: list[str]) -> DataFrame:
    """Jensen-Shannon divergence (base 2) of p's counts (by keys, token) from q's (by token).

    Counts of 0 are as good as absent; keys whose counts are all 0 have no row."""
    p, q = p.filter("n > 0"), q.filter("n > 0")
    pt = p.withColumn("__p", F.col("n") / F.sum("n").over(Window.partitionBy(*keys))).select(*keys, "token", "__p")
    qt = q.crossJoin(q.agg(F.sum("n").alias("__t"))).select("token", (F.col("n") / F.col("__t")).alias("__q"))
    both = pt.join(qt, "token")
    m = (F.col("__p") + F.col("__q")) / 2
    # tokens that p lacks add q/2 each (log2 of 2): all of q's mass that the join left out
    parts = both.groupBy(*keys).agg(F.sum(F.col("__p") * F.log2(F.col("__p") / m) + F.col("__q") * F.log2(F.col("__q") / m)).alias("__s"), F.sum("__p").alias("__ps"), F.sum("__q").alias("__qs"))
    return parts.select(*keys, F.round((F.col("__s") + (1 - F.col("__ps")) + (1 - F.col("__qs"))) / 2, 6).alias("jsd"))


def rarity(freq: DataFrame, keys: list[str]) -> DataFrame:
    yes = lambda c: F.sum(c.cast("long"))
    return freq.groupBy(*keys).agg(yes(F.col("n") == 1).alias("hapax"), *(yes((F.col("n") > 0) & (F.col("n") < k)).alias(f"below_{k}") for k in (2, 5, 10, 20)))


def cumulative(freq: DataFrame, keys: list[str]) -> DataFrame:
    """rank, log10(n + 1) and cumulative share of each token, most frequent first."""
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), "token")
    run = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(Window.partitionBy(*keys))
    return freq.select(*keys, "token", "n", F.row_number().over(w).alias("rank"), F.round(F.log10(F.col("n") + 1), 6).alias("log_n"), F.round(run, 8).alias("share"))


def coverage_points(freq: DataFrame, keys: list[str], points: tuple[int, ...] = (50, 80, 90, 95, 99)) -> DataFrame:
    """How many of the top types reach each share of all occurrences."""
    c = cumulative(freq, keys)
    return c.groupBy(*keys).agg(*(F.min(F.when(F.col("share") * 100 >= p - 1e-7, F.col("rank"))).alias(f"top_{p}") for p in points))


def lengths(rows: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Count, extremes, mean, nearest-rank median and 95th percentile, deviation."""
    q = lambda f: F.expr(f"percentile_disc({f}) WITHIN GROUP (ORDER BY {n})").cast("long")
    return rows.groupBy(*keys).agg(F.count(n).alias("rows"), F.min(n).cast("long").alias("least"), F.max(n).cast("long").alias("most"), F.round(F.avg(n), 4).alias("mean"), q(0.5).alias("median"), q(0.95).alias("p95"), F.round(F.stddev_pop(n), 4).alias("sd"))


def axis(rows: DataFrame, axis_col: str, labels: list[str]) -> DataFrame:
    """Count, percentage and deviation from an even spread for each of fixed labels."""
    spark = rows.sparkSession
    fixed = spark.createDataFrame([(x,) for x in labels], "label string")
    per = rows.groupBy(F.col(axis_col).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"))
    got = fixed.join(per, "label", "left").crossJoin(F.broadcast(total)).withColumn("n", F.coalesce("n", F.lit(0)))  # one row
    pct = F.when(F.col("t") > 0, 100.0 * F.col("n") / F.col("t")).otherwise(0.0)
    return got.select("label", "n", F.round(pct, 2).alias("pct"), F.round(pct - 100.0 / len(labels), 2).alias("off_even"))


def crosstab(rows: DataFrame, a: str, b: str, a_labels: list[str], b_labels: list[str]) -> DataFrame:
    spark = rows.sparkSession
    full = spark.createDataFrame([(x, y) for x in a_labels for y in b_labels], "a string, b string")
    per = rows.groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return full.join(per, ["a", "b"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def breakdown(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Count and share of each value of each metadata axis; no value is ``unknown``."""
    pairs = F.array(*(F.struct(F.lit(a).alias("axis"), F.coalesce(F.nullif(F.col(a).cast("string"), F.lit("")), F.lit("unknown")).alias("value")) for a in axes))
    per = rows.select(F.explode(pairs).alias("x")).groupBy("x.axis", "x.value").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("axis")), 8))


def tempered(freq: DataFrame, tokens: int, power: float = 0.5, places: int | None = 6) -> DataFrame:
    """Target counts: n ** power, scaled to ``tokens`` in all, to ``places`` (None: as they are)."""
    weight = F.pow(F.greatest(F.lit(1), F.col("n")).cast("double"), F.lit(power))
    return freq.withColumn("w", weight).crossJoin(freq.agg(F.sum(weight).alias("t"))).select("token", "n", (F.lit(float(tokens)) * F.col("w") / F.col("t")).alias("target")).withColumn("target", F.col("target") if places is None else F.round("target", places))


def auc(rows: DataFrame, score: str, label: str, tie: str) -> DataFrame:
    """ROC-AUC by rank sum; ties ranked by ``tie``.  Null if a class is missing."""
    r = ranked(rows.select(score, label, tie), [score, tie], "__r")
    y = F.col(label) == 1
    a = r.agg(F.sum(F.when(y, F.col("__r"))).alias("s"), F.sum(y.cast("long")).alias("p"), F.sum((~y).cast("long")).alias("q"))
    return a.select(F.round((F.col("s") - F.col("p") * (F.col("p") + 1) / 2) / (F.col("p") * F.col("q")), 6).alias("auc"))


def ranked(rows: DataFrame, order: list[str | Column], out: str = "r") -> DataFrame:
    """Adds the 1-based rank in ``order``: rows are ranged by it and counts per range shift the
    ranks within, so no task sees all rows.  Equal rows are ranked in any order."""
    rows = settled(rows.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "ranked")
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("__n")).select("__p", before.alias("__b"))  # one row a partition
    inside = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return rows.withColumn(out, inside).join(F.broadcast(shift), "__p").withColumn(out, F.col(out) + F.col("__b")).drop("__p", "__b")


def rank_quantile(rows: DataFrame, col: str, share: float) -> DataFrame:
    """One row: the value of ``col`` at 0-based rank round-half-even((n - 1) * share) of the rows that have one."""
    rows = rows.filter(F.col(col).isNotNull()).select(col)
    r = ranked(rows, [col], "__r")
    n = r.agg(F.count(F.lit(1)).alias("__n"))
    at = F.bround((F.col("__n") - 1) * F.lit(share)) + 1
    return r.crossJoin(F.broadcast(n)).filter(F.col("__r") == at).agg(F.max(col).alias(col))  # one row


def first_seen_tokens(rows: DataFrame, order: list[str], tokens: str = "tokens") -> DataFrame:
    """token, place: each token once, in the order in which the rows (by ``order``) first show it."""
    first, *_ = order
    rows = settled(rows.select(*order, F.array_distinct(tokens).alias("__t")), "distinct-tokens")  # in order of their first places
    seen = rows.select(first, F.explode_outer("__t").alias("token")).filter("token IS NOT NULL").groupBy("token")
    least = seen.agg(F.min(first).alias("__m"), F.bool_or(F.col(first).isNull()).alias("__n"))  # a number and a flag a token; nulls come first
    early = settled(least.select(F.when(~F.col("__n"), F.col("__m")).alias("__first")).distinct(), "first-rows")  # a vocabulary
    some = rows.join(F.broadcast(early), F.col(first).eqNullSafe(F.col("__first")), "left_semi")
    x = some.select(*order, F.posexplode_outer("__t").alias("__pos", "token")).filter("token IS NOT NULL")
    first = x.groupBy("token").agg(F.min(F.struct(*order, "__pos")).alias("__first"))  # a vocabulary
    return first.select("token", (F.row_number().over(Window.orderBy("__first")) - 1).alias("place"))
