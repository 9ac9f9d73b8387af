"""Corpora side by side: each as it is, all rows together, and the union without repeated texts.

A view is a corpus by its name, ``source_native`` (all rows) or ``deduplicated`` (one row of
each normalised text; equal texts have equal measures, so any row of them will do).  Counts
are taken once by corpus and added up for ``source_native``; only the union needs a shuffle
by text hash.  A null corpus is a view of its own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import stats
from textloom.operators.tables import settled
from textloom.profile import Profile

NATIVE, UNION = "source_native", "deduplicated"
LENGTHS = ("n_chars", "n_letters", "n_tokens")


def records(docs: DataFrame, profile: Profile, corpus: str, text: str = "text", normalise: Callable[[Column, Profile], Column] = T.normalize) -> DataFrame:
    """corpus, status, hash, tokens, n_chars, n_letters, n_tokens, n_unmatched of every record.

    Tokens are those that hold a letter of the profile; what is not usable has none."""
    rows = docs.select(F.col(corpus).alias("corpus"), F.col(text).alias("__raw"), T.once(normalise(F.col(text), profile)).alias("__norm"))
    rows = rows.withColumn("__m", T.once(T.lettered_of(F.col("__norm"), profile))).select("corpus", "__raw", "__norm", "__m.*")
    norm = F.col("__norm")
    return rows.select(
        "corpus", T.status(F.col("__raw"), norm).alias("status"), F.sha2(norm.cast("binary"), 256).alias("hash"), "tokens", F.length(norm).alias("n_chars"),
        "n_letters", F.size("tokens").alias("n_tokens"), "n_unmatched",
    )


def _kept(rec: DataFrame) -> DataFrame:
    """Adds kept: for one row a text of the usable ones.  Repeats are found by narrow rows (hash and
    row), so the tokens are not sent with them."""
    rec = settled(rec.withColumn("__row", F.monotonically_increasing_id()), "analysis-records")
    usable = rec.filter("status = 'usable'").select("hash", "__row")
    first = usable.groupBy("hash").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("hash", "__first")
    again = settled(usable.join(first, "hash").filter("__row <> __first").select("__row", F.lit(False).alias("kept")), "analysis-repeats")
    return rec.join(again, "__row", "left").withColumn("kept", F.coalesce("kept", F.col("status") == "usable")).drop("__row")


def _with_native(per: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Counts by view: those by corpus, and their sums over the corpora."""
    per = per.withColumnRenamed("corpus", "view")
    others = [k for k in keys if k != "view"]
    whole = per.withColumn("view", F.lit(NATIVE)).groupBy("view", *others).agg(*(F.sum(c).alias(c) for c in sums))
    return per.unionByName(whole)


def _views(per: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Counts by view from those by corpus and kept."""
    per = settled(per, "analysis-views")
    others = [k for k in keys if k != "view"]
    union = per.filter("kept").groupBy(F.lit(UNION).alias("view"), *others).agg(*(F.sum(c).alias(c) for c in sums))
    own = per.groupBy("corpus", *others).agg(*(F.sum(c).alias(c) for c in sums))
    return _with_native(own, ["view", *others], sums).unionByName(union)


def frequencies(rec: DataFrame) -> DataFrame:
    """view, token, n."""
    rows = _kept(rec.filter("status = 'usable'").select("corpus", "status", "hash", "tokens"))
    return _views(stats.token_frequency(rows, ["corpus", "kept"]), ["view", "token"], ["n"])


def counts(rec: DataFrame) -> DataFrame:
    """view, input, usable, empty, rejected, tokens, letters, unmatched and its share of the letters."""
    usable = F.col("status") == "usable"
    some = lambda c: F.coalesce(F.sum(F.when(usable, F.col(c))), F.lit(0)).cast("long")
    sums = {
        "input": F.count(F.lit(1)), "usable": F.count_if(usable), "empty": F.count_if(F.col("status") == "empty"), "rejected": F.count_if(F.col("status") == "rejected"),
        "tokens": some("n_tokens"), "letters": some("n_letters"), "unmatched": some("n_unmatched"),
    }
    per = _kept(rec.drop("tokens")).groupBy("corpus", "kept").agg(*(v.alias(k) for k, v in sums.items()))
    got = _views(per, ["view"], list(sums))
    return got.withColumn("unmatched_ratio", F.when(F.col("letters") > 0, F.round(F.col("unmatched") / F.col("letters"), 8)).otherwise(F.lit(0.0)))


def lengths(rec: DataFrame) -> DataFrame:
    """view, measure, rows, least, most, mean, median, p95 (nearest rank), sd of the usable records.

    By histograms: they add up over corpora, and windows see distinct lengths only."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("value")) for c in LENGTHS)))
    rows = _kept(rec.filter("status = 'usable'").drop("tokens")).select("corpus", "kept", pairs.alias("x"))
    h = _views(rows.groupBy("corpus", "kept", "x.measure", "x.value").agg(F.count(F.lit(1)).alias("n")), ["view", "measure", "value"], ["n"])
    return histogram_lengths(h, ["view", "measure"])


def histogram_lengths(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Statistics of ``value`` counted ``n`` times."""
    w = Window.partitionBy(*keys)
    h = hist.withColumns({"__to": F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)), "__all": F.sum("n").over(w), "__m": F.sum(F.col("value") * F.col("n")).over(w) / F.sum("n").over(w)})
    at = lambda f: F.min(F.when(F.col("__to") >= F.ceil(F.col("__all") * f), F.col("value")))
    got = h.groupBy(*keys).agg(
        F.sum("n").alias("rows"), F.min("value").alias("least"), F.max("value").alias("most"), F.max("__m").alias("__m"), at(0.5).alias("median"), at(0.95).alias("p95"),
        F.sqrt(F.sum(F.pow(F.col("value") - F.col("__m"), 2) * F.col("n")) / F.sum("n")).alias("__s"),
    )
    return got.select(*keys, "rows", "least", "most", F.round("__m", 4).alias("mean"), "median", "p95", F.round("__s", 4).alias("sd"))


def summary(freq: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """A row a view: tokens, types, vocabulary and its coverage, hapax, unobserved, distribution
    statistics and the types that cover 50 to 99 % of the tokens.  ``vocabulary``: token, distinct."""
    freq = settled(freq.filter("n > 0"), "analysis-frequencies")
    size = vocabulary.count()
    known = freq.join(vocabulary.select("token"), "token", "left_semi").groupBy("view").agg(F.count(F.lit(1)).alias("__known"))
    d = stats.distribution(freq, ["view"]).drop("median", "mean", "sd")
    got = d.join(stats.rarity(freq, ["view"]).select("view", "hapax"), "view").join(stats.coverage_points(freq, ["view"]), "view").join(known, "view", "left")
    share = F.col("types") / F.lit(float(max(size, 1)))
    return got.withColumns({
        "vocabulary": F.lit(size).cast("long"), "coverage": F.round(share, 6), "coverage_pct": F.round(share * 100, 4), "unobserved": (F.lit(size) - F.coalesce("__known", F.lit(0))).cast("long"),
    }).drop("__known")


def comparison(freq: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """token, native, deduplicated, their shares of all tokens and what the union removed, over a vocabulary."""
    freq = settled(freq.filter(F.col("view").isin(NATIVE, UNION)).groupBy("token").pivot("view", [NATIVE, UNION]).agg(F.sum("n")), "analysis-compared")
    a, b = F.coalesce(NATIVE, F.lit(0)), F.coalesce(UNION, F.lit(0))
    whole = freq.agg(F.sum(a).alias("__a"), F.sum(b).alias("__b"))
    got = vocabulary.select("token").join(freq, "token", "left").crossJoin(F.broadcast(whole))  # one row
    share = lambda n, t: F.when(F.col(t) > 0, F.round(n / F.col(t), 8)).otherwise(F.lit(0.0))
    return got.select("token", a.alias("native"), b.alias("deduplicated"), share(a, "__a").alias("native_share"), share(b, "__b").alias("deduplicated_share"), (a - b).alias("removed"))


def extremes(freq: DataFrame, keys: list[str], k: int = 20) -> DataFrame:
    """keys, most (true for the most frequent), rank, token, n: k tokens at either end, ties by token."""
    w = Window.partitionBy(*keys)
    ranks = [(True, w.orderBy(F.desc("n"), "token")), (False, w.orderBy("n", "token"))]
    one = lambda most, order: freq.select(*keys, F.lit(most).alias("most"), F.row_number().over(order).alias("rank"), "token", "n").filter(F.col("rank") <= k)
    return one(*ranks[0]).unionByName(one(*ranks[1]))


def same_tokens(freqs: list[DataFrame]) -> bool:
    """Whether all tables hold the same tokens (counts of 0 don't count)."""
    seen = None
    for i, f in enumerate(freqs):
        f = f.filter("n > 0").select("token", F.lit(i).alias("__i"))
        seen = f if seen is None else seen.unionByName(f)
    if seen is None:
        return True
    return seen.groupBy("token").agg(F.countDistinct("__i").alias("k")).filter(F.col("k") < len(freqs)).isEmpty()


def inventory(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row about a source: records, unique_tokens, the sorted tokens and their document frequencies.

    The arrays are as long as the vocabulary; no row gives 0, and empty arrays."""
    n = rows.agg(F.count(F.lit(1)).alias("records"))
    df = stats.token_frequency(rows, [], tokens, per_row=True)
    entries = df.agg(F.array_sort(F.collect_list(F.struct("token", "n"))).alias("__e"))
    got = n.crossJoin(F.broadcast(entries))  # one row each
    return got.select("records", F.size("__e").alias("unique_tokens"), F.col("__e.token").alias("tokens"), F.map_from_entries("__e").alias("frequency"))


def rare_summary(freq: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """One row: total, types, vocabulary, coverage, rare_threshold (a tenth of the mean count, 1 at least) and rare tokens below it."""
    freq = freq.filter("n > 0")
    whole = freq.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("types"))
    limit = F.greatest(F.lit(1.0), F.when(F.col("types") > 0, F.col("total") / F.col("types")).otherwise(F.lit(0.0)) / 10)
    known = vocabulary.select("token").join(freq.select("token"), "token", "left_semi").agg(F.count(F.lit(1)).alias("__known"))
    size = vocabulary.agg(F.count(F.lit(1)).alias("vocabulary"))
    marked = freq.crossJoin(F.broadcast(whole.select(limit.alias("__limit"))))  # one row
    rare = marked.agg(F.count_if(F.col("n") < F.col("__limit")).alias("rare"))
    got = whole.crossJoin(known).crossJoin(size).crossJoin(rare)  # one row each
    return got.select("total", "types", "vocabulary", F.when(F.col("vocabulary") > 0, F.round(F.col("__known") / F.col("vocabulary"), 4)).otherwise(F.lit(0.0)).alias("coverage"), F.round(limit, 1).alias("rare_threshold"), "rare")


def upper_median(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """least, most, median (of an even number of rows the upper one) and mean to one place."""
    h = rows.groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    h = h.withColumns({"__to": F.sum("n").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)), "__all": F.sum("n").over(w)})
    middle = F.min(F.when(F.col("__to") > F.floor(F.col("__all") / 2), F.col("value")))
    return h.groupBy(*keys).agg(F.min("value").alias("least"), F.max("value").alias("most"), middle.alias("median"), F.round(F.sum(F.col("value") * F.col("n")) / F.sum("n"), 1).alias("mean"))


def balance(rows: DataFrame, axes: dict[str, list[str]]) -> DataFrame:
    """axis, label, n, ideal_pct, deviation (percentage points from an even spread over the labels) and the axis's largest."""
    spark = rows.sparkSession
    fixed = spark.createDataFrame([(a, x, 100.0 / len(labels)) for a, labels in axes.items() for x in labels], "axis string, label string, __ideal double")
    pairs = F.array(*(F.struct(F.lit(a).alias("axis"), F.coalesce(F.col(a).cast("string"), F.lit("unknown")).alias("label")) for a in axes))
    per = rows.select(F.explode(pairs).alias("x")).groupBy("x.axis", "x.label").agg(F.count(F.lit(1)).alias("n"))
    whole = per.groupBy("axis").agg(F.sum("n").alias("__t"))
    got = fixed.join(per, ["axis", "label"], "left").join(whole, "axis", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    off = F.when(F.col("__t") > 0, F.round(F.abs(F.col("n") / F.col("__t") * 100 - F.col("__ideal")), 4)).otherwise(F.lit(0.0))
    got = got.select("axis", "label", "n", F.round("__ideal", 4).alias("ideal_pct"), off.alias("deviation"))
    return got.withColumn("largest", F.max("deviation").over(Window.partitionBy("axis")))


def memberships(rows: DataFrame, members: str) -> DataFrame:
    """value, n: rows that list each value in an array (a value twice in a row counts twice)."""
    return rows.select(F.explode_outer(members).alias("value")).filter("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
