"""Pools of sentences, exact deduplication with provenance, overlap and contribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.tables import settled
from textloom.profile import MAX_TOKENS, MAX_UNKNOWN, MIN_TOKENS, MIN_UNIQUE, Profile


def sentences(docs: DataFrame, profile: Profile, raw_first: bool = False, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """One row a sentence: keep, pos, sentence.  ``raw_first`` splits before cleaning."""
    parts = docs.select(*keep, F.posexplode_outer(T.sentences(F.col("text"), profile, raw_first)).alias("pos", "sentence"))
    return parts.filter("sentence <> ''")  # outer: a filter on the array would make it twice


def measured(rows: DataFrame, profile: Profile, col: str = "sentence") -> DataFrame:
    """Adds tokens, n_tokens, n_unique, unknown and reason (null: accepted)."""
    rows = rows.withColumn("__m", T.once(T.measures(F.col(col), profile))).select(*(c for c in rows.columns if c != "tokens"), "__m.*")
    return rows.withColumn("reason", T.quality_reason(F.col("n_tokens"), F.col("n_unique"), F.col("unknown"), MIN_TOKENS, MAX_TOKENS, MIN_UNIQUE, MAX_UNKNOWN))


def pool(docs: DataFrame, profile: Profile) -> DataFrame:
    """Accepted sentences with their hash."""
    return measured(sentences(docs, profile), profile).filter("reason is null").withColumn("hash", F.sha2(F.col("sentence").cast("binary"), 256))  # cleaned, so its spaces are collapsed


def first_seen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; min_by keeps partial sums small and needs no window."""
    cols = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("__f")).select(key, "__f.*")


def priority_union(rows: DataFrame, corpus: str, key: str = "hash") -> DataFrame:
    """key, first corpus, all corpora (sorted) and copies."""
    return rows.groupBy(key).agg(F.min(corpus).alias("first_corpus"), F.array_sort(F.collect_set(corpus)).alias("corpora"), F.count(F.lit(1)).alias("copies"))


def overlap(rows: DataFrame, corpus: str, key: str = "hash") -> DataFrame:
    """Intersection, union and Jaccard of every pair of corpora that share a text."""
    member = settled(rows.select(key, F.col(corpus).alias("c")).distinct(), "members")  # read three times
    sizes = member.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    sets = member.groupBy(key).agg(F.array_sort(F.collect_set("c")).alias("cs")).filter(F.size("cs") > 1)  # as long as there are corpora
    pairs = sets.select(F.explode(F.flatten(F.transform("cs", lambda a: F.transform(F.filter("cs", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n_both"))
    got = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b").withColumn("n_union", F.col("na") + F.col("nb") - F.col("n_both"))
    return got.select("a", "b", "n_both", "n_union", F.round(F.col("n_both") / F.col("n_union"), 8).alias("jaccard"))


def contribution(rows: DataFrame, corpus: str, key: str = "hash") -> DataFrame:
    """Per corpus: usable rows, distinct texts, repeats within, kept by priority, exclusive, shared."""
    per = rows.groupBy(key, F.col(corpus).alias("corpus")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key)
    per = per.withColumn("first", F.min("corpus").over(w)).withColumn("k", F.count(F.lit(1)).over(w))
    yes = lambda c: F.sum(c.cast("long"))
    return per.groupBy("corpus").agg(F.sum("n").alias("n_usable"), F.count(F.lit(1)).alias("n_distinct"), F.sum(F.col("n") - 1).alias("n_within"), yes(F.col("first") == F.col("corpus")).alias("n_retained"), yes(F.col("k") == 1).alias("n_exclusive"), yes(F.col("k") > 1).alias("n_shared"))


def merge_batches(batches: list[DataFrame], key: Column | None = None) -> DataFrame:
    """First row of each key over batches in order; inside a batch the first by all its columns.

    Without a key it is ``id``, else ``pool_id`` where there are such columns.  Rows without a
    key are one row."""
    rows = None
    for i, b in enumerate(batches):
        b = b.withColumn("__batch", F.lit(i))
        rows = b if rows is None else rows.unionByName(b, allowMissingColumns=True)
    if key is None:
        key = F.coalesce(*(F.col(c).cast("string") for c in ("id", "pool_id") if c in rows.columns))
    order = [F.col(c) for c in rows.columns if c != "__batch" and not rows.schema[c].dataType.simpleString().startswith("map")]
    rows = rows.withColumns({"__key": key, "__row": F.struct(*order)})
    return first_seen(rows, "__key", ["__batch", "__row"]).drop("__key", "__batch", "__row")


def unselected(rows: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """The rows whose key was not selected before; rows without a key stay."""
    return rows.join(selected.select(key).distinct(), key, "left_anti")


def retokenised(rows: DataFrame, profile: Profile, normalise=T.normalize) -> DataFrame:
    """Rows with text, tokens, unique_tokens and hash made anew; what was stored of these is ignored."""
    keep = [c for c in rows.columns if c not in ("text", "tokens", "unique_tokens", "hash")]
    got = rows.select(*keep, T.once(normalise(F.coalesce("text", F.lit("")), profile)).alias("text"))
    got = got.withColumn("tokens", T.once(T.tokenize(F.col("text"), profile, profile.skip)))
    return got.withColumns({"unique_tokens": F.array_sort(F.array_distinct("tokens")), "hash": F.sha2(F.col("text").cast("binary"), 256)})


def hydrated(short: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The shortlist's rows with the columns of the pool that it lacks; a key that the pool lacks is an error."""
    more = [c for c in rows.columns if c not in short.columns]
    got = short.join(rows.select(key, *more, F.lit(True).alias("__there")), key, "left")
    got = got.withColumn("__there", F.when(F.col("__there").isNull(), F.raise_error(F.concat(F.lit("not in the pool: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))).otherwise(F.lit(True)))
    return got.filter("__there").drop("__there")
