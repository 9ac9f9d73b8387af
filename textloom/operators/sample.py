"""Bounded candidates and samples; every order is a hash or a stated key, never chance.

Null cells are cells of their own; rows without tokens have no per-token rank; repeated rows
are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def hash_order(id_col: str, seed: str):
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"), 256)


def per_cell(rows: DataFrame, cell: list[str], cap: int, id_col: str, seed: str = "7") -> DataFrame:
    """At most ``cap`` rows a cell in hash order.

    Up to 1,000 Spark keeps cap rows a task before the shuffle; beyond, a hot cell is first cut
    into 256 parts by a hash of the id, which keep cap rows each."""
    order = [hash_order(id_col, seed), id_col]
    if cap > 1000:
        part = rows.withColumn("__part", F.pmod(F.xxhash64(id_col), F.lit(256)))
        part = part.withColumn("__r", F.row_number().over(Window.partitionBy(*cell, "__part").orderBy(*order)))
        rows = part.filter(F.col("__r") <= cap).drop("__part", "__r")
    w = Window.partitionBy(*cell).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= cap)


def round_robin(rows: DataFrame, cell: list[str], n: int, id_col: str, seed: str = "7") -> DataFrame:
    """One row of each stratum a round, strata in order, until n rows; null strata come first.

    No stratum gives more than n rows, so each task keeps n a stratum before the shuffle.
    """
    w = Window.partitionBy(*cell).orderBy(hash_order(id_col, seed), id_col)
    return rows.withColumn("round", F.row_number().over(w)).filter(F.col("round") <= n).orderBy("round", *cell).limit(n)


def priority(rows: DataFrame, tokens: str, freq: DataFrame, key: str) -> DataFrame:
    """Rarity: sum of 1 / sqrt(rows with the token) over distinct tokens / sqrt(length), rounded
    to six places, and against ties the first 12 hex digits of a hash of the key as a fraction
    of a billionth.  Rows without tokens have no priority; rows of one key are one row."""
    x = rows.select(key, F.size(tokens).alias("len"), F.explode_outer(F.array_distinct(tokens)).alias("token")).filter("token IS NOT NULL").join(freq, "token")
    score = F.sum(1 / F.sqrt("n")) / F.sqrt(F.greatest(F.max("len"), F.lit(1)))
    jitter = F.conv(F.substring(F.sha2(F.col(key).cast("string").cast("binary"), 256), 1, 12), 16, 10).cast("double") / F.lit(16.0**12)
    return x.groupBy(key).agg(F.round(score, 6).alias("priority")).withColumn("priority", F.col("priority") + jitter * F.lit(1e-9))


def stratified(rows: DataFrame, cell: list[str], n: int, id_col: str, seed: str = "7") -> DataFrame:
    """``round_robin``, but a table of n rows or fewer stays whole, as it is (``round`` null)."""
    if rows.count() <= n:
        return rows.withColumn("round", F.lit(None).cast("int"))
    return round_robin(rows, cell, n, id_col, seed)


def top(rows: DataFrame, n: int, *order) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def top_per_token(rows: DataFrame, tokens: str, k: int, order: list) -> DataFrame:
    """The first k rows of each token in ``order``; each task keeps k a token before the shuffle."""
    x = rows.withColumn("token", F.explode_outer(F.array_distinct(tokens))).filter("token IS NOT NULL")
    return x.withColumn("rank", F.row_number().over(Window.partitionBy("token").orderBy(*order))).filter(F.col("rank") <= k)


def shortlist(rows: DataFrame, tokens: str, key: str, per_token: int, limit: int) -> DataFrame:
    """All per-token tops, then the best of the rest, up to ``limit`` rows; fails if the tops alone are more."""
    order = [F.desc("priority"), F.desc(key)]
    must = top_per_token(rows, tokens, per_token, order).select(key).distinct().withColumn("required", F.lit(True))
    got = rows.join(must, key, "left").withColumn("required", F.coalesce("required", F.lit(False)))
    got = got.orderBy(F.desc("required"), *order).limit(limit + 1).withColumn("place", F.row_number().over(Window.orderBy(F.desc("required"), *order)))
    over = F.raise_error(F.lit(f"more than {limit} rows are required by their tokens")).cast("int")
    return got.withColumn("place", F.when((F.col("place") > limit) & F.col("required"), over).otherwise(F.col("place"))).filter(F.col("place") <= limit).drop("place")


def speaker_split(rows: DataFrame, speaker: str, shares: tuple[tuple[str, float], ...] = (("train", 0.8), ("dev", 0.1), ("test", 0.1)), seed: str = "7") -> DataFrame:
    """Whole speakers to splits: the largest first, each to the split that lacks most.

    Sizes per speaker come to one task (speakers are a dimension); rows stay distributed.
    """
    import pandas as pd

    sizes = rows.groupBy(speaker).agg(F.count(F.lit(1)).alias("n")).withColumn("h", hash_order(speaker, seed))
    kind = dict(sizes.dtypes)[speaker]

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "h"], ascending=[False, True])
        total, held, out = int(pdf.n.sum()), {k: 0 for k, _ in shares}, []
        for n in pdf.n:
            to = max(shares, key=lambda s: (s[1] * total - held[s[0]], s[0]))[0]
            held[to] += n
            out.append(to)
        return pd.DataFrame({speaker: pdf[speaker], "split": out})

    return sizes.groupBy().applyInPandas(deal, f"{speaker} {kind}, split string")


def budget_bins(rows: DataFrame, size: str, order: str, budget: int, most: int = 40) -> DataFrame:
    """Archives filled in order up to a byte budget: bin of each row.

    Where a bin ends depends on all before, so the list of sizes is one task's; more than
    ``most`` archives are an error, which bounds what they hold."""
    import pandas as pd

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        at, held, out = 0, 0, []
        pdf = pdf.sort_values(order)
        for n in pdf[size]:
            if held and held + n > budget:
                at, held = at + 1, 0
            if at >= most:
                raise ValueError(f"more than {most} archives are needed")
            held += n
            out.append(at)
        return pd.DataFrame({order: pdf[order], "bin": out})

    return rows.select(order, size).groupBy().applyInPandas(fill, f"{order} {dict(rows.dtypes)[order]}, bin long")
