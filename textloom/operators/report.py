"""Acceptance of a selection, voice scores, calibration and documents about a run.

Everything gathered here is a row a token of the vocabulary, a row a voice or one row.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators import stats
from textloom.operators.tables import settled


def invariants(rows: DataFrame, key: str, tokens: str, freq: DataFrame, support: DataFrame, vocabulary: DataFrame, size: int, floor: int = 5) -> dict[str, bool]:
    """Six checks of a selection.

    ``freq``: the reported token, n; ``support``: token, n as sentence frequencies of the
    sources; ``vocabulary``: token.  Attainable tokens are those of both.  Missing rows and
    null token arrays count as none.
    """
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("keys"), F.coalesce(F.sum(F.greatest(F.size(tokens), F.lit(0))), F.lit(0)).alias("tokens")).first()
    reported = freq.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    seen = stats.token_frequency(rows, [], tokens, per_row=True).withColumnRenamed("n", "__seen")
    inventory = vocabulary.select("token", F.lit(True).alias("__v")).distinct()
    x = inventory.join(support.select("token", F.col("n").alias("__n")), "token", "full").join(seen, "token", "full").fillna(0, ["__n", "__seen"])
    attainable, known = F.col("__v").isNotNull() & (F.col("__n") > 0), F.col("__v").isNotNull()
    c = x.agg(
        F.count_if(attainable & (F.col("__seen") == 0)).alias("missing"),
        F.count_if(attainable & (F.col("__seen") < F.least(F.lit(floor), F.col("__n")))).alias("short"),
        F.count_if(~known & (F.col("__seen") > 0)).alias("strange"),
    ).first()
    return {
        "exact_size": whole["n"] == size, "unique_hashes": whole["keys"] == size, "complete_coverage": c["missing"] == 0,
        "rare_floor_met": c["short"] == 0, "all_in_vocabulary": c["strange"] == 0, "total_matches": reported == whole["tokens"],
    }


def improvements(selected: DataFrame, baseline: DataFrame, target: DataFrame, attainable: DataFrame, near: tuple[float, float], near_baseline: tuple[float, float]) -> dict[str, bool]:
    """Five comparisons with a baseline on the tokens that are attainable and in the baseline.

    ``near``: median and 95th percentile of nearest-neighbour cosines under a held-out model.
    No common token is an error.
    """
    shared = attainable.select("token").intersect(baseline.filter("n > 0").select("token"))
    if shared.isEmpty():
        raise ValueError("no token is shared with the baseline")
    both = stats.zero_filled(selected, shared).select(F.lit("selected").alias("view"), "token", "n").unionByName(stats.zero_filled(baseline, shared).select(F.lit("baseline").alias("view"), "token", "n"))
    d = {r["view"]: r for r in stats.distribution(both, ["view"]).collect()}
    jsd = {r["view"]: r["jsd"] for r in stats.divergence(both, stats.zero_filled(target, shared).select("token", "n"), ["view"]).collect()}
    a, b = d["selected"], d["baseline"]
    return {
        "entropy": a["entropy_share"] > b["entropy_share"], "gini": a["gini"] < b["gini"], "divergence": jsd.get("selected", 0.0) < jsd.get("baseline", 0.0),
        "median_similarity": near[0] < near_baseline[0], "p95_similarity": near[1] < near_baseline[1],
    }


def build_gates(rows: DataFrame, tokens: str, targets: DataFrame, axes: list[str], size: int, most: float = 0.02) -> dict[str, bool]:
    """Whether a build has its exact size, covers all target tokens, and strays from an even
    share of the labels present by ``most`` at most on each axis."""
    covered = rows.select(F.explode(tokens).alias("token")).distinct()
    out = {"exact_size": rows.count() == size, "full_coverage": targets.select("token").join(covered, "token", "left_anti").isEmpty()}
    for axis in axes:
        n = [r["count"] for r in rows.groupBy(axis).count().collect()]  # a row a label
        out[f"balanced_{axis}"] = all(abs(v / sum(n) - 1 / len(n)) <= most for v in n)
    return out


def voice_scores(rows: DataFrame, voice: str, gender: str, cer: str, recall: str, passed: str, vector: str) -> DataFrame:
    """voice, gender, median_cer, recall, passed, separation, score, rank (in its gender).

    0.55 (1 - median cer) + 0.25 recall + 0.10 share passed + 0.10 separation, scaled to 0..1
    over the voices; separation is 1 - the largest cosine with another voice's mean vector.
    Voices are configuration (tens); each is compared with every other.
    """
    middle = F.sort_array(F.collect_list(F.coalesce(F.col(cer), F.lit(1.0))))  # an audition is a few texts a voice
    per = rows.groupBy(voice, gender).agg(
        F.element_at(middle, (F.floor(F.count(F.lit(1)) / 2) + 1).cast("int")).alias("median_cer"), F.avg(F.coalesce(F.col(recall), F.lit(0.0))).alias("recall"),
        F.avg(F.coalesce(F.col(passed), F.lit(False)).cast("double")).alias("passed"),
    )
    own = F.col("__v")
    mean = rows.select(voice, F.posexplode(vector).alias("__i", "__v")).groupBy(voice, "__i").agg(F.avg(own).alias("__v"))
    mean = mean.withColumn("__v", own / F.sqrt(F.sum(own * own).over(Window.partitionBy(voice))))
    other = mean.select(F.col(voice).alias("__o"), "__i", own.alias("__u"))
    near = mean.join(other, "__i").filter(F.col(voice) != F.col("__o")).groupBy(voice, "__o").agg(F.sum(own * F.col("__u")).alias("__c")).groupBy(voice).agg((1 - F.max("__c")).alias("separation"))
    x = per.join(near, voice, "left").fillna(0.0, ["separation"])
    low, high = x.agg(F.min("separation"), F.max("separation")).first() or (0.0, 0.0)
    scaled = (F.col("separation") - F.lit(low or 0.0)) / F.lit(max(1e-12, (high or 0.0) - (low or 0.0)))
    x = x.withColumn("score", 0.55 * (1 - F.col("median_cer")) + 0.25 * F.col("recall") + 0.10 * F.col("passed") + 0.10 * scaled)
    return x.withColumn("rank", F.row_number().over(Window.partitionBy(gender).orderBy(F.desc("score"), voice)))


def calibration(rows: DataFrame, seconds: str, n: str, least: float = 0.35) -> DataFrame:
    """Seconds a token: mean, 95th percentile (by rank) and a cautious value of 1.2 times that, ``least`` at least."""
    ratio = rows.select((F.col(seconds) / F.greatest(F.lit(1), F.col(n))).alias("r"))
    got = ratio.agg(F.avg("r").alias("mean")).crossJoin(stats.rank_quantile(ratio, "r", 0.95).select(F.col("r").alias("p95")))  # one row each
    return got.withColumn("cautious", F.greatest(F.lit(least), F.col("p95") * 1.2))


def next_step(accepted: Column, attempts: Column, most: int = 2) -> Column:
    """accept, regenerate while attempts are left, else quarantine."""
    return F.when(F.coalesce(accepted, F.lit(False)), "accept").when(F.coalesce(attempts, F.lit(0)) < most, "regenerate").otherwise("quarantine")


def lost_tokens(before: DataFrame, after: DataFrame, allowed: tuple[str, ...] = ()) -> DataFrame:
    """token: what ``before`` (token, n) has and ``after`` lacks, but for the allowed ones."""
    seen = after.filter("n > 0").select("token")
    return before.filter("n > 0").select("token").distinct().join(seen, "token", "left_anti").filter(~F.col("token").isin(*allowed) if allowed else F.lit(True))


def demand_none_lost(before: DataFrame, after: DataFrame, allowed: tuple[str, ...] = ()) -> None:
    """Spoken forms may do without digits; any other token that they lose is an error."""
    lost = sorted(r["token"] for r in lost_tokens(before, after, allowed).collect())  # a vocabulary at most
    if lost:
        raise ValueError(f"tokens were lost: {', '.join(lost)}")


def missing(targets: DataFrame, rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """token: the targets that no row holds."""
    covered = rows.select(F.explode_outer(tokens).alias("token")).filter("token IS NOT NULL").distinct()
    return targets.select("token").distinct().join(covered, "token", "left_anti")


def final_counts(rows: DataFrame, sources: str, axes: list[str], labels: str | None = None) -> DataFrame:
    """axis, value, n: rows by each of ``axes``, by source (an array of them; none is unknown), and by each entry of a map of labels."""
    pairs = [F.array(*(F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value")) for a in axes))]
    listed = F.when(F.size(sources) > 0, F.col(sources)).otherwise(F.array(F.lit("unknown")))
    pairs.append(F.transform(listed, lambda v: F.struct(F.lit("source").alias("axis"), v.cast("string").alias("value"))))
    if labels:
        entries = F.coalesce(F.map_entries(labels), F.array().cast("array<struct<key:string,value:string>>"))
        pairs.append(F.transform(entries, lambda e: F.struct(F.concat(F.lit("label."), e["key"]).alias("axis"), e["value"].cast("string").alias("value"))))
    return rows.select(F.explode(F.concat(*pairs)).alias("x")).groupBy("x.axis", "x.value").agg(F.count(F.lit(1)).alias("n"))


def final_totals(rows: DataFrame, tokens: str, inventory: DataFrame, seconds: str, exception: str) -> DataFrame:
    """One row: tokens, types, inventory, whether the counts add up, hours and rows taken in spite of their similarity."""
    freq = settled(stats.token_frequency(rows, [], tokens), "final-counts")
    own = rows.agg(F.coalesce(F.sum(F.greatest(F.size(tokens), F.lit(0))), F.lit(0)).alias("__own"), (F.coalesce(F.sum(seconds), F.lit(0.0)) / 3600).alias("__h"), F.count_if(F.coalesce(F.col(exception), F.lit(False))).alias("exceptions"))
    whole = freq.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types"))
    size = inventory.select("token").distinct().agg(F.count(F.lit(1)).alias("inventory"))
    got = whole.crossJoin(own).crossJoin(size)  # one row each
    return got.select("tokens", "types", "inventory", (F.col("tokens") == F.col("__own")).alias("reconciled"), F.round("__h", 6).alias("hours"), "exceptions")


def _file(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    at, fs = _file(spark, path)
    if not fs.exists(at):
        return None
    return bytes(spark.read.format("binaryFile").load(path).first()["content"]).decode()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside its place and then renamed, so a reader sees the old text or the new one."""
    at, fs = _file(spark, path)
    beside, _ = _file(spark, f"{path}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(at, False)
    fs.rename(beside, at)


def json_document(spark: SparkSession, path: str, value: dict) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def with_section(content: str, run: str, body: str) -> str:
    """The log with the run's section put in, or in place of the one that it has."""
    first, last = f"<!-- run:{run}:start -->", f"<!-- run:{run}:end -->"
    block = f"{first}\n{body.strip()}\n{last}"
    had = re.compile(re.escape(first) + ".*?" + re.escape(last), re.DOTALL)
    return (had.sub(lambda _: block, content) if had.search(content) else f"{content.rstrip()}\n\n{block}".lstrip()).rstrip() + "\n"


def run_log(spark: SparkSession, path: str, run: str, body: str) -> None:
    write_text(spark, path, with_section(read_text(spark, path) or "# Runs\n", run, body))
