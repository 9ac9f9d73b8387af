"""Quality control: error rates, gates, acceptance, ledgers, voice scores.

A missing figure never accepts a row; null texts count as empty; null keys are one key in
counts and match nothing in joins, unless a function says otherwise; empty tables give
empty results (one row where a result is one row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edits(a: Column, b: Column) -> Column:
    """Edit distance in code points; null counts as empty."""
    return F.levenshtein(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))


def token_edits(a: Column, b: Column) -> Column:
    """Edit distance between arrays of tokens (null counts as empty): each distinct token of the
    two becomes a character of its own and the strings are compared, which stays in the JVM.

    Characters are taken from U+0100 on, around the surrogates: 55,000 distinct tokens, more are an error."""
    a, b = (F.coalesce(c, F.array().cast("array<string>")) for c in (a, b))
    names = F.array_distinct(F.concat(a, b))
    places = F.map_from_entries(F.transform(names, lambda t, i: F.struct(t, F.when(i >= 55_000, F.raise_error(F.lit("too many distinct tokens")).cast("int")).otherwise(i + 256))))
    said = lambda tokens, of: F.array_join(F.transform(tokens, lambda t: F.decode(F.unhex(F.lpad(F.hex(F.element_at(of, t)), 4, "0")), "UTF-16BE")), "")
    return F.element_at(F.transform(F.array(places), lambda of: F.levenshtein(said(a, of), said(b, of))), 1).cast("long")


def error_rate(n_edits: Column, length: Column) -> Column:
    return n_edits / F.greatest(F.lit(1), length)


def corpus_rates(rows: DataFrame, ref: str, hyp: str) -> DataFrame:
    """Micro-averaged character and word error rates; a null text counts as an empty one."""
    rows = rows.select(F.coalesce(ref, F.lit("")).alias(ref), F.coalesce(hyp, F.lit("")).alias(hyp))
    x = rows.select(edits(F.col(ref), F.col(hyp)).alias("ce"), F.length(ref).alias("cn"), token_edits(F.split(ref, " "), F.split(hyp, " ")).alias("we"), F.size(F.split(ref, " ")).alias("wn"))
    return x.agg(F.round(F.sum("ce") / F.greatest(F.lit(1), F.sum("cn")), 8).alias("cer"), F.round(F.sum("we") / F.greatest(F.lit(1), F.sum("wn")), 8).alias("wer"))


def recall(wanted: Column, found: Column) -> Column:
    """Share of the wanted tokens that were found; 1 if none is wanted."""
    w = F.array_distinct(wanted)
    return F.when(F.size(w) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(w, found)) / F.size(w))


def acceptance(rows: DataFrame, max_cer: float, max_wer: float, min_recall: float) -> DataFrame:
    """Adds reasons (array) and accepted."""
    why = F.array_compact(F.array(F.when(~F.col("cpu_ok"), F.lit("cpu")), F.when(F.col("cer") > max_cer, F.lit("cer")), F.when(F.col("wer") > max_wer, F.lit("wer")), F.when(F.col("recall") < min_recall, F.lit("recall"))))
    return rows.withColumn("reasons", why).withColumn("accepted", F.size("reasons") == 0)


def second_opinion(rare: Column, cer: Column, found: Column, max_cer: float, margin: float = 0.05) -> Column:
    return rare | (cer > max_cer) | (F.abs(cer - max_cer) <= margin) | (found < 1)


def phase_gate(rows: DataFrame, phase: str, accepted: str, threshold: float) -> DataFrame:
    g = rows.groupBy(phase).agg(F.count(F.lit(1)).alias("complete"), F.sum(F.col(accepted).cast("long")).alias("passed"))
    rate = F.col("passed") / F.col("complete")
    return g.select(phase, "complete", "passed", F.round(rate, 6).alias("rate"), (rate >= threshold).alias("open"))


def best_candidate(rows: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The row with the least (score, tie) of each key."""
    cols = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(score, tie)).alias("b")).select(key, "b.*")


def align(left: DataFrame, right: DataFrame, key: str, text: str) -> DataFrame:
    """Left rows with their transcript, or the reason why there is none; a key that stands for
    several rows on the right is an error."""
    one = right.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(text).alias(text), F.lit(True).alias("__there"))
    one = one.withColumn("__there", F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("ambiguous: "), F.col(key).cast("string"))).cast("boolean")).otherwise(F.col("__there"))).drop("__n")
    got = left.join(one, key, "left")
    reason = F.when(F.col("__there").isNull(), "missing").when(F.trim(F.coalesce(F.col(text), F.lit(""))) == "", "empty_transcript")
    return got.withColumn("reason", reason).drop("__there")


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """Adds is_repeated: whether another row has the same key (nulls are one key).

    Counted before the join, so one key with very many rows is no task's burden."""
    counted = rows.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__k", F.lit(True).alias("__more"))
    got = rows.join(counted, F.col(key).eqNullSafe(F.col("__k")), "left")
    return got.withColumn("is_repeated", F.coalesce("__more", F.lit(False))).drop("__k", "__more")


def spend(rows: DataFrame, phase: str, cost: str) -> DataFrame:
    return rows.groupBy(phase).agg(F.coalesce(F.round(F.sum(cost), 4), F.lit(0.0)).alias("spent"))


def forecast(jobs: DataFrame, text: str, tokens: str, seconds_per_token: float, audio_per_second: float, input_price: float, audio_price: float, keys: list[str] | None = None) -> DataFrame:
    """Forecast by ``keys`` (or one row): input_tokens (a quarter of the bytes, rounded up), seconds of
    speech, audio_tokens (rounded up), and the cost of either and of both at prices a million tokens."""
    size = F.coalesce(F.sum(F.coalesce(F.octet_length(text), F.lit(0))), F.lit(0))
    n = F.coalesce(F.sum(F.greatest(F.size(tokens), F.lit(0))), F.lit(0))
    got = jobs.groupBy(*(keys or [])).agg(F.ceil(size / 4).cast("long").alias("input_tokens"), (n * F.lit(float(seconds_per_token))).alias("seconds"))
    got = got.withColumn("audio_tokens", F.ceil(F.col("seconds") * F.lit(float(audio_per_second))).cast("long"))
    got = got.withColumns({"input_cost": F.col("input_tokens") / 1_000_000 * F.lit(float(input_price)), "audio_cost": F.col("audio_tokens") / 1_000_000 * F.lit(float(audio_price))})
    return got.withColumn("total_cost", F.col("input_cost") + F.col("audio_cost"))


def verdicts(jobs: DataFrame, cpu: DataFrame, first: DataFrame, second: DataFrame, max_cer: float = 0.35, max_wer: float = 0.6, names: tuple[str, str] = ("whisper", "mms")) -> DataFrame:
    """``jobs`` with what the checks of audio (cpu) and two recognisers found, reasons and accepted.

    Left joins on job_id; each side has at most one row a job.  cpu: cpu_pass, audio_sha256,
    duration_seconds; recognisers: cer, wer, recall; jobs: required_rare (array).  A missing cer or
    wer counts as 1, a missing recall as 0.  The second recogniser is needed where the first one
    is over the limit of cer or within 0.05 of it, and for rare tokens.
    """
    a, b = names
    own = lambda rows, cols, pre: rows.select("job_id", *(F.col(c).alias(f"{pre}{c}") for c in cols), F.lit(True).alias(f"{pre}there"))
    x = jobs.join(own(cpu, ["cpu_pass", "audio_sha256", "duration_seconds"], "cpu_"), "job_id", "left")
    x = x.join(own(first, ["cer", "wer", "recall"], "a_"), "job_id", "left").join(own(second, ["cer", "wer", "recall"], "b_"), "job_id", "left")
    has = {k: F.coalesce(F.col(f"{k}_there"), F.lit(False)) for k in ("cpu", "a", "b")}
    cer, wer = F.coalesce("a_cer", F.lit(1.0)), F.coalesce("a_wer", F.lit(1.0))
    rare = F.coalesce(F.size("required_rare") > 0, F.lit(False))
    disputed = has["a"] & ((cer > max_cer) | (F.abs(cer - max_cer) <= 0.05)) & ~has["b"]
    why = F.array_compact(F.array(
        F.when(~has["cpu"] | ~F.coalesce("cpu_cpu_pass", F.lit(False)), "cpu_qc"), F.when(~has["a"], f"missing_{a}").when((cer > max_cer) | (wer > max_wer), f"{a}_accuracy"),
        F.when(disputed, f"missing_{b}_disputed"), F.when(rare & ~has["b"], f"missing_{b}").when(rare & (F.coalesce("b_recall", F.lit(0.0)) < 1), f"{b}_rare_recall"),
        F.when(rare & has["a"] & (F.coalesce("a_recall", F.lit(0.0)) < 1), f"{a}_rare_recall"),
    ))
    got = x.withColumn("reasons", why).withColumn("accepted", F.size("reasons") == 0)
    return got.select(*jobs.columns, F.col("cpu_audio_sha256").alias("audio_sha256"), F.col("cpu_duration_seconds").alias("duration_seconds"), F.col("a_cer").alias(f"{a}_cer"), F.col("a_wer").alias(f"{a}_wer"), F.col("b_cer").alias(f"{b}_cer"), "reasons", "accepted")


def canonical(judged: DataFrame, key: str, cer: str = "whisper_cer") -> DataFrame:
    """The accepted recording of each text with the least (cer, job_id): its canonical job or a later attempt."""
    own = (F.col("realisation") == "canonical") | F.col("realisation").startswith("regeneration")
    return best_candidate(judged.filter("accepted").filter(own).withColumn("__cer", F.coalesce(cer, F.lit(1.0))), key, "__cer", "job_id").drop("__cer")


def regenerations(texts: DataFrame, judged: DataFrame, key: str, most: int = 2, prefix: str = "ful_") -> DataFrame:
    """key, attempt, failed_job_id for the texts without an accepted recording that have attempts left."""
    done = canonical(judged, key).select(key)
    own = (F.col("realisation") == "canonical") | F.col("realisation").startswith("regeneration")
    tried = F.coalesce(F.nullif(F.regexp_extract("realisation", r"^regeneration_(\d+)", 1), F.lit("")).cast("int"), F.lit(0))
    failed = judged.filter("NOT accepted").filter(own).groupBy(key).agg(F.max(tried).alias("__k"), F.max("job_id").alias("__job"))
    left = texts.select(key).distinct().join(done, key, "left_anti").join(failed, key, "left")
    got = left.select(key, (F.coalesce("__k", F.lit(0)) + 1).alias("attempt"), F.coalesce("__job", F.concat(F.lit(prefix), F.col(key).cast("string"))).alias("failed_job_id"))
    return got.filter(F.col("attempt") <= most)


def structural(m: DataFrame, rate: int = 16_000, least: float = 0.2, most: float = 655.0, max_clipping: float = 0.001) -> Column:
    """Whether a WAV file (``readers.wav_metrics``) is usable: mono, 16 bits, rate, length, sound, no clipping."""
    ok = (m.channels == 1) & (m.bits == 16) & (m.rate == rate) & m.duration.between(least, most) & (m.rms > 0) & (m.clipping <= max_clipping)
    return F.coalesce(ok, F.lit(False))


def clipped_recall(rows: DataFrame, key: str, ref: str, hyp: str, wanted: list[str]) -> DataFrame:
    """matched, n, recall of the wanted tokens over the corpus; a token counts at most as often as it was found."""
    count = lambda c, n: rows.select(key, F.explode(c).alias("token")).filter(F.col("token").isin(wanted)).groupBy(key, "token").agg(F.count(F.lit(1)).alias(n))
    both = count(ref, "a").join(count(hyp, "b"), [key, "token"], "left").fillna(0, ["b"])
    got = both.agg(F.coalesce(F.sum(F.least("a", "b")), F.lit(0)).alias("matched"), F.coalesce(F.sum("a"), F.lit(0)).alias("n"))
    return got.withColumn("recall", F.when(F.col("n") > 0, F.col("matched") / F.col("n")).otherwise(F.lit(1.0)))


def split_summary(rows: DataFrame, split: str, speaker: str, seconds: str) -> DataFrame:
    return rows.groupBy(split).agg(F.count(F.lit(1)).alias("utterances"), F.countDistinct(speaker).alias("speakers"), F.round(F.coalesce(F.sum(seconds), F.lit(0)) / 3600, 6).alias("hours"))


def import_faults(results: DataFrame, jobs: DataFrame, known: DataFrame, key: str, checksum: str, values: list[str]) -> DataFrame:
    """key, fault of results that cannot be taken: repeated, unknown, checksum (not the job's), conflict (differs from the row known)."""
    r = results.select(key, checksum, F.struct(*values).alias("__r"), F.lit(1).alias("__one"))
    per = r.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(checksum, "__r")).alias("__v"))
    x = per.join(jobs.select(key, F.col(checksum).alias("__want"), F.lit(True).alias("__job")), key, "left").join(known.select(key, F.struct(*values).alias("__k"), F.lit(True).alias("__had")), key, "left")
    fault = (
        F.when(F.col("__n") > 1, "repeated").when(F.col("__job").isNull(), "unknown").when(~F.col(f"__v.{checksum}").eqNullSafe(F.col("__want")), "checksum")
        .when(F.col("__had") & ~F.col("__v.__r").eqNullSafe(F.col("__k")), "conflict")
    )
    return x.select(key, fault.alias("fault")).filter("fault IS NOT NULL")


def same_keys(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether both sides hold the same set of keys (scoring needs that)."""
    x, y = a.select(key).distinct().withColumn("__a", F.lit(1)), b.select(key).distinct().withColumn("__b", F.lit(1))
    return x.join(y, key, "full").filter("__a IS NULL OR __b IS NULL").isEmpty()


def shared_speakers(rows: DataFrame, split: str, speaker: str) -> DataFrame:
    """Speakers in more than one split; a sound split has none."""
    return rows.groupBy(speaker).agg(F.array_sort(F.collect_set(split)).alias("splits")).filter(F.size("splits") > 1)  # a few splits
