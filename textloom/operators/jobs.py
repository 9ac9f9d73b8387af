"""Speech jobs by phase: who speaks which text, further voices for rare tokens, new attempts.

``voices`` is configuration: (name, gender) in order.  Jobs carry the text's columns and
job_id, phase, realisation, voice, voice_gender, style.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.sources import sinks

Voices = list[tuple[str, str]]


def _listed(voices: Voices) -> Column:
    return F.array(*(F.struct(F.lit(v).alias("name"), F.lit(g).alias("gender")) for v, g in voices))


def _jobs(rows: DataFrame, job_id: Column, phase: str, realisation: Column, voice: Column, rare: Column, sector: str) -> DataFrame:
    return rows.withColumns({
        "job_id": job_id, "phase": F.lit(phase), "realisation": realisation, "voice": voice["name"], "voice_gender": voice["gender"],
        "style": T.style(F.col(sector), rare),
    })


def audition(texts: DataFrame, key: str, sector: str, voices: Voices) -> DataFrame:
    """Every text by every voice."""
    rows = texts.withColumn("__v", F.explode(_listed(voices)))
    return _jobs(rows, F.concat_ws("_", F.lit("aud"), key, F.lower("__v.name")), "audition", F.lit("audition"), F.col("__v"), F.lit(False), sector).drop("__v")


def canonical(texts: DataFrame, key: str, sector: str, voices: Voices, phase: str) -> DataFrame:
    """One job a text; voices take turns in order of ``key``.  ``slot`` is the text's turn."""
    rows = sinks.numbered(texts, [key], "slot", "", 1).withColumn("slot", (F.col("slot").cast("long") % len(voices)).cast("int"))
    voice = F.get(_listed(voices), F.col("slot"))
    return _jobs(rows, F.concat_ws("_", F.lit(phase[:3]), key), phase, F.lit("canonical"), voice, F.lit(False), sector)


def extra(supports: DataFrame, order: str, key: str, tokens: str, jobs: DataFrame, rare: str, sector: str, voices: Voices) -> DataFrame:
    """Further voices for texts with rare tokens, in order: one that neither the text nor its
    tokens had yet; else, of those that the text had not, the one that fewest of its tokens had.

    ``jobs`` are canonical jobs with their ``rare`` tokens.  Each choice depends on those before,
    so rows go in one group; they are a few a rare token, so the vocabulary bounds them.
    Too few voices for a text is an error.
    """
    names = [v for v, _ in voices]
    needed = supports.select(order, F.col(key).alias("__k"), F.explode_outer(F.array_distinct(tokens)).alias("__t"))
    wanted = needed.select("__t").distinct()
    had = jobs.select("voice", F.explode(F.array_distinct(rare)).alias("__t")).join(wanted, "__t", "left_semi").groupBy("__t").agg(F.collect_set("voice").alias("__had"))
    own = jobs.join(supports.select(key).distinct(), key, "left_semi").groupBy(F.col(key).alias("__k")).agg(F.collect_set("voice").alias("__own"))
    rows = needed.join(had, "__t", "left").groupBy(order, "__k").agg(F.collect_list(F.when(F.col("__t").isNotNull(), F.struct("__t", "__had"))).alias("__s")).join(own, "__k", "left")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        by_token: dict[str, set] = {}
        by_text: dict[object, set] = {}
        out = []
        for r in pdf.sort_values(order).to_dict("records"):
            for s in r["__s"]:
                by_token.setdefault(s["__t"], set()).update(s["__had"] if s["__had"] is not None else ())
        for r in pdf.sort_values(order).to_dict("records"):
            mine = by_text.setdefault(r["__k"], set(r["__own"] if r["__own"] is not None else ()))
            tokens_had = [by_token[s["__t"]] for s in r["__s"]]
            left = [n for n in names if n not in mine]
            if not left:
                raise ValueError(f"not enough voices for {r['__k']}")
            fresh = [n for n in left if not any(n in t for t in tokens_had)]
            pick = fresh[0] if fresh else min(left, key=lambda n: (sum(n in t for t in tokens_had), n))
            mine.add(pick)
            for t in tokens_had:
                t.add(pick)
            out.append((r[order], pick))
        return pd.DataFrame(out, columns=["__o", "__pick"])

    order_type = supports.schema[order].dataType.simpleString()
    picked = rows.groupBy().applyInPandas(choose, f"__o {order_type}, __pick string")
    rows = supports.join(picked, F.col(order) == F.col("__o")).drop("__o")
    voice = F.element_at(F.filter(_listed(voices), lambda v: v["name"] == F.col("__pick")), 1)
    return _jobs(rows, F.concat(F.lit("rare_"), F.format_string("%06d", F.col(order)), F.lit("_"), F.col(key)), "full", F.lit("rare_extra"), voice, F.lit(True), sector).drop("__pick")


def again(requests: DataFrame, jobs: DataFrame, key: str, rare: str, sector: str, voices: Voices) -> DataFrame:
    """Jobs for (key, attempt, failed_job_id): the text's next voice by attempt."""
    base = jobs.drop("job_id", "phase", "realisation", "voice", "voice_gender", "style")
    rows = requests.select(key, "attempt", F.col("failed_job_id").alias("regenerates_job_id")).join(base, key)
    voice = F.get(_listed(voices), ((F.col("slot") + F.col("attempt")) % len(voices)).cast("int"))
    job_id = F.concat(F.lit("regen"), F.col("attempt"), F.lit("_"), F.col(key))
    return _jobs(rows, job_id, "full", F.concat(F.lit("regeneration_"), F.col("attempt")), voice, F.size(rare) > 0, sector)


def requested(known: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Known requests and those of the new ones whose key is not known yet."""
    return known.unionByName(new.dropDuplicates(key).join(known.select(*key), key, "left_anti"))
