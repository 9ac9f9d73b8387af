"""Rule-based labels.  Rules are a parameter: label axis -> label -> patterns (YAML).

A null text matches nothing and gets each axis's default label; repeated rows get the same
labels; an empty table gives none.  Columns of the labels' names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Rules = dict[str, dict[str, list[str]]]

def load_rules(path: str, spark: SparkSession) -> Rules:
    """Rules of a YAML file, wherever Spark can read it."""
    import yaml

    content = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())  # one file
    return {a: {k: [str(p) for p in v or []] for k, v in (labels or {}).items()} for a, labels in (yaml.safe_load(content) or {}).items()}


def any_of(text: Column, patterns: list[str]) -> Column:
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.coalesce(text.rlike(p), F.lit(False))
    return hit


def hits(text: Column, patterns: list[str]) -> Column:
    """Matches of each pattern on its own, added up (overlaps between patterns count twice)."""
    n = F.lit(0)
    for p in patterns:
        n = n + F.coalesce(F.regexp_count(text, F.lit(p)), F.lit(0))
    return n


def tense(text: Column, rules: Rules) -> Column:
    found = {k: any_of(text, rules["tense"].get(k, [])).cast("int") for k in ("past", "present", "future")}
    n = found["past"] + found["present"] + found["future"]
    return F.when(n == 0, "present").when(n > 1, "mixed").when(found["past"] == 1, "past").when(found["present"] == 1, "present").otherwise("future")


def polarity(text: Column, rules: Rules) -> Column:
    neg, pos = (hits(text, rules["polarity"].get(k, [])) for k in ("negative", "positive"))
    return F.when((neg > 0) & (neg >= pos), "negative").when(pos > neg, "positive").otherwise("neutral")


def gender(text: Column, rules: Rules) -> Column:
    f, m = (hits(text, rules["gender"].get(k, [])) for k in ("feminine", "masculine"))
    return F.when(f > m, "feminine").when(m > f, "masculine").otherwise("neutral")


def sector(text: Column, hint: Column, rules: Rules) -> Column:
    """Conversational, then formal, then for news the topic with most hits (two at least,
    the earlier wins ties), else the hint."""
    topics = [k for k in rules["sector"] if k not in ("conversational", "formal")]
    n = {k: hits(text, rules["sector"][k]) for k in topics}
    most = F.greatest(*n.values(), F.lit(0)) if topics else F.lit(0)
    topic = F.coalesce(*(F.when(n[k] == most, F.lit(k)) for k in topics)) if topics else F.lit("news")
    return F.when(any_of(text, rules["sector"].get("conversational", [])), "conversational").when(any_of(text, rules["sector"].get("formal", [])), "formal").when((hint == "news") & (most >= 2), topic).otherwise(hint)


def annotate(rows: DataFrame, text: str, hint: str, rules: Rules) -> DataFrame:
    t, h = F.col(text), F.coalesce(F.col(hint), F.lit("news"))
    return rows.withColumns({"tense": tense(t, rules), "polarity": polarity(t, rules), "gender": gender(t, rules), "sector": sector(t, h, rules)})


def label_counts(rows: DataFrame, axes: list[str]) -> DataFrame:
    """axis, label, n; a null label is unknown."""
    pairs = F.array(*(F.struct(F.lit(a).alias("axis"), F.coalesce(F.col(a).cast("string"), F.lit("unknown")).alias("label")) for a in axes))
    return rows.select(F.explode(pairs).alias("x")).groupBy("x.axis", "x.label").agg(F.count(F.lit(1)).alias("n"))


def annotated(rows: DataFrame) -> bool:
    return {"tense", "polarity", "gender", "sector"} <= set(rows.columns)
