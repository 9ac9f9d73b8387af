"""Cleaning and tokenising as Arrow functions: once a text, and what the column builders of the JVM give."""

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import analysis
from textloom.plans import catalogue
from textloom.profile import DEVA, LATIN

ODD = ["", None, " ", "A<b>c", "x < y", "<<a>b", "été. Über?! 12 straße.. ", "नेपाल। क ख! <p>ग</p>", "a b c\td", "İstanbul K", ">a<b"]


def test_texts_are_not_matched_in_the_jvm(spark, tmp_path):
    spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    for q in (catalogue.record_metrics, catalogue.raw_sentences, catalogue.sentence_pool, catalogue.sentence_lengths, catalogue.priority_union, catalogue.source_memberships):
        plan = q(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_replace" not in plan and "split(" not in plan, (q.__name__, plan)


def test_one_pass_equals_the_steps(spark):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "i int, t string")
    for p in (DEVA, LATIN):
        low = F.lower("t") if p is LATIN else F.col("t")
        jvm = F.trim(F.regexp_replace(F.regexp_replace(low, "<[^>]+>", " "), f"[^{p.letters}]+", " "))
        every = F.regexp_extract_all(jvm, F.lit(p.pattern), F.lit(0))
        got = rows.select("i", T.clean(F.col("t"), p).alias("a"), jvm.alias("b"), T.content_of(F.col("t"), p).alias("c"), T.content(every, p).alias("d"), T.lettered_of(jvm, p)["tokens"].alias("e"), T.lettered(every, p).alias("f"))
        for r in got.collect():
            assert (r["a"], r["c"], r["e"]) == (r["b"], r["d"], r["f"]), r


def test_repeats_are_found_by_narrow_rows(spark):
    rec = analysis.records(spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "X"), ("b", ""), ("b", None), ("b", "y")], "c string, t string"), LATIN, "c", "t")
    kept = analysis._kept(rec)
    assert sorted((r["corpus"], r["kept"]) for r in kept.filter("status = 'usable'").collect()).count(("b", True)) == 1 and kept.filter("kept").count() == 2
    assert "first(tokens" not in analysis.frequencies(rec)._jdf.queryExecution().optimizedPlan().toString()
