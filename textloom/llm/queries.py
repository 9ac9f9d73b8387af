"""The operators' queries over the driver's tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import classifier, common, exact_dedup, mixing, neardup, packing, quality_rules, sharding, suffix_dedup, token_counts, token_files, tokenizing
from textloom.llm.common import documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Almost even sources; the exponent is below 1 wherever sources aren't all but even already."""
    return mixing.mix(documents(spark, sf_dir), mixing.Target(entropy=0.9999, budget=1.0))


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.resolve(documents(spark, sf_dir), neardup.Settings(words=2)).drop("cls")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load under two tokenizer versions, the load again, a revision of counts (an end id more
    each), a compaction, the load once more, and the documents below 50 words deleted."""
    docs, t = documents(spark, sf_dir).withColumn("n_words", token_counts.words(F.col("text"))), token_counts
    store = t.new_store(spark)
    n, ended = (lambda _: F.col("n_tokens")), (lambda _: F.col("n_tokens") + 1)
    for name in ("word_bpe_49k", "byte_bpe_50k"):
        rows = common.table(t.counted(docs, tokenizing.public(f"{name}.json"), ["source", "lang", "n_words"]), "token-counts")
        store.commit(f"load {name}", t.inserts(rows, name, n))
        store.commit(f"load {name}", t.inserts(rows, name, n))
        store.commit(f"end ids {name}", t.revisions(rows, name, n, ended))
        store.compact()
        store.commit(f"load {name}", t.inserts(rows, name, n))
        store.commit(f"short ones go {name}", t.deletes(rows.filter("n_words < 50"), name, ended))
    return store.totals()


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.annotate(documents(spark, sf_dir), columns=["doc_id"])


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizing.public("word_bpe_49k.json"))


def op6_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return classifier.score(docs, classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.resolve(documents(spark, sf_dir))


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_table_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir), path, tokenizing.public("byte_bpe_50k.json"))
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing, "op2_neardup": op2_neardup, "op3_token_counts": op3_token_counts, "op4_quality_rules": op4_quality_rules, "op5_packing": op5_packing,
    "op6_classifier": op6_classifier, "op7_sharding": op7_sharding, "op8_exact_dedup": op8_exact_dedup, "op9_token_files": op9_token_files, "op10_suffix_dedup": op10_suffix_dedup,
}
ORACLE_SQL: dict[str, str] = {"op8_exact_dedup": OP8_SQL}
