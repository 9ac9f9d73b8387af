"""Cumulative token counts over arriving files, as a stream of idempotent batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import stats
from textloom.profile import Profile


def counts(rows: DataFrame, profile: Profile) -> DataFrame:
    tokens = T.content_of(F.col("text"), profile)
    return stats.token_frequency(rows.select(tokens.alias("tokens")), [])


def follow(spark: SparkSession, source: str, schema: str, state: str, checkpoint: str, profile: Profile):
    """Read new Parquet files, add each batch's counts to the state folder, once a batch id."""

    def commit(batch: DataFrame, batch_id: int) -> None:
        counts(batch, profile).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.parquet(state).groupBy("token").agg(F.sum("n").alias("n"))
