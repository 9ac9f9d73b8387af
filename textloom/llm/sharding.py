"""Proportional stratified interleaving into shards.

Rows of each source are shuffled by a seeded hash and ranked; a row's fractional rank
(2 * rank + 1) / (2 * rows of the source) places it on [0, 1); all rows are sorted by it and
the line is cut into equal runs, so every shard holds the corpus mixture, in order.

Law ``rows``: shard sizes in rows differ by one at most.  A null source is a source of its
own; a null or empty text has size 1; equal doc_ids and repeated rows are ranked by their
text checksum, then arbitrarily but each once.  An empty table gives no rows.  Only
doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import common


def _source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def interleave(rows: DataFrame, n_rows: int, seed: int = 7, id_col: str = "doc_id", source: str = "source", tie: str = "text_crc32") -> DataFrame:
    """Adds ``position``: the 0-based place of each row in the interleaved order."""
    rows = rows.withColumn("__g", _source_key(source)).withColumn("__h", F.xxhash64(F.lit(seed), F.col(id_col), F.col(tie)))
    sizes = common.table(rows.groupBy("__g").agg(F.count(F.lit(1)).alias("__size")), "shard-sources")
    rows = common.attach(rows, sizes, "__g").withColumn("__b", common.bucket_of(F.col("__h"), common.slots_of(F.col("__size"))))
    one = common.ranked(rows, ["__g"], "__b", ["__h", id_col, tie], "__rank")
    buckets = common.slots_for(n_rows)
    one = common.table(one.withColumn("__f", (2 * F.col("__rank") + 1) / (2 * F.col("__size"))).drop("__b", "__size", "__rank"), "shard-ranks")
    two = one.withColumn("__b", F.least(F.floor(F.col("__f") * buckets), F.lit(buckets - 1)).cast("long"))
    return common.ranked(two, [], "__b", ["__f", "__h", id_col, tie], "position").drop("__g", "__h", "__b", "__f")


def shard(docs: DataFrame, shards: int = 8, seed: int = 7) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard for every row."""
    raw = common.utf8()
    rows = docs.select("doc_id", "source", (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = common.table(rows, "shard-rows")
    n = rows.count()
    placed = interleave(rows, n, seed)
    # shard s takes positions ceil(s * n / shards) .. ceil((s + 1) * n / shards) - 1
    at = F.floor(F.col("position") * F.lit(shards) / F.lit(max(n, 1))).cast("long")
    first = lambda s: F.ceil(s * F.lit(n) / F.lit(shards)).cast("long")
    at = F.when(F.col("position") < first(at), at - 1).when(F.col("position") >= first(at + 1), at + 1).otherwise(at)
    placed = placed.withColumn("shard", at.cast("int"))
    return placed.select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("position") - first(F.col("shard").cast("long"))).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
