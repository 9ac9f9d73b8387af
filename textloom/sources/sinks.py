"""Sinks: sharded JSON lines, index files, tables with checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators.tables import settled


def numbered(rows: DataFrame, order: list[str], name: str, prefix: str, digits: int = 8) -> DataFrame:
    """Gapless ids like pool_00000000 in a stated order.

    Rows are ranged by the order, and counts per range shift the ranks within: no global window.
    The ranges are a table: planned twice, adaptive execution could merge them differently each time.
    """
    rows = settled(rows.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "numbered")
    counts = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = counts.select("__p", before.alias("__b"))  # one row a partition
    at = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1
    got = rows.withColumn("__i", at).join(F.broadcast(shift), "__p")
    return got.withColumn(name, F.format_string(f"{prefix}%0{digits}d", F.col("__b") + F.col("__i"))).drop("__p", "__b", "__i")


def jsonl(rows: DataFrame, path: str, per_file: int = 50_000) -> None:
    rows.write.option("maxRecordsPerFile", per_file).mode("overwrite").json(path)


def csv(rows: DataFrame, path: str) -> None:
    rows.write.option("header", "true").mode("overwrite").csv(path)


def frequency_table(rows: DataFrame, path: str) -> None:
    rows.write.option("compression", "zstd").mode("overwrite").parquet(path)


def text_list(rows: DataFrame, col: str, path: str) -> None:
    """A sorted list, one value a line, in one file (vocabularies)."""
    rows.select(F.col(col).alias("value")).orderBy("value").coalesce(1).write.mode("overwrite").text(path)


def batch(rows: DataFrame, order: list[str], batch_id: str, path: str, per_file: int = 50_000) -> None:
    """JSON lines with gapless ids in ``order`` and the batch that they belong to."""
    jsonl(numbered(rows, order, "id", f"{batch_id}_").withColumn("batch_id", F.lit(batch_id)), path, per_file)


def index(rows: DataFrame, key: str, value: str, path: str) -> None:
    """``key value`` lines, written beside their place and then renamed: a reader sees all or the old ones."""
    spark = rows.sparkSession
    rows.select(F.concat_ws(" ", key, value).alias("value")).write.mode("overwrite").text(f"{path}.tmp")
    at, beside = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.tmp"))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(at, True)
    if not fs.rename(beside, at):
        raise OSError(f"could not rename to {path}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """file, length and SHA-256 of everything below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), "length", F.sha2("content", 256).alias("sha256"))
