"""Helpers shared by the pipeline operators: shared tables, code shipping, ranks.

All state that outlives one job is a Parquet table below ``spark.checkpoint.dir``
(a folder every executor and the driver share), written through Spark's own
committer, so a lost executor costs a task retry and never a result.
"""

from __future__ import annotations

import gc
import io
import math
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Give the executors this package once per context, so that Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_textloom_shipped", False):
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, Path(_PACKAGE.name) / p.relative_to(_PACKAGE))
    at = Path(tempfile.mkdtemp(prefix="textloom-"), "textloom_code.zip")
    at.write_bytes(data.getvalue())
    sc.addPyFile(str(at))
    sc._textloom_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only in local mode (tests), where one machine has all."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not found and sc._jsc.sc().getCheckpointDir().isDefined():
        found = sc._jsc.sc().getCheckpointDir().get()
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="textloom-shared-")
        sc.setCheckpointDir(found)
    return found


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/textloom/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it again: lineage ends here."""
    path = new_table_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let the context drop shuffle files and broadcasts that no live plan refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def parts_for(size: int, each: int = 16_000_000, up_to: int = 64_000_000_000, power: float = 0.5) -> int:
    """Partitions for ``size`` bytes: of ``each`` bytes up to ``up_to``, beyond that larger ones,
    so that their number grows as ``size ** (1 - power)`` (100 TB: 158,000 of 632 MB at 0.5)."""
    return max(1, math.ceil(size / (each * max(1.0, size / up_to) ** power)))


def slots_for(rows: int, rows_per_bucket: int = 1_000) -> int:
    """Buckets that hold about ``rows_per_bucket`` rows each; grows with the data."""
    return max(16, -(-rows // rows_per_bucket))


def bucket_of(key: Column, buckets: int | Column) -> Column:
    """Order-preserving bucket of a uniformly spread signed 64-bit key."""
    buckets = F.lit(buckets) if isinstance(buckets, int) else buckets
    unit = (key.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.least(F.floor(unit * buckets), buckets - 1).cast("long")


def slots_of(size: Column, rows_per_bucket: int = 500) -> Column:
    """Buckets for a group of ``size`` rows, so that large and small groups fill them alike."""
    return F.ceil(size / F.lit(rows_per_bucket)).cast("long")


def attach(rows: DataFrame, small: DataFrame, key: str, most: int = 50_000) -> DataFrame:
    """Join per-group values: broadcast up to ``most`` groups (a few MB), else by shuffle."""
    return rows.join(F.broadcast(small) if small.count() <= most else small, key)


def before(per: DataFrame, group: list[str], bucket: str, sums: list[str]) -> DataFrame:
    """Each bucket's sums over the buckets before it, by way of runs of 512 buckets."""
    keys = [*group, "__run"]
    per = per.withColumn("__run", F.floor(F.col(bucket) / 512))
    runs = per.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))
    over_runs = Window.partitionBy(*group).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*keys, *(F.coalesce(F.sum(c).over(over_runs), F.lit(0)).alias(f"{c}r") for c in sums))
    inside = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, bucket, *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}i") for c in sums))
    return per.join(runs, keys).select(*group, bucket, *((F.col(f"{c}r") + F.col(f"{c}i")).alias(f"{c}0") for c in sums))


def ranked(df: DataFrame, group: list[str], bucket: str, order: list[str | Column], out: str, carry: str | None = None) -> DataFrame:
    """0-based rank ``out`` (and ``out_carry``, the sum of ``carry`` before the row) in each group.

    ``bucket`` must rise with ``order`` and hold boundedly many rows per group and value, so
    no window sees a whole group: one runs inside (group, bucket), the others over counts per
    bucket, which are summed map-side.  Columns of ``group`` and ``bucket`` hold no nulls.
    """
    keys = [*group, bucket]
    sums = {"__n": F.count(F.lit(1))} | ({"__c": F.sum(carry)} if carry else {})
    per = before(df.groupBy(*keys).agg(*(v.alias(k) for k, v in sums.items())), group, bucket, list(sums))
    inner = Window.partitionBy(*keys).orderBy(*order)
    got = df.withColumn("__r", F.row_number().over(inner) - 1)
    if carry:
        got = got.withColumn("__s", F.sum(carry).over(inner.rowsBetween(Window.unboundedPreceding, -1)))
    got = got.join(per, keys).withColumn(out, (F.col("__n0") + F.col("__r")).cast("long"))
    if carry:
        got = got.withColumn(f"{out}_{carry}", (F.col("__c0") + F.coalesce(F.col("__s"), F.lit(0))).cast("long"))
    return got.drop("__r", "__n0", *(["__s", "__c0"] if carry else []))


def utf8(text: str = "text") -> Column:
    return F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")

