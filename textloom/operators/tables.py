"""Intermediate tables: lineage ends, and what is used several times is computed once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; one of our own only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not found and sc._jsc.sc().getCheckpointDir().isDefined():
        found = sc._jsc.sc().getCheckpointDir().get()
    if not found:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="textloom-tables-")
        sc.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/textloom/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def settled(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to a table and read again; Spark's committer covers lost executors."""
    path = new_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
