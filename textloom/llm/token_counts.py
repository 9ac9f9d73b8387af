"""Token totals by source, language and tokenizer version, kept by signed deltas.

A commit turns a batch of changes into one signed row per (source, lang, tokenizer) and
writes it to a folder of its own under the store, named by the batch.  Totals are the sum of
all folders, so work is in proportion to the change, never to the corpus.  A batch that is
committed again changes nothing, and is an error if its delta is another one than before; a
batch that died half-way has no finished folder and is written anew.

``compact`` sums all folders into a new base, which also lists the batches it holds with a
digest of each, marks it as done, and only then takes the folders away: whoever dies on the
way leaves either the old state or the new one, and a listed batch is never added twice.
``commit`` compacts by itself every ``most_deltas`` folders, so a read lists few.  One writer
at a time; a reader that planned before a compaction may have to plan again.

Changes: ``insert`` adds 1 document and n_tokens; ``delete`` takes both away; ``revise``
adds n_tokens - old_tokens and no document.  Null keys form groups of their own; a null
text has 0 tokens; repeated rows count each; groups that come back to nothing (no documents,
no tokens) drop out of the totals; no commits give an empty result.  Columns of the input
other than source, lang and what a count reads are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import common, tokenizing

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"
BATCHES = "batch string, digest string"


def words(text: Column) -> Column:
    """``words``: runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def marked_words(text: Column) -> Column:
    """``words`` with each of # * $ % & | < > as a token besides."""
    return (words(text) + F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0))).cast("long")


def counted(docs: DataFrame, vocabulary: str, keep: list[str], out: str = "n_tokens") -> DataFrame:
    """``keep`` and the number of ids that the tokenizer in the file ``vocabulary`` gives each text."""
    common.ship(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizing.encoder(vocabulary)
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                n = [len(raw) // 4 for raw in coder.encode(some.column(len(keep)).to_pylist())]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(n, pa.int64())], [*keep, out])

    rows = docs.select(*keep, F.col("text").alias("__text"))
    return rows.mapInArrow(run, rows.drop("__text").schema.add(out, "long"))


def inserts(docs: DataFrame, tokenizer: str, count) -> DataFrame:
    return docs.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit("insert").alias("op"), count(F.col("text")).alias("n_tokens"), F.lit(None).cast("long").alias("old_tokens"))


def deletes(docs: DataFrame, tokenizer: str, count) -> DataFrame:
    return inserts(docs, tokenizer, count).withColumn("op", F.lit("delete"))


def revisions(docs: DataFrame, tokenizer: str, old, new) -> DataFrame:
    return docs.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit("revise").alias("op"), new(F.col("text")).alias("n_tokens"), old(F.col("text")).alias("old_tokens"))


class Rollup:
    """A store of committed deltas in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, most_deltas: int = 256):
        self.spark, self.path, self.most_deltas = spark, path.rstrip("/"), most_deltas
        jvm = spark.sparkContext._jvm
        self._fs = jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._at = jvm.org.apache.hadoop.fs.Path

    @staticmethod
    def _name(batch: str) -> str:
        return f"delta-{hashlib.sha256(batch.encode()).hexdigest()[:32]}"

    def _finished(self, start: str, mark: str) -> list[str]:
        """Names of the folders that begin with ``start`` and hold ``mark``, in order."""
        if not self._fs.exists(self._at(self.path)):
            return []
        names = sorted(f.getPath().getName() for f in self._fs.listStatus(self._at(self.path)))
        return [n for n in names if n.startswith(start) and self._fs.exists(self._at(f"{self.path}/{n}/{mark}"))]

    def _base(self) -> str | None:
        return (self._finished("base-", "_DONE") or [None])[-1]

    def _listed(self) -> DataFrame:
        """batch, digest of all batches in the base."""
        base = self._base()
        return self.spark.read.schema(BATCHES).parquet(f"{self.path}/{base}/batches") if base else self.spark.createDataFrame([], BATCHES)

    def _pending(self) -> list[str]:
        """Finished folders of batches that the base doesn't hold."""
        names = self._finished("delta-", "_SUCCESS")
        held = {r["batch"] for r in self._listed().filter(F.col("batch").isin(names)).collect()} if names else set()  # as many as folders
        return [n for n in names if n not in held]

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(*(f"{self.path}/{n}" for n in names)) if names else self.spark.createDataFrame([], SCHEMA)

    @staticmethod
    def _digest() -> Column:
        """Of the rows of a delta, in any order."""
        row = F.xxhash64(*(F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("")) for k in KEYS), "docs", "tokens")
        return F.concat_ws(":", F.count(F.lit(1)), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)))

    def committed(self, batch: str) -> str | None:
        """The digest of a committed batch."""
        if self._fs.exists(self._at(f"{self.path}/{self._name(batch)}/_SUCCESS")):
            return self._read([self._name(batch)]).agg(self._digest()).first()[0]
        found = self._listed().filter(F.col("batch") == self._name(batch)).first()
        return found["digest"] if found else None

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """False if the batch is in already; an error if it is in with another delta."""
        docs = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
        n, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
        tokens = F.when(F.col("op") == "insert", n).when(F.col("op") == "delete", -n).when(F.col("op") == "revise", n - old).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))))
        delta = changes.groupBy(*KEYS).agg(F.sum(docs).cast("long").alias("docs"), F.sum(tokens).cast("long").alias("tokens"))
        before = self.committed(batch)
        if before is not None:
            if delta.agg(self._digest()).first()[0] != before:
                raise ValueError(f"batch {batch!r} was committed with other changes")
            return False
        delta.write.mode("overwrite").parquet(f"{self.path}/{self._name(batch)}")
        if len(self._finished("delta-", "_SUCCESS")) > self.most_deltas:
            self.compact()
        return True

    def deltas(self) -> DataFrame:
        base = self._base()
        return self._read(([f"{base}/totals"] if base else []) + self._pending())

    def compact(self) -> None:
        """One base in place of all finished folders."""
        old, names = self._base(), self._pending()
        new = f"{self.path}/base-{int(old[5:]) + 1 if old else 0:08d}"
        self.deltas().groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(f"{new}/totals")
        folder = F.regexp_extract(F.input_file_name(), "(delta-[0-9a-f]+)/[^/]*$", 1)
        digests = self._read(names).withColumn("batch", folder).groupBy("batch").agg(self._digest().alias("digest"))
        added = self.spark.createDataFrame([(n,) for n in names], "batch string").join(digests, "batch", "left").fillna("0:0", ["digest"])  # no rows: an empty delta
        self._listed().unionByName(added.select("batch", "digest")).write.mode("overwrite").parquet(f"{new}/batches")
        self._fs.create(self._at(f"{new}/_DONE"), True).close()
        for gone in [*self._finished("delta-", "_SUCCESS"), *([old] if old else [])]:
            self._fs.delete(self._at(f"{self.path}/{gone}"), True)

    def totals(self) -> DataFrame:
        got = self.deltas().groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return got.filter("n_docs <> 0 or n_tokens <> 0")


def new_store(spark: SparkSession) -> Rollup:
    return Rollup(spark, common.new_table_path(spark, "token-rollup"))
