"""Exact deduplication against immutable snapshots screened by static binary-fuse filters.

A snapshot is a table of digest buckets.  Bucket ``b`` holds the sorted distinct digests
whose hash falls into it and, beside them, one 3-wise binary-fuse filter of 8-bit
fingerprints (about 9 bits a digest) that is built once and never changes.  A new batch is
first grouped by digest among itself; what the filter lets through is joined with the exact
bucket and then compared byte by byte with the stored text.  Most rows of a batch are new
and never touch the exact digests.  Where digests agree and bytes don't, both groups stay
apart, each known by its digest and its side.

Digest: SHA-256 of the UTF-8 text; within one side equal digests are equal texts.  Null texts
count as empty.  Rows with a null doc_id
take part; they lose to any row with one.  Of equal texts the row with the largest doc_id
stays, and of repeated rows (same doc_id, same text) all carry the same verdict
(``unique_rows`` keeps one of them).  An empty table gives an empty result.  Further
columns of the input are ignored by ``resolve`` and kept by ``unique_rows``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import common
from textloom.llm.textkit import mix

ARITY = 3


class FuseFilter:
    """A static 3-wise binary-fuse filter over distinct 64-bit keys; 8-bit fingerprints."""

    def __init__(self, seed: int, segment: int, segments: int, prints: np.ndarray):
        self.seed, self.segment, self.segments, self.prints = seed, segment, segments, prints

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
        window = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
        inner = mix(h ^ np.uint64(0xC2B2AE3D27D4EB4F))
        at = np.empty((ARITY, len(keys)), np.int64)
        for i in range(ARITY):
            at[i] = (window + i) * segment + ((inner >> np.uint64(20 * i)) & np.uint64(segment - 1)).astype(np.int64)
        return at, (h & np.uint64(255)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Peel in rounds: each round removes every key that is alone in some slot."""
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
        slots = max(ARITY * segment, int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))) + 32)
        segments = max(1, -(-slots // segment) - (ARITY - 1))
        for seed in range(1, 200):
            if seed % 10 == 0:
                segments += max(1, segments // 16)
            at, marks = cls._places(keys, seed, segment, segments)
            size = (segments + ARITY - 1) * segment
            count = np.bincount(at.ravel(), minlength=size)
            ids = np.zeros(size, np.int64)
            for i in range(ARITY):
                np.bitwise_xor.at(ids, at[i], np.arange(n))
            alive, layers = np.ones(n, bool), []
            while True:
                single = np.flatnonzero(count == 1)
                if not len(single):
                    break
                who, which = np.unique(ids[single], return_index=True)
                slot = single[which]
                alive[who] = False
                layers.append((who, slot))
                for i in range(ARITY):
                    np.subtract.at(count, at[i][who], 1)
                    np.bitwise_xor.at(ids, at[i][who], who)
            if not alive.any():
                prints = np.zeros(size, np.uint8)
                for who, slot in reversed(layers):
                    # slots of one layer are met by one living key each, so a layer is set at once
                    others = prints[at[0][who]] ^ prints[at[1][who]] ^ prints[at[2][who]] ^ prints[slot]
                    prints[slot] = others ^ marks[who]
                return cls(seed, segment, segments, prints)
        raise RuntimeError(f"no binary-fuse filter found for {n} keys")

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], np.uint64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        at, marks = self._places(keys.astype(np.uint64), self.seed, self.segment, self.segments)
        return (self.prints[at[0]] ^ self.prints[at[1]] ^ self.prints[at[2]]) == marks

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment, self.segments], np.int64).tobytes() + self.prints.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> FuseFilter:
        seed, segment, segments = np.frombuffer(raw, np.int64, 3)
        return cls(int(seed), int(segment), int(segments), np.frombuffer(raw, np.uint8, offset=24))


def digest(raw: Column) -> Column:
    return F.sha2(raw, 256)


def digested(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the whole text, and its first 60 bits as the filters' key."""
    return docs.select("doc_id", digest(common.utf8()).alias("text_sha256")).withColumn("fkey", F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long"))


def grouped(rows: DataFrame) -> DataFrame:
    """One row per distinct digest of a batch; partial sums leave each task before the shuffle."""
    return rows.groupBy("text_sha256", "fkey").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def with_bucket(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("fkey"), F.lit(buckets)).cast("int"))


class Snapshot:
    """An immutable set of digests: ``exact`` (digest, keep_id, group_size, bucket), ``filters`` (bucket, fuse)."""

    def __init__(self, exact: DataFrame, filters: DataFrame, buckets: int):
        self.exact, self.filters, self.buckets = exact, filters, buckets

    @classmethod
    def write(cls, groups: DataFrame, keys_per_bucket: int = 100_000) -> Snapshot:
        """Publish distinct groups as a snapshot.  Buckets grow in number, not in size."""
        groups = common.table(groups, "exact-groups")
        buckets = max(1, -(-groups.count() // keys_per_bucket))
        exact = common.table(with_bucket(groups, buckets), "exact-buckets")

        def fuse(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"bucket": pdf.bucket[:1], "fuse": [FuseFilter.build(pdf.fkey.to_numpy()).to_bytes()]})

        filters = exact.select("bucket", "fkey").groupBy("bucket").applyInPandas(fuse, "bucket int, fuse binary")
        return cls(exact, common.table(filters, "fuse-filters"), buckets)

    def screen(self, groups: DataFrame) -> DataFrame:
        """Adds ``maybe``: false means that the snapshot surely lacks the digest."""
        schema = "text_sha256 string, fkey long, keep_id long, group_size long, bucket int, maybe boolean"

        def test(left: pa.Table, right: pa.Table) -> pa.Table:
            keys = left["fkey"].to_numpy()
            hit = FuseFilter.from_bytes(right["fuse"][0].as_py()).has(keys) if right.num_rows else np.zeros(len(keys), bool)
            return left.append_column("maybe", pa.array(hit, pa.bool_()))

        rows = with_bucket(groups, self.buckets).select("text_sha256", "fkey", "keep_id", "group_size", "bucket")
        return rows.groupBy("bucket").cogroup(self.filters.groupBy("bucket")).applyInArrow(test, schema)


def _texts_of(docs: DataFrame, groups: DataFrame, out: str) -> DataFrame:
    """The stored text of each group, read back through the row that stands for it."""
    raw = docs.select(F.col("doc_id").alias("keep_id"), common.utf8().alias(out)).withColumn("text_sha256", digest(F.col(out)))
    return groups.select("text_sha256", "keep_id").join(raw, (raw.keep_id.eqNullSafe(groups.keep_id)) & (raw.text_sha256 == groups.text_sha256), "left").select(groups.text_sha256, out).dropDuplicates(["text_sha256"])


def merge_batch(snapshot: Snapshot, stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Groups of snapshot and batch together: text_sha256, keep_id, group_size, in_stored, in_batch.

    ``stored`` and ``batch`` are the documents behind either side; they serve the byte check.
    """
    groups = common.table(grouped(digested(batch)), "batch-groups")
    screened = common.table(snapshot.screen(groups), "batch-screened")
    old = snapshot.exact.select(F.col("text_sha256"), F.col("keep_id").alias("old_id"), F.col("group_size").alias("old_size"))
    hits = screened.filter("maybe").join(old, "text_sha256").select("text_sha256", "keep_id", "group_size", "old_id", "old_size")
    hits = common.table(hits, "batch-hits")
    mine = _texts_of(batch, hits, "new_bytes")
    theirs = _texts_of(stored, hits.select("text_sha256", F.col("old_id").alias("keep_id")), "old_bytes")
    sure = hits.join(mine, "text_sha256").join(theirs, "text_sha256")
    same = sure.filter(F.col("new_bytes") == F.col("old_bytes")).select("text_sha256", F.greatest("keep_id", "old_id").alias("keep_id"), (F.col("group_size") + F.col("old_size")).alias("group_size"))
    same = common.table(same, "batch-same")
    sides = lambda rows, in_stored, in_batch: rows.withColumns({"in_stored": F.lit(in_stored), "in_batch": F.lit(in_batch)})
    fresh = screened.select("text_sha256", "keep_id", "group_size").join(same.select("text_sha256"), "text_sha256", "left_anti")
    rest = snapshot.exact.select("text_sha256", "keep_id", "group_size").join(same.select("text_sha256"), "text_sha256", "left_anti")
    return common.table(sides(same, True, True).unionByName(sides(fresh, False, True)).unionByName(sides(rest, True, False)), "exact-merged")


def _is_stored() -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(2)) == 0


def halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A standing snapshot and an incoming batch out of one table, by a hash of doc_id."""
    return docs.filter(_is_stored()), docs.filter(~_is_stored())


def resolve(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    spark: SparkSession = docs.sparkSession
    common.ship(spark)
    docs = docs.select("doc_id", "text")
    stored, batch = halves(docs)
    snapshot = Snapshot.write(grouped(digested(stored)))
    merged = merge_batch(snapshot, stored, batch)
    rows = digested(docs).select("doc_id", "text_sha256", _is_stored().alias("__stored"))
    own = F.when(F.col("__stored"), F.col("in_stored")).otherwise(F.col("in_batch"))
    got = rows.join(merged, (rows["text_sha256"] == merged["text_sha256"]) & own).drop(merged["text_sha256"])
    return got.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def unique_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one of repeated rows."""
    cols = docs.columns
    keep = resolve(docs).filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    rows = docs.withColumn("__sha", F.sha2(common.utf8(), 256))
    hit = rows.join(keep, (rows["__sha"] == keep["__sha"]) & rows["doc_id"].eqNullSafe(keep["__id"]), "left_semi")
    return hit.dropDuplicates(["doc_id", "__sha"]).select(*cols)
