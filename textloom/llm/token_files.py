"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

The most frequent id gets rank 0, the next rank 1, and so on, so common tokens fit one byte.
A block's ranks are written as two streams: control bytes (two bits a value, four values a
byte: its length less one) and data bytes (little-endian).  Decoding looks each control byte
up in a table of four lengths and gathers the data bytes with numpy; no loop over values.

Block image (little-endian): magic ``TLV1``, uint32 rows, uint64 values, then per row
int64 doc_id, uint8 null flag, uint64 length; control bytes; data bytes.  A store is a
folder: ``ranks`` (rank -> id) and ``blocks`` (file, block, image), both Parquet written by
Spark's committer, so blocks work on any store that Spark reaches and a lost executor leaves
no torn file.  Files hold ascending ranges of doc_id, blocks ascend within a file.

A null doc_id sorts first; null and empty texts hold the end id alone; rows with equal
doc_id follow one another in any order, those without one by a hash of the text, so that they
may fill many files; a long text is never split between blocks.  An empty table gives a store
without blocks and an empty result.  Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import common, tokenizing

MAGIC = b"TLV1"
_FOUR = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
LENGTHS = (_FOUR + 1).astype(np.uint8)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    values = values.astype("<u4")
    code = (values > 0xFF).astype(np.uint8)
    for limit in (0xFFFF, 0xFFFFFF):
        if len(values) and values.max() > limit:
            code += values > limit
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = code
    control = padded[0::4] | padded[1::4] << 2 | padded[2::4] << 4 | padded[3::4] << 6
    end = np.cumsum(code, dtype=np.int64) + np.arange(1, len(code) + 1)
    data = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    at = end - 1 - code
    data[at] = values & 0xFF
    for k in range(1, int(code.max()) + 1 if len(code) else 1):
        more = np.flatnonzero(code >= k)
        data[at[more] + k] = values[more] >> np.uint32(8 * k) & 0xFF
    return control.tobytes(), data.tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    length = LENGTHS[control].ravel()[:n]
    end = np.cumsum(length, dtype=np.int64)
    at = end - length
    out = data[at].astype(np.uint32)
    for k in range(1, int(length.max()) if n else 0):
        more = np.flatnonzero(length > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _keys(ids: list[int | None]) -> tuple[bytes, bytes]:
    return np.array([0 if i is None else i for i in ids], "<i8").tobytes(), np.array([i is None for i in ids], np.uint8).tobytes()


def to_image(ids: list[int | None], lengths: np.ndarray, values: np.ndarray) -> bytes:
    control, data = encode_values(values)
    key, null = _keys(ids)
    return b"".join((MAGIC, np.uint32(len(ids)).tobytes(), np.uint64(len(values)).tobytes(), key, null, lengths.astype("<u8").tobytes(), control, data))


def from_image(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    if raw[:4] != MAGIC:
        raise ValueError("not a token block")
    rows, n = int(np.frombuffer(raw, "<u4", 1, 4)[0]), int(np.frombuffer(raw, "<u8", 1, 8)[0])
    at = 16
    key = np.frombuffer(raw, "<i8", rows, at)
    null = np.frombuffer(raw, np.uint8, rows, at := at + 8 * rows)
    lengths = np.frombuffer(raw, "<u8", rows, at := at + rows).astype(np.int64)
    control = np.frombuffer(raw, np.uint8, -(-n // 4), at := at + 8 * rows)
    values = decode_values(control, np.frombuffer(raw, np.uint8, offset=at + len(control)), n)
    return [None if z else int(k) for k, z in zip(key, null, strict=True)], lengths, values


_BLOCKS = "file long, block long, n_tokens long, image binary"


def _block(file: int, block: int, n: int, image: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([n], pa.int64()), pa.array([image], pa.binary())], ["file", "block", "n_tokens", "image"])


def tokenise(docs: DataFrame, vocabulary: str, end_id: int = 0, per_block: int = 500_000, bytes_per_file: int = 16_000_000) -> DataFrame:
    """Blocks of plain ids in ascending doc_id: ranges of doc_id are dealt out and sorted as
    texts, so ids are made once, in place, and never shuffled.  Each file has a block -1 besides,
    with how often each id comes in it."""
    common.ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    size, nameless = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(F.col("doc_id").isNull())).first()
    end = int(end_id).to_bytes(4, "little")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = tokenizing.encoder(vocabulary)
        file, block, held = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        raws: list[bytes] = []
        total = np.zeros(0, np.int64)

        def full() -> pa.RecordBatch:
            nonlocal total
            ids = np.frombuffer(b"".join(raws), "<u4")
            total = _added(total, np.bincount(ids))
            return _block(file, block, held, to_plain(keys, raws, ids))

        for part in parts:
            for at in range(0, part.num_rows, 64):
                some = part.slice(at, 64)
                for key, raw in zip(some.column(0).to_pylist(), coder.encode(some.column(1).to_pylist()), strict=True):
                    keys.append(key)
                    raws.append(raw + end)
                    held += len(raws[-1]) // 4
                    if held >= per_block:
                        yield full()
                        keys, raws, held, block = [], [], 0, block + 1
        if keys:
            yield full()
        if len(total):
            yield _block(file, -1, 0, total.astype("<i8").tobytes())

    order = ["doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0))] if nameless else ["doc_id"]
    return rows.repartitionByRange(common.parts_for(size, bytes_per_file), *order).sortWithinPartitions("doc_id").mapInArrow(run, _BLOCKS)


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sum of two arrays of counts; the shorter one ends in zeros."""
    if len(a) < len(b):
        a, b = b, a
    a = a.copy()
    a[: len(b)] += b
    return a


def to_plain(keys: list, raws: list[bytes], ids: np.ndarray) -> bytes:
    """A block image whose values are plain: two bytes each if all fit, else four."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    key, null = _keys(keys)
    return b"".join((b"W" if wide else b"S", np.uint32(len(keys)).tobytes(), key, null, np.array([len(r) // 4 for r in raws], "<u8").tobytes(), ids.astype("<u4" if wide else "<u2").tobytes()))


def from_plain(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    rows = int(np.frombuffer(raw, "<u4", 1, 1)[0])
    key, null = np.frombuffer(raw, "<i8", rows, 5), np.frombuffer(raw, np.uint8, rows, 5 + 8 * rows)
    lengths = np.frombuffer(raw, "<u8", rows, 5 + 9 * rows).astype(np.int64)
    return [None if z else int(k) for k, z in zip(key, null, strict=True)], lengths, np.frombuffer(raw, "<u4" if raw[:1] == b"W" else "<u2", offset=5 + 17 * rows)


def frequencies(blocks: DataFrame) -> np.ndarray:
    """Ids by falling count, ties by id; as many rows as the vocabulary has, never more."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in parts:
            for image in part.column(0):
                total = _added(total, np.frombuffer(image.as_py(), "<i8"))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    per = blocks.filter("block = -1").select("image").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = per.collect()
    ids, n = np.array([r["id"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)
    return ids[np.lexsort((ids, -n))]


def write(docs: DataFrame, path: str, vocabulary: str, per_block: int = 500_000) -> None:
    """Write the store.  Counts are taken from plain blocks, so texts are encoded once."""
    spark = docs.sparkSession
    plain = common.table(tokenise(docs, vocabulary, per_block=per_block), "token-ids")
    common.release(spark)
    ranked = frequencies(plain)
    spark.createDataFrame([(i, int(v)) for i, v in enumerate(ranked)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(ranked.max()) + 1 if len(ranked) else 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for file, block, image in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                keys, lengths, ids = from_plain(image.as_py())
                yield _block(file, block, len(ids), to_image(keys, lengths, rank_of[ids]))

    plain.filter("block >= 0").select("file", "block", "image").mapInArrow(run, _BLOCKS).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, most_broadcast: int = 200_000) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian uint32) of every row, from the files."""
    common.ship(spark)
    ids_of = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)  # one row an id of the vocabulary
    blocks = spark.read.schema("file long, block long, n_tokens long, image binary").parquet(f"{path}/blocks")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for before, image in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                docs, lengths, ranks = from_image(image.as_py())
                ids = ids_of[ranks].astype("<u4")
                end = np.cumsum(lengths)
                raw = [ids[a:b].tobytes() for a, b in zip(end - lengths, end, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(before + end - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    at = (F.col("file") * F.lit(1 << 20) + F.col("block")).alias("__at")
    index = common.table(blocks.select(at, F.col("n_tokens").alias("__n")), "token-index")
    before = common.before(index, [], "__at", ["__n"])
    few = index.count() <= most_broadcast  # 16 bytes a block
    rows = blocks.select(at, "image").join(F.broadcast(before) if few else before, "__at")
    return rows.select(F.col("__n0").cast("long"), "image").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
