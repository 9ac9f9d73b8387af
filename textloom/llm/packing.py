"""Best-fit packing into sequences by large-item matching.

The plan needs lengths only, and there are at most ``capacity`` of those: it is made once,
on the counts per length, and so is the same for any number of rows, workers or partitions.

1. Pieces above a third of the capacity go two to a bin at most.  From the longest down,
   each is paired with the longest other large piece that still fits; one that has no
   partner opens a bin alone.
2. Smaller pieces, from the longest down, fill the smallest gap that holds them, again and
   again in the same bin while they fit; what no gap holds opens new bins.

Bins with equal contents are planned as one pattern with a multiplicity.  Pieces then learn
their rank among the pieces of their length (a distributed rank, no window over a whole
length) and look their place up in the plan.

Null and empty texts are one piece of the end id alone.  Texts longer than the capacity are
cut at multiples of it; no other piece is cut.  Repeated rows are packed each.  Rows with a
null doc_id are packed like others.  An empty table gives no pieces.  Columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import common, tokenizing

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Tokenise whole texts and cut the long ones; ``ids`` (little-endian uint32) on demand."""
    common.ship(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizing.encoder(vocabulary)
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                rows: list[list] = [[] for _ in range(6)]
                for doc, raw in zip(some.column(0).to_pylist(), coder.encode(some.column(1).to_pylist()), strict=True):
                    raw += end
                    for k, lo in enumerate(range(0, len(raw), 4 * capacity)):
                        cut = raw[lo : lo + 4 * capacity]
                        for column, value in zip(rows, (doc, k, lo // 4, len(cut) // 4, zlib.crc32(cut), cut if with_ids else None), strict=True):
                            column.append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


class Plan:
    """Patterns of bins for counts per length, and where the r-th piece of a length goes."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.bins = capacity, 0
        self._gaps: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
        self._sizes: list[int] = []
        self._slots: dict[int, list[tuple[int, int, int]]] = {}
        self._used: dict[int, int] = {}
        left = {k: v for k, v in counts.items() if v > 0}
        self._match_large(left)
        for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
            self._fill(length, left[length])
        for found in list(self._gaps.values()):
            for content, many in found:
                self._close(content, many)
        self._freeze()

    def _open(self, gap: int, content: list[tuple[int, int]], many: int) -> None:
        if not gap:
            return self._close(content, many)
        if not self._gaps.get(gap):
            insort(self._sizes, gap)
            self._gaps[gap] = []
        self._gaps[gap].append((content, many))

    def _close(self, content: list[tuple[int, int]], many: int) -> None:
        """Give numbers to ``many`` bins; ``content`` lists (length, how many of it) in order."""
        base, offset = self.bins, 0
        self.bins += many
        for length, times in content:
            for _ in range(times):
                rank = self._used.get(length, 0)
                self._slots.setdefault(length, []).append((rank, base, offset))
                self._used[length] = rank + many
                offset += length

    def _match_large(self, left: dict[int, int]) -> None:
        large = sorted(k for k in left if 3 * k > self.capacity)
        while large:
            longest = large[-1]
            k = bisect_left(large, self.capacity - longest + 1) - 1
            if k >= 0 and large[k] == longest and left[longest] == 1:
                k -= 1
            if k < 0:
                many = left[longest]
                self._open(self.capacity - longest, [(longest, 1)], many)
                left[longest] = 0
            elif large[k] == longest:
                many = left[longest] // 2
                self._open(self.capacity - 2 * longest, [(longest, 2)], many)
                left[longest] -= 2 * many
            else:
                other = large[k]
                many = min(left[longest], left[other])
                self._open(self.capacity - longest - other, [(longest, 1), (other, 1)], many)
                left[longest] -= many
                left[other] -= many
                if not left[other]:
                    large.remove(other)
            if not left[longest]:
                large.pop()

    def _fill(self, length: int, count: int) -> None:
        while count:
            k = bisect_left(self._sizes, length)
            if k == len(self._sizes):
                per = self.capacity // length
                whole, rest = divmod(count, per)
                if whole:
                    self._open(self.capacity - per * length, [(length, per)], whole)
                if rest:
                    self._open(self.capacity - rest * length, [(length, rest)], 1)
                return
            gap = self._sizes[k]
            content, many = self._gaps[gap].pop()
            if not self._gaps[gap]:
                del self._sizes[k]
            per = gap // length
            whole = min(many, count // per)
            if whole:
                self._open(gap - per * length, [*content, (length, per)], whole)
                count -= whole * per
            if many > whole:
                if count and count < per:
                    self._open(gap - count * length, [*content, (length, count)], 1)
                    count, whole = 0, whole + 1
                if many > whole:
                    self._open(gap, content, many - whole)

    def _freeze(self) -> None:
        flat = sorted((length, rank, base, offset) for length, found in self._slots.items() for rank, base, offset in found)
        at = np.array(flat, np.int64).reshape(-1, 4)
        self._key, self._rank, self._base, self._offset = (at[:, 0] << 46) | at[:, 1], at[:, 1], at[:, 2], at[:, 3]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self._key, (length.astype(np.int64) << 46) | rank, "right") - 1
        return self._base[k] + rank - self._rank[k], self._offset[k]


def place(cut: DataFrame, capacity: int = 2048, more: list[str] | None = None) -> DataFrame:
    """Adds sequence_id and offset to pieces (``cut`` is read three times: pass a table)."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    plan = Plan(counts, capacity)
    buckets = common.slots_for(sum(counts.values()))
    rows = cut.withColumn("__h", F.xxhash64("doc_id", "piece", "ids_crc32")).withColumn("__b", common.bucket_of(F.col("__h"), buckets))
    rows = common.ranked(rows, ["length"], "__b", ["__h", "doc_id", "piece"], "__rank").drop("__h", "__b")
    names = [c for c in rows.columns if c != "__rank"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            seq, offset = plan.place(part.column("length").to_numpy(zero_copy_only=False), part.column("__rank").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(seq), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema.fields)
    return rows.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset for every piece."""
    cut = pieces(docs, vocabulary, capacity, with_ids=with_ids)
    cut = common.table(cut if with_ids else cut.drop("ids"), "pack-pieces")
    return place(cut, capacity)
