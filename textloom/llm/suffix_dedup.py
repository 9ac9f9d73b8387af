"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes if some 100-byte string over it also starts earlier: in a row with a smaller
doc_id, or earlier in its own text.  Matches never cross texts.

1. Anchors.  Of the 69 32-byte strings within each 100-byte window, the one with the least
   hash is the window's anchor, so equal windows have equal anchors at the same distance.
   Consecutive windows share anchors; about 3 % of positions are one.  Anchors that occur
   once in the corpus end here, and with them nearly all of the text.
2. Contexts.  An anchor that occurs again stands for a context: the bytes of all its windows.
   Of rows with equal contexts (by digest) all but the earliest repeat it in every window.
   Bytes are read for anchors with several different contexts alone.
3. Suffix buckets.  The earliest rows of different contexts with one anchor form a bucket;
   tasks gather buckets into blocks of bounded size and sort each block's window suffixes,
   one bucket of leading bytes at a time.  The first 32 bytes decide; longer ties are settled
   by ranks, computed once for the block, of the suffixes at positions i with i mod 31 in the
   difference cover {0, 1, 3, 8, 12, 18}: for any two suffixes some shift below 31 takes both
   to such positions.  Neighbours with 100 bytes in common repeat; the earliest stays.
4. A bucket of more than ``most`` different contexts (the edge of a passage that very many
   texts share) is not sorted in one task.  Its contexts are cut by the distance of a window
   from its anchor, into parts 35, 7 and at last 1 windows wide; a part's new bucket is named
   by a 128-bit digest of the bytes that all its windows hold.  Of equal parts the earliest
   stays, by partial minima before the shuffle; new buckets of bounded size are sorted as in
   step 3, the others cut again.  At width 1 a part is one window and no bucket is left open.

Null doc_ids count as smaller than all others; null and empty texts, and texts below 100
bytes, lose nothing.  Rows with one doc_id are ordered by a hash of their text; repeated rows
(same doc_id, same text) are one document and get the same answer each.  Rows without a doc_id
are dealt out by the hash of their text.  Long texts are taken whole.  An empty table gives an
empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import common, textkit

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1
PERIOD = 31
COVER = np.array([0, 1, 3, 8, 12, 18])
WIDTHS = (35, 7, 1)
NO_ID = -(2**63)
SLICE = 2_000_000
HOT = 1_000_000
"""Most repeated anchors that a task remembers from one slice to the next."""
_MASK = np.uint64((1 << 24) - 1)


def _shifts() -> tuple[np.ndarray, np.ndarray]:
    """For residues (a, b): the least shift that takes both into the cover; and for (a, a)."""
    inside = np.zeros(PERIOD, bool)
    inside[COVER] = True
    both = np.full((PERIOD, PERIOD), -1)
    for a in range(PERIOD):
        for b in range(PERIOD):
            both[a, b] = next(d for d in range(PERIOD) if inside[(a + d) % PERIOD] and inside[(b + d) % PERIOD])
    return both, both.diagonal().copy()


SHIFT, OWN_SHIFT = _shifts()


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor position, first window, last window, hash) of each anchor of a batch of texts."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    if n > 1 << 23:  # positions are packed in 24 bits: long batches go by overlapping parts
        found = []
        for at in range(0, n - LENGTH + 1, 1 << 22):
            end = min(n, at + (1 << 22) + LENGTH - 1)
            cut = np.unique(np.clip(offsets, at, end)) - at
            p, lo, hi, h = anchors(data[at:end], cut)
            found.append((p + at, lo + at, hi + at, h))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))
    prefix = textkit.prefix_hash(data)
    _, inverse = textkit.powers(n)
    g = textkit.mix((prefix[GRAM:] - prefix[:-GRAM]) * inverse[: n - GRAM + 1])
    least = (g & ~_MASK) | np.arange(len(g), dtype=np.uint64)
    size = 1
    while 2 * size <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - size)], least[SPAN - size :])
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.maximum(offsets[:-1], offsets[1:] - LENGTH + 1), 1)
    np.add.at(edge, offsets[1:], -1)
    window = np.flatnonzero(np.cumsum(edge[: len(least)]) == 0)
    if not len(window):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    at = (least[window] & _MASK).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1))))
    last = np.concatenate((new[1:], [len(window)])) - 1
    return at[new], window[new], window[last], g[at[new]]


# -- one block: suffix order of window starts -------------------------------------------


def _words(text: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """The first 8 * n bytes at each position as big-endian numbers; bytes past the end are 0."""
    view = np.lib.stride_tricks.sliding_window_view(text, 8)
    return [view[at + 8 * k].copy().view(">u8").ravel().astype(np.uint64) for k in range(n)]


def _dense(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def cover_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Rank of the suffix at each cover position by its first ``depth`` bytes at least; -1 elsewhere.

    ``text`` ends in at least 2 * depth zero bytes.  Adding the period stays within the
    cover, so ranks of one length give those of twice the length.
    """
    size = len(text) - 40
    at = (np.arange(0, size, PERIOD)[:, None] + COVER).ravel()
    at = at[at < size]
    words = _words(text, at, 4)
    words[3] &= ~np.uint64(0xFF)  # 31 bytes
    rank = _dense(np.lexsort(words[::-1]), words)
    full = np.full(len(text) + 2 * depth, -1, np.int64)
    full[at] = rank
    have = PERIOD
    while have < depth:
        pair = [rank, full[at + have]]
        rank = _dense(np.lexsort(pair[::-1]), pair)
        full[at] = rank
        have *= 2
    return full


def suffix_order(text: np.ndarray, starts: np.ndarray, depth: int = LENGTH, bucket: int = 200_000) -> Iterator[np.ndarray]:
    """The starts in suffix order (to ``depth`` bytes at least), one bucket of leading bytes at a time."""
    padded = np.concatenate((text, np.zeros(2 * depth + 64, np.uint8)))
    rank = cover_ranks(padded, depth)
    lead = padded[starts].astype(np.int64) << 8 | padded[starts + 1]
    size = np.bincount(lead, minlength=65536)
    group = np.cumsum(size) // max(1, bucket)
    group_of = group[lead]
    by_group = np.argsort(group_of, kind="stable")
    for mine in np.split(by_group, np.flatnonzero(np.diff(group_of[by_group])) + 1) if len(starts) else []:
        at = starts[mine]
        words = _words(padded, at, 4)
        residue = at % PERIOD
        tie = rank[at + OWN_SHIFT[residue]]
        order = np.lexsort((tie, residue, *words[::-1]))
        # same first 32 bytes but several residues: the shared shift decides, pair by pair
        s = [w[order] for w in words]
        new = np.concatenate(([True], np.logical_or.reduce([x[1:] != x[:-1] for x in s])))
        group_at = np.flatnonzero(new)
        r = residue[order]
        mixed = np.add.reduceat(np.concatenate(([False], (r[1:] != r[:-1]) & ~new[1:])).astype(np.int64), group_at) > 0
        ends = np.concatenate((group_at[1:], [len(order)]))
        for lo, hi in zip(group_at[mixed], ends[mixed], strict=True):

            def compare(i: int, j: int) -> int:
                d = SHIFT[residue[i], residue[j]]
                return int(rank[at[i] + d] - rank[at[j] + d])

            order[lo:hi] = sorted(order[lo:hi], key=cmp_to_key(compare))
        yield at[order]


def repeats_in_block(text: np.ndarray, starts: np.ndarray, age: np.ndarray) -> np.ndarray:
    """Which starts have an equal ``LENGTH``-byte string with a smaller age in the block."""
    out = np.zeros(len(starts), bool)
    slot = np.full(len(text) + 1, -1, np.int64)
    slot[starts] = np.arange(len(starts))
    view = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    for order in suffix_order(text, starts):
        equal = np.zeros(len(order), bool)
        for a in range(1, len(order), 20_000):
            b = min(len(order), a + 20_000)
            equal[a:b] = (view[order[a:b]] == view[order[a - 1 : b - 1]]).all(1)
        run = np.flatnonzero(~equal)
        old = age[slot[order]]
        least = np.repeat(np.minimum.reduceat(old, run), np.diff(np.append(run, len(order))))
        out[slot[order]] = old > least
    return out


# -- the distributed operator -----------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    """d orders the rows; u names the text in shuffles, where many rows may have no doc_id."""
    raw = common.utf8()
    doc_id, x = F.col("doc_id").cast("long"), F.xxhash64(raw)
    return docs.select(F.coalesce(doc_id, F.lit(NO_ID)).alias("d"), x.alias("x"), F.coalesce(doc_id, x).alias("u"), raw.alias("raw"))


def _partitions(docs: DataFrame) -> int:
    return common.parts_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, power=0.4)  # 100 TB: 328,000


def _shared(docs: DataFrame, parts: int) -> DataFrame:
    """u, hs: the anchors of each text that occur again anywhere.

    Within a slice of a task's texts all but the first row of an anchor are known to repeat,
    and in later slices of the task all rows of the anchors that did: they are dealt out at
    random, so a hot anchor sends about one row a task to its partition.
    """

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.zeros(0, np.uint64)
        for part in rows:
            ids = part.column(0).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in textkit.batches(part.column(1), SLICE):
                p, _, _, h = anchors(data, offsets)
                d = ids[a:b][np.searchsorted(offsets, p, "right") - 1]
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                same = np.concatenate(([False], h[1:] == h[:-1])) if len(h) else np.zeros(0, bool)
                again = same | (hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h) if len(hot) else same
                found = np.unique(h[same])
                hot = np.union1d(hot, found) if len(hot) + len(found) <= HOT else found[:HOT]
                sure = again.copy()
                sure[:-1] |= same[1:]
                new = np.ones(len(h), bool)  # rows of one text and anchor go one way: once is enough
                new[1:] = ~(same[1:] & (d[1:] == d[:-1]) & again[:-1])
                h, d, again, sure = h[new], d[new], again[new], sure[new]
                route = np.where(again, textkit.mix(h ^ textkit.mix(d.astype(np.uint64))), h)
                yield pa.RecordBatch.from_arrays([pa.array(route.view(np.int64)), pa.array(h.view(np.int64)), pa.array(d), pa.array(sure)], ["r", "h", "u", "sure"])

    def repeated(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(rows)  # a partition: one row an anchor and slice, 25 bytes each
        if not held:
            return
        r, h, d, sure = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in held]) for i in range(4))
        order = np.lexsort((h, r))
        same = np.concatenate(([False], (r[order][1:] == r[order][:-1]) & (h[order][1:] == h[order][:-1])))
        keep = sure.copy()
        keep[order] |= same
        keep[order[:-1]] |= same[1:]
        for at in range(0, len(held := np.flatnonzero(keep)), 100_000):
            some = held[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(h[some]), pa.array(d[some])], ["h", "u"])

    def listed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(rows)  # a partition of texts: their anchors, 16 bytes each
        if not held:
            return
        h, d = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in held]) for i in range(2))
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
        first = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        edges = np.append(first, len(d)).astype(np.int32)
        for at in range(0, len(first), 2_000):
            e = edges[at : at + 2_001]
            yield pa.RecordBatch.from_arrays([pa.array(d[first[at : at + 2_000]]), pa.ListArray.from_arrays(pa.array(e - e[0]), pa.array(h[e[0] : e[-1]]))], ["u", "hs"])

    rows = _keyed(docs).filter(F.octet_length("raw") >= LENGTH).select("u", "raw").mapInArrow(cut, "r long, h long, u long, sure boolean")
    rows = rows.repartition(parts, "r").mapInArrow(repeated, "h long, u long")
    return rows.repartition(parts, "u").mapInArrow(listed, "u long, hs array<long>")


_CONTEXT = "h long, c long, d long, x long, lo long, n int, t int, ctx binary"


def _contexts(docs: DataFrame, wanted: DataFrame, with_bytes: bool) -> DataFrame:
    """A row for each wanted anchor: its first window, windows, distance, digest of its context.

    ``wanted``: u and hs, anchors; or, ``with_bytes``, d, x and los, first windows whose
    context bytes are to be read.  Digest and anchor together have 128 bits.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part in parts:
            lists = part.column(3)
            for a, b, data, offsets in textkit.batches(part.column(2), SLICE):
                p, lo, hi, h = anchors(data, offsets)
                owner = np.searchsorted(offsets, p, "right") - 1
                seek = lo - offsets[owner] if with_bytes else h.view(np.int64)
                keep = np.zeros(len(p), bool)
                edge = np.searchsorted(owner, np.arange(b - a + 1))
                for i in range(b - a):
                    s = slice(edge[i], edge[i + 1])
                    keep[s] = np.isin(seek[s], lists[a + i].values.to_numpy(zero_copy_only=False))
                p, lo, hi, h, owner = (v[keep] for v in (p, lo, hi, h, owner))
                raw = data.tobytes()
                n, t = (hi - lo + 1).astype(np.int32), (p - lo).astype(np.int32)
                ctx = [raw[s:e] for s, e in zip(lo, hi + LENGTH, strict=True)]
                c = np.array([xxhash.xxh3_64_intdigest(v) for v in ctx], np.uint64) ^ textkit.mix((n.astype(np.uint64) << np.uint64(32)) | t.astype(np.uint64))
                ids, xs = (part.column(i).slice(a, b - a).take(pa.array(owner)) for i in (0, 1))
                bytes_ = pa.array(ctx, pa.binary()) if with_bytes else pa.nulls(len(ctx), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), ids, xs, pa.array(lo - offsets[owner]), pa.array(n), pa.array(t), bytes_], ["h", "c", "d", "x", "lo", "n", "t", "ctx"])

    keys, seek = (["d", "x"], "los") if with_bytes else (["u"], "hs")
    got = _keyed(docs).join(wanted, keys).select("d", "x", "raw", seek).mapInArrow(run, _CONTEXT)
    return got if with_bytes else got.drop("ctx")


_SPANS = "d long, x long, lo long, hi long"


def _runs(d: np.ndarray, x: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Spans [lo, hi) of the windows that start at ``at``, consecutive ones as one."""
    order = np.lexsort((at, x, d))
    d, x, at = d[order], x[order], at[order]
    new = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (x[1:] != x[:-1]) | (at[1:] > at[:-1] + 1)))) if len(at) else at
    last = np.append(new[1:], len(at)) - 1 if len(at) else at
    return pa.RecordBatch.from_arrays([pa.array(d[new]), pa.array(x[new]), pa.array(at[new]), pa.array(at[last] + LENGTH)], ["d", "x", "lo", "hi"])


def _sorted_block(rows: list[tuple]) -> pa.RecordBatch:
    """Sort one block's buckets.  Each context is laid so that its anchor falls on residue 0;
    contexts are parted by one byte or more, and no window reaches past its own context."""
    at, places = 0, []
    for _, d, x, lo, n, t, ctx in rows:
        at += -(at + t) % PERIOD
        places.append(at)
        at += len(ctx) + 1
    text = np.zeros(at + LENGTH, np.uint8)
    for place, row in zip(places, rows, strict=True):
        text[place : place + len(row[6])] = np.frombuffer(row[6], np.uint8)
    n = np.array([r[4] for r in rows], np.int64)
    d, x, lo = (np.repeat(np.array([r[k] for r in rows], np.int64), n) for k in (1, 2, 3))
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts = np.repeat(np.array(places, np.int64), n) + step
    age = np.empty(len(starts), np.int64)
    age[np.lexsort((lo + step, x, d))] = np.arange(len(starts))
    gone = repeats_in_block(text, starts, age)
    return _runs(d[gone], x[gone], (lo + step)[gone])


def _sorted_spans(rows: DataFrame, block: int) -> DataFrame:
    """Spans found by sorting; whole buckets, gathered to blocks of about ``block`` bytes."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if size >= block and held[-1][0] != row[0]:
                    yield _sorted_block(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield _sorted_block(held)

    cols = ["h", "d", "x", "lo", "n", "t", "ctx"]
    return rows.select(*cols).repartition("h").sortWithinPartitions("h").mapInArrow(run, _SPANS)


def _narrowed(rows: DataFrame, width: int) -> DataFrame:
    """Contexts cut into parts of windows with equal ``distance // width``, in buckets of their own.

    All windows of a part hold the bytes around the anchor that its least and its largest
    distance have in common; a digest of those and of the bucket names the new bucket, so
    equal windows stay together.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = ["h", "c", "d", "x", "lo", "n", "t", "ctx"]
        types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        for part in parts:
            for at in range(0, part.num_rows, 2_000):
                out: list[list] = [[] for _ in names]
                for h, d, x, lo, n, t, ctx in zip(*(c.slice(at, 2_000).to_pylist() for c in part.columns), strict=True):
                    for g in range((t - n + 1) // width, t // width + 1):
                        near, far = g * width, min(SPAN - 1, g * width + width - 1)
                        least, most = max(near, t - n + 1), min(far, t)
                        cut = ctx[t - most : t - least + LENGTH]
                        key = xxhash.xxh3_128_digest(h + bytes([g]) + ctx[t - near : t + LENGTH - far])
                        c = xxhash.xxh3_64_intdigest(cut, seed=least << 8 | most)
                        for column, value in zip(out, (key, c - (c >> 63 << 64), d, x, lo + t - most, most - least + 1, most, cut), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, types, strict=True)], names)

    return rows.select("h", "d", "x", "lo", "n", "t", "ctx").mapInArrow(run, "h binary, c long, d long, x long, lo long, n int, t int, ctx binary")


def _hot_spans(rows: DataFrame, most: int, block: int) -> Iterator[DataFrame]:
    """Spans in buckets too large for one task: narrower buckets, until they can be sorted.

    At the edge of a shared passage only windows that lie almost within it stay together,
    so few parts of a context go on.  A part of width 1 is one window: equal or not.
    """
    rows = rows.withColumn("h", F.encode(F.col("h").cast("string"), "UTF-8"))
    for width in WIDTHS:
        if rows.isEmpty():
            return
        parts = common.table(_narrowed(rows, width), f"suffix-parts-{width}")
        firsts = parts.groupBy("h", "c").agg(F.min(F.struct("d", "x", "lo", "n", "t", "ctx")).alias("f"), F.count(F.lit(1)).alias("k"))
        firsts = common.table(firsts, f"suffix-part-firsts-{width}")
        copied = firsts.filter("k > 1").select("h", "c", F.struct("f.d", "f.x", "f.lo").alias("f"))
        again = parts.drop("ctx").join(copied, ["h", "c"]).filter(F.struct("d", "x", "lo") != F.col("f"))
        yield again.select("d", "x", "lo", (F.col("lo") + F.col("n") - 1 + LENGTH).alias("hi"))
        sizes = common.table(firsts.groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), f"suffix-part-sizes-{width}")
        open_ = common.table(firsts.join(sizes, "h").select("h", "m", "f.*"), f"suffix-part-open-{width}")
        yield _sorted_spans(open_.filter(F.col("m") <= most), block)
        rows = open_.filter(F.col("m") > most)


def spans(docs: DataFrame, most: int = 1024, block: int = 2_000_000) -> DataFrame:
    """d, x, lo, hi: byte spans to remove (they may overlap), d and x naming the row."""
    spark = docs.sparkSession
    common.ship(spark)
    shared = common.table(_shared(docs, _partitions(docs)), "suffix-shared")
    common.release(spark)
    found = common.table(_contexts(docs, shared, with_bytes=False), "suffix-contexts")
    common.release(spark)
    firsts = common.table(found.groupBy("h", "c").agg(F.min(F.struct("d", "x", "lo")).alias("f"), F.count(F.lit(1)).alias("k")), "suffix-firsts")
    # sizes are tables, so that the joins on them have plain exchanges and a hot bucket can be split
    sizes = common.table(firsts.groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "suffix-sizes")
    open_ = common.table(firsts.join(sizes, "h").select("h", "m", "f.d", "f.x", "f.lo"), "suffix-open")
    copied = firsts.filter("k > 1").select("h", "c", "f")
    whole = found.join(copied, ["h", "c"]).filter(F.struct("d", "x", "lo") != F.col("f"))
    whole = common.table(whole.select("d", "x", "lo", (F.col("lo") + F.col("n") - 1 + LENGTH).alias("hi")), "suffix-whole")
    common.release(spark)
    seek = open_.groupBy("d", "x").agg(F.collect_set("lo").alias("los"))  # a list per text, no longer than the text
    texts = _contexts(docs, common.table(seek, "suffix-seek"), with_bytes=True).dropDuplicates(["h", "d", "x", "lo"])
    texts = common.table(texts.join(sizes, "h"), "suffix-texts")
    common.release(spark)
    cold = _sorted_spans(texts.filter(F.col("m") <= most), block)
    found = whole.unionByName(cold)
    for hot in _hot_spans(texts.filter(F.col("m") > most), most, block):
        found = found.unionByName(hot)
    return found


def remove(docs: DataFrame, with_text: bool = False, most: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, (kept bytes) for every row of ``docs``."""
    found = common.table(spans(docs, most), "suffix-spans")
    per = common.table(found.groupBy("d", "x").agg(F.collect_list(F.struct("lo", "hi")).alias("gone")), "suffix-gone")
    common.release(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[list] = [[] for _ in range(5)]
            for raw, gone in zip(part.column(1), part.column(2), strict=True):
                raw = raw.as_py()
                removed = count = 0
                if gone.is_valid and len(gone.values):
                    lo, hi = (gone.values.field(k).to_numpy() for k in (0, 1))
                    order = np.argsort(lo, kind="stable")
                    lo, hi = lo[order], np.maximum.accumulate(hi[order])
                    new = np.flatnonzero(np.concatenate(([True], lo[1:] > hi[:-1])))
                    lo, hi = lo[new], hi[np.append(new[1:], len(hi)) - 1]
                    removed, count = int((hi - lo).sum()), len(lo)
                    kept = b"".join(raw[a:b] for a, b in zip(np.append(0, hi), np.append(lo, len(raw)), strict=True))
                else:
                    kept = raw
                for column, value in zip(out, (len(raw), removed, count, hashlib.sha256(kept).hexdigest(), kept if with_text else None), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(out, types, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    rows = _keyed(docs).join(per, ["d", "x"], "left").select(F.when(F.col("d") != NO_ID, F.col("d")).alias("doc_id"), "raw", "gone")
    got = rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return got if with_text else got.drop("kept")
