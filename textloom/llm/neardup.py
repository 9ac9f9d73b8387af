"""Near-duplicate components by b-bit MinHash, every link confirmed on full shingle sets.

1. Each text gives its set of distinct k-word shingles (64-bit hashes), an order-free 128-bit
   digest of the set, 216 minima, 36 band keys of six minima each, and the low four bits of
   the minima packed two a byte.  Texts with equal sets form a class; work goes on by class.
2. Classes that share a band key meet.  In a group each class is held against one centre
   only, and bands take different centres; pairs are never expanded within a group.
3. A pair's similarity is estimated from its packed bits: equal lanes, corrected for chance
   collisions (1/16 a lane).  A pair more than six deviations below the threshold is dropped;
   any other is confirmed by the exact intersection of the full sets.
4. Confirmed links join into components.  The classes of groups that still span several
   components are compared once more without centres, by an exact rule: two sets that link share
   one of their rarest members (``_postings``), and enough members from there on.  Classes with a
   possible partner of another component get their full sets, once or a few times each and not
   once a group and block; pairs are confirmed in place and a pair of blocks returns one link at
   most for each component that it joins.  So no link between them is lost, and no pairs are
   written out.

At similarity 0.8 a link shares no band with probability 2e-5.  A text with fewer than k
words has its whole sequence as its one shingle; null, empty and blank texts have an empty
set, link with nothing and stay.  Links and components are between classes, never between
ids: rows with a null doc_id, and different texts under one doc_id, are told apart.  The
component_id is the smallest doc_id in the component, null if it has none.  Repeated rows get
the same answer each from ``resolve``; ``unique_rows`` keeps one row of each component (the
smallest doc_id, then by a hash of the text; null ids last) and each row with an empty set.
An empty table gives an empty result.  Other columns are ignored, or kept as they are by
``unique_rows``; their names must not begin with two underscores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm import common, textkit

NO_ID = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    words: int = 2
    percent: int = 80
    bands: int = 36
    rows: int = 6
    bits: int = 4
    seed: int = 5
    deviations: float = 6.0
    block: int = 512
    """Most classes under a key that one block of the last comparison holds (8 times as many before sets are sent)."""

    @property
    def lanes(self) -> int:
        return self.bands * self.rows

    @property
    def floor(self) -> float:
        """Estimates below this are beyond ``deviations`` standard deviations of the threshold."""
        chance = 1 / 2**self.bits
        p = self.percent / 100 * (1 - chance) + chance
        return self.percent / 100 - self.deviations * np.sqrt(p * (1 - p) / self.lanes) / (1 - chance)

    def family(self) -> tuple[np.ndarray, np.ndarray]:
        r = textkit.mix(np.arange(1, 2 * self.lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(self.seed))
        return (r[: self.lanes] >> np.uint64(32)).astype(np.uint32), (r[self.lanes :] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def sets_of(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash), distinct and sorted, of a batch; A-Z count as a-z."""
    low = textkit.LOWER[data]
    text_of, start, end = textkit.word_spans(low, offsets)
    return textkit.distinct_per_text(*textkit.shingles(text_of, textkit.span_hash(textkit.prefix_hash(low), start, end), k))


def digests(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bytes for each set: sums of two independent mixes of its members."""
    one = np.add.reduceat(textkit.mix(h + np.uint64(0x632BE59BD9B4E019)), first)
    two = np.add.reduceat(textkit.mix(h ^ np.uint64(0xE7037ED1A0B428DB)), first)
    return np.stack((one, two), 1)


def minima(h: np.ndarray, first: np.ndarray, last: np.ndarray, s: Settings) -> np.ndarray:
    flip, step = s.family()
    h = (h >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(first), s.lanes), 0xFFFFFFFF, np.uint32)
    most, a = 2048, 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(last, first[a] + most, "right")))
        if b == a + 1:
            for at in range(first[a], last[a], most):
                part = (h[at : min(at + most, last[a]), None] ^ flip) * step
                np.minimum(out[a], part.min(0), out=out[a])
        else:
            part = (h[first[a] : last[b - 1], None] ^ flip) * step
            out[a:b] = np.minimum.reduceat(part, first[a:b] - first[a], 0)
        a = b
    return out


def pack_bits(low: np.ndarray) -> np.ndarray:
    """Low four bits of the mixed minima, two a byte."""
    m = low ^ (low >> np.uint32(15))
    m = (m * np.uint32(0x2C1B3C6D)) >> np.uint32(28)
    return (m[:, 0::2] | m[:, 1::2] << np.uint32(4)).astype(np.uint8)


_UNEQUAL = np.array([(x & 15 > 0) + (x >> 4 > 0) for x in range(256)], np.uint8)


def estimate(a: np.ndarray, b: np.ndarray, s: Settings) -> np.ndarray:
    """Collision-corrected similarity of packed signatures, along the last axis."""
    equal = 1 - _UNEQUAL[a ^ b].sum(-1, dtype=np.int64) / s.lanes
    chance = 1 / 2**s.bits
    return (equal - chance) / (1 - chance)


def _band_keys(low: np.ndarray, s: Settings) -> np.ndarray:
    steps = textkit.mix(np.arange(101, 101 + s.rows, dtype=np.uint64)) | np.uint64(1)
    per = (low.reshape(-1, s.bands, s.rows).astype(np.uint64) * steps).sum(-1, dtype=np.uint64)
    return textkit.mix(per + textkit.mix(np.arange(1, s.bands + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))).view(np.int64)


def sketch(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, x (text hash), n_shingles, cls (set digest), packed, bands; the last three null for empty sets."""
    common.ship(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for a, b, data, offsets in textkit.batches(part.column(2)):
                t, h = sets_of(data, offsets, s.words)
                n = np.bincount(t, minlength=b - a)
                full = np.flatnonzero(n)
                last = np.cumsum(n)[full]
                first = last - n[full]
                cls: list = [None] * (b - a)
                packed, bands = list(cls), list(cls)
                if len(full):
                    low = minima(h, first, last, s)
                    for i, c, p, k in zip(full, digests(h, first), pack_bits(low), _band_keys(low, s), strict=True):
                        cls[i], packed[i], bands[i] = c.tobytes(), p.tobytes(), k
                kept = [part.column(i).slice(a, b - a) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(packed, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "x", "n_shingles", "cls", "packed", "bands"])

    return docs.select(F.col("doc_id").cast("long"), _text_hash().alias("x"), "text").mapInArrow(run, "doc_id long, x long, n_shingles long, cls binary, packed binary, bands array<long>")


def _text_hash() -> Column:
    return F.xxhash64(common.utf8())


def _row_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def full_sets(docs: DataFrame, wanted: DataFrame, s: Settings, most_broadcast: int = 200_000) -> DataFrame:
    """k and its sorted shingles (uint64 bytes) for the wanted classes (k, cls, d, x).

    Texts are read again, one row that stands for each class (by id and text hash).
    """
    rows = wanted.select("d", "x").distinct()
    rows = F.broadcast(rows) if wanted.count() <= most_broadcast else rows  # 16 bytes a row
    some = docs.select(_row_id().alias("d"), _text_hash().alias("x"), "text").join(rows, ["d", "x"], "left_semi")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, _, data, offsets in textkit.batches(part.column(0)):
                t, h = sets_of(data, offsets, s.words)
                if len(t):
                    first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
                    yield pa.RecordBatch.from_arrays([pa.array([d.tobytes() for d in digests(h, first)], pa.binary()), pa.array([x.tobytes() for x in np.split(h, first[1:])], pa.binary())], ["cls", "members"])

    found = some.select("text").mapInArrow(run, "cls binary, members binary")
    return found.join(wanted.select("cls", "k"), "cls").select("k", "members").dropDuplicates(["k"])


def _plausible(pairs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose packed bits allow a link."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                x, y = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(part.num_rows, -1) for i in (2, 3))
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(estimate(x, y, s) >= s.floor)) for c in part.columns[:2]], ["a", "b"])

    sig = classes.select("k", "packed")
    both = pairs.join(sig.withColumnsRenamed({"k": "a", "packed": "x"}), "a").join(sig.withColumnsRenamed({"k": "b", "packed": "y"}), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("k")).union(pairs.select("b")).distinct().join(classes.select("k", "cls", "d", "x"), "k")
    sets = common.table(full_sets(docs, common.table(wanted, "near-wanted"), s), "near-sets")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ok = []
            for x, y in zip(part.column(2), part.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= s.percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in part.columns[:2]], ["a", "b"])

    joined = pairs.join(sets.withColumnsRenamed({"k": "a", "members": "x"}), "a").join(sets.withColumnsRenamed({"k": "b", "members": "y"}), "b")
    return common.table(joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "near-links")


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def components(links: DataFrame) -> DataFrame:
    """k, label (smallest k reachable) for the classes that have links.

    Labels spread along links and then jump to their label's label, so the rounds grow
    with the logarithm of a component's width; nothing comes to the driver but one number.
    """
    both = common.table(links.select("a", "b").union(links.select("b", "a")), "near-both")
    lab = common.table(both.select(F.col("a").alias("k")).distinct().withColumn("label", F.col("k")), "near-labels")
    while True:
        heard = both.join(lab.withColumnRenamed("k", "a"), "a").groupBy("b").agg(F.min("label").alias("heard"))
        new = common.table(lab.join(heard, lab["k"] == heard["b"]).select("k", F.col("label").alias("old"), F.least("label", "heard").alias("label")), "near-heard")
        jump = new.select(F.col("k").alias("at"), F.col("label").alias("to"))
        new = common.table(new.join(jump, new["label"] == jump["at"]).select("k", "old", F.least("label", "to").alias("label")), "near-labels")
        lab = new.select("k", "label")
        if new.filter("label <> old").isEmpty():
            return lab


def _inside(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets of x with all sets of y: products of 0/1 matrices over
    the shingles that either side shares, a slice of them at a time."""
    common_ = np.intersect1d(np.concatenate(x), np.concatenate(y))
    out = np.zeros((len(x), len(y)), np.float32)
    for at in range(0, len(common_), 4096):
        some = common_[at : at + 4096]
        sides = []
        for side in (x, y):
            m = np.zeros((len(side), len(some)), np.float32)
            for i, members in enumerate(side):
                own = members[np.searchsorted(members, some[0]) : np.searchsorted(members, some[-1], "right")]
                k = np.searchsorted(some, own)
                m[i, k[some[k] == own]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return np.rint(out).astype(np.int64)


def _members_of(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(k, set size, shingle) of each member of the sets (k, members), slices of the batch at a time."""
    keys = part.column(0).to_numpy()
    for a, b, data, offsets in textkit.batches(part.column(1), 4_000_000):
        n = np.diff(offsets) // 8
        yield np.repeat(keys[a:b], n), np.repeat(n, n), np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), np.int64)


def _postings(sets: DataFrame, s: Settings) -> DataFrame:
    """t, k, n (set size), rest (members from t on, itself included): the shingles t among which two
    sets that link must share one.

    Members are ordered by how many of the sets hold them, rarest first.  Sets that share none of
    their first n - ceil(percent * n / 100) + 1 members share too few of the others, so what many
    texts have in common is no key unless it is nearly all of them.  Members of one set alone come
    first and are counted, not written."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, _, t in _members_of(part):
                t, held = np.unique(t, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(held, pa.int64())], ["t", "held"])

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k, n, t in _members_of(part):
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(k, pa.int64()), pa.array(n, pa.int64())], ["t", "k", "n"])

    held = sets.select("k", "members").mapInArrow(count, "t long, held long").groupBy("t").agg(F.sum("held").alias("held")).filter("held > 1")
    rows = sets.select("k", "members").mapInArrow(spread, "t long, k long, n long").join(common.table(held, "near-held"), "t")
    own = Window.partitionBy("k")
    before = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("held", "t")) - 1
    return rows.withColumn("rest", F.col("n") - before).filter(f"rest >= ({s.percent} * n + 99) div 100").select("t", "k", "n", "rest")


def _dealt(rows: DataFrame, each: int) -> DataFrame:
    """The rows of a key t in blocks of about ``each`` that meet in pairs (i, j), pair by pair."""
    size = common.table(rows.groupBy("t").agg(F.count(F.lit(1)).alias("size")), "near-sizes")  # a table, so that a hot key can be split in the join
    rows = rows.join(size, "t").withColumn("parts", F.ceil(F.col("size") / each).cast("int")).withColumn("mine", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select("t", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "k", "label", "n", "rest")


def _whole(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (t, i, j), and where each begins, from batches sorted by group."""
    held = None
    for part in parts:
        if not part.num_rows:
            continue
        got = pa.Table.from_batches([part])
        got = pa.concat_tables([held, got]) if held is not None else got
        keys = np.stack([got[c].to_numpy().astype(np.int64) for c in ("t", "i", "j")])
        starts = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1))
        held = got.slice(starts[-1])
        if len(starts) > 1:
            yield got.slice(0, starts[-1]), starts[:-1]
    if held is not None:
        yield held, np.zeros(1, np.int64)


def _enough(n: np.ndarray, rest: np.ndarray, m: np.ndarray, more: np.ndarray, s: Settings) -> np.ndarray:
    """Whether sets of n and m members can link that share their member before ``rest`` and ``more``
    others, itself counted, and none earlier."""
    return (100 + s.percent) * np.minimum(rest, more) >= s.percent * (n + m)


def _close(rows: DataFrame, s: Settings) -> DataFrame:
    """The rows (t, k, label, n, rest) that have a possible partner of another label under t; no
    sets are sent, so blocks are larger here."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got, starts in _whole(parts):
            i, j, mine, label, n, rest = (got[c].to_numpy() for c in ("i", "j", "mine", "label", "n", "rest"))
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(i))))
            wanted, at, step = np.zeros(len(i), bool), np.arange(len(i)), 0
            while len(at):  # each row with the one that follows ``step`` later in its group
                step += 1
                at = at[at < len(i) - step]
                at = at[group[at] == group[at + step]]
                to = at + step
                ok = (label[at] != label[to]) & ((mine[at] != mine[to]) == (i[at] != j[at])) & _enough(n[at], rest[at], n[to], rest[to], s)
                wanted[at[ok]] = wanted[to[ok]] = True
            yield from got.filter(pa.array(wanted)).select(["t", "k", "label", "n", "rest"]).to_batches()

    sorted_ = _dealt(rows, 8 * s.block).repartition("t", "i", "j").sortWithinPartitions("t", "i", "j")
    return sorted_.mapInArrow(run, "t long, k long, label long, n long, rest long").distinct()


def _linked(group: pa.Table, s: Settings) -> tuple[list[int], list[int]]:
    """Links between the different labels of a group (t, i, j), one at most for each component that it joins."""
    i, j, mine = group["i"][0].as_py(), group["j"][0].as_py(), group["mine"].to_numpy()
    own, label, size, rest = (group[c].to_numpy() for c in ("k", "label", "n", "rest"))
    sets = [np.frombuffer(x, np.uint64) for x in group["members"].to_pylist()]
    left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
    root = {int(v): int(v) for v in np.unique(label)}

    def find(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    a: list[int] = []
    b: list[int] = []
    for at in range(0, len(left), 32):
        some = left[at : at + 32]
        tops = np.array([find(int(v)) for v in label])
        ok = (tops[some][:, None] != tops[right][None]) & _enough(size[some][:, None], rest[some][:, None], size[right][None], rest[right][None], s)
        if i == j:
            ok &= some[:, None] < right[None]
        x, y = (np.flatnonzero(ok.any(k)) for k in (1, 0))
        if not len(x):
            continue
        both = _inside([sets[k] for k in some[x]], [sets[k] for k in right[y]])
        linked = ok[np.ix_(x, y)] & (100 * both >= s.percent * (size[some[x]][:, None] + size[right[y]][None] - both))
        for p, q in zip(*np.nonzero(linked), strict=True):
            u, v = some[x[p]], right[y[q]]
            if (m := find(int(label[u]))) != (n := find(int(label[v]))):
                root[max(m, n)] = min(m, n)
                a.append(int(min(own[u], own[v])))
                b.append(int(max(own[u], own[v])))
    return a, b


def _across(rows: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Links between different labels under the same key, confirmed on full sets in place."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got, starts in _whole(parts):
            for lo, hi in zip(starts, [*starts[1:], got.num_rows], strict=True):
                a, b = _linked(got.slice(lo, hi - lo), s)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    sorted_ = _dealt(rows, s.block).join(sets, "k").repartition("t", "i", "j").sortWithinPartitions("t", "i", "j")
    return sorted_.mapInArrow(run, "a long, b long").distinct()


def _spanning(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key has several labels."""
    spans = rows.groupBy(key).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select(key)
    return common.table(rows.join(common.table(spans, "near-spans"), key, "left_semi"), "near-open")


def _open_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the groups that span several components, with their labels."""
    got = members.select("bk", "k").join(labels, "k", "left").select("bk", "k", F.coalesce("label", "k").alias("label"))
    return _spanning(common.table(got, "near-grouped"), "bk")


def _more_links(open_: DataFrame, classes: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """All links between different labels of the open classes, but those that join nothing new."""
    labels = common.table(open_.select("k", "label").distinct(), "near-open-labels")
    wanted = common.table(labels.join(classes.select("k", "cls", "d", "x"), "k").drop("label"), "near-wanted")
    sets = common.table(full_sets(docs, wanted, s), "near-sets")
    rows = _spanning(common.table(_postings(sets, s).join(labels, "k"), "near-postings"), "t")
    return common.table(_across(common.table(_close(rows, s), "near-close"), sets, s), "near-more")


def _named(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """cls, component (the smallest doc_id, null if there is none), and whether the class holds
    the row that stays, with that row's id and text hash (d, x)."""
    own = classes.select("k", "cls", "least", "d", "x").join(labels, "k", "left").withColumn("label", F.coalesce("label", "k"))
    own = common.table(own, "near-named")
    of = common.table(own.groupBy("label").agg(F.min("least").alias("component"), F.min(F.struct("d", "x", "k")).alias("head")), "near-heads")
    return own.join(of, "label").select("cls", "component", (F.col("head.k") == F.col("k")).alias("head"), "d", "x")


def _resolved(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, x, n_shingles, cls, component_id, head (the row, or a copy of it, stays) for every row."""
    docs = docs.select("doc_id", "text")
    rows = common.table(sketch(docs, s), "near-sketches")
    first = F.min(F.struct(_row_id().alias("d"), "x")).alias("rep")
    classes = rows.filter("n_shingles > 0").groupBy("cls").agg(first, F.min("doc_id").alias("least"), F.first("packed").alias("packed"), F.first("bands").alias("bands"))
    # k numbers the classes; it is fixed as soon as the table is written
    classes = common.table(classes.select("cls", "rep.d", "rep.x", "least", "packed", "bands", F.monotonically_increasing_id().alias("k")), "near-classes")
    # a centre for each group: another order of the classes in every fourth of the groups
    banded = classes.select("k", "cls", F.explode("bands").alias("bk")).withColumn("o", F.xxhash64(F.pmod(F.col("bk"), F.lit(4)), F.col("cls"))).drop("cls")
    centres = banded.groupBy("bk").agg(F.count(F.lit(1)).alias("n"), F.min_by("k", "o").alias("centre")).filter("n > 1").drop("n")
    members = common.table(banded.select("bk", "k").join(common.table(centres, "near-centres"), "bk"), "near-members")
    star = members.filter(F.col("k") != F.col("centre")).select(*_ordered(F.col("k"), F.col("centre"))).distinct()
    tried = common.table(_plausible(star, classes, s), "near-pairs")
    links = _confirmed(tried, classes, docs, s)
    labels = components(links)
    open_ = _open_groups(members, labels)
    if not open_.isEmpty():
        links = links.unionByName(_more_links(open_, classes, docs, s))
        labels = components(links)
    named = common.table(_named(classes, labels), "near-components").withColumnsRenamed({"d": "hd", "x": "hx"})
    got = rows.select("doc_id", "x", "n_shingles", "cls").join(named, "cls", "left")
    mine = F.col("head") & (_row_id() == F.col("hd")) & (F.col("x") == F.col("hx"))
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return got.select("doc_id", "x", "n_shingles", "cls", component.alias("component_id"), (F.col("cls").isNull() | mine).alias("head"))


def resolve(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, cls for every row of ``docs``."""
    return _resolved(docs, s).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "cls")


def unique_rows(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component."""
    keep = _resolved(docs, s).filter("head").groupBy(_row_id().alias("__d"), F.col("x").alias("__x"))
    keep = common.table(keep.agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("n_shingles") > 0).alias("full")), "near-kept")
    rows = docs.withColumns({"__d": _row_id(), "__x": _text_hash()})
    got = rows.join(keep.filter("n = 1 or not full"), ["__d", "__x"], "left_semi")
    more = keep.filter("n > 1 and full")
    if not more.isEmpty():  # repeated rows
        got = got.unionByName(rows.join(more, ["__d", "__x"], "left_semi").dropDuplicates(["__d", "__x"]))
    return got.select(*docs.columns)
