"""Quality scores by a factorisation machine.

Features of a text: its hashed lower-cased words (term frequencies, square-root scaled, unit
length), structure statistics (lengths, shares of symbols, capitals, digits, marks, repeated
lines and words) and one metadata column, ``n_chars``: its octave (a feature each, one more
where it is null or there is no such column).  The machine is

    y = w0 + <w, x> + 1/2 * sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

whose pairwise part costs rank * (features present) by the sum-of-squares identity.  The
score is 1 / (1 + exp(-y)).

Training reads a bounded sample: at most ``sample`` labelled rows and ``sample_bytes`` of
features, those with the smallest hash of their id, so the same rows at any partitioning.
Everything else covers every row.  Labels are joined by doc_id for training only; labels,
lang, source and doc_id are no features; other columns are ignored.  Rows with a null label or doc_id are not trained on; null and empty texts have no
words and get the score of their structure statistics.  Of an id with several labels each
counts.  With no training rows, or one class alone, the score is the class share (0.5 if
none).  Repeated rows get the same score; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm import common, quality_rules, textkit


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 14
    rank: int = 8
    epochs: int = 8
    batch: int = 256
    steps: int = 300
    """Least number of batches that training takes, so that a small sample is read more often."""
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 3
    sample: int = 10_000
    """Most labelled rows that training reads."""
    sample_bytes: int = 64_000_000
    """Most bytes of their features (four a feature) that come to the driver."""


STRUCTURE, OCTAVES = 14, 25
EXTRA = STRUCTURE + OCTAVES
_CLASS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "mark": [ord(c) for c in ".,;:!?'\"()-"], "symbol": [ord(c) for c in "#*$%&|<>=+~^_{}[]\\/@"]}
_MASKS = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASS.items()}


def octave(n_chars: np.ndarray) -> np.ndarray:
    """Size class of each n_chars: 1 + its bits, up to 24; 0 for missing ones (below 0)."""
    return np.where(n_chars < 0, 0, np.minimum(1 + np.floor(np.log2(np.maximum(n_chars, 0) + 1.0)), OCTAVES - 1)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row starts, feature ids, values) of a batch in compressed rows; structure and metadata last.

    Ids fit in 16 bits; values are rounded to 16 bits, so that training and scoring see the same.
    """
    n = len(offsets) - 1
    low = textkit.LOWER[data]
    text_of, start, end = textkit.word_spans(low, offsets)
    h = textkit.span_hash(textkit.prefix_hash(low), start, end)
    bucket = (h % np.uint64(s.buckets)).astype(np.int64)
    cell, count = np.unique(text_of * s.buckets + bucket, return_counts=True)
    row, col = cell // s.buckets, cell % s.buckets
    value = np.sqrt(count)
    norm = np.sqrt(np.bincount(row, value**2, n))
    value = value / np.maximum(norm[row], 1e-9)
    m = quality_rules.measure(data, offsets)
    size = np.diff(offsets).astype(float)
    sums = {k: np.concatenate(([0], np.cumsum(v[data]))) for k, v in _MASKS.items()}
    share = {k: (v[offsets[1:]] - v[offsets[:-1]]) / np.maximum(size, 1) for k, v in sums.items()}
    words = np.maximum(m["n_words"], 1)
    unique = np.bincount(row, minlength=n) / words
    letters = share["upper"] + share["lower"]
    dense = np.stack((
        np.log1p(size) / 10, np.log1p(m["n_words"]) / 8, m["word_chars"] / words / 10, share["upper"] / np.maximum(letters, 1e-9), share["digit"] * 5, share["mark"] * 5, share["symbol"] * 10,
        m["n_symbols"] / words, m["n_dup_lines"] / (1 + m["n_dup_lines"]), m["n_repeat_words"] / words, unique, (m["n_words"] < 50).astype(float), np.minimum(size / np.maximum(m["word_chars"], 1) / 2, 2), np.ones(n),
    ), 1)
    dense = np.clip(dense, 0, 3)
    row = np.concatenate((row, np.repeat(np.arange(n), STRUCTURE), np.arange(n)))
    col = np.concatenate((col, np.tile(s.buckets + np.arange(STRUCTURE), n), s.buckets + STRUCTURE + octave(n_chars)))
    value = np.concatenate((value, dense.ravel(), np.ones(n)))
    order = np.argsort(row, kind="stable")
    return np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))), col[order].astype(np.uint16), value[order].astype(np.float16).astype(np.float32)


class Machine:
    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = bias, w, v

    def raw(self, start: np.ndarray, col: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Linear-time y for compressed rows (each row holds the structure features at least)."""
        if len(start) < 2:
            return np.zeros(0)
        x = value[:, None]
        vx = self.v[col] * x
        sums = np.add.reduceat(vx, start[:-1], 0)
        squares = np.add.reduceat(vx * vx, start[:-1], 0)
        return self.bias + np.add.reduceat(self.w[col] * value, start[:-1]) + 0.5 * (sums * sums - squares).sum(1)

    def score(self, start: np.ndarray, col: np.ndarray, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(start, col, value), -30, 30)))


def fit(start: np.ndarray, col: np.ndarray, value: np.ndarray, label: np.ndarray, s: Settings) -> Machine:
    """Adagrad on the log loss, classes weighted to be even.

    The weights multiply the odds of label 1 by (1 - share) / share, so the log of that is
    taken from the bias afterwards and the scores are chances among the rows as they are.
    """
    n, size = len(label), s.buckets + EXTRA
    rng = np.random.default_rng(s.seed)
    share = float(label.mean()) if n else 0.5
    if not n or not 0 < share < 1:
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Machine(float(np.log(p / (1 - p))), np.zeros(size, np.float32), np.zeros((size, s.rank), np.float32))
    w, v = np.zeros(size, np.float32), rng.normal(0, 0.02, (size, s.rank)).astype(np.float32)
    gw, gv, g0, bias = np.full(size, 1e-6, np.float32), np.full((size, s.rank), 1e-6, np.float32), 1e-6, 0.0
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    batches = max(1, n // s.batch)
    for _ in range(max(s.epochs, -(-s.steps // batches))):
        for rows in np.array_split(rng.permutation(n), batches):
            count = start[rows + 1] - start[rows]
            at = np.cumsum(count) - count
            pick = np.repeat(start[rows] - at, count) + np.arange(count.sum())
            c, x = col[pick], value[pick]
            owner = np.repeat(np.arange(len(rows)), count)
            vx = v[c] * x[:, None]
            sums = np.add.reduceat(vx, at, 0)
            y = bias + np.add.reduceat(w[c] * x, at) + 0.5 * (sums * sums - np.add.reduceat(vx * vx, at, 0)).sum(1)
            slope = ((1 / (1 + np.exp(-np.clip(y, -30, 30))) - label[rows]) * weight[rows] / len(rows)).astype(np.float32)
            d = slope[owner] * x
            used, where = np.unique(c, return_inverse=True)
            dw = np.bincount(where, d, len(used)).astype(np.float32) + s.decay * w[used]
            dv = np.stack([np.bincount(where, d * (sums[owner, f] - vx[:, f]), len(used)) for f in range(s.rank)], 1).astype(np.float32) + s.decay * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            g0 += float(slope.sum()) ** 2
            w[used] -= s.rate * 5 * dw / np.sqrt(gw[used])
            v[used] -= s.rate * dv / np.sqrt(gv[used])
            bias -= s.rate * 5 * float(slope.sum()) / np.sqrt(g0)
    return Machine(bias + float(np.log(share / (1 - share))), w, v)


def held_out(doc_id: str = "doc_id"):
    """Rows whose crc32 of the id as text is 1 modulo 3; a null id is not held out and never trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _size_class(docs: DataFrame) -> Column:
    """n_chars, -1 where it is null or missing."""
    return F.coalesce(F.col("n_chars").cast("long"), F.lit(-1)) if "n_chars" in docs.columns else F.lit(-1).cast("long")


def train(docs: DataFrame, labels: DataFrame, label: str, s: Settings = Settings()) -> Machine:
    common.ship(docs.sparkSession)
    known = labels.select("doc_id", F.col(label).cast("int").alias("__y")).filter(F.col("doc_id").isNotNull() & F.col("__y").isNotNull() & ~held_out())
    chosen = known.orderBy(F.xxhash64(F.lit(s.seed), "doc_id"), "doc_id", "__y").limit(s.sample)
    rows = docs.select("doc_id", "text", _size_class(docs).alias("__n")).join(F.broadcast(chosen), "doc_id")  # at most s.sample rows are sent
    rows = rows.select(F.xxhash64(F.lit(s.seed), "doc_id").alias("k"), "__y", "text", "__n")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for a, b, data, offsets in textkit.batches(part.column(2)):
                start, col, value = features(data, offsets, part.column(3).slice(a, b - a).to_numpy(), s)
                split = start[1:-1]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(a, b - a), part.column(1).slice(a, b - a), pa.array([x.tobytes() for x in np.split(col, split)], pa.binary()), pa.array([x.tobytes() for x in np.split(value.astype(np.float16), split)], pa.binary())], ["k", "y", "col", "value"])

    made = common.table(rows.mapInArrow(run, "k long, y int, col binary, value binary"), "classifier-features")
    # an id may stand for several rows: the bounds hold for the rows there are
    size = (F.octet_length("col") + F.octet_length("value")).cast("long")
    first = made.orderBy("k", "y", "col").limit(s.sample)
    upto = first.withColumn("__to", F.sum(size).over(Window.orderBy("k", "y", "col").rowsBetween(Window.unboundedPreceding, 0)))
    got = upto.filter(F.col("__to") <= s.sample_bytes).orderBy("__to").collect()
    col = np.frombuffer(b"".join(r["col"] for r in got), np.uint16)
    value = np.frombuffer(b"".join(r["value"] for r in got), np.float16).astype(np.float32)
    start = np.concatenate(([0], np.cumsum([len(r["col"]) // 2 for r in got]))).astype(np.int64)
    return fit(start, col, value, np.array([r["y"] for r in got], np.int64), s)


def score(docs: DataFrame, machine: Machine, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; one narrow pass."""
    common.ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.w, machine.v))  # (buckets + EXTRA) * (rank + 1) floats

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = Machine(*sent.value)
        for part in parts:
            for a, b, data, offsets in textkit.batches(part.column(2)):
                p = fm.score(*features(data, offsets, part.column(3).slice(a, b - a).to_numpy(), s)).astype(float)
                yield pa.RecordBatch.from_arrays([part.column(0).slice(a, b - a), part.column(1).slice(a, b - a), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out().alias("held_out"), "text", _size_class(docs).alias("__n")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
