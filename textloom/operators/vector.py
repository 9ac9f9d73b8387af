"""Embeddings as arrays: normalising, nearest neighbours, calibration, clusters.

Rows without a vector take no part.  Of equal cosines (to six places) the smallest key is
nearest; rows of one key are not each other's neighbours.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.tables import settled


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    n = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(x))


BLOCKS, MOST = 16, 65_536
"""Tables are cut into so many blocks, or more where a block would have more rows than ``MOST``."""


def _best(i: np.ndarray, x: np.ndarray, j: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of i, x the nearest other row of j, y (in order of j): key, nn, cosine to six places; of equals the smallest.

    Products are taken in single precision first; what can be the nearest by their bound of error, in double."""
    if not len(i) or not len(j):
        return i[:0], j[:0], np.zeros(0)
    best, at = np.full(len(i), -np.inf), np.zeros(len(i), np.int64)
    low, high = np.searchsorted(j, i, "left"), np.searchsorted(j, i, "right")  # rows of the same key
    x4, y4 = x.astype(np.float32), y.astype(np.float32)
    slack = (2 * (x.shape[1] + 4) * 2.0**-23 * np.linalg.norm(x.astype(float), axis=1) * np.linalg.norm(y.astype(float), axis=1).max() + 2e-6).astype(np.float32)
    for c in range(0, len(j), 2048):
        part = y4[c : c + 2048].T
        for r in range(0, len(i), 512):
            s = x4[r : r + 512] @ part
            for k in np.flatnonzero((high[r : r + 512] > np.maximum(low[r : r + 512], c)) & (low[r : r + 512] < c + 2048)):
                s[k, max(low[r + k] - c, 0) : high[r + k] - c] = -np.inf
            top = s.max(1)
            least = np.maximum(top, best[r : r + 512].astype(np.float32)) - slack[r : r + 512]
            rows = np.flatnonzero((top >= least) & np.isfinite(top))
            near, col = np.nonzero(s[rows] >= least[rows, None])
            near = rows[near]
            exact = np.round(np.einsum("ij,ij->i", x[r + near].astype(float), y[c + col].astype(float)), 6)
            order = np.lexsort((col, -exact, near))
            first = order[np.unique(near[order], return_index=True)[1]]
            first = first[exact[first] > best[r + near[first]]]  # of equals the first stays
            best[r + near[first]], at[r + near[first]] = exact[first], c + col[first]
    ok = np.isfinite(best)
    return i[ok], j[at[ok]], best[ok]


def _packed(rows: DataFrame, by: list[str], kind: str, more: str | None = None) -> DataFrame:
    """k, v (and an array of ints) of each group in one row of bytes, in order of k."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("k")
        raw = lambda name, to: np.asarray(group[name].combine_chunks().flatten() if pa.types.is_list(group[name].type) else group[name], to).tobytes()
        got = {c: group[c].slice(0, 1) for c in by} | {"k": [raw("k", np.int64)], "v": [raw("v", kind)]}
        return pa.table(got | ({"more": [raw(more, np.int32)]} if more else {}))

    kinds = dict(rows.dtypes)
    return rows.groupBy(*by).applyInArrow(pack, ", ".join([*(f"{c} {kinds[c]}" for c in by), "k binary, v binary", *(["more binary"] if more else [])]))


def _crossed(asked: DataFrame, there: DataFrame, of: int, key: str, kind: str, cells: bool) -> DataFrame:
    """key, nn, cosine: the nearest for each row of the blocks ``asked`` in the blocks ``there``.

    A task compares one block with one other.  Blocks meet by a Cartesian product, which reads
    them where they are: what is shuffled are the blocks, once, and a row's nearest in each block."""

    def compare(parts):
        for part in parts:
            for r in part.to_pylist():
                i, j = np.frombuffer(r["k"], np.int64), np.frombuffer(r["k2"], np.int64)
                x, y = np.frombuffer(r["v"], kind).reshape(len(i), -1), np.frombuffer(r["v2"], kind).reshape(len(j), -1)
                if cells:
                    mine = (np.frombuffer(r["more"], np.int32).reshape(len(i), -1) == r["c2"]).any(1)
                    i, x = i[mine], x[mine]
                yield pa.RecordBatch.from_arrays([pa.array(z) for z in _best(i, x, j, y)], ["k", "nn", "cosine"])

    pairs = asked.repartitionByRange(of, "b").drop("b").crossJoin(there.repartitionByRange(of, "b2").drop("b2"))
    got = pairs.mapInArrow(compare, "k long, nn long, cosine double")
    return got.groupBy(F.col("k").alias(key)).agg(F.max_by("nn", F.struct("cosine", -F.col("nn"))).alias("nn"), F.max("cosine").alias("cosine"))


def _kind(rows: DataFrame, vector: str) -> str:
    return "float32" if dict(rows.dtypes)[vector] == "array<float>" else "float64"


def _blocks(n: int, block: int) -> int:
    return max(1, min(BLOCKS, -(-n // block)), -(-n // MOST))


def nearest(rows: DataFrame, key: str, vector: str, block: int = 2048, most: int = 2048) -> DataFrame:
    """Each row's nearest other row by inner product: key, nn, cosine.

    Exact: all pairs are compared.  Up to ``most`` rows are one block.  Beyond, rows are dealt into
    blocks of ``block`` rows, but ``BLOCKS`` of them at most while they stay within ``MOST`` rows, and each
    pair of blocks is one task.  Rows without a vector are nobody's neighbours and have none; a row alone has none.
    """
    rows = rows.filter(F.col(vector).isNotNull())
    n = rows.count()
    of = _blocks(n, block) if n > most else 1
    own = rows.select(F.pmod(F.xxhash64(key), F.lit(of)).cast("int").alias("b"), F.col(key).cast("long").alias("k"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    kind = _kind(rows, vector)
    own = settled(_packed(own, ["b"], kind), "vector-blocks")
    return _crossed(own, own.toDF("b2", "k2", "v2"), of, key, kind, False)


def nearest_pruned(rows: DataFrame, key: str, vector: str, cells: int, probes: int, fit: int = 100_000, seed: int = 7) -> DataFrame:
    """``nearest`` without comparing all pairs: key, nn, cosine.

    Rows belong to the cell of the nearest of ``cells`` centres, which are fitted on at most
    ``fit`` rows (those of the smallest hash); every row is looked for in the ``probes`` cells
    nearest to it, against all their rows.  With as many probes as cells it is exact.  Cells
    are cut into blocks, and blocks compared as ``nearest`` does, so no task holds a hot cell.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    kind = _kind(rows, vector)
    rows = settled(rows.filter(F.col(vector).isNotNull()).select(F.col(key).alias("k"), F.transform(vector, lambda x: x.cast("double")).alias("v")), "vectors")
    some = rows.orderBy(F.xxhash64(F.lit(seed), "k"), "k").limit(fit).select(array_to_vector("v").alias("features"))
    if not some.take(1):
        return rows.select(F.col("k").alias(key), F.col("k").alias("nn"), F.lit(0.0).alias("cosine")).limit(0)
    centres = np.array(KMeans(k=cells, seed=seed, distanceMeasure="cosine", maxIter=10).fit(some).clusterCenters())  # cells rows
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)

    def near(parts):
        for part in parts:
            if part.num_rows:
                s = np.stack(part.column("v").to_numpy(zero_copy_only=False)) @ centres.T
                order = np.argsort(-s, axis=1, kind="stable")[:, : min(probes, len(centres))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("v"), pa.array(list(order), pa.list_(pa.int32()))], ["k", "v", "cells"])

    own = rows.mapInArrow(near, f"k {dict(rows.dtypes)['k']}, v array<double>, cells array<int>")
    per = max(1, -(-_blocks(rows.count(), 2048) // len(centres)))  # parts of a cell of the usual size
    own = own.select(F.get("cells", F.lit(0)).alias("c"), F.col("k").cast("long").alias("k"), "v", "cells")
    own = settled(own, "vector-cells")
    size = own.groupBy("c").agg(F.greatest(F.lit(per), F.ceil(F.count(F.lit(1)) / F.lit(MOST))).cast("int").alias("parts"))  # a row a cell
    own = own.join(F.broadcast(size), "c").withColumn("p", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
    own = settled(_packed(own.select("c", "p", "k", "v", "cells"), ["c", "p"], kind, "cells"), "vector-blocks").withColumn("b", F.col("p") * len(centres) + F.col("c"))
    of = max(1, own.select("b").count())
    there = own.select(F.col("b").alias("b2"), F.col("c").alias("c2"), F.col("k").alias("k2"), F.col("v").alias("v2"))
    return _crossed(own.select("b", "k", "v", "more"), there, of, key, kind, True)


def clusters(rows: DataFrame, key: str, vector: str, k: int, seed: int = 7) -> DataFrame:
    """Spherical k-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    x = rows.select(key, array_to_vector(F.transform(vector, lambda v: v.cast("double"))).alias("features"))
    return KMeans(k=k, seed=seed, distanceMeasure="cosine", maxIter=20).fit(x).transform(x).select(key, F.col("prediction").alias("cluster"))


def percentile_of(value: Column, background: Column) -> Column:
    """Share of the background at or below the value."""
    return F.avg((background <= value).cast("double"))




def mean_pool(states: Column, mask: Column) -> Column:
    """Unit-length mean of the hidden states (array of vectors) whose mask is not 0; zeros if none is."""
    kept = F.filter(F.arrays_zip(states.alias("s"), mask.alias("m")), lambda x: x["m"] != 0)
    size = F.size(F.get(states, F.lit(0)))
    total = F.aggregate(kept, F.array_repeat(F.lit(0.0), size), lambda acc, x: F.zip_with(acc, x["s"], lambda a, b: a + b.cast("double")))
    norm = F.sqrt(F.aggregate(total, F.lit(0.0), lambda acc, v: acc + v * v))
    return F.transform(total, lambda v: v / F.greatest(norm, F.lit(1e-12)))
