"""Greedy selection over bounded candidates: one group, one task, ids and token ids only.

Each choice depends on those before, so the candidates, which the caller bounds, go to one
task.  Null and empty token arrays hold no tokens; ties fall to the smallest key; keys are
taken to be unique; no candidates give no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from textloom.functions import text as T


PER_CELL, PER_TOKEN = 2_000, 256
"""The reference's bounds of candidates: rows a cell, rows a token."""


@F.arrow_udf(StructType().add("t", ArrayType(StringType())).add("n", ArrayType(IntegerType())))
def _counted(tokens: pa.Array) -> pa.Array:
    """Distinct tokens and how often each comes."""
    kind, parts = pa.struct([("t", pa.list_(pa.string())), ("n", pa.list_(pa.int32()))]), []
    for at in range(0, len(tokens), 256):
        some = [Counter(t or ()) for t in tokens.slice(at, 256).to_pylist()]
        parts.append(pa.array([{"t": list(c), "n": list(c.values())} for c in some], kind))
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def deficits(rows: DataFrame, key: str, tokens: str, freq: DataFrame, target: float, bonus: float = 0.0) -> DataFrame:
    """key, score: what the distinct tokens of a row lack of ``target`` in all (token, n), and
    ``bonus`` targets more for each that has not been seen.  Rows without tokens score 0."""
    x = rows.select(key, F.explode_outer(F.array_distinct(tokens)).alias("token")).join(freq.select("token", "n"), "token", "left")
    n = F.coalesce("n", F.lit(0))
    part = F.greatest(F.lit(0.0), F.lit(float(target)) - n) + F.when(n == 0, F.lit(float(bonus) * target)).otherwise(0.0)
    return x.groupBy(key).agg(F.sum(F.when(F.col("token").isNotNull(), part).otherwise(0.0)).alias("score"))


def score_target(freq: DataFrame, rows: DataFrame, length: str, n: int, targets: int = 0) -> DataFrame:
    """One row, target: the tokens there will be after n more rows of mean ``length`` (above 0; 15 if
    there is none), spread over the types seen, or ``targets`` types if more, and 500 at least."""
    seen = freq.agg(F.coalesce(F.sum("n"), F.lit(1)).alias("__t"), F.count(F.lit(1)).alias("__k"))
    mean = rows.filter(F.col(length) > 0).agg(F.coalesce(F.avg(length), F.lit(15.0)).alias("__m"))
    return seen.crossJoin(mean).select(((F.col("__t") + n * F.col("__m")) / F.greatest(F.col("__k"), F.lit(max(targets, 500)))).alias("target"))  # one row each


def balance_gain(rows: DataFrame, key: str, tokens: str, held: DataFrame, target: DataFrame) -> DataFrame:
    """key, gain: for each token of a row what it adds up to the deficit (target - n held), over
    the target (1 at least), in all over the root of the row's length.  ``held``: token, n; ``target``: token, target."""
    x = rows.select(key, F.greatest(F.size(tokens), F.lit(1)).alias("len"), F.explode_outer(tokens).alias("token")).groupBy(key, "len", "token").agg(F.count("token").alias("amount"))
    x = x.join(target.select("token", "target"), "token", "left").join(held.select("token", "n"), "token", "left")
    lack = F.greatest(F.lit(0.0), F.coalesce("target", F.lit(0.0)) - F.coalesce("n", F.lit(0)))
    part = F.least(F.col("amount").cast("double"), lack) / F.greatest(F.lit(1.0), F.coalesce("target", F.lit(1.0)))
    return x.groupBy(key).agg((F.sum(part) / F.sqrt(F.max("len"))).alias("gain"))


def metadata_scores(rows: DataFrame, key: str, axes: list[str], counts: DataFrame) -> DataFrame:
    """key, novelty (mean of 1 / (1 + rows that have the label)) and scarcity (minus their sum).

    ``counts``: axis, value, n, a few labels an axis; a null label counts as unknown."""
    got = rows.select(key, *(F.coalesce(F.col(a).cast("string"), F.lit("unknown")).alias(a) for a in axes))
    for i, a in enumerate(axes):
        one = counts.filter(F.col("axis") == a).select(F.col("value").alias(a), F.col("n").alias(f"__n{i}"))
        got = got.join(one, a, "left").withColumn(f"__n{i}", F.coalesce(f"__n{i}", F.lit(0)))
    n = [F.col(f"__n{i}") for i in range(len(axes))]
    return got.select(key, (sum(1 / (1 + c) for c in n) / len(axes)).alias("novelty"), (-sum(n)).alias("scarcity"))


def rare_support(rows: DataFrame, key: str, tokens: str, rare: list[str], times: int, seed: str = "7") -> DataFrame:
    """Rows, again and again, until each rare token has been taken ``times`` times: each time the
    row with most open tokens, of those the one with the least sha256 of seed, step and key.

    key, step, required (the open tokens that it was taken for).  A token that no row holds is an
    error.  Each choice depends on those before, so the rows that hold rare tokens go in one
    group, with those tokens only; rarity bounds them.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import hashlib

        pdf = pdf.sort_values(key).reset_index(drop=True)
        has = [sorted(t) for t in pdf[tokens]]
        open_, out = dict.fromkeys(sorted(set(rare)), times), []
        while any(open_.values()):
            gain = [sum(open_[t] > 0 for t in some) for some in has]
            most = max(gain, default=0)
            if not most:
                raise ValueError(f"no row holds {', '.join(t for t, n in open_.items() if n)[:200]}")
            best = min((i for i, g in enumerate(gain) if g == most), key=lambda i: hashlib.sha256(f"{seed}:{len(out)}:{pdf[key].iloc[i]}".encode()).hexdigest())
            took = [t for t in has[best] if open_[t] > 0]
            out.append((pdf[key].iloc[best], len(out), took))
            for t in took:
                open_[t] -= 1
        return pd.DataFrame(out, columns=[key, "step", "required"])

    kind = dict(rows.dtypes)[key]
    if not rare or times <= 0:
        return rows.sparkSession.createDataFrame([], f"{key} {kind}, step int, required array<string>")
    wanted = F.array(*(F.lit(t) for t in sorted(set(rare))))
    some = rows.select(key, F.array_intersect(tokens, wanted).alias(tokens)).filter(F.size(tokens) > 0)
    some = some.unionByName(rows.sparkSession.createDataFrame([(None, [])], f"{key} {kind}, {tokens} array<string>"))  # so that the group is there, and can fail
    return some.groupBy().applyInPandas(run, f"{key} {kind}, step int, required array<string>")


def greedy_cover(pdf: pd.DataFrame, key: str, tokens: str, want: int, metadata: list[str] | None = None) -> list:
    """Rows until each token has ``want`` rows or all it can: for the open token with the fewest rows,
    the row with most open tokens, then with the least-held metadata, then with the least key."""
    names = np.unique(np.concatenate([np.asarray(list(t), object) for t in pdf[tokens]] or [np.zeros(0, object)]))
    has = np.zeros((len(pdf), len(names)), bool)
    for i, t in enumerate(pdf[tokens]):
        has[i, np.searchsorted(names, np.asarray(list(t), object))] = True
    supply = has.sum(0)
    need = np.minimum(want, supply)
    labels = [pd.factorize(pdf[c].astype(str))[0] for c in metadata or []]
    held = [np.zeros(len(pdf), np.int64) for _ in labels]
    free, chosen = np.ones(len(pdf), bool), []
    while need.any():
        target = min(np.flatnonzero(need), key=lambda t: (supply[t], t))
        rows = np.flatnonzero(has[:, target] & free)
        gain = has[rows][:, need > 0].sum(1)
        rows = rows[gain == gain.max()]
        count = sum((h[v[rows]] for h, v in zip(held, labels, strict=True)), np.zeros(len(rows), np.int64))
        best = int(rows[np.argmin(count)])
        free[best] = False
        chosen.append(best)
        need[has[best] & (need > 0)] -= 1
        supply -= has[best]
        for h, v in zip(held, labels, strict=True):
            h[v[best]] += 1
    return [pdf[key].iloc[i] for i in chosen]


def coverage_seed(rows: DataFrame, key: str, tokens: str, want: int = 1, metadata: list[str] | None = None, targets: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Rows that cover every token, or every one of ``targets``, ``want`` times; rows must be bounded
    beforehand.  ``strict``: a target that no row holds is an error; else it is passed over."""
    if targets is not None:
        wanted = F.array(*(F.lit(t) for t in sorted(set(targets)))) if targets else F.array().cast("array<string>")
        rows = rows.withColumn(tokens, F.array_intersect(tokens, wanted))
        if strict:
            held = {r["t"] for r in rows.select(F.explode_outer(tokens).alias("t")).distinct().collect()}  # targets at most
            if lacking := sorted(set(targets) - held):
                raise ValueError(f"no row holds {', '.join(lacking)[:200]}")
        rows = rows.filter(F.size(tokens) > 0)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key).reset_index(drop=True)
        return pd.DataFrame({key: greedy_cover(pdf, key, tokens, want, metadata)}).assign(step=lambda d: range(len(d)))

    got = rows.select(key, *(metadata or []), F.coalesce(F.array_distinct(tokens), F.array().cast("array<string>")).alias(tokens))
    return got.groupBy().applyInPandas(run, f"{key} {dict(rows.dtypes)[key]}, step int")


def balanced(rows: DataFrame, key: str, cell: list[str], tokens: str, n: int, target: float | None = None, snapshot: bool = False, look: int = 200, seed: int = 7, held: DataFrame | None = None, bonus: float = 0.0, targets: int = 0) -> DataFrame:
    """n rows, cells with the fewest rows first, each time the row whose tokens lack most.

    A pick looks at ``look`` rows of its cell, drawn by ``seed`` and step.  ``snapshot`` scores all cells of a round against the same counts.
    ``held`` (token, n; a vocabulary) carries the counts of earlier batches on; ``bonus`` targets
    more are given for each token not held yet.  Without a ``target`` it is ``score_target``'s.
    Rows without tokens (null or empty) score 0; a table without rows gives none.
    """
    rows = rows.withColumn(tokens, F.coalesce(tokens, F.array().cast("array<string>")))
    spark = rows.sparkSession
    held = spark.createDataFrame([], "token string, n long") if held is None else held.select("token", "n")
    if target is None:
        target = score_target(held, rows.select(F.size(tokens).alias("len")), "len", n, targets).first()["target"]
    before = {r["t"]: r["n"] for r in held.select(F.xxhash64("token").alias("t"), "n").collect()}  # a vocabulary

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key).reset_index(drop=True)
        cells: dict[tuple, list[int]] = {}
        for i, c in enumerate(pdf[cell].itertuples(index=False, name=None)):
            cells.setdefault(tuple(map(str, c)), []).append(i)
        count, held, out = dict.fromkeys(cells, 0), dict(before), []
        toks = [t.tolist() for t in pdf[tokens]]
        score = lambda i, seen: sum(max(0.0, target - seen.get(t, 0)) + bonus * target * (not seen.get(t, 0)) for t in toks[i])
        while len(out) < n and any(cells.values()):
            least = min(count[c] for c, some in cells.items() if some)
            seen = dict(held) if snapshot else held
            for c in sorted(k for k, some in cells.items() if some and count[k] == least):
                if len(out) == n:
                    break
                some = cells[c]
                if len(some) > look:
                    some = [some[i] for i in np.random.default_rng([seed, len(out)]).choice(len(some), look, replace=False)]
                best = max(some, key=lambda i: (score(i, seen), -i))
                cells[c].remove(best)
                count[c] += 1
                out.append(best)
                for t, k in zip(toks[best], pdf["__n"].iloc[best], strict=True):
                    held[t] = held.get(t, 0) + int(k)
        return pd.DataFrame({key: pdf[key].iloc[out].to_numpy(), "step": np.arange(len(out), dtype=np.int32)})

    # distinct tokens and how often each comes: a text's repeats are counted where it is, and not sent
    x = rows.select(key, *cell, F.explode_outer(tokens).alias("__t")).groupBy(key, *cell, "__t").agg(F.count("__t").alias("__k"))
    per = F.collect_list(F.when(F.col("__k") > 0, F.struct(F.xxhash64("__t").alias("t"), F.col("__k").cast("int").alias("n"))))
    rows = x.groupBy(key, *cell).agg(F.array_sort(per).alias("__p")).select(key, *cell, F.col("__p.t").alias(tokens), F.col("__p.n").alias("__n"))
    return rows.groupBy().applyInPandas(run, f"{key} {dict(rows.dtypes)[key]}, step int")


def diverse(rows: DataFrame, key: str, tokens: str, vector: str, cluster: str, n: int, floor: int = 5, limit: float | None = None, cap: int = 7, weights: tuple[float, float, float] = (0.6, 0.35, 0.05), metadata: list[str] | None = None, root: str | None = None, rates: tuple[float, ...] = (0.02, 0.01, 0.005), power: float = 0.5, seed: int = 7) -> DataFrame:
    """Rare support first, then clusters in turn; at most n rows, fewer if the rest is too near.

    Support: each token in ``floor`` rows or all it can, the open token with the fewest rows first, and of
    its rows the one of the highest priority (sum of 1 / sqrt(rows with the token) / sqrt(length));
    these rows may be near others.  Then the clusters take turns up to ``cap`` rows, one more a level.
    A row is open while its greatest cosine to the chosen is within the step of the ladder: the upper
    tails ``rates`` of cosines of random pairs, strictest first, or ``limit`` alone.  Rows beyond it wait for
    the next step.  A row whose ``root`` (near-duplicate text) is chosen is blocked.  Gain: what a row
    gives of the deficits to the tempered target, over the target and the root of its length; novelty: share
    of random pairs with a greater cosine; metadata: mean of 1 / (1 + rows with the value).
    All rows are candidates; one task holds their vectors and counted distinct tokens.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key).reset_index(drop=True)
        m = len(pdf)
        x = np.stack(pdf[vector].map(np.asarray)).astype(np.float32)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        pairs = np.random.default_rng(seed).integers(0, m, (100_000, 2))
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        background = np.sort(np.concatenate([(x[p[:, 0]] * x[p[:, 1]]).sum(1) for p in np.array_split(pairs, 20)])) if len(pairs) else np.zeros(1, np.float32)
        ladder = [limit] if limit is not None else sorted(np.quantile(background, [1 - r for r in rates]))
        owner = np.repeat(np.arange(m), pdf[tokens].map(len).to_numpy())
        names, token = np.unique(np.concatenate([np.asarray(t, np.int64) for t in pdf[tokens]]), return_inverse=True)
        amount = np.concatenate([np.asarray(n, np.int64) for n in pdf["__n"]])
        size = np.bincount(owner, amount, m).astype(np.int64)
        order = np.lexsort((token, owner))
        token, amount = token[order], amount[order]
        del pdf[tokens], pdf["__n"]
        start = np.searchsorted(owner, np.arange(m + 1))
        of = np.argsort(token, kind="stable")
        at = np.searchsorted(token[of], np.arange(len(names) + 1))
        df = np.diff(at)
        root_len = np.sqrt(np.maximum(size, 1))
        priority = np.bincount(owner, 1 / np.sqrt(df[token]), m) / root_len
        freq = np.bincount(token, amount, len(names))
        target = freq**power / max((freq**power).sum(), 1e-9) * n * (size.mean() if m else 0)
        held, has = np.zeros(len(names)), np.zeros(len(names), np.int64)
        labels = [pd.factorize(pdf[c].astype(str))[0] for c in metadata or []]
        count = [np.zeros(m, np.int64) for _ in labels]
        roots = pd.factorize(pdf[root].astype(str))[0] if root else np.arange(m)
        clusters = pdf[cluster].to_numpy()
        used = dict.fromkeys(np.unique(clusters), 0)
        free, near, out = np.ones(m, bool), np.full(m, -1.0, np.float32), []

        def take(i: int) -> None:
            out.append(i)
            free[roots == roots[i]] = False
            used[clusters[i]] += 1
            np.maximum(near, x @ x[i], out=near)
            mine = slice(start[i], start[i + 1])
            held[token[mine]] += amount[mine]
            has[token[mine]] += 1
            for c, v in zip(count, labels, strict=True):
                c[v[i]] += 1

        chosen = np.zeros(m, bool)
        for t in sorted(range(len(names)), key=lambda t: (df[t], t)):
            mine = owner[of[at[t] : at[t + 1]]]
            while has[t] < min(floor, df[t]) and len(out) < n:
                some = mine[~chosen[mine]]
                some = some[free[some]] if free[some].any() else some  # support comes before nearness and roots
                best = int(some[np.argmax(priority[some])])
                chosen[best] = True
                take(best)
        for most in ladder:
            level, idle = cap, False
            while len(out) < n and not idle:
                any_ = False
                for c in sorted(used):
                    open_ = np.flatnonzero(free & (clusters == c) & (near <= most))
                    if len(out) == n or used[c] >= level or not len(open_):
                        continue
                    lack = np.maximum(target - held, 0)
                    part = np.minimum(amount, lack[token]) / np.maximum(target[token], 1)
                    gain = np.bincount(owner, part, m)[open_] / root_len[open_]
                    novel = 1 - np.searchsorted(background, near[open_], "right") / len(background)
                    meta = np.mean([1 / (1 + k[v[open_]]) for k, v in zip(count, labels, strict=True)], 0) if labels else np.zeros(len(open_))
                    take(int(open_[np.argmax(weights[0] * gain + weights[1] * novel + weights[2] * meta)]))
                    any_ = True
                level += 1
                idle = not any_ and not any(used[c] >= level - 1 and (free & (clusters == c) & (near <= most)).any() for c in used)
        return pd.DataFrame({key: pdf[key].iloc[out].to_numpy(), "step": np.arange(len(out), dtype=np.int32)})

    rows = rows.filter(F.col(vector).isNotNull())  # a row without a vector can't be placed
    # a text's repeats are counted where it is, and not sent
    rows = rows.withColumn("__c", T.once(_counted(tokens)))
    got = rows.select(key, F.transform("__c.t", lambda t: F.xxhash64(t)).alias(tokens), F.col("__c.n").alias("__n"), vector, cluster, *(metadata or []), *([root] if root else []))
    return got.groupBy().applyInPandas(run, f"{key} {dict(rows.dtypes)[key]}, step int")
