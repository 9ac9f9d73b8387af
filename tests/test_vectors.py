"""Neighbours by packed blocks."""

import numpy as np

from textloom.operators import vector


def test_rows_are_not_sent_once_a_block(spark, monkeypatch):
    monkeypatch.setattr(vector, "MOST", 16)
    v = np.random.default_rng(5).normal(size=(150, 8)).astype(np.float32)
    v[7] = v[3] = v[90]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    keys = [*range(149), 0]  # one key twice
    rows = [(k, [float(x) for x in r]) for k, r in zip(keys, v, strict=True)] + [(900, None)]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(3)
    s = np.round(v.astype(float) @ v.T.astype(float), 6)
    s[np.equal.outer(keys, keys)] = -np.inf
    for found in (vector.nearest(df, "id", "v", 20, 20), vector.nearest_pruned(df, "id", "v", 3, 3)):
        assert "explode(" not in found._jdf.queryExecution().optimizedPlan().toString()
        got = {r["id"]: (r["nn"], r["cosine"]) for r in found.collect()}
        assert len(got) == 149
        for k in range(1, 149):
            assert got[k] == (min(np.array(keys)[s[k] == s[k].max()]), s[k].max())
    assert vector.nearest(df.limit(0), "id", "v").count() == 0 and vector.nearest(df.filter("id = 5"), "id", "v").count() == 0
