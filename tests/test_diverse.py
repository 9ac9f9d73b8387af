"""The diverse selection takes every vector as a candidate."""

from textloom.operators import sample, select
from textloom.plans import catalogue


def test_no_candidate_is_left_out(spark, monkeypatch, tmp_path):
    """Candidates were drawn by ``per_cell``; of them, repeats of a token were sent each."""
    docs = [(i, " ".join(["ab", "ba", "ce"][: 1 + i % 3] * (1 + i)), "en", f"s{i % 2}", 9) for i in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    vectors = [(i, [float(i % 4 == k) + 0.01 * i for k in range(4)]) for i in range(16)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setattr(sample, "per_cell", lambda *a, **k: (_ for _ in ()).throw(AssertionError("candidates are cut")))
    seen = []
    diverse = select.diverse
    monkeypatch.setattr(select, "diverse", lambda rows, *a, **k: seen.append(rows.count()) or diverse(rows, *a, **k))
    got = catalogue.diverse_selection(spark, str(tmp_path)).collect()
    assert seen == [16] and len({r["vec_id"] for r in got}) == len(got) > 0
