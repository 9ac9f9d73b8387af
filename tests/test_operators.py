import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import analysis, annotate, corpus, jobs, near, qc, report, sample, select, stats, vector
from textloom.plans import catalogue
from textloom.profile import DEVA, Profile
from textloom.sources import readers, sinks
from textloom.streaming import state

SMALL = Profile("deva", DEVA.letters, "।", "।!?", ("न", "े", "प", "ा", "ल", "क", "ख", "ग", "घ"))
TWO = [("a", "नेपाल"), ("a", "नेपाल"), ("a", "क"), ("a", ""), ("a", None), ("b", "<p>नेपाल</p>"), ("b", "ख"), ("b", "क")]


def test_two_corpora(spark):
    rows = spark.createDataFrame(TWO, "c string, t string").withColumn("x", T.normalize(F.col("t"), SMALL)).filter("x <> ''").withColumn("hash", T.text_hash(F.col("x")))
    assert rows.count() == 6 and corpus.priority_union(rows, "c").count() == 3
    got = {r["corpus"]: r for r in corpus.contribution(rows, "c").collect()}
    assert (got["a"]["n_within"], got["b"]["n_retained"], got["a"]["n_exclusive"], got["b"]["n_exclusive"]) == (1, 1, 0, 1)
    both = corpus.overlap(rows, "c").first()
    assert (both["n_both"], both["n_union"]) == (2, 3)
    tokens = rows.select(T.tokenize(F.col("x"), SMALL).alias("tokens"))
    assert stats.token_frequency(tokens, []).count() == 7


def test_pool(spark):
    docs = spark.createDataFrame([(1, "a", "क क क क क। ख ख ख ख ख"), (2, "a", "ग ग ग ग ग"), (3, "b", "क क क क क"), (4, "b", "घ घ घ घ घ")], "doc_id long, source string, text string").withColumn("lang", F.lit("ne"))
    rows = corpus.measured(corpus.sentences(docs, SMALL, raw_first=True), SMALL)
    assert rows.filter("n_tokens >= 5").count() == 5
    union = corpus.priority_union(rows.withColumn("hash", T.text_hash(F.col("sentence"))), "source")
    assert union.count() == 4 and union.filter("copies = 2").first()["corpora"] == ["a", "b"]


def test_distribution_identities(spark):
    rows = [("u", t, 10) for t in "abc"] + [("s", "a", 28), ("s", "b", 1), ("s", "c", 1)]
    freq = spark.createDataFrame(rows, "k string, token string, n long")
    got = {r["k"]: r for r in stats.distribution(freq, ["k"]).collect()}
    assert got["u"]["entropy_share"] == 1.0 and got["u"]["gini"] == 0.0
    assert got["s"]["entropy_share"] < 1 and got["s"]["gini"] > 0
    uniform = freq.filter("k = 'u'")
    assert stats.divergence(uniform, uniform.select("token", "n"), ["k"]).first()["jsd"] == 0.0
    assert stats.rarity(spark.createDataFrame([("x", "a", 1), ("x", "b", 4), ("x", "c", 12)], "k string, token string, n long"), ["k"]).first()["below_5"] == 2


def test_same_result_for_any_partitioning(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("cell"))
    a, b = (sorted(map(tuple, sample.per_cell(rows.repartition(n), ["cell"], 3, "doc_id").collect())) for n in (1, 8))
    assert a == b and len(a) == 21
    many = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("cell"))
    top = sample.per_cell(many, ["cell"], 1001, "doc_id").collect()
    import hashlib

    first = sorted(range(0, 6000, 2), key=lambda i: hashlib.sha256(f"7:{i}".encode()).hexdigest())[:1001]
    assert sorted((r["rank"], r["doc_id"]) for r in top if r["cell"] == 0) == list(enumerate(first, 1))
    ids = [sorted(map(tuple, sinks.numbered(rows.repartition(n), ["doc_id"], "i", "pool_").collect())) for n in (1, 8)]
    assert ids[0] == ids[1] and ids[0][-1][2] == "pool_00001999"


def test_selection(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(36, 16))
    rows = [(i, ["क", "कखग"[i % 3]], [float(x) for x in v[i]], i % 4, f"c{i % 3}") for i in range(36)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, v array<double>, cluster int, cell string")
    got = select.diverse(df, "id", "tokens", "v", "cluster", 10, floor=2, limit=0.9999, cap=3).collect()
    assert len({r["id"] for r in got}) == 10
    chosen = [rows[r["id"]][1] for r in got]
    assert all(sum(t in c for c in chosen) >= 2 for t in "कखग")
    cover = select.coverage_seed(df, "id", "tokens").collect()
    assert {t for r in cover for t in rows[r["id"]][1]} == set("कखग")
    for snapshot in (False, True):
        cells = [rows[r["id"]][4] for r in select.balanced(df, "id", ["cell"], "tokens", 9, 20.0, snapshot).collect()]
        assert sorted(cells) == ["c0"] * 3 + ["c1"] * 3 + ["c2"] * 3


def test_numbers_have_no_gaps_where_ranges_are_merged(spark):
    """Columns beside the order make ranges larger, so adaptive execution merges fewer of them."""
    conf = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("more"))
        got = sinks.numbered(rows.repartition(4), ["doc_id"], "i", "", 1).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted((r["doc_id"], int(r["i"])) for r in got) == [(i, i) for i in range(20_000)]


def test_candidates_of_selections(spark, tmp_path):
    """Best rows are found among many: neither five rows a cell nor the shortest rows of a token bound them."""
    words = [a + b for a in "bdfgkl" for b in "aeiou"]
    texts = [words[i % 30] for i in range(400)] + [" ".join(words)]
    rows = [(i, x, "en", "s", len(x)) for i, x in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, [float(i == k) + 0.1 for k in range(8)], 0) for i in range(8)], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert [r["doc_id"] for r in catalogue.coverage_seed(spark, str(tmp_path)).collect()] == [400]
    assert 400 in [r["doc_id"] for r in catalogue.balanced_selection(spark, str(tmp_path)).collect()]
    assert catalogue.balanced_selection(spark, str(tmp_path)).count() == 100
    assert catalogue.diverse_selection(spark, str(tmp_path)).count() == 8


def test_cover_takes_the_rarest_token_first():
    pdf = pd.DataFrame({"id": [0, 1, 2, 3], "tokens": [["a", "b", "c"], ["z", "a"], ["a", "b", "c"], ["b", "c"]], "m": ["x", "x", "x", "y"]})
    assert select.greedy_cover(pdf, "id", "tokens", 1, ["m"]) == [1, 3]


def test_diverse_leaves_near_duplicates(spark):
    """Copies of a vector and rows of a chosen root are not taken to reach n; metadata breaks ties."""
    e = np.eye(12)
    rows = [(i, ["a", "b"], [float(y) for y in e[i % 6]], 0, "xy"[i >= 6], i % 6) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>, v array<double>, cluster int, m string, root long")
    got = [r["id"] for r in select.diverse(df, "id", "tokens", "v", "cluster", 10, floor=1, limit=0.9, metadata=["m"]).collect()]
    assert len(got) == 6 and len({i % 6 for i in got}) == 6 and {i >= 6 for i in got} == {False, True}
    got = [r["id"] for r in select.diverse(df, "id", "tokens", "v", "cluster", 10, floor=1, limit=2.0, root="root").collect()]
    assert len(got) == 6


def test_shortlist_fails_when_tops_exceed_the_limit(spark):
    rows = spark.createDataFrame([(i, [f"t{i}"], float(i)) for i in range(6)], "id long, tokens array<string>, priority double")
    assert sample.shortlist(rows, "tokens", "id", 1, 6).count() == 6
    got = sample.shortlist(rows.union(spark.createDataFrame([(9, ["t0"], -1.0)], rows.schema)), "tokens", "id", 1, 6).collect()
    assert sorted(r["id"] for r in got) == list(range(6))
    with pytest.raises(Exception, match="more than 5 rows"):
        sample.shortlist(rows, "tokens", "id", 1, 5).collect()


def test_speaker_split_is_disjoint(spark):
    rows = spark.createDataFrame([(f"s{i // 2}", i) for i in range(24)], "speaker string, u long")
    got = sample.speaker_split(rows, "speaker").collect()
    assert len(got) == 12 and len({r["speaker"] for r in got}) == 12 and {r["split"] for r in got} == {"train", "dev", "test"}
    bins = [r["bin"] for r in sample.budget_bins(spark.createDataFrame([(i, 4) for i in range(5)], "id long, n long"), "n", "id", 10).orderBy("id").collect()]
    assert bins == [0, 0, 1, 1, 2]


def test_neighbours_in_blocks(spark):
    v = np.random.default_rng(11).normal(size=(120, 12))
    v[1] = v[0] + 1e-4
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, v array<double>")
    s = np.round(v @ v.T, 6) - 2 * np.eye(120)
    for most in (1000, 10):
        got = {r["id"]: r["nn"] for r in vector.nearest(df, "id", "v", block=32, most=most).collect()}
        assert [got[i] for i in range(120)] == s.argmax(1).tolist()


def test_annotation(spark):
    rules = {"tense": {"past": ["थिय"], "present": ["छ$"], "future": ["नेछ"]}, "polarity": {"negative": ["छैन"], "positive": ["राम्रो"]}, "gender": {"feminine": ["उनी"], "masculine": ["ऊ"]}, "sector": {"formal": ["ऐन"], "conversational": ["यार"], "sports": ["खेल"], "health": ["रोग"]}}
    rows = spark.createDataFrame([("राम्रो खेल खेल थियो", "news"), ("रोग छैन यार", "news"), ("उनी आउने छ", None)], "t string, hint string")
    got = [tuple(r)[2:] for r in annotate.annotate(rows, "t", "hint", rules).collect()]
    assert got == [("past", "positive", "neutral", "sports"), ("present", "negative", "neutral", "conversational"), ("present", "neutral", "feminine", "news")]


def test_quality_control(spark):
    rows = spark.createDataFrame([(1, True, 0.1, 0.1, 1.0), (2, False, 0.5, 0.1, 0.5)], "id long, cpu_ok boolean, cer double, wer double, recall double")
    got = {r["id"]: r["reasons"] for r in qc.acceptance(rows, 0.2, 0.2, 0.9).collect()}
    assert got == {1: [], 2: ["cpu", "cer", "recall"]}
    rates = qc.corpus_rates(spark.createDataFrame([("क ख ग", "क ख घ"), ("", "")], "r string, h string"), "r", "h").first()
    assert rates["cer"] == 0.2 and rates["wer"] == 0.25
    left = spark.createDataFrame([("x",), ("y",), ("z",)], "k string")
    right = spark.createDataFrame([("x", "t"), ("y", " ")], "k string, t string")
    assert {r["k"]: r["reason"] for r in qc.align(left, right, "k", "t").collect()} == {"x": None, "y": "empty_transcript", "z": "missing"}


def test_readers(spark, tmp_path):
    assert readers.parse_paragraphs("header<p>पहिलो <b>अनुच्छेद</b></p><p>दोस्रो अनुच्छेद</p>") == ["पहिलो  अनुच्छेद", "दोस्रो अनुच्छेद"]
    page = spark.createDataFrame([(1, "x<P a>one\ntwo</p><p>three</p><p>open")], "id long, html string")
    assert [r["text"] for r in readers.paragraphs_by_pattern(page, "html", ["id"]).orderBy("pos").collect()] == ["one\ntwo", "three"]
    assert readers.paragraphs(page.withColumn("html", F.lit("<p>a</p>")), "html", ["id"]).first()["text"] == "a"
    (tmp_path / "a.jsonl").write_text('{"text": "a"}\n\n{"text": null}\n')
    assert readers.read(spark, "jsonl", str(tmp_path / "a.jsonl"), schema="text string").count() == 3
    (tmp_path / "b.txt").write_text("title\nx/१२\ny\r\n")
    assert [r["text"] for r in readers.book(spark, str(tmp_path / "b.txt"), skip=((1, 1),)).orderBy("line").collect()] == ["x", "y"]
    (tmp_path / "s.tsv").write_text("file_id\tspeaker_id\ttext\nf\ts\tone\ttwo\n")
    assert tuple(readers.speakers(spark, str(tmp_path / "s.tsv")).first()) == ("f", "s", "one\ttwo")
    sinks.index(spark.createDataFrame([("k", "a b")], "k string, v string"), "k", "v", str(tmp_path / "i"))
    assert tuple(readers.index(spark, str(tmp_path / "i")).first()) == ("k", "a b")
    assert sinks.manifest(spark, str(tmp_path / "i")).count() >= 1


def test_stream_state(spark, tmp_path):
    src, st, ck = (str(tmp_path / x) for x in ("in", "state", "ck"))
    for _ in range(2):
        spark.createDataFrame([("क ख क",)], "text string").write.mode("append").parquet(src)
        state.follow(spark, src, "text string", st, ck, SMALL).awaitTermination()
    assert {r["token"]: r["n"] for r in state.totals(spark, st).collect()} == {"क": 4, "ख": 2}


def test_near_representatives(spark):
    """Against the sequential definition, where similar texts are similar enough to share a band."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(400)]
    rows = []
    for group in range(12):
        base = [str(w) for w in rng.choice(words, 60)]
        for _ in range(8):
            w = list(base)
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(0, 60))] = str(rng.choice(words))
            rows.append((len(rows), "  ".join(w), int(rng.integers(0, 4))))
    rows += [(len(rows) + i, x, None) for i, x in enumerate(["", None, " ", "ab", "ab", "नेपालको सुन्दर प्राकृतिक वातावरण सबैका लागि महत्वपूर्ण छ", "नेपालको सुन्दर प्राकृतिक वातावरण सबैका लागि महत्वपूर्ण छन्"])]
    df = spark.createDataFrame(rows, "id long, text string, score int").repartition(5)
    got = {r["id"]: r for r in near.representatives(df, "id", "text", "score").collect()}
    assert len(got) == len(rows)
    text, score = {}, {}
    for i, x, s in rows:
        h = got[i]["hash"]
        text[h], score[h] = " ".join((x or "").split()), max(score.get(h, 0), s or 0)
    grams = lambda x: {x[i : i + 5] for i in range(max(1, len(x) - 4))}
    like = lambda a, b: (lambda p, q: len(p & q) / len(p | q))(grams(text[a]), grams(text[b]))
    kept: list[str] = []
    for h in sorted(text, key=lambda h: (-score[h], h)):
        if not any(like(h, k) >= 0.85 for k in kept):
            kept.append(h)
    assert {r["hash"] for r in got.values() if not r["near_duplicate"]} == set(kept) and len(kept) < len(text)
    assert all(like(r["hash"], r["representative"]) >= 0.85 for r in got.values())
    assert near.representatives(df.limit(0), "id", "text", "score").count() == 0


def test_a_bucket_of_different_texts_takes_few_rounds(spark, monkeypatch):
    """All in one bucket and none similar: one after the other would take as many rounds as texts."""
    one = F.udf(lambda text: [1], "array<long>")
    tables, rounds = near.settled, []
    monkeypatch.setattr(near, "band_keys", one)
    monkeypatch.setattr(near, "settled", lambda rows, name: rounds.append(name) or tables(rows, name))
    texts = spark.createDataFrame([(i, " ".join(chr(97 + (i * 7 + k * k) % 26) * (3 + i % 5) + str(i * k) for k in range(30)), 1) for i in range(24)], "id long, text string, score int")
    assert not any(r["near_duplicate"] for r in near.representatives(texts, "id", "text", "score").collect())
    assert len(rounds) < 48


def test_acceptance_of_a_selection(spark):
    rows = spark.createDataFrame([("x", ["a", "b"]), ("y", ["a", "a"])], "hash string, tokens array<string>")
    count = lambda **n: spark.createDataFrame(list(n.items()), "token string, n long")
    vocabulary = spark.createDataFrame([("a",), ("b",), ("c",)], "token string")
    good = report.invariants(rows, "hash", "tokens", count(a=3, b=1), count(a=9, b=1, z=4), vocabulary, 2, floor=2)
    assert all(good.values()) and len(good) == 6
    bad = report.invariants(rows, "hash", "tokens", count(a=2), count(a=9, b=3, c=1), vocabulary.filter("token <> 'a'"), 3, floor=2)
    assert not any(bad.values())
    better = report.improvements(count(a=5, b=5), count(a=9, b=1, q=7), count(a=1, b=1), vocabulary, (0.4, 0.5), (0.6, 0.5))
    assert better == {"entropy": True, "gini": True, "divergence": True, "median_similarity": True, "p95_similarity": False}
    with pytest.raises(ValueError):
        report.improvements(count(a=1), count(q=1), count(a=1), vocabulary, (0, 0), (0, 0))


def test_voice_scores(spark):
    voices = {"F1": ("female", [1.0, 0.0], 0.05), "F2": ("female", [0.9, 0.1], 0.08), "M1": ("male", [0.0, 1.0], 0.06), "M2": ("male", [-1.0, 0.0], 0.05)}
    rows = [(v, g, c, 1.0, True, e) for v, (g, e, c) in voices.items() for _ in range(2)]
    got = {r["v"]: r for r in report.voice_scores(spark.createDataFrame(rows, "v string, g string, cer double, r double, p boolean, e array<double>"), "v", "g", "cer", "r", "p", "e").collect()}
    assert sum(r["rank"] == 1 for r in got.values()) == 2 and got["F1"]["rank"] == 1
    cosine = 0.9 / np.hypot(0.9, 0.1)
    assert abs(got["F1"]["separation"] - (1 - cosine)) < 1e-9 and got["M2"]["median_cer"] == 0.05


def test_run_documents(spark, tmp_path):
    log, doc = str(tmp_path / "log.md"), str(tmp_path / "report.json")
    for body in ("one", "one", r"two \\1"):
        report.run_log(spark, log, "r1", body)
    report.run_log(spark, log, "r2", "other")
    content = report.read_text(spark, log)
    assert content.count("run:r1:start") == 1 and "two" in content and "one" not in content and content.count("run:r2:end") == 1
    report.json_document(spark, doc, {"b": 1, "a": "é"})
    assert report.read_text(spark, doc) == '{\n  "a": "é",\n  "b": 1\n}\n'


def test_wav_metrics_and_results(spark, tmp_path):
    import wave

    (tmp_path / "a").mkdir()
    with wave.open(str(tmp_path / "a" / "tone.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(16000)
        w.writeframes(np.concatenate((np.zeros(800), np.full(1000, 16384), np.zeros(1600), np.full(400, 16384), np.zeros(200))).astype("<i2").tobytes())
    r = readers.wav_metrics(spark, str(tmp_path / "a")).first()
    assert (r["frames"], r["rate"], r["channels"], r["bits"], r["duration"], r["peak"], r["clipping"]) == (4000, 16000, 1, 16, 0.25, 0.5, 0.0)
    assert (r["lead"], r["gap"], r["trail"]) == (0.05, 0.1, 0.0125)
    m = readers.wav_metrics(spark, str(tmp_path / "a"))
    assert m.filter(qc.structural(m)).count() == 1 and m.filter(qc.structural(m, rate=8000)).count() == 0
    (tmp_path / "q" / "deep").mkdir(parents=True)
    (tmp_path / "q" / "deep" / "x.jsonl").write_text('{"job_id": "j1", "cer": 0.1}\n')
    assert [tuple(r) for r in readers.results(spark, str(tmp_path / "q"), "job_id string, cer double").collect()] == [("j1", 0.1)]
    spark.createDataFrame([("j2", 0.2)], "job_id string, cer double").write.parquet(str(tmp_path / "q" / "p"))
    assert [r["job_id"] for r in readers.results(spark, str(tmp_path / "q"), "job_id string, cer double").collect()] == ["j2"]


def test_speech_jobs(spark):
    voices = [("F1", "female"), ("F2", "female"), ("M1", "male"), ("M2", "male")]
    texts = spark.createDataFrame([(f"u{i}", "news" if i else "sports", ["ne"] if i < 2 else []) for i in range(6)], "uid string, sector string, rare array<string>")
    assert jobs.audition(texts, "uid", "sector", voices).select("job_id").distinct().count() == 24
    full = jobs.canonical(texts.repartition(3), "uid", "sector", voices, "full").cache()
    assert [r["voice"] for r in full.orderBy("uid").collect()] == ["F1", "F2", "M1", "M2", "F1", "F2"]
    assert {r["uid"]: r["style"] for r in full.collect()}["u0"] == "conversational"
    supports = spark.createDataFrame([(0, "u0", ["ne"], "news"), (1, "u1", ["ne"], "news"), (2, "u1", ["ne"], "news"), (3, "u5", [], "news")], "n int, uid string, need array<string>, sector string")
    more = jobs.extra(supports, "n", "uid", "need", full, "rare", "sector", voices).orderBy("n").collect()
    # ne was spoken by F1 and F2; M1 and M2 are fresh; then the text's unused voices by use, name
    assert [(r["voice"], r["style"]) for r in more] == [("M1", "neutral"), ("M2", "neutral"), ("F1", "neutral"), ("F1", "neutral")]
    requests = spark.createDataFrame([("u1", 1, "full_u1"), ("u1", 2, "x")], "uid string, attempt int, failed_job_id string")
    got = {r["job_id"]: (r["voice"], r["style"], r["realisation"]) for r in jobs.again(requests, full, "uid", "rare", "sector", voices).collect()}
    assert got == {"regen1_u1": ("M1", "neutral", "regeneration_1"), "regen2_u1": ("M2", "neutral", "regeneration_2")}
    assert jobs.requested(requests, requests.unionByName(requests), ["uid", "attempt"]).count() == 2
    with pytest.raises(Exception, match="not enough voices"):
        jobs.extra(supports, "n", "uid", "need", full, "rare", "sector", voices[:1]).collect()


def test_checks_of_results(spark):
    new = spark.createDataFrame([("a", "1", 0.1), ("b", "1", 0.1), ("c", "2", 0.1), ("d", "1", 0.1), ("d", "1", 0.1), ("e", "1", 0.2)], "job string, sum string, cer double")
    known = spark.createDataFrame([("a", 0.1), ("e", 0.1)], "job string, cer double")
    planned = spark.createDataFrame([(j, "1") for j in "acde"], "job string, sum string")
    assert {r["job"]: r["fault"] for r in qc.import_faults(new, planned, known, "job", "sum", ["cer"]).collect()} == {"b": "unknown", "c": "checksum", "d": "repeated", "e": "conflict"}
    assert qc.same_keys(known, known, "job") and not qc.same_keys(known, planned, "job")
    rows = spark.createDataFrame([(1, ["a", "a", "b", "c"], ["a", "b", "b"]), (2, ["a"], [])], "id int, r array<string>, h array<string>")
    assert tuple(qc.clipped_recall(rows, "id", "r", "h", ["a", "b"]).first())[:2] == (2, 4)
    said = spark.createDataFrame([("train", "s1", 1800.0), ("train", "s2", 1800.0), ("dev", "s2", 36.0)], "split string, speaker string, sec double")
    assert {tuple(r) for r in qc.split_summary(said, "split", "speaker", "sec").collect()} == {("train", 2, 2, 1.0), ("dev", 1, 1, 0.01)}
    assert [tuple(r) for r in qc.shared_speakers(said, "split", "speaker").collect()] == [("s2", ["dev", "train"])]
    pooled = spark.createDataFrame([([[3.0, 0.0], [0.0, 4.0], [9.0, 9.0]], [1, 1, 0])], "s array<array<float>>, m array<int>").select(vector.mean_pool(F.col("s"), F.col("m")).alias("v")).first()["v"]
    assert np.allclose(pooled, [0.6, 0.8])
    build = spark.createDataFrame([(["a"], "x"), (["b"], "y")], "t array<string>, ax string")
    targets = spark.createDataFrame([("a",), ("b",)], "token string")
    assert all(report.build_gates(build, "t", targets, ["ax"], 2).values()) and not any(report.build_gates(build.filter("ax = 'x'").unionByName(build.filter("ax = 'x'")).unionByName(build.select(F.array(F.lit("a")).alias("t"), "ax")), "t", targets, ["ax"], 2).values())


def test_targets_vocabulary_and_sources(spark, tmp_path):
    put = lambda name, content: ((tmp_path / name).write_text(content), str(tmp_path / name))[1]
    tokens = lambda path: {r["token"] for r in readers.coverage_targets(spark, path, {"?"}).collect()}
    assert tokens(put("a.json", '["x", "?", "y"]')) == tokens(put("b.json", '{"syllables": ["y", "x"]}')) == tokens(put("c.json", '{"syllable_sentence_frequency": {"x": 1, "y": 2}}')) == tokens(put("d.txt", "x\n\n y \n?\n")) == {"x", "y"}
    for bad in ('["?"]', "3", "[]"):
        with pytest.raises(ValueError):
            readers.coverage_targets(spark, put("bad.json", bad), {"?"})
    assert sorted(readers.vocabulary(spark, put("v.txt", "a\n \n\nb\n"))) == [" ", "a", "b"]
    spark.range(3).write.parquet(str(tmp_path / "p"))
    info = readers.validated(spark, "ids", "parquet", str(tmp_path / "p"), ("id",))
    assert info["files"] >= 1 and info["bytes"] > 0
    with pytest.raises(ValueError):
        readers.validated(spark, "ids", "parquet", str(tmp_path / "p"), ("text",))
    with pytest.raises(FileNotFoundError):
        readers.validated(spark, "ids", "text", str(tmp_path / "none"))


def test_text_lines_are_numbered_over_splits(spark, tmp_path):
    want = []
    for name, n in (("a.txt", 5000), ("b.txt", 3)):
        lines = [f"{name} {i} " + "x" * (i % 40) for i in range(n)]
        (tmp_path / name).write_bytes("\r\n".join(lines).encode() + (b"\n" if n == 3 else b""))
        want += [(name, i + 1, x) for i, x in enumerate(lines)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        got = readers.text_lines(spark, str(tmp_path)).collect()
        first = readers.read(spark, "text_lines", str(tmp_path), limit=5002).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["file"].rsplit("/", 1)[1], r["line"], r["text"]) for r in got) == want
    assert sorted((r["file"].rsplit("/", 1)[1], r["line"]) for r in first) == [w[:2] for w in want[:5002]]


def test_more_readers(spark, tmp_path):
    put = lambda name, content: ((tmp_path / name).write_text(content), str(tmp_path / name))[1]
    assert readers.jsonl(spark, put("a.jsonl", '{"text": "a"}\n \t\n{"text": "b"}\n'), "text string", keep_blank=False).count() == 2
    assert [r["text"] for r in readers.jsonl(spark, str(tmp_path / "a.jsonl"), "text string", limit=2).collect()] == ["a", None]
    with pytest.raises(Exception):  # noqa: B017
        readers.jsonl(spark, put("bad.jsonl", "{nothing"), "text string").collect()
    assert [r["text"] for r in readers.stripped_lines(spark, put("t.txt", " a \n\t\n b\tc\n")).orderBy("line").collect()] == ["a", "b\tc"]
    assert {r["hash"] for r in readers.hashes(spark, put("h.txt", "x 1\n\n y\nx 2\n")).collect()} == {"x", "y"}
    assert readers.hashes(spark, str(tmp_path / "none")).count() == 0
    assert [r["text"] for r in readers.read(spark, "html_paragraphs", put("p.html", "<p>one</p><p>two</p>"), limit=1).collect()] == ["one"]
    with pytest.raises(ValueError, match="no paragraphs"):
        readers.html_paragraphs(spark, put("q.html", "<div>x</div>"))
    with pytest.raises(Exception, match="three fields"):
        readers.speakers(spark, put("s.tsv", "a\tb\n")).collect()
    assert [tuple(r) for r in readers.speakers(spark, put("s2.tsv", "a\ts\tx\nfile_id\ts\ty\n \ts\tz\n\n")).orderBy("file_id").collect()] == [("a", "s", "x"), ("file_id", "s", "y")]
    for name in ("train-2", "train-1", "test-1"):
        spark.createDataFrame([(f"{name} {i}", "web") for i in range(3)], "Article string, Source string").coalesce(1).write.parquet(str(tmp_path / "one"))
        next((tmp_path / "one").glob("part-*")).rename(tmp_path / f"{name}.parquet")
        __import__("shutil").rmtree(tmp_path / "one")
    (tmp_path / "train-0.parquet").write_bytes(b"torn")
    assert {r["text"][:7] for r in readers.articles(spark, str(tmp_path), "train").collect()} == {"train-1", "train-2"}
    assert [tuple(r) for r in readers.articles(spark, str(tmp_path), "train", shards=2, limit=2).collect()] == [("train-1 0", "web"), ("train-1 1", "web")]
    with pytest.raises(FileNotFoundError):
        readers.articles(spark, str(tmp_path), "dev")


def test_configured_corpora(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"body": "x", "site": 1}\n\n')
    (tmp_path / "b.txt").write_text("y\nz\n")
    (tmp_path / "c.yaml").write_text("corpora:\n- {name: A, slug: a, kind: jsonl, path: a.jsonl, text_column: body, metadata_columns: {source: site}, other: 1}\n- {name: B, slug: b, kind: text_lines, path: b.txt}\n")
    found = readers.load_corpora(spark, str(tmp_path / "c.yaml"))
    rows = readers.union_in_order([(c.slug, c.rows(spark, str(tmp_path))) for c in found])
    assert sorted((r["corpus"], r["text"] or "", r["prio"], str(r["metadata"])) for r in rows.collect()) == [("a", "", 0, "{'source': None}"), ("a", "x", 0, "{'source': '1'}"), ("b", "y", 1, "{}"), ("b", "z", 1, "{}")]
    one = {"name": "A", "slug": "a", "kind": "jsonl", "path": "x"}
    for bad in ({}, {"corpora": []}, {"corpora": [{"name": "A"}]}, {"corpora": [one, one]}, {"corpora": [one | {"kind": "odd"}]}):
        with pytest.raises(ValueError):
            readers.corpora(bad)


def test_two_corpora_side_by_side(spark):
    rows = spark.createDataFrame([*TWO, (None, "क")], "c string, t string")
    rec = analysis.records(rows, SMALL, "c", "t")
    got = {r["view"]: r for r in analysis.counts(rec).collect()}
    assert [(r["input"], r["usable"], r["empty"], r["rejected"]) for r in (got["a"], got["b"], got["source_native"], got["deduplicated"], got[None])] == [(5, 3, 1, 1), (3, 3, 0, 0), (9, 7, 1, 1), (3, 3, 0, 0), (1, 1, 0, 0)]
    freq = analysis.frequencies(rec)
    assert {r["token"]: r["n"] for r in freq.filter("view = 'deduplicated'").collect()} == dict.fromkeys("न े प ा ल क ख".split(), 1)
    assert analysis.same_tokens([freq.filter("view = 'source_native'"), freq.filter("view = 'deduplicated'")]) and not analysis.same_tokens([freq.filter("view = 'a'"), freq.filter("view = 'b'")])
    vocabulary = spark.createDataFrame([(v,) for v in SMALL.vocabulary], "token string")
    line = {r["token"]: r for r in analysis.comparison(freq, vocabulary).collect()}
    assert (line["न"]["native"], line["न"]["deduplicated"], line["न"]["removed"], line["ग"]["native"]) == (3, 1, 2, 0) and len(line) == 9
    s = {r["view"]: r for r in analysis.summary(freq, vocabulary).collect()}
    assert (s["deduplicated"]["types"], s["deduplicated"]["unobserved"], s["deduplicated"]["hapax"], s["deduplicated"]["gini"]) == (7, 2, 7, 0.0)
    empty = analysis.records(rows.limit(0), SMALL, "c", "t")
    assert analysis.counts(empty).count() == 0 and analysis.frequencies(empty).count() == 0
    assert analysis.lengths(empty).count() == 0 and analysis.inventory(rows.limit(0).select(F.array("t").alias("tokens"))).first()["unique_tokens"] == 0


def test_selection_scores(spark):
    rows = spark.createDataFrame([(1, ["a", "a", "b"]), (2, []), (3, None), (4, ["z"])], "id long, tokens array<string>")
    held = spark.createDataFrame([("a", 3), ("b", 12)], "token string, n long")
    assert {r["id"]: r["score"] for r in select.deficits(rows, "id", "tokens", held, 10.0, 0.5).collect()} == {1: 7.0, 2: 0.0, 3: 0.0, 4: 15.0}
    target = spark.createDataFrame([("a", 4.0), ("b", 4.0), ("z", 0.5)], "token string, target double")
    gain = {r["id"]: r["gain"] for r in select.balance_gain(rows, "id", "tokens", held, target).collect()}
    assert abs(gain[1] - 0.25 / np.sqrt(3)) < 1e-12 and gain[2] == gain[3] == 0.0 and gain[4] == 0.5
    assert select.score_target(held, rows.select(F.size("tokens").alias("len")), "len", 10).first()["target"] == (15 + 10 * 2) / 500
    counts = spark.createDataFrame([("x", "u", 3)], "axis string, value string, n long")
    got = select.metadata_scores(spark.createDataFrame([(1, "u"), (2, None)], "id long, x string"), "id", ["x"], counts)
    assert {r["id"]: (r["novelty"], r["scarcity"]) for r in got.collect()} == {1: (0.25, -3), 2: (1.0, 0)}
    df = spark.createDataFrame([(i, ["a"] if i else ["new"], "c") for i in range(5)], "id long, tokens array<string>, cell string")
    carried = spark.createDataFrame([("a", 0)], "token string, n long")
    assert select.balanced(df, "id", ["cell"], "tokens", 1, 5.0, held=spark.createDataFrame([("a", 99)], "token string, n long")).first()["id"] == 0
    assert select.balanced(df, "id", ["cell"], "tokens", 5, held=carried, bonus=1.0).count() == 5


def test_coverage_of_targets(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, None)], "id long, tokens array<string>")
    assert [r["id"] for r in select.coverage_seed(rows, "id", "tokens", targets=["a", "z"]).collect()] == [1]
    assert sorted(r["id"] for r in select.coverage_seed(rows, "id", "tokens", targets=["a", "c"], strict=True).collect()) == [1, 2]
    with pytest.raises(ValueError, match="no row holds z"):
        select.coverage_seed(rows, "id", "tokens", targets=["a", "z"], strict=True)
    assert select.coverage_seed(rows, "id", "tokens", targets=[]).count() == 0


def test_rare_support(spark):
    rows = spark.createDataFrame([("u1", ["a", "b", "x"]), ("u2", ["a"]), ("u3", ["b", "c"]), ("u4", ["x"])], "uid string, tokens array<string>")
    got = select.rare_support(rows, "uid", "tokens", ["a", "b", "c"], 2).orderBy("step").collect()
    best = lambda step, ids: min(ids, key=lambda u: __import__("hashlib").sha256(f"7:{step}:{u}".encode()).hexdigest())
    assert got[0]["uid"] == best(0, ["u1", "u3"]) and sorted(t for r in got for t in r["required"]) == ["a", "a", "b", "b", "c", "c"]
    with pytest.raises(Exception, match="no row holds d"):
        select.rare_support(rows, "uid", "tokens", ["a", "d"], 1).collect()
    with pytest.raises(Exception, match="no row holds d"):
        select.rare_support(rows.limit(0), "uid", "tokens", ["d"], 1).collect()
    assert select.rare_support(rows, "uid", "tokens", [], 2).count() == 0


def test_batches_and_shortlists(spark):
    a = spark.createDataFrame([("i1", "p1", 2), ("i1", "p1", 1), (None, "p2", 5)], "id string, pool_id string, v int")
    b = spark.createDataFrame([("p2", 0), ("p3", 0)], "pool_id string, v int")
    for n in (1, 4):
        assert sorted((r["id"] or r["pool_id"], r["v"]) for r in corpus.merge_batches([a.repartition(n), b]).collect()) == [("i1", 1), ("p2", 5), ("p3", 0)]
    pool = spark.createDataFrame([(1, "x"), (2, "y")], "id long, text string")
    assert tuple(corpus.hydrated(pool.select("id").limit(1), pool, "id").first()) == (1, "x")
    with pytest.raises(Exception, match="not in the pool: 9"):
        corpus.hydrated(spark.createDataFrame([(9,)], "id long"), pool, "id").collect()
    assert [r["id"] for r in corpus.unselected(pool, pool.filter("id = 1"), "id").collect()] == [2]
    few = sample.stratified(pool, ["text"], 5, "id")
    assert few.count() == 2 and few.filter("round IS NULL").count() == 2 and sample.stratified(pool, ["text"], 1, "id").count() == 1
    stale = spark.createDataFrame([(1, "क ख", ["old"], "old")], "id long, text string, tokens array<string>, hash string")
    assert corpus.retokenised(stale, SMALL).first()["tokens"] == ["क", "ख"]
    with pytest.raises(Exception, match="more than 2 archives"):
        sample.budget_bins(spark.createDataFrame([(i, 4) for i in range(9)], "id long, n long"), "n", "id", 4, most=2).collect()
    with pytest.raises(Exception, match="ambiguous: x"):
        qc.align(spark.createDataFrame([("x",)], "k string"), spark.createDataFrame([("x", "t"), ("x", "u")], "k string, t string"), "k", "t").collect()


def test_lost_tokens(spark):
    count = lambda **n: spark.createDataFrame(list(n.items()), "token string, n long")
    report.demand_none_lost(count(a=1, d=2, z=0), count(a=4), ("d",))
    with pytest.raises(ValueError, match="tokens were lost: b"):
        report.demand_none_lost(count(a=1, b=2), count(a=4, b=0))


def test_judged_flow(spark):
    jobs_ = spark.createDataFrame([("full_u1", "u1", "canonical", []), ("regen1_u1", "u1", "regeneration_1", []), ("full_u2", "u2", "canonical", ["r"]), ("full_u3", "u3", "canonical", []), ("regen2_u3", "u3", "regeneration_2", [])], "job_id string, uid string, realisation string, required_rare array<string>")
    cpu = spark.createDataFrame([(j, True, j, 1.0) for j in ("full_u1", "regen1_u1", "full_u2", "full_u3")], "job_id string, cpu_pass boolean, audio_sha256 string, duration_seconds double")
    first = spark.createDataFrame([("full_u1", 0.2, 0.1, 1.0), ("regen1_u1", 0.1, 0.1, 1.0), ("full_u2", 0.1, 0.1, 0.5), ("full_u3", 0.36, 0.1, 1.0)], "job_id string, cer double, wer double, recall double")
    judged = qc.verdicts(jobs_, cpu, first, first.limit(0)).cache()
    assert {r["job_id"]: r["reasons"] for r in judged.collect()} == {
        "full_u1": [], "regen1_u1": [], "full_u2": ["missing_mms", "whisper_rare_recall"], "full_u3": ["whisper_accuracy", "missing_mms_disputed"], "regen2_u3": ["cpu_qc", "missing_whisper"],
    }
    assert {r["uid"]: r["job_id"] for r in qc.canonical(judged, "uid").collect()} == {"u1": "regen1_u1"}
    texts = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u4",)], "uid string")
    assert {tuple(r) for r in qc.regenerations(texts, judged, "uid").collect()} == {("u2", 1, "full_u2"), ("u4", 1, "ful_u4")}


def test_token_edits(spark):
    import random

    rng = random.Random(4)
    rows = [([rng.choice("abcé") * rng.randint(1, 2) for _ in range(rng.randint(0, 9))], [rng.choice("abcé") * rng.randint(1, 2) for _ in range(rng.randint(0, 9))]) for _ in range(60)]

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, p in enumerate(x, 1):
            new = [i]
            for j, q in enumerate(y, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != q)))
            row = new
        return row[-1]

    df = spark.createDataFrame([*rows, (None, ["a"]), (["a"], None)], "x array<string>, y array<string>")
    got = [r["d"] for r in df.select(qc.token_edits(F.col("x"), F.col("y")).alias("d")).collect()]
    assert got == [*(distance(x, y) for x, y in rows), 1, 1]
    assert qc.corpus_rates(spark.createDataFrame([(None, None)], "r string, h string"), "r", "h").first()["cer"] == 0.0


def test_ranks_and_quantiles(spark):
    rows = spark.createDataFrame([(i, float(i * 37 % 101) if i % 9 else None) for i in range(300)], "id long, v double")
    values = sorted(r["v"] for r in rows.collect() if r["v"] is not None)
    for share in (0.0, 0.5, 0.95, 1.0):
        assert stats.rank_quantile(rows, "v", share).first()["v"] == values[int(np.round((len(values) - 1) * share))]
    assert stats.rank_quantile(rows.limit(0), "v", 0.5).first()["v"] is None
    assert stats.rank_quantile(rows.withColumnRenamed("v", "r"), "r", 1.0).first()["r"] == 100.0
    got = stats.ranked(rows, ["v", "id"]).orderBy("v", "id").collect()
    assert [r["r"] for r in got] == list(range(1, 301))


def test_tokens_are_made_once(spark, tmp_path):
    """The plans evaluate the tokenising pattern once a text."""
    spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    for q in (catalogue.token_frequency, catalogue.document_frequency, catalogue.distribution_by_lang, catalogue.sentence_pool, catalogue.rejection_reasons):
        plan = q(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == 1, (q.__name__, plan)
