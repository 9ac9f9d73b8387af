"""Queries over checks of results, speech jobs, documents about a run and files in other forms."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import annotate, jobs, qc, report, sample, stats, vector
from textloom.operators.tables import new_path, settled
from textloom.plans.catalogue import _T, _TF, WHITE, _inventory, _listed, customer_split, doc_tokens, lang_frequency, query, t
from textloom.profile import LATIN
from textloom.sources import readers, sinks
from textloom.streaming import state

# -- text and tokens -----------------------------------------------------------------------------


@query(f"SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(text, '[।॥.?!]', ' ', 'g'), '[{WHITE}]+', ' ', 'g'))) AS hash FROM documents")
def punctuation_free(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", F.sha2(T.punctuation_free(F.col("text")).cast("binary"), 256).alias("hash"))


@query("WITH c AS (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations) SELECT a.conv_id, a.turn, round(CASE WHEN len(list_distinct(a.w)) = 0 THEN 1.0 ELSE len(list_intersect(list_distinct(a.w), b.w)) / len(list_distinct(a.w)) END, 8) AS recall FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1")
def turn_recall(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "conversations").select("conv_id", "turn", F.split("text", " ", -1).alias("w"))
    both = c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("v")), ["conv_id", "turn"])
    return both.select("conv_id", "turn", F.round(qc.recall(F.col("w"), F.col("v")), 8).alias("recall"))


@query("""WITH c AS (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations), p AS (SELECT a.conv_id, a.turn, a.w, b.w AS v FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
r AS (SELECT conv_id, turn, k, count(*) AS n FROM (SELECT conv_id, turn, unnest(w) AS k FROM p) WHERE k IN ('the', 'a', 'of', 'and', 'is') GROUP BY ALL), h AS (SELECT conv_id, turn, k, count(*) AS n FROM (SELECT conv_id, turn, unnest(v) AS k FROM p) GROUP BY ALL)
SELECT CAST(coalesce(sum(least(r.n, coalesce(h.n, 0))), 0) AS BIGINT) AS matched, CAST(coalesce(sum(r.n), 0) AS BIGINT) AS n, round(CASE WHEN coalesce(sum(r.n), 0) > 0 THEN sum(least(r.n, coalesce(h.n, 0))) / sum(r.n) ELSE 1.0 END, 8) AS recall FROM r LEFT JOIN h ON r.conv_id = h.conv_id AND r.turn = h.turn AND r.k = h.k""")
def clipped_recall(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "conversations").select(F.concat_ws(":", "conv_id", "turn").alias("id"), F.split("text", " ", -1).alias("w"), F.concat_ws(":", "conv_id", (F.col("turn") - 1).cast("string")).alias("before"))
    both = c.select("id", "w").join(c.select(F.col("before").alias("id"), F.col("w").alias("v")), "id")
    return qc.clipped_recall(both, "id", "w", "v", ["the", "a", "of", "and", "is"]).withColumn("recall", F.round("recall", 8))


@query("SELECT CAST(sum(2 * ((length(text) - length(replace(text, 'a', ''))) > 0)::INT) AS BIGINT) AS edits FROM documents WHERE doc_id % 10 = 0")
def planted_edits(spark: SparkSession, d: str) -> DataFrame:
    """Two tokens put in front of the tokens of a text with an a: two edits."""
    rows = t(spark, d, "documents").filter("doc_id % 10 = 0").select(F.slice(F.split("text", " "), 1, 40).alias("a"), F.col("text").contains("a").alias("more"))
    changed = F.when(F.col("more"), F.concat(F.array(F.lit("#1#"), F.lit("#2#")), "a")).otherwise(F.col("a"))
    return rows.select(qc.token_edits(F.col("a"), changed).alias("e")).agg(F.sum("e").alias("edits"))


@query(f"{_TF}, v AS (SELECT unnest({_listed([k for k in LATIN.selectable if LATIN.tokens(k) == [k]])}) AS token) SELECT DISTINCT token FROM tf JOIN v USING (token)")
def attainable_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Observed, in the vocabulary and emittable."""
    return lang_frequency(spark, d).select("token").intersect(_inventory(spark).filter("emittable").select("token"))


@query(f"{_T} SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(tokens) AS token FROM t) GROUP BY token")
def streamed_counts(spark: SparkSession, d: str) -> DataFrame:
    """The documents arrive in three files; each batch is committed once, in a stream that is stopped and resumed."""
    src, held, mark = (new_path(spark, n) for n in ("stream-in", "stream-state", "stream-mark"))
    rows = t(spark, d, "documents").select("doc_id", "text")
    for part in ((0,), (1, 2)):
        for k in part:
            rows.filter(F.col("doc_id") % 3 == k).select("text").write.mode("append").parquet(src)
        state.follow(spark, src, "text string", held, mark, LATIN).awaitTermination()
    return state.totals(spark, held)


@query("SELECT doc_id, lang || ' é é & ñ' AS text FROM documents")
def composed_texts(spark: SparkSession, d: str) -> DataFrame:
    """Entities decoded and characters composed."""
    raw = F.concat("lang", F.lit(" e\u0301 &eacute; &amp; n\u0303"))
    return t(spark, d, "documents").select("doc_id", T.unescape_nfc(raw).alias("text"))


# -- rules -----------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('tense', 'past', 'ed '), ('tense', 'past', 'was '), ('polarity', 'negative', '1')) r(axis, label, pattern)")
def rules_file(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "rules")
    report.write_text(spark, path, "tense:\n  past: ['ed ', 'was ']\npolarity:\n  negative: [1]\n  positive:\n")
    return spark.createDataFrame([(a, k, p) for a, labels in annotate.load_rules(path, spark).items() for k, found in labels.items() for p in found], "axis string, label string, pattern string")


@query("SELECT 'lang' AS axis, lang AS label, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, CAST(count(*) AS BIGINT) FROM documents GROUP BY source")
def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return annotate.label_counts(t(spark, d, "documents"), ["lang", "source"])


# -- speech jobs -----------------------------------------------------------------------------------

VOICES = [("F1", "female"), ("M1", "male"), ("F2", "female")]
_VOICES = "(VALUES (0, 'F1', 'female'), (1, 'M1', 'male'), (2, 'F2', 'female')) v(slot, voice, voice_gender)"
_STYLE = "CASE WHEN {rare} THEN 'neutral' WHEN sector IN ('formal', 'news', 'education', 'business', 'health') THEN 'formal' WHEN sector IN ('conversational', 'entertainment', 'sports') THEN 'conversational' ELSE 'neutral' END"
_TEXTS = "x AS (SELECT CAST(doc_id AS VARCHAR) AS uid, CASE doc_id % 4 WHEN 0 THEN 'news' WHEN 1 THEN 'sports' WHEN 2 THEN 'technology' ELSE 'formal' END AS sector, doc_id FROM documents)"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id") % 4
    sector = F.when(i == 0, "news").when(i == 1, "sports").when(i == 2, "technology").otherwise("formal")
    return t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("uid"), sector.alias("sector"), F.array().cast("array<string>").alias("rare"))


@query(f"WITH {_TEXTS} SELECT 'aud_' || uid || '_' || lower(voice) AS job_id, voice, voice_gender, {_STYLE.format(rare='false')} AS style FROM x, {_VOICES}")
def audition_jobs(spark: SparkSession, d: str) -> DataFrame:
    return jobs.audition(_texts(spark, d), "uid", "sector", VOICES).select("job_id", "voice", "voice_gender", "style")


@query(f"WITH {_TEXTS}, y AS (SELECT *, (row_number() OVER (ORDER BY encode(uid)) - 1) % 3 AS slot FROM x) SELECT 'ful_' || uid AS job_id, voice, {_STYLE.format(rare='false')} AS style FROM y JOIN {_VOICES} USING (slot)")
def canonical_jobs(spark: SparkSession, d: str) -> DataFrame:
    return jobs.canonical(_texts(spark, d), "uid", "sector", VOICES, "full").select("job_id", "voice", "style")


@query(f"WITH {_TEXTS}, y AS (SELECT *, (row_number() OVER (ORDER BY encode(uid)) - 1) % 3 AS own FROM x), r AS (SELECT *, 1 + doc_id % 2 AS attempt, (own + 1 + doc_id % 2) % 3 AS slot FROM y WHERE doc_id % 5 = 0) SELECT 'regen' || attempt || '_' || uid AS job_id, voice, {_STYLE.format(rare='false')} AS style, 'regeneration_' || attempt AS realisation FROM r JOIN {_VOICES} USING (slot)")
def regeneration_jobs(spark: SparkSession, d: str) -> DataFrame:
    full = settled(jobs.canonical(_texts(spark, d), "uid", "sector", VOICES, "full"), "canonical-jobs")
    i = F.col("uid").cast("long")
    asked = full.filter(i % 5 == 0).select("uid", (1 + i % 2).cast("int").alias("attempt"), F.col("job_id").alias("failed_job_id"))
    return jobs.again(asked, full, "uid", "rare", "sector", VOICES).select("job_id", "voice", "style", "realisation")


@query("SELECT doc_id AS uid, CAST(doc_id % 2 AS INT) AS attempt, 'known' AS origin FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, CAST(doc_id % 2 AS INT), 'new' FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 2 = 0")
def requested_again(spark: SparkSession, d: str) -> DataFrame:
    """Known requests stay; of the new ones those with a key that is not known are added, once."""
    rows = t(spark, d, "documents").select(F.col("doc_id").alias("uid"), (F.col("doc_id") % 2).cast("int").alias("attempt"))
    new = rows.filter("uid % 2 = 0").withColumn("origin", F.lit("new"))
    return jobs.requested(rows.filter("uid % 3 = 0").withColumn("origin", F.lit("known")), new.unionByName(new), ["uid", "attempt"])


@query("SELECT doc_id, n_chars % 3 > 0 AND n_chars % 7 > 0 AND n_chars / 1000.0 BETWEEN 0.2 AND 6.0 AND n_chars % 5 > 0 AS sound FROM documents")
def structural_gate(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_chars")
    m = t(spark, d, "documents").select("doc_id", F.when(n % 3 > 0, 1).otherwise(2).alias("channels"), F.lit(16).alias("bits"), F.when(n % 7 > 0, 16_000).alias("rate"), (n / 1000.0).alias("duration"), (n % 5 / 9.0).alias("rms"), F.lit(0.0).alias("clipping"))
    return m.select("doc_id", qc.structural(m, most=6.0).alias("sound"))


@query("""WITH r AS (SELECT doc_id AS job_id, 'h' || (n_chars % 4) AS sum, n_chars % 6 AS v FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'h0', 0 FROM documents WHERE doc_id % 30 = 0), j AS (SELECT doc_id AS job_id, 'h' || (n_chars % 2) AS sum FROM documents WHERE doc_id % 7 > 0), k AS (SELECT doc_id AS job_id, n_chars % 3 AS v FROM documents WHERE doc_id % 2 = 0),
p AS (SELECT job_id, count(*) AS n, any_value(sum) AS sum, any_value(v) AS v FROM r GROUP BY job_id), f AS (SELECT p.job_id, CASE WHEN n > 1 THEN 'repeated' WHEN j.job_id IS NULL THEN 'unknown' WHEN p.sum <> j.sum THEN 'checksum' WHEN k.job_id IS NOT NULL AND p.v <> k.v THEN 'conflict' END AS fault FROM p LEFT JOIN j USING (job_id) LEFT JOIN k USING (job_id))
SELECT * FROM f WHERE fault IS NOT NULL""")
def import_faults(spark: SparkSession, d: str) -> DataFrame:
    x, n = t(spark, d, "documents").withColumn("job_id", F.col("doc_id")), F.col("n_chars")
    found = x.filter("doc_id % 3 = 0").select("job_id", F.concat(F.lit("h"), n % 4).alias("sum"), (n % 6).alias("v"))
    found = found.unionByName(x.filter("doc_id % 30 = 0").select("job_id", F.lit("h0").alias("sum"), F.lit(0).cast("long").alias("v")))
    planned = x.filter("doc_id % 7 > 0").select("job_id", F.concat(F.lit("h"), n % 2).alias("sum"))
    known = x.filter("doc_id % 2 = 0").select("job_id", (n % 3).alias("v"))
    return qc.import_faults(found, planned, known, "job_id", "sum", ["v"])


@query("SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) = 0 AND (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) = 0 AS same_ids")
def same_ids(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(qc.same_keys(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id"),)], "same_ids boolean")


_SPLIT = "CASE o_orderkey % 10 WHEN 0 THEN 'dev' WHEN 1 THEN 'test' ELSE 'train' END"


def _utterances(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("o_orderkey") % 10
    return t(spark, d, "orders").select(F.when(i == 0, "dev").when(i == 1, "test").otherwise("train").alias("split"), F.col("o_custkey").alias("speaker"), (F.col("o_totalprice") / 10_000).alias("seconds"))


@query(f"SELECT {_SPLIT} AS split, CAST(count(*) AS BIGINT) AS utterances, CAST(count(DISTINCT o_custkey) AS BIGINT) AS speakers, round(sum(o_totalprice / 10000) / 3600, 6) AS hours FROM orders GROUP BY 1")
def split_summary(spark: SparkSession, d: str) -> DataFrame:
    return qc.split_summary(_utterances(spark, d), "split", "speaker", "seconds")


@query(f"SELECT speaker, array_to_string(list_sort(list(DISTINCT split)), ',') AS splits FROM (SELECT {_SPLIT} AS split, o_custkey AS speaker FROM orders) GROUP BY speaker HAVING count(DISTINCT split) > 1")
def shared_speakers(spark: SparkSession, d: str) -> DataFrame:
    return qc.shared_speakers(_utterances(spark, d), "split", "speaker").withColumn("splits", F.array_join("splits", ","))


@query("""WITH e AS (SELECT *, 'v' || label AS voice, CASE WHEN label % 2 = 0 THEN 'female' ELSE 'male' END AS gender, (vec_id * 37 % 1001) / 2000.0 AS cer, 1 - (vec_id % 9) / 20.0 AS recall, vec_id % 6 > 0 AS ok FROM embeddings),
o AS (SELECT voice, cer, row_number() OVER (PARTITION BY voice ORDER BY cer) - 1 AS i, count(*) OVER (PARTITION BY voice) AS n FROM e), md AS (SELECT voice, max(CASE WHEN i = n // 2 THEN cer END) AS median_cer FROM o GROUP BY voice),
g AS (SELECT voice, gender, avg(recall) AS recall, avg(ok::INT) AS passed FROM e GROUP BY ALL), m AS (SELECT voice, i, avg(x) AS x FROM (SELECT voice, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM e) GROUP BY ALL), u AS (SELECT voice, i, x / sqrt(sum(x * x) OVER (PARTITION BY voice)) AS x FROM m),
c AS (SELECT a.voice, b.voice AS o, sum(a.x * b.x) AS c FROM u a JOIN u b ON a.i = b.i AND a.voice <> b.voice GROUP BY ALL), s AS (SELECT voice, 1 - max(c) AS separation FROM c GROUP BY voice), y AS (SELECT g.*, median_cer, separation, 0.55 * (1 - median_cer) + 0.25 * recall + 0.10 * passed + 0.10 * (separation - min(separation) OVER ()) / greatest(1e-12, max(separation) OVER () - min(separation) OVER ()) AS score FROM g JOIN md USING (voice) JOIN s USING (voice))
SELECT voice, gender, round(median_cer, 6) AS median_cer, round(recall, 6) AS recall, round(passed, 6) AS passed, round(separation, 6) AS separation, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY gender ORDER BY score DESC, voice) AS INT) AS rank FROM y""")
def voice_scores(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("vec_id")
    rows = t(spark, d, "embeddings").select(
        F.concat(F.lit("v"), "label").alias("voice"), F.when(F.col("label") % 2 == 0, "female").otherwise("male").alias("gender"), (i * 37 % 1001 / 2000.0).alias("cer"),
        (1 - i % 9 / 20.0).alias("recall"), (i % 6 > 0).alias("ok"), F.transform("embedding", lambda x: x.cast("double")).alias("e"),
    )
    got = report.voice_scores(rows, "voice", "gender", "cer", "recall", "ok", "e")
    return got.select("voice", "gender", *(F.round(c, 6).alias(c) for c in ("median_cer", "recall", "passed", "separation", "score")), "rank")


# -- vectors ---------------------------------------------------------------------------------------


@query("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM e) SELECT vec_id, round(list_dot_product(u, u), 6) AS length, round(list_sum(u), 6) AS total, round(list_sum(u), 6) AS pooled FROM u")
def unit_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Rows scaled to length 1; the mean of a vector's states under a mask that leaves one is that one, scaled."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    rows = t(spark, d, "embeddings").select("vec_id", T.once(vector.unit(e)).alias("u"), vector.mean_pool(F.array(e, F.reverse(e), e), F.array(F.lit(1), F.lit(0), F.lit(1))).alias("p"))
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda s, x: s + x), 6)
    return rows.select("vec_id", F.round(vector.dot(F.col("u"), F.col("u")), 6).alias("length"), total("u").alias("total"), total("p").alias("pooled"))


@query("SELECT true AS exact, true AS recalled")
def pruned_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Against the exact form: all cells probed give the same, 11 of 16 nine in ten of the same cosines (these vectors hardly cluster)."""
    e = t(spark, d, "embeddings")
    want = settled(vector.nearest(e, "vec_id", "embedding"), "nearest")
    same = lambda probes: vector.nearest_pruned(e, "vec_id", "embedding", 16, probes).withColumnRenamed("cosine", "c").join(want, "vec_id").filter("c = cosine").count()
    n = want.count()
    return spark.createDataFrame([(same(16) == n, same(11) >= 0.9 * n)], "exact boolean, recalled boolean")


# -- selections judged -------------------------------------------------------------------------------


@query(f"""{_T}, sel AS (SELECT * FROM t WHERE doc_id % 4 = 0), v AS (SELECT unnest({_listed(LATIN.selectable)}) AS token), seen AS (SELECT token, count(*) AS n FROM (SELECT unnest(list_distinct(tokens)) AS token FROM sel) GROUP BY token), sup AS (SELECT token, count(*) AS n FROM (SELECT unnest(list_distinct(tokens)) AS token FROM t) GROUP BY token),
a AS (SELECT v.token, sup.n, coalesce(seen.n, 0) AS k FROM v JOIN sup USING (token) LEFT JOIN seen USING (token))
SELECT 'exact_size' AS name, true AS ok UNION ALL SELECT 'unique_hashes', true UNION ALL SELECT 'complete_coverage', (SELECT count(*) FROM a WHERE k = 0) = 0 UNION ALL SELECT 'rare_floor_met', (SELECT count(*) FROM a WHERE k < least(2, n)) = 0 UNION ALL SELECT 'all_in_vocabulary', (SELECT count(*) FROM seen WHERE token NOT IN (SELECT token FROM v)) = 0 UNION ALL SELECT 'total_matches', true""")
def selection_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Every fourth document as the selection, two rows a token as the floor."""
    rows = settled(doc_tokens(spark, d), "doc-tokens")
    some = rows.filter("doc_id % 4 = 0")
    got = report.invariants(some, "doc_id", "tokens", stats.token_frequency(some, []), stats.token_frequency(rows, [], per_row=True), _inventory(spark).select("token"), some.count(), floor=2)
    return spark.createDataFrame(list(got.items()), "name string, ok boolean")


@query(f"{_T}, sel AS (SELECT * FROM t WHERE lang IN ('en', 'fr')), sup AS (SELECT DISTINCT unnest(tokens) AS token FROM t), held AS (SELECT DISTINCT unnest(tokens) AS token FROM sel), n AS (SELECT lang, count(*) AS n, sum(count(*)) OVER () AS s FROM sel GROUP BY lang) SELECT 'exact_size' AS name, true AS ok UNION ALL SELECT 'full_coverage', (SELECT count(*) FROM sup WHERE token NOT IN (SELECT token FROM held)) = 0 UNION ALL SELECT 'balanced_lang', (SELECT bool_and(abs(n / s - 0.5) <= 0.02) FROM n)")
def build_gates(spark: SparkSession, d: str) -> DataFrame:
    rows = settled(doc_tokens(spark, d), "doc-tokens")
    some = rows.filter("lang IN ('en', 'fr')")
    got = report.build_gates(some, "tokens", stats.token_frequency(rows, []).select("token"), ["lang"], some.count())
    return spark.createDataFrame(list(got.items()), "name string, ok boolean")


# Nations go to one split each, the largest first: a recursion over them.
query("WITH RECURSIVE s AS (SELECT c_nationkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, sha256('7:' || c_nationkey)) AS i, sum(count(*)) OVER () AS t FROM customer GROUP BY c_nationkey), r AS (SELECT i, c_nationkey, CASE WHEN true THEN 'train' END AS split, n AS train, CAST(0 AS BIGINT) AS dev, CAST(0 AS BIGINT) AS test FROM s WHERE i = 1 UNION ALL SELECT i, c_nationkey, split, train + CASE WHEN split = 'train' THEN n ELSE 0 END, dev + CASE WHEN split = 'dev' THEN n ELSE 0 END, test + CASE WHEN split = 'test' THEN n ELSE 0 END FROM (SELECT s.i, s.c_nationkey, s.n, r.train, r.dev, r.test, CASE WHEN 0.8 * t - r.train > greatest(0.1 * t - r.dev, 0.1 * t - r.test) THEN 'train' WHEN 0.8 * t - r.train = greatest(0.1 * t - r.dev, 0.1 * t - r.test) THEN 'train' WHEN 0.1 * t - r.test >= 0.1 * t - r.dev THEN 'test' ELSE 'dev' END AS split FROM r JOIN s ON s.i = r.i + 1)) SELECT c_nationkey, split FROM r")(customer_split)


@query("SELECT n_nationkey, CAST((row_number() OVER (ORDER BY n_nationkey) - 1) // 4 AS BIGINT) AS bin FROM nation")
def archive_bins(spark: SparkSession, d: str) -> DataFrame:
    got = sample.budget_bins(t(spark, d, "nation").select("n_nationkey", F.lit(10).alias("size")), "size", "n_nationkey", 45)
    return got.select("n_nationkey", "bin")


@query("SELECT doc_id, CAST(CASE WHEN (SELECT count(*) FROM documents) <= 300 THEN 0 ELSE round END AS INT) AS round FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('7:' || CAST(doc_id AS VARCHAR)), doc_id) AS round FROM documents) ORDER BY 2, lang LIMIT 300")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample.stratified(t(spark, d, "documents").select("doc_id", "lang"), ["lang"], 300, "doc_id").select("doc_id", F.coalesce("round", F.lit(0)).alias("round"))


# -- documents about a run, and other files ----------------------------------------------------------


@query("""SELECT '{' || chr(10) || string_agg('  "' || lang || '": ' || n, ',' || chr(10) ORDER BY lang) || chr(10) || '}' || chr(10) AS content FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)""")
def run_document(spark: SparkSession, d: str) -> DataFrame:
    """Counts by language as a JSON document, written beside its place and renamed, then read."""
    path = new_path(spark, "document") + ".json"
    report.json_document(spark, path, {r["lang"]: r["count"] for r in t(spark, d, "documents").groupBy("lang").count().collect()})  # a row a language
    return spark.createDataFrame([(report.read_text(spark, path),)], "content string")


@query("SELECT '# Runs' || chr(10) || chr(10) || '<!-- run:a:start -->' || chr(10) || 'second ' || (SELECT count(*) FROM documents) || chr(10) || '<!-- run:a:end -->' || chr(10) || chr(10) || '<!-- run:b:start -->' || chr(10) || 'other' || chr(10) || '<!-- run:b:end -->' || chr(10) AS content")
def run_log(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "log") + ".md"
    for run, body in (("a", "first"), ("b", "other"), ("a", f"second {t(spark, d, 'documents').count()}")):
        report.run_log(spark, path, run, body)
    return spark.createDataFrame([(report.read_text(spark, path),)], "content string")


@query("SELECT CAST(sum(length(CAST(c_custkey AS VARCHAR)) + 1) AS BIGINT) AS length, sha256(string_agg(c_custkey, chr(10) ORDER BY c_custkey) || chr(10)) AS sha256 FROM customer")
def file_manifest(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "manifest")
    t(spark, d, "customer").orderBy("c_custkey").select(F.col("c_custkey").cast("string").alias("value")).coalesce(1).write.text(path)
    return sinks.manifest(spark, path).filter("file LIKE '%.txt'").select("length", "sha256")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "csv")
    sinks.csv(t(spark, d, "nation").select("n_nationkey", "n_name"), path)
    return spark.read.option("header", "true").csv(path)


@query("SELECT doc_id AS job_id, (n_chars % 50) / 100.0 AS cer FROM documents")
def result_files(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines below a folder, at any depth."""
    path = new_path(spark, "results")
    rows = t(spark, d, "documents").select(F.col("doc_id").alias("job_id"), (F.col("n_chars") % 50 / 100.0).alias("cer"), (F.col("doc_id") % 3).alias("part"))
    rows.select(F.to_json(F.struct("job_id", "cer")).alias("value"), "part").write.partitionBy("part").option("compression", "none").text(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(at, "*/*.txt")):
        fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f.getPath().toString()[:-4] + ".jsonl"))
    return readers.results(spark, path, "job_id long, cer double")


@query("SELECT name, frames, rate, CAST(duration AS DOUBLE) AS duration, CAST(peak AS DOUBLE) AS peak, CAST(lead AS DOUBLE) AS lead, CAST(gap AS DOUBLE) AS gap, CAST(trail AS DOUBLE) AS trail FROM (VALUES ('one', CAST(4000 AS BIGINT), CAST(16000 AS BIGINT), 0.25, 0.5, 0.05, 0.1, 0.0125), ('still', 800, 8000, 0.1, 0.0, 0.1, 0.1, 0.1)) w(name, frames, rate, duration, peak, lead, gap, trail)")
def sound_files(spark: SparkSession, d: str) -> DataFrame:
    """A tone with silence around and within it, and a file that is all silence."""
    import io
    import wave

    path = new_path(spark, "sound")
    jvm = spark.sparkContext._jvm
    for name, rate, runs in (("one", 16_000, ((800, 0), (1000, 16_384), (1600, 0), (400, 16_384), (200, 0))), ("still", 8_000, ((800, 0),))):
        held = io.BytesIO()
        with wave.open(held, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(rate)
            w.writeframes(b"".join(v.to_bytes(2, "little") * n for n, v in runs))
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}.wav")
        out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
        out.write(bytearray(held.getvalue()))
        out.close()
    got = readers.wav_metrics(spark, path)
    return got.select(F.regexp_extract("file", "([a-z]+)[.]wav$", 1).alias("name"), "frames", "rate", "duration", "peak", "lead", "gap", "trail")


@query("SELECT DISTINCT lang || '-' || source AS text FROM documents")
def transcript_file(spark: SparkSession, d: str) -> DataFrame:
    """The third field, or the last where there are fewer."""
    path = new_path(spark, "transcripts")
    said = F.concat_ws("-", "lang", "source")
    t(spark, d, "documents").select(F.when(F.col("doc_id") % 2 == 0, F.concat_ws("\t", F.lit("f"), F.lit("s"), said, F.lit("more"))).otherwise(F.concat_ws("\t", F.lit("f"), said)).alias("value")).write.text(path)
    return readers.transcripts(spark, path)


@query("SELECT DISTINCT source AS token FROM documents")
def target_file(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "targets") + ".json"
    report.write_text(spark, path, json.dumps({"syllables": ["?", *(r["source"] for r in t(spark, d, "documents").select("source").distinct().collect())]}))  # a row a source
    return readers.coverage_targets(spark, path, {"?"})


@query("SELECT 'docs' AS name, 'parquet' AS kind, true AS found")
def validated_source(spark: SparkSession, d: str) -> DataFrame:
    info = readers.validated(spark, "docs", "parquet", f"{d}/documents.parquet", ("doc_id", "text"))
    return spark.createDataFrame([(info["name"], info["kind"], info["files"] >= 1 and info["bytes"] > 0)], "name string, kind string, found boolean")


@query("SELECT CAST(row_number() OVER (ORDER BY s_suppkey) + 1 AS BIGINT) AS line, 'said ' || s_suppkey AS text FROM supplier")
def book_lines(spark: SparkSession, d: str) -> DataFrame:
    """A title, which is skipped, and lines that end in a page mark."""
    path = new_path(spark, "book")
    rows = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("said "), "s_suppkey", F.lit("/१२")).alias("value"))
    rows.unionByName(spark.createDataFrame([(-1, "title")], "s_suppkey long, value string")).orderBy("s_suppkey").select("value").coalesce(1).write.text(path)
    return readers.book(spark, path, skip=((1, 1),)).select(F.col("line").cast("long").alias("line"), "text")


@query("SELECT sha256(text) AS hash, source FROM documents WHERE lang = 'en'")
def article_shards(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "articles")
    rows = t(spark, d, "documents").select(F.col("text").alias("Article"), F.col("source").alias("Source"), "lang")
    for lang, name in (("en", "train"), ("fr", "dev")):
        rows.filter(F.col("lang") == lang).drop("lang").write.parquet(f"{path}/{name}.parquet")
    return readers.articles(spark, path, "train").select(F.sha2(F.col("text").cast("binary"), 256).alias("hash"), "source")


@query("SELECT CAST(c_custkey AS VARCHAR) || ' x' AS text FROM customer WHERE c_custkey % 3 > 0")
def stripped_file(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "stripped")
    i = F.col("c_custkey")
    t(spark, d, "customer").select(F.when(i % 3 > 0, F.concat(F.lit("\t "), i, F.lit(" x  "))).otherwise(" \t").alias("value")).write.text(path)
    return readers.stripped_lines(spark, path).select("text")


@query("SELECT doc_id, CAST(0 AS INT) AS pos, source || '  ' || lang AS text FROM documents UNION ALL SELECT doc_id, 1, 'é & ' || doc_id FROM documents")
def parsed_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """By a real parser: parts of a paragraph are joined by a space, entities decoded, what is outside is left."""
    html = F.concat(F.lit("head<p>"), "source", F.lit(" <b>"), "lang", F.lit("</b></p><div>no</div><P class=a>&eacute; &amp; "), "doc_id", F.lit("</P>tail"))
    return readers.paragraphs(t(spark, d, "documents").select("doc_id", html.alias("html")), "html", ["doc_id"])
