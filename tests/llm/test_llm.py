"""Each operator against a brute-force version, over rows that hold every awkward case."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from textloom.llm import classifier, common, exact_dedup, mixing, neardup, packing, quality_rules, queries, sharding, suffix_dedup, textkit, token_counts, token_files, tokenizing

WORD, BYTE = tokenizing.public("word_bpe_49k.json"), tokenizing.public("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string"
SPACE = r"[^\x20\x09-\x0D]+"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß", k=rng.randint(1, 9))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))
    passage = prose(60)
    texts = [prose(rng.randint(1, 260)) for _ in range(70)]
    base = prose(200)
    for _ in range(25):  # near copies of one text
        w = base.split(" ")
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append(" ".join(w))
    texts += [f"{prose(9)} {passage} {prose(9)}" for _ in range(12)]
    texts += [texts[3]] * 9 + [base] * 4 + ["", " \n ", "one", "ONE", "a b", "same words " * 400, prose(9000), "\x00 \x85x  y", "x " * 3, None]
    return [(i * 3, t, "en", None if i % 11 == 0 else f"s{i % 3 if i % 2 else 0}", i, "clash", "clash") for i, t in enumerate(texts)] + [(0, texts[0], "en", "s0", 0, "clash", "clash"), (None, "no id here", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows(), SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def unique(docs):
    """Without the repeated row and the null id, for comparisons by doc_id."""
    return docs.filter("doc_id is not null").dropDuplicates(["doc_id"])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def data(df):
    return sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: r[0])


def table(df):
    return {r["doc_id"]: r for r in df.collect()}


def shingles(text, k):
    w = re.findall(SPACE, text.translate(LOW))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_components(texts, k, percent=80):
    sets = {d: shingles(t, k) for d, t in texts}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sets, {d: find(d) for d in ids}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(unique, k):
    sets, want = near_components(data(unique), k)
    got = table(neardup.resolve(unique, neardup.Settings(words=k)))
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[d]) and r["kept"] == (d == want[d]) for d, r in got.items())


def test_near_duplicates_edge_rows(docs, empty):
    got = neardup.resolve(docs).collect()
    assert len(got) == docs.count() and [r["kept"] for r in got if r["doc_id"] == 0] == [True] * 2
    assert neardup.resolve(empty).count() == 0 and neardup.unique_rows(empty).columns == empty.columns
    assert neardup.unique_rows(docs).columns == docs.columns


def families(rng, n):
    """Near copies of n different texts, with null ids, ids that several texts share, and repeated rows."""
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(600)]
    out = []
    for f in range(n):
        base = rng.choices(words, k=80)
        for _ in range(6):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(80)] = rng.choice(words)
            out.append((rng.choice([None, None, f, 7, rng.randint(0, 9)]), " ".join(w)))
    return out + out[:5] + [(None, ""), (None, ""), (7, None), (7, " "), (5, "A b"), (7, "a B"), (7, "z z"), (9, "z  z")]


def test_classes_are_linked_and_not_ids(spark):
    from collections import Counter

    rows = families(random.Random(8), 20)
    sets = [frozenset(shingles(t or "", 2)) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    want = []
    for i, (d, t) in enumerate(rows):
        c = min((x for x in ids[find(i)] if x is not None), default=None)
        want.append((d, len(sets[i]), c, d == c))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("label", F.lit("x")).repartition(7)
    for block in (512, 3):
        got = neardup.resolve(docs, neardup.Settings(words=2, block=block))
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect()) == Counter(want)
    kept = [(r["doc_id"], r["text"]) for r in neardup.unique_rows(docs).collect()]
    at = {}
    for i, r in enumerate(rows):
        at.setdefault(r, i)
    full = [find(at[r]) for r in kept if sets[at[r]]]
    assert sorted(full) == sorted({find(i) for i, s in enumerate(sets) if s})  # one row of each component
    assert sum(not sets[at[r]] for r in kept) == sum(not s for s in sets)
    for r in kept:
        assert not sets[at[r]] or r[0] == min((x for x in ids[find(at[r])] if x is not None), default=None)


def test_unrelated_rows_under_one_id_stay(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    for one, two in ((None, None), (7, 7)):
        docs = spark.createDataFrame([(5, a), (one, a + " end"), (two, b), (9 if two else None, b + " end")], "doc_id long, text string")
        want = [(0, "b"), (5, "a")] if two is None else [(5, "a"), (7, "b")]
        assert sorted((r["doc_id"] or 0, r["text"][0]) for r in neardup.unique_rows(docs).collect()) == want


def test_blocks_find_what_the_centres_miss(unique):
    _, want = near_components(data(unique), 2)
    got = table(neardup.resolve(unique, neardup.Settings(words=2, block=4)))
    assert {d: r["component_id"] for d, r in got.items()} == want


def test_a_common_passage_sends_sets_few_times(spark, monkeypatch):
    """Texts that share most of a passage and don't link get their full sets a few times each, not once a band."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    passage = " ".join(word() for _ in range(85))
    texts = [f"{passage} {' '.join(word() for _ in range(14))}" for _ in range(150)]
    texts += [f"{t} {word()}" for t in texts[::10]]
    texts += [" ".join(t.split(" ")[: 85 + 7] + [word() for _ in range(7)]) for t in texts[:15]]
    rows = list(enumerate(texts))
    _, want = near_components(rows, 2)
    seen, across = [], neardup._across
    monkeypatch.setattr(neardup, "_across", lambda rows, sets, s: seen.append(rows.count()) or across(rows, sets, s))
    got = table(neardup.resolve(spark.createDataFrame(rows, "doc_id long, text string"), neardup.Settings(words=2)))
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert 1 < len(set(want.values())) < len(texts) and seen[0] <= 3 * len(texts)


@pytest.mark.parametrize("block", [512, 2])
def test_rare_members_find_every_link(spark, block):
    rng, s = random.Random(9), neardup.Settings(block=block)
    sets = []
    for _ in range(25):
        base = rng.sample(range(-60, 60), rng.randint(1, 24))
        sets += [sorted({*base[rng.randint(0, 2) :], *rng.sample(range(-60, 60), rng.randint(0, 2))}) for _ in range(5)]
    sets = [x for x in sets if x]
    links = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len({*sets[i]} & {*sets[j]}) >= 80 * len({*sets[i]} | {*sets[j]})}
    rows = [(i, np.array(x, np.int64).astype("<i8").view("<u8")) for i, x in enumerate(sets)]
    held = common.table(spark.createDataFrame([(i, np.sort(x).tobytes(), i) for i, x in rows], "k long, members binary, label long").repartition(3), "test")
    close = neardup._close(neardup._spanning(neardup._postings(held, s).join(held.select("k", "label"), "k"), "t"), s)
    got = {(r["a"], r["b"]) for r in neardup._across(close, held.select("k", "members"), s).collect()}
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in got:
        root[find(i)] = find(j)
    assert got <= links and len(links) > 50 and all(find(i) == find(j) for i, j in links)


def test_estimate_follows_jaccard():
    s, rng = neardup.Settings(), np.random.default_rng(1)
    a = rng.integers(0, 2**63, 3000).astype(np.uint64)
    b = np.concatenate((a[:2400], rng.integers(0, 2**63, 300).astype(np.uint64)))
    h = np.concatenate((a, b))
    m = neardup.pack_bits(neardup.minima(h, np.array([0, 3000]), np.array([3000, 5700]), s))
    assert abs(neardup.estimate(m[0], m[1], s) - 2400 / 3300) < 0.15 and s.floor < 0.7


def bands_hold(raw):
    """The verdict of the bands, by the library alone."""
    import zstandard

    bands = quality_rules.Bands()
    ratio = lambda x: len(zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress(x)) / len(x)
    if not raw:
        return False
    low, high = [(lo, hi) for most, lo, hi in bands.whole if len(raw) < most][0]
    held = [(raw, low, high)]
    for size, least, most in bands.chunks:
        if len(raw) >= 2 * size:
            held += [(raw[at : at + size] if at + size <= len(raw) else raw[-size:], least, most) for at in range(0, len(raw), size)]
            break
    return all(lo <= ratio(x) <= hi for x, lo, hi in held)


def test_quality_rules(docs, unique, empty):
    got = table(quality_rules.annotate(unique, columns=["doc_id"]))
    for d, t in data(unique):
        w = re.findall(SPACE, t)
        lines = [x for x in t.split("\n") if re.search(SPACE, x)]
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(grams) < 3000 else None
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        if hit is not None:
            assert r["n_repeat_words"] == len(hit) and r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert r["kept"] == (not r["base_failed"] and bands_hold(t.encode()))
    assert len({(r["base_failed"], r["kept"]) for r in got.values()}) == 3
    kept = quality_rules.filter_rows(docs)
    assert kept.columns == docs.columns and {r["kept"] for r in kept.collect()} == {"clash"}
    assert quality_rules.filter_rows(empty).count() == 0
    assert not got[[d for d, t in data(unique) if t.startswith("same words")][0]]["kept"]


PARTS = "th he in er an re nd on en at ou ed ha to or it is hi es ng ing tion ent ble ly with what from".split()


def sound(rng, size, end="", alphabet=None):
    """Words of common word parts (or of single letters), each with an ending of its own."""
    word = lambda: "".join(rng.choices(alphabet, k=rng.randint(2, 9)) if alphabet else rng.choices(PARTS, k=rng.randint(1, 4)))
    return " ".join(word() + (rng.choice(end) * 3 if end else rng.choice(["", "", ",", "."])) for _ in range(size // 3))[:size]


def verdicts(spark, texts):
    got = table(quality_rules.annotate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("size", [2500, 5000, 9000, 20000])
def test_bands_alone_reject(spark, size):
    rng = random.Random(2)
    noise = [sound(rng, size, alphabet=a) for a in ("abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(33, 127))), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")]
    got = verdicts(spark, [sound(rng, size), sound(rng, size, "#$%&*"), *noise])
    assert [r["kept"] for r in got] == [True] + [False] * 4 and not any(r["base_failed"] for r in got)


def test_chunks_reach_the_end_and_one_bad_stretch_counts(spark):
    rng = random.Random(4)
    phrase = "the same phrase again and again "
    clean = sound(rng, 98_304, alphabet=None)
    cases = [(4100, 2400), (8200, 3900), (1500, 700), (3000, 1100), (600, 300), (30_000, 4500)]
    mixed = [clean[:a] + (phrase * b)[:b] for a, b in cases] + [clean[:20_000] + (phrase * 300)[:8192] + clean[20_000:40_000]]
    got = verdicts(spark, [*(clean[: a + b] for a, b in cases), *mixed])
    assert [r["kept"] for r in got] == [True] * len(cases) + [False] * len(mixed) and not any(r["base_failed"] for r in got)
    bands = quality_rules.Bands(whole=((float("inf"), 0.0, 2.0),))
    import zstandard

    packer = zstandard.ZstdCompressor(level=3, write_content_size=False)
    for a, b in cases:  # the chunks alone reject; every byte is judged
        assert not quality_rules.compress(memoryview((clean[:a] + (phrase * b)[:b]).encode()), bands, packer)[3]
    assert [quality_rules.compress(memoryview(clean[:n].encode()), bands, packer)[1] for n in (511, 512, 513, 2047, 2048, 8191, 8192, 8193)] == [0, 2, 3, 8, 2, 8, 2, 3]


def ids_of(path, text):
    from tokenizers import Tokenizer

    return np.array([*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, 0], "<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunks_give_the_tokenizer_ids(path):
    coder, rng = tokenizing.Encoder(path), random.Random(2)
    bits = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "́", "a", "Zé", "'s", "9", "!", ".,", "ß", "Σ", "中", "İ", "\r\n", "word", "x" * 70, "\x00", " the"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(3000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode(texts) == want and coder.encode(texts) == want


def test_other_tokenizers_take_whole_texts(tmp_path):
    import json

    for name, change in (("a", {"pre_tokenizer": {"type": "WhitespaceSplit"}, "normalizer": None}), ("b", {"normalizer": {"type": "NFKC"}})):
        spec = json.load(open(WORD if name == "a" else BYTE)) | change
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(spec))
        coder = tokenizing.Encoder(str(path))
        texts = ["a b", "", "x\u2460 y's", None, "ﬁ  ne\n"]
        assert coder.whole and coder.encode(texts) == [np.array(coder.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert not tokenizing.Encoder(WORD).whole and not tokenizing.Encoder(BYTE).whole


def test_packing(docs, unique, empty):
    got = packing.pack(unique, WORD, with_ids=True).collect()
    assert [(p["doc_id"], p["piece"]) for p in sorted(got, key=lambda p: (p["doc_id"], p["piece"]))] == [(d, k) for d, t in data(unique) for k in range(-(-len(ids_of(WORD, t)) // 2048))]
    for d, t in data(unique):
        ids, mine = ids_of(WORD, t), sorted((p for p in got if p["doc_id"] == d), key=lambda p: p["piece"])
        assert b"".join(p["ids"] for p in mine) == ids.tobytes() and all(zlib.crc32(p["ids"]) == p["ids_crc32"] and p["start"] == 2048 * k for k, p in enumerate(mine))
    bins = {}
    for p in got:
        bins.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for some in bins.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(docs, WORD).count() == len(got) + 2 and packing.pack(empty, WORD).count() == 0


def test_plan_is_close_to_the_bound():
    rng = random.Random(4)
    for capacity in (10, 64, 2048):
        for _ in range(30):
            counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(0, 40))}
            plan = packing.Plan(counts, capacity)
            fill, seen = {}, set()
            for length, n in counts.items():
                seq, off = plan.place(np.full(n, length), np.arange(n))
                for q, o in zip(seq, off, strict=True):
                    fill[q] = fill.get(q, 0) + length
                    assert (q, o) not in seen
                    seen.add((q, o))
            assert all(v <= capacity for v in fill.values()) and len(fill) == plan.bins
            large = sum(n for k, n in counts.items() if 3 * k > capacity)
            assert plan.bins <= max(large, 2 * -(-sum(k * n for k, n in counts.items()) // capacity) + 1)


def test_new_chunks_are_encoded_together(monkeypatch):
    """Chunks after one space share a call of the library, whatever characters they hold; ids are those of whole texts."""
    rng, coder, alone = random.Random(12), tokenizing.Encoder(BYTE), []
    odd = "ab7-_.,'\u00e9\u0130\u01c5\u02b0\u0300\u4e2d\u0661\u00b2\u2028\u00a0\U0001f600\x1c\x1f\x85\u180e\u200b\x00#<|>\u0120\u010a"
    texts = [" ".join("".join(rng.choices(odd, k=rng.randint(0, 7))) + rng.choice(["", "", "\n", "'s", ".", "  ", "<|endoftext|>"]) for _ in range(60)) for _ in range(150)]
    texts += [" ".join(f"{rng.choice('abc')}-{i * 7919 + k},{k}" for k in range(300)) for i in range(3)] + [None, "", " ", "\n", " \n a", "a\nb\n\nc"]
    for t, raw in zip(texts, coder.encode(texts), strict=True):
        assert raw == np.array(coder.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
    coder, one = tokenizing.Encoder(BYTE), tokenizing.Encoder._one_by_one
    monkeypatch.setattr(tokenizing.Encoder, "_one_by_one", lambda self, chunks: alone.extend(chunks) or one(self, chunks))
    coder.encode(texts[150:153])
    assert len(alone) <= 6


def test_token_files(spark, docs, unique, empty):
    path = common.new_table_path(spark, "test")
    token_files.write(unique, path, BYTE, per_block=700)
    got, at = table(token_files.read(spark, path)), 0
    for d, t in data(unique):
        ids = ids_of(BYTE, t)
        assert (got[d]["start"], got[d]["n_tokens"], bytes(got[d]["ids"])) == (at, len(ids), ids.tobytes())
        at += len(ids)
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    for some, n in ((docs, docs.count()), (empty, 0), (nameless, docs.count())):
        path = common.new_table_path(spark, "test")
        token_files.write(some, path, BYTE)
        assert token_files.read(spark, path).count() == n
    for high in (3, 300, 70_000, 2**31):
        v = np.random.default_rng(1).integers(0, high, 1001).astype(np.uint32)
        control, raw = token_files.encode_values(v)
        assert (token_files.decode_values(np.frombuffer(control, np.uint8), np.frombuffer(raw, np.uint8), len(v)) == v).all()


def test_sharding(docs, empty):
    got = sharding.shard(docs).collect()
    size = [sum(r["shard"] == s for r in got) for s in range(8)]
    assert sum(size) == docs.count() and max(size) - min(size) <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(size[s]))
    for source in {r["source"] for r in got}:
        per = [sum(r["shard"] == s and r["source"] == source for r in got) for s in range(8)]
        assert max(per) - min(per) <= 2
    assert sharding.shard(empty).count() == 0


def test_interleaved_order_by_brute_force(docs):
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    rows = docs.select("doc_id", "source", crc.alias("c"), F.xxhash64(F.lit(7), "doc_id", crc).alias("h"), F.octet_length("text").alias("n")).collect()
    key = lambda r: (r["h"], r["doc_id"] is not None, r["doc_id"] or 0, r["c"])
    line = []
    for source in {r["source"] for r in rows}:
        mine = sorted((r for r in rows if r["source"] == source), key=key)
        line += [((2 * i + 1) / (2 * len(mine)), key(r), r) for i, r in enumerate(mine)]
    line = [r for *_, r in sorted(line, key=lambda x: x[:2])]
    want = []
    for s in range(8):
        cut = line[-(-s * len(line) // 8) : -(-(s + 1) * len(line) // 8)]
        want += [(r["doc_id"], r["source"], (r["n"] or 0) + 1, r["c"], s, k) for k, r in enumerate(cut)]
    order = lambda rows: sorted(rows, key=lambda r: (r[4], r[5]))
    assert order((r["doc_id"], r["source"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shard(docs).collect()) == order(want)


def test_exact_dedup(docs, empty):
    got = exact_dedup.resolve(docs).collect()
    by = {}
    for r in docs.collect():
        by.setdefault(hashlib.sha256((r["text"] or "").encode()).hexdigest(), []).append(r["doc_id"])
    assert len(got) == docs.count()
    for r in got:
        mine = by[r["text_sha256"]]
        keep = max((i for i in mine if i is not None), default=None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(mine), r["doc_id"] == keep)
    kept = exact_dedup.unique_rows(docs)
    assert kept.columns == docs.columns and kept.count() == len(by) and exact_dedup.unique_rows(empty).count() == 0


def test_equal_digests_of_different_bytes_stay_apart(spark, monkeypatch):
    """With a digest of 8 bits, texts of either side meet in it; only equal bytes join."""
    monkeypatch.setattr(exact_dedup, "digest", lambda raw: F.substring(F.sha2(raw, 256), 1, 2))
    ids = spark.range(1000).withColumnRenamed("id", "doc_id").select("doc_id", exact_dedup._is_stored().alias("s")).collect()
    stored, batch = ([r["doc_id"] for r in ids if r["s"] == s] for s in (True, False))
    short = lambda t: hashlib.sha256(t.encode()).hexdigest()[:2]
    one, two = {}, {}
    for k in range(3000):
        (one if k % 2 else two).setdefault(short(f"text {k}"), f"text {k}")
    both = sorted(set(one) & set(two))[:60]
    texts = [(stored[i], one[d]) for i, d in enumerate(both)] + [(batch[i], (two if i % 3 else one)[d]) for i, d in enumerate(both)]
    texts += [(stored[-1], one[both[0]]), (batch[-1], two[both[1]])]
    got = exact_dedup.resolve(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    by = {}
    for d, t in texts:
        by.setdefault(t, []).append(d)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == sorted((d, max(by[t]), len(by[t])) for d, t in texts)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n).astype(np.uint64)
    f = exact_dedup.FuseFilter.from_bytes(exact_dedup.FuseFilter.build(keys).to_bytes())
    assert f.has(keys).all() and f.has(rng.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.02
    assert n < 1000 or len(f.prints) < 1.6 * n


def removed(texts, length=100):
    seen, out = set(), {}
    for d, t in texts:
        raw, gone = t.encode(), set()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            gone.update(range(i, i + length)) if w in seen else seen.add(w)
        kept = bytes(c for i, c in enumerate(raw) if i not in gone)
        out[d] = (len(raw), len(gone), sum(i in gone and i - 1 not in gone for i in range(len(raw))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most", [1024, 1])
def test_suffix_dedup(docs, unique, empty, most):
    want = removed(data(unique))
    got = {d: tuple(r)[1:] for d, r in table(suffix_dedup.remove(unique, most=most)).items()}
    assert got == want and any(v[1] for v in want.values())
    if most > 1:
        again = {(r["doc_id"], r["n_removed"]) for r in suffix_dedup.remove(docs).collect()}
        assert again >= {(d, v[1]) for d, v in want.items()} and suffix_dedup.remove(empty).count() == 0


@pytest.mark.parametrize("most", [0, 3])
def test_edges_of_shared_passages(spark, most):
    """Many texts share a passage and differ around it, some in a few bytes only."""
    rng = random.Random(11)
    some = lambda n, letters: "".join(rng.choices(letters, k=n))
    passage, short = some(160, "abcdefgh "), some(40, "abcdefgh ")
    texts = [some(rng.randint(0, 130), "ab") + passage[rng.randint(0, 5) :] + some(rng.randint(0, 130), "xyz"[: i % 3 + 1]) for i in range(90)]
    texts += [some(70, "pq") + short + some(70, "pq") for _ in range(40)] + ["ab" * 150, "ab" * 90 + "c" * 150, "é" * 120]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = removed(list(enumerate(texts)))
    assert {d: tuple(r)[1:] for d, r in table(suffix_dedup.remove(docs, most=most)).items()} == want


def test_rows_without_ids_and_hot_anchors(spark, monkeypatch):
    """Small slices, so that a task meets hot anchors again and again; equal texts stand for one row each."""
    rng = random.Random(12)
    some = lambda n: "".join(rng.choices("abcdefgh", k=n))
    passage = some(300)
    texts = sorted({some(rng.randint(0, 200)) + passage[: rng.randint(150, 300)] + some(rng.randint(0, 200)) for _ in range(120)})
    rows = [(None, t) for t in texts[:60] for _ in range(3)] + [(i, t) for i, t in enumerate(texts[60:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hashes = {r["text"]: r["x"] for r in docs.select("text", F.xxhash64(F.encode("text", "UTF-8")).alias("x")).distinct().collect()}
    order = sorted(texts[:60], key=hashes.get) + texts[60:]
    want = removed(list(enumerate(order)))
    monkeypatch.setattr(suffix_dedup, "SLICE", 2_000)
    for hot in (1_000_000, 20):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = sorted(tuple(r)[1:] for r in suffix_dedup.remove(docs).collect())
        assert got == sorted(v for i, v in want.items() for _ in range(3 if i < 60 else 1))


def test_suffix_order_is_right():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 4):
        text = rng.integers(97, 97 + letters, 900).astype(np.uint8)
        text[500:700] = text[100:300]
        starts = np.sort(rng.choice(800, 300, replace=False))
        raw = text.tobytes() + bytes(300)
        order = np.concatenate(list(suffix_dedup.suffix_order(text, starts, bucket=50)))
        assert sorted(order) == starts.tolist()
        assert all(raw[a : a + 100] <= raw[b : b + 100] for a, b in zip(order, order[1:], strict=False))


def test_classifier(spark, docs, empty):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice(["good", "fine", "text", "words"] if i % 3 else ["$$$", "***", "junk", "WORDS"]) for _ in range(60))) for i in range(400)]
    train = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in texts] + [(None, 1), (5, None)], "doc_id long, quality int")
    machine = classifier.train(train, labels, "quality")
    got = classifier.score(train, machine).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 > 0) for r in got if r["held_out"]]) > 0.95
    assert classifier.score(docs, machine).count() == docs.count() and classifier.score(empty, machine).count() == 0
    none = classifier.train(empty, labels.limit(0), "quality")
    assert {round(r["score"], 6) for r in classifier.score(train, none).collect()} == {0.5}
    data_, offsets = np.frombuffer(b"a b a c d", np.uint8), np.array([0, 9])
    start, col, value = classifier.features(data_, offsets, np.array([9]), classifier.Settings())
    slow = machine.bias + machine.w[col] @ value + sum(float(machine.v[col[i]] @ machine.v[col[j]]) * value[i] * value[j] for i in range(len(col)) for j in range(i))
    assert abs(machine.raw(start, col, value)[0] - slow) < 1e-3


def test_classifier_reads_n_chars_and_gives_true_odds(spark):
    """Texts that say nothing: the score is the share of label 1; then n_chars alone tells the labels."""
    rng = random.Random(3)
    texts = [(i, "some words " * 30, int(rng.random() < 0.8), 0) for i in range(900)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, quality int, n_chars long").withColumn("n_chars", F.when(F.col("quality") == 1, 100).when(F.col("doc_id") % 2 == 0, 40_000))
    labels = rows.select("doc_id", "quality")
    plain = rows.drop("n_chars")
    got = classifier.score(plain, classifier.train(plain, labels, "quality")).collect()
    seen = [y for i, _, y, _ in texts if zlib.crc32(str(i).encode()) % 3 != 1]
    assert abs(got[0]["score"] - np.mean(seen)) < 0.05 and len({r["score"] for r in got}) == 1
    got = classifier.score(rows, classifier.train(rows, labels, "quality")).collect()
    assert all(r["predicted"] == texts[r["doc_id"]][2] for r in got)
    assert classifier.octave(np.array([-1, 0, 1, 2, 3, 2**40])).tolist() == [0, 1, 2, 2, 3, 24]


def test_training_sample_is_bounded(spark):
    rows = spark.createDataFrame([(i, f"word{i} " * 20, i % 2) for i in range(300)], "doc_id long, text string, quality int")
    seen = []
    real = classifier.fit
    for s in (classifier.Settings(sample=50), classifier.Settings(sample_bytes=4 * 17 * 20 + 3), classifier.Settings()):
        classifier.fit = lambda start, col, value, label, _, s=s: (seen.append((len(label), 2 * len(col) + 2 * len(value))), real(start, col, value, label, s))[1]
        try:
            classifier.train(rows, rows.select("doc_id", "quality"), "quality", s)
        finally:
            classifier.fit = real
    held = sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in range(300))
    assert seen[0][0] == 50 and seen[1][1] <= 4 * 17 * 20 + 3 and 0 < seen[1][0] < 50 and seen[2][0] == 300 - held


def test_token_counts(spark, docs, empty):
    store = token_counts.new_store(spark)
    t = token_counts
    assert store.totals().count() == 0
    assert store.commit("a", t.inserts(docs, "w", t.words)) and not store.commit("a", t.inserts(docs, "w", t.words))
    store.commit("b", t.revisions(docs, "w", t.words, t.marked_words))
    want = {}
    for r in docs.collect():
        text = r["text"] or ""
        n = want.setdefault((r["source"], r["lang"]), [0, 0])
        n[0] += 1
        n[1] += len(re.findall(SPACE, text)) + len(re.findall(r"[#*$%&|<>]", text))
    assert {(r["source"], r["lang"]): [r["n_docs"], r["n_tokens"]] for r in store.totals().collect()} == want
    store.commit("c", t.deletes(docs, "w", t.marked_words))
    assert store.totals().count() == 0
    store.commit("d", t.inserts(empty, "w", t.words))
    assert store.totals().count() == 0


def test_token_totals_by_the_library(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for r in docs.collect():
        if len(re.findall(SPACE, r["text"] or "")) >= 50:
            for name, path in (("word_bpe_49k", WORD), ("byte_bpe_50k", BYTE)):
                n = want.setdefault((r["source"], r["lang"], name), [0, 0])
                n[0] += 1
                n[1] += len(ids_of(path, r["text"]))
    got = queries.op3_token_counts(spark, str(tmp_path)).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): [r["n_docs"], r["n_tokens"]] for r in got} == want


def test_rollup_compacts_and_knows_its_batches(spark):
    t = token_counts
    store = t.Rollup(spark, common.new_table_path(spark, "rollup"), most_deltas=3)
    rows = spark.createDataFrame([("a", "en", "x y z"), (None, None, None), ("a", "en", "x")], "source string, lang string, text string")
    one = lambda n: t.inserts(rows.limit(n), "w", t.words)
    total = lambda: sorted((r["source"] or "", r["n_docs"], r["n_tokens"]) for r in store.totals().collect())
    assert store.commit("a", one(3)) and store.commit("none", one(0)) and total() == [("", 1, 0), ("a", 2, 4)]
    for _ in range(2):  # before and after the batches went into a base
        assert not store.commit("a", one(3).repartition(3)) and not store.commit("none", one(0))
        with pytest.raises(ValueError, match="other changes"):
            store.commit("a", one(1))
        with pytest.raises(ValueError, match="other changes"):
            store.commit("none", one(1))
        store.compact()
        assert total() == [("", 1, 0), ("a", 2, 4)] and not store._pending()
    # a compaction that died before its mark counts for nothing; folders left after it count once
    store.commit("b", one(3))
    store.deltas().limit(0).write.parquet(f"{store.path}/base-00000009/totals")
    assert total() == [("", 2, 0), ("a", 4, 8)]
    t.Rollup(spark, store.path).commit("c", one(3))
    left = spark.read.schema(t.SCHEMA).parquet(f"{store.path}/{store._name('c')}").collect()
    store.compact()
    spark.createDataFrame(left, t.SCHEMA).write.parquet(f"{store.path}/{store._name('c')}")
    assert total() == [("", 3, 0), ("a", 6, 12)]
    for k in range(5):
        store.commit(f"d{k}", one(3))
    assert len(store._pending()) < 4 and total() == [("", 8, 0), ("a", 16, 32)]


def test_mixing(docs, empty):
    n = {}
    for r in docs.collect():
        n[r["source"]] = n.get(r["source"], 0) + len(re.findall(SPACE, r["text"] or ""))
    whole = sum(n.values())
    p = np.array([v / whole for v in n.values()])
    entropy = lambda a: -sum(w * np.log(w) for w in p**a / (p**a).sum())
    low, high = 0.0, 1.0
    goal = 0.95 * np.log(len(n))
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(mid) >= goal else (low, mid)
    low = 1.0 if entropy(1.0) >= goal else low
    got = mixing.mix(docs, mixing.Target(entropy=0.95)).collect()
    assert abs(got[0]["exponent"] - low) < 1e-6
    rows_of = {s: sum(r["source"] == s for r in docs.collect()) for s in n}
    for s, own in n.items():
        mine = [r for r in got if r["source"] == s]
        share = mine[0]["weight"] * whole
        assert sum(r["n_tokens"] for r in mine) <= share + 1e-3
        for b in range(int(share // own)):
            assert sorted(r["row_in_block"] for r in mine if r["block"] == b) == list(range(rows_of[s]))
    repeats = mixing.mix(docs, mixing.Target(repeats=1.3)).collect()
    assert all(r["weight"] * whole <= 1.3 * n[r["source"]] + 1e-6 for r in repeats)
    drawn = mixing.mixed_rows(docs, mixing.Target(entropy=0.95))
    assert drawn.columns == docs.columns and abs(drawn.count() - len(got)) <= 2
    assert mixing.mix(empty, mixing.Target(entropy=0.9)).count() == 0 and mixing.mixed_rows(empty, mixing.Target(entropy=0.9)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, mixing.Target())


@pytest.mark.parametrize("target", [mixing.Target(entropy=0.95), mixing.Target(repeats=1.3), mixing.Target(entropy=0.97, budget=2.5)])
def test_drawn_rows_by_brute_force(docs, target):
    from collections import Counter

    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    rows = docs.select("doc_id", "source", "text", crc.alias("c"), *(F.xxhash64(F.lit(target.seed), F.lit(b), "doc_id", crc).alias(f"h{b}") for b in range(9))).collect()
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    n = {k: sum(len(re.findall(SPACE, r["text"] or "")) for r in some) for k, some in by.items()}
    whole = sum(n.values())
    got = mixing.mix(docs, target).collect()
    a = got[0]["exponent"]
    assert 0 < a < 1
    z = sum((v / whole) ** a for v in n.values())
    want = Counter()
    for k, some in by.items():
        goal = (n[k] / whole) ** a / z * whole * target.budget
        full = int(goal / n[k] + 1e-9)
        for b in range(full + 1):
            at = 0
            for i, r in enumerate(sorted(some, key=lambda r: (r[f"h{b}"], r["doc_id"] is not None, r["doc_id"], r["c"]))):
                size = len(re.findall(SPACE, r["text"] or ""))
                if b == full and at + size > int(goal - full * n[k] + 1e-6):
                    break
                want[r["doc_id"], k, size, b, i, at] += 1
                at += size
    assert Counter((r["doc_id"], r["source"], r["n_tokens"], r["block"], r["row_in_block"], r["tokens_before"]) for r in got) == want
    drawn = Counter(r["doc_id"] for r in mixing.mixed_rows(docs, target).collect())
    assert sum((Counter(r["doc_id"] for r in got) - drawn).values()) <= 2 and not drawn - Counter(r["doc_id"] for r in got)


def test_mixing_limits_and_clashing_names(spark, docs):
    tiny = spark.createDataFrame([(i, "a b c d", "big") for i in range(500)] + [(900, "a", "small")], "doc_id long, text string, source string")
    got = mixing.mix(tiny, mixing.Target(entropy=1.0)).collect()
    assert sum(r["source"] == "small" for r in got) <= 4 and got[0]["exponent"] < 1
    clash = docs.withColumns({c: F.lit(c) for c in ("cut_tokens", "whole_blocks", "weight", "block", "n_tokens", "source_rows", "p", "exponent")})
    out = mixing.mixed_rows(clash, mixing.Target(entropy=0.95))
    assert out.columns == clash.columns and {r["cut_tokens"] for r in out.collect()} == {"cut_tokens"} and out.count() == mixing.mixed_rows(docs, mixing.Target(entropy=0.95)).count()


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_the_query_mixes(spark, scale):
    got = queries.op1_mixing(spark, f"/root/testdata/{scale}")
    assert 0 < got.first()["exponent"] < 1 and got.filter("block > 0").count() > 0


def test_kernels_on_null_and_empty_texts():
    import pyarrow as pa

    parts = list(textkit.batches(pa.array([None, "", "a b", None]), most=1))
    assert [(a, b) for a, b, *_ in parts][-1][1] == 4 and sum(len(d) for *_, d, _ in parts) == 3


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    at = docs
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        at = common.table(stage(spark, at, str(tmp_path)), f"t{k}")
        seen.append(at)
        if k < 4:
            assert at.columns == docs.columns
    kept = {d: r["kept"] for d, r in table(quality_rules.annotate(docs.select("doc_id", "text"))).items()}
    one = sorted(r["doc_id"] for r in seen[0].collect())
    assert one == sorted(r["doc_id"] for r in docs.collect() if kept[r["doc_id"]])
    best = {}
    for r in seen[0].collect():
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in seen[1].collect()) == sorted(best.values())
    _, comp = near_components(data(seen[1]), 5)
    assert sorted(r["doc_id"] for r in seen[2].collect()) == sorted(set(comp.values()))
    assert {r["doc_id"] for r in seen[3].collect()} <= set(comp.values())
    assert {p["doc_id"] for p in seen[4].collect()} == {r["doc_id"] for r in seen[3].collect()}
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0
        empty = out if isinstance(out.schema, T.StructType) and "text" in out.columns else empty
