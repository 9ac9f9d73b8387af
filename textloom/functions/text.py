"""Text expressions over a script profile.

Cleaning, splitting and tokenising are Arrow functions: the JVM's regular expressions took several times
as long over the same texts.  They take each text once, whatever is made of it; the rest stays in the JVM.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
import zlib
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.profile import WHITE, Profile, trie_pattern


@F.pandas_udf(StringType())
def unescape_nfc(text: pd.Series) -> pd.Series:
    """HTML entities decoded (also those without a semicolon), then Unicode NFC."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", html.unescape(t)))


def _python(pattern: str) -> re.Pattern:
    return re.compile(re.sub(r"\\x\{([0-9a-fA-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), pattern))


def _each(one: Callable, kind: pa.DataType, returns: str, name: str, none=None) -> Callable[[Column], Column]:
    """An Arrow function of one text; lists are turned into Arrow a few hundred texts at a time."""

    def run(text: pa.Array) -> pa.Array:
        parts = [pa.array([none if t is None else one(t) for t in text.slice(at, 256).to_pylist()], kind) for at in range(0, len(text), 256)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    run.__name__ = name
    return F.arrow_udf(run, returns)


_LIST = pa.list_(pa.string())


def _untagged(profile: Profile) -> Callable[[str], str]:
    """Lower case for Latin script, tags to spaces (none is open behind the last bracket)."""
    tag, low = re.compile("<[^>]+>"), profile.name == "latin"

    def one(t: str) -> str:
        t = t.lower() if low else t
        end = t.rfind(">") + 1
        return tag.sub(" ", t[:end]) + t[end:] if end else t

    return one


def _cleaner(profile: Profile) -> Callable[[str], str]:
    runs, untagged = _python(f"[{profile.letters}]+").findall, _untagged(profile)
    return lambda t: " ".join(runs(untagged(t)))


def _finder(profile: Profile, without: tuple[str, ...] = ()) -> Callable[[str], list[str]]:
    """The tokens of a cleaned text but for ``without``.

    Tokens of one character can be left out of the pattern: where one of them is the longest match
    nothing else matches, and what matches no token is skipped by one character too."""
    if all(len(t) == 1 for t in without if t):
        return re.compile(trie_pattern(t for t in profile.vocabulary if t and len(t) <= profile.reach and t not in without) or "(?!)").findall
    every, skip = re.compile(profile.pattern or "(?!)").findall, frozenset(without)
    return lambda t: [k for k in every(t) if k not in skip]


def _letters(profile: Profile) -> Callable[[str], int]:
    other = _python(f"[^{profile.letters}]+")

    def one(t: str) -> int:
        t = t.replace(" ", "")
        return len(other.sub("", t)) if other.search(t) else len(t)

    return one


def clean(text: Column, profile: Profile) -> Column:
    """Tags and everything outside the profile's letters to spaces; spaces collapsed."""
    return _each(_cleaner(profile), pa.string(), "string", "clean")(text)


def normalize(text: Column, profile: Profile) -> Column:
    """Entities, NFC, cleaning."""
    return clean(unescape_nfc(text), profile)


def split_sentences(cleaned: Column, marks: str) -> Column:
    """Trimmed, non-empty pieces between sentence marks."""
    return F.filter(F.transform(F.split(cleaned, f"[{marks}]+"), lambda s: F.trim(s)), lambda s: s != "")


def compact(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{WHITE}]+", " "))


def text_hash(text: Column) -> Column:
    return F.sha2(compact(text).cast("binary"), 256)


def letter_count(text: Column, profile: Profile) -> Column:
    return F.length(F.regexp_replace(text, f"[^{profile.letters}]", ""))


def sentences(text: Column, profile: Profile, raw_first: bool = False) -> Column:
    """Cleaned sentences of raw text; ``raw_first`` splits before cleaning, and what is nothing then stays, as an empty text."""
    one, parts = _cleaner(profile), _python(f"[{profile.raw_end_marks if raw_first else profile.end_marks}]+").split
    if raw_first:
        return _each(lambda t: [one(x) for x in parts(t)], _LIST, "array<string>", "sentences")(text)
    return _each(lambda t: [x for x in (y.strip(" ") for y in parts(one(t))) if x], _LIST, "array<string>", "sentences")(text)


def tokenize(cleaned: Column, profile: Profile, without: tuple[str, ...] = ()) -> Column:
    """Greedy longest-match tokens, spaces included; what matches no token is skipped, and so are the tokens ``without``."""
    return _each(_finder(profile, without), _LIST, "array<string>", "regexp_extract_all")(cleaned)


def content_of(text: Column, profile: Profile) -> Column:
    """``content(tokenize(clean(text)))`` in one pass.

    Where every token is letters or one skipped character, tokens lie within runs of letters,
    so they are found in the text as it is."""
    letters, untagged, skip = _python(f"[{profile.letters}]+").fullmatch, _untagged(profile), profile.skip
    if all(letters(t) or (len(t) == 1 and t != " ") or t in skip for t in profile.vocabulary if t) and all(len(t) <= 1 for t in skip):
        plain = [t for t in profile.vocabulary if t and t not in skip and len(t) <= profile.reach and letters(t)]
        find = re.compile(trie_pattern(plain) or "(?!)").findall
        return _each(lambda t: find(untagged(t)), _LIST, "array<string>", "regexp_extract_all")(text)
    one, find = _cleaner(profile), _finder(profile, skip)
    return _each(lambda t: find(one(t)), _LIST, "array<string>", "regexp_extract_all")(text)


def measures(sentence: Column, profile: Profile) -> Column:
    """Of a cleaned sentence: its content tokens, how many, how many distinct, and ``unknown_ratio``."""
    every, skip = _finder(profile), frozenset(profile.skip)
    kind = pa.struct([("tokens", _LIST), ("n_tokens", pa.int32()), ("n_unique", pa.int32()), ("unknown", pa.float64())])

    def one(t: str) -> dict:
        found = every(t)
        tokens, letters = [k for k in found if k not in skip], len("".join(t.split()))
        return {"tokens": tokens, "n_tokens": len(tokens), "n_unique": len(set(tokens)), "unknown": 1 - sum(map(len, found)) / letters if letters else 1.0}

    none = {"tokens": None, "n_tokens": None, "n_unique": None, "unknown": 1.0}
    return _each(one, kind, "tokens array<string>, n_tokens int, n_unique int, unknown double", "regexp_extract_all", none)(sentence)


def lettered_of(normalised: Column, profile: Profile) -> Column:
    """Of a normalised text: ``lettered`` tokens, its letters, and those that no such token covers."""
    find, letters = _finder(profile, tuple(t for t in profile.vocabulary if not profile.has_letter(t))), _letters(profile)
    kind = pa.struct([("tokens", _LIST), ("n_letters", pa.int32()), ("n_unmatched", pa.int32())])

    def one(t: str) -> dict:
        tokens, n = find(t), letters(t)
        return {"tokens": tokens, "n_letters": n, "n_unmatched": max(0, n - letters("".join(tokens)))}

    none = {"tokens": None, "n_letters": None, "n_unmatched": 0}
    return _each(one, kind, "tokens array<string>, n_letters int, n_unmatched int", "regexp_extract_all", none)(normalised)


def fingerprint(text: Column, profile: Profile) -> Column:
    """Of a text: sha256 of its cleaned form, its letters, sha256 of its tokens joined by a bar, and the letters they don't cover."""
    clean_, find, letters = _cleaner(profile), _finder(profile), _letters(profile)
    kind = pa.struct([("clean_hash", pa.string()), ("n_letters", pa.int64()), ("tokens_hash", pa.string()), ("n_unmatched", pa.int64())])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def one(t: str) -> dict:
        t = clean_(t)
        tokens, n = find(t), letters(t)
        return {"clean_hash": sha(t), "n_letters": n, "tokens_hash": sha("|".join(tokens)), "n_unmatched": max(0, n - letters("".join(tokens)))}

    none = {"clean_hash": None, "n_letters": None, "tokens_hash": None, "n_unmatched": 0}
    return _each(one, kind, "clean_hash string, n_letters long, tokens_hash string, n_unmatched long", "regexp_extract_all", none)(text)


def content(tokens: Column, profile: Profile) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*profile.skip))


def lettered(tokens: Column, profile: Profile) -> Column:
    """The tokens that hold a letter of the profile (the analysis counts these)."""
    without = [t for t in profile.vocabulary if not profile.has_letter(t)]
    return F.filter(tokens, lambda t: ~t.isin(*without))


def once(value: Column) -> Column:
    """``value`` as a generator of one row: what is built on it does not evaluate it again.

    Projects and filters above are not merged into its expression, as they would be with a
    plain column.  Costly expressions (tokenising) that are used several times go through it.
    """
    return F.explode_outer(F.array(value))


def unmatched(cleaned: Column, tokens: Column, profile: Profile) -> Column:
    """Letters of the profile that no token covers."""
    matched = F.length(F.regexp_replace(F.array_join(tokens, ""), f"[^{profile.letters}]", ""))
    return F.greatest(F.lit(0), letter_count(cleaned, profile) - matched)


def unknown_ratio(cleaned: Column, tokens: Column) -> Column:
    """1 - covered / letters.  Space tokens count as covered while the letters are without
    spaces, so the share is understated; kept that way for equal results."""
    letters = F.length(F.regexp_replace(cleaned, f"[{WHITE}]", ""))
    return F.when(letters > 0, 1 - F.length(F.array_join(tokens, "")) / letters).otherwise(F.lit(1.0))


def char_ngrams(text: Column, size: int = 5) -> Column:
    """Distinct character n-grams of whitespace-compacted text; a short text is one gram, an empty one has none."""

    def grams(t: Column) -> Column:  # bound by a lambda, so that the text is compacted once
        many = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(t) - (size - 1))), lambda i: F.substring(t, i, size))
        return F.when(t == "", F.array().cast("array<string>")).when(F.length(t) <= size, F.array(t)).otherwise(many)

    return F.array_distinct(F.flatten(F.transform(F.array(compact(text)), grams)))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def metadata_value(value: Column, nested: bool = False) -> Column:
    """A value as text: null and empty are ``unknown``; a map (``nested``) is JSON in order of its keys."""
    if nested:
        value = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(value))))
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit("unknown"))


def status(text: Column, normalised: Column) -> Column:
    """rejected (no text), empty (nothing is left of it) or usable."""
    return F.when(text.isNull(), "rejected").when(F.coalesce(normalised, F.lit("")) == "", "empty").otherwise("usable")


def within_bytes(text: Column, most: int) -> Column:
    """Whether a text may be sent as it is: its UTF-8 bytes are within the limit (no text is not)."""
    return F.coalesce(F.octet_length(text) <= most, F.lit(False))


def style(sector: Column, rare: Column) -> Column:
    """Speaking style by sector; texts taken for their rare tokens are read neutrally."""
    formal = sector.isin("formal", "news", "education", "business", "health")
    lively = sector.isin("conversational", "entertainment", "sports")
    return F.when(F.coalesce(rare, F.lit(False)), "neutral").when(formal, "formal").when(lively, "conversational").otherwise("neutral")


# Sector of a source domain; anything else is news.
SECTOR_OF_DOMAIN = {
    "hamrokhelkud.com": "sports", "technologykhabar.com": "technology", "techpana.com": "technology", "ictsamachar.com": "technology",
    "nepalihealth.com": "health", "healthpati.com": "health", "karobardaily.com": "business", "arthasarokar.com": "business",
    "bizshala.com": "business", "newskarobar.com": "business", "narimag.com.np": "entertainment",
}
# Fragments of a domain that hint at a sector, in order of precedence.
SECTOR_HINTS = {
    "sports": ("sport", "khel", "खेल"), "technology": ("tech", "ict", "प्रविध"), "health": ("health", "स्वास्थ्य"),
    "business": ("business", "econom", "artha", "अर्थ"), "entertainment": ("entertain", "film", "मनोरञ्ज"), "education": ("education", "school", "शिक्ष"),
}


def sector_of(domain: Column) -> Column:
    pairs = [F.lit(x) for kv in SECTOR_OF_DOMAIN.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(F.trim(F.coalesce(domain, F.lit(""))))), F.lit("news"))


def sector_hint(domain: Column) -> Column:
    d = F.lower(F.coalesce(domain, F.lit("")))
    hits = [F.when(F.greatest(*(d.contains(x).cast("int") for x in some), F.lit(0)) == 1, F.lit(sector)) for sector, some in SECTOR_HINTS.items()]
    return F.coalesce(*hits, F.lit("news"))


def punctuation_free(text: Column) -> Column:
    """The form that speech recognition is scored on: no danda, single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[।॥.?!]", " "), f"[{WHITE}]+", " "))


def to_ids(tokens: Column, vocabulary: list[str], unknown: int = 1, start: int = 2, end: int = 3, first: int = 4) -> Column:
    """Start id, the id of each token (or the unknown id), end id; null tokens have null ids.

    It stays in the JVM, where a map is searched from its start: tokens are dealt by crc32 into
    small constant maps, and each token is looked for in the one that can hold it.
    """
    places = {t: first + i for i, t in enumerate(dict.fromkeys(vocabulary))}
    dealt: list[list] = [[] for _ in range(max(1, len(places) // 8))]
    for t, i in places.items():
        dealt[zlib.crc32(t.encode()) % len(dealt)] += [F.lit(t), F.lit(i)]
    tables = F.array(*(F.create_map(*(pairs or [F.lit(""), F.lit(unknown)])) for pairs in dealt))
    mine = lambda t: F.get(tables, (F.crc32(t.cast("binary")) % len(dealt)).cast("int"))
    ids = F.transform(tokens, lambda t: F.coalesce(F.element_at(mine(t), t), F.lit(unknown)))
    return F.when(tokens.isNotNull(), F.concat(F.array(F.lit(start)), ids, F.array(F.lit(end))))


def quality_reason(n: Column, distinct: Column, unknown: Column, least: int, most: int, least_distinct: int, most_unknown: float) -> Column:
    """Null if accepted, else short, long or quality."""
    return F.when(n < least, "short").when(n > most, "long").when((distinct < least_distinct) | (unknown > most_unknown), "quality")
