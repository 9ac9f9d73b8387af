"""Written to spoken text: dates, percentages, currency, decimals and digits as words."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Digits, words for digits and signs, marks of rupees, reasons and names of steps.
DIGITS = "०१२३४५६७८९"
DIGIT_WORDS = ("शून्य", "एक", "दुई", "तीन", "चार", "पाँच", "छ", "सात", "आठ", "नौ")
POINT, PERCENT, RUPEES, YEAR, MONTH, DAY, DANDA = "दशमलव", "प्रतिशत", "रुपैयाँ", "साल", "महिना", "गते", "।"
CURRENCY = r"(?:रु\.?|रू\.?|₨|NPR)"
UNCLEAR, NOTHING = "ambiguous_numeric_form", "empty_after_normalization"
STEPS = {"date": "expanded_date_ymd", "percent": "expanded_percentage", "money": "expanded_currency", "decimal": "expanded_decimal", "digits": "expanded_digits"}

_D = "[०-९0-9]"
_N = rf"{_D}+(?:[.,]{_D}+)?"
_DATE = re.compile(rf"(?<!{_D})({_D}{{4}})\s*[-/]\s*({_D}{{1,2}})\s*[-/]\s*({_D}{{1,2}})(?!{_D})")
_TWO_WAYS = re.compile(rf"{_D}\s*[/:-]\s*{_D}")
_PERCENT, _MONEY, _NUMBER = re.compile(rf"({_N})\s*%"), re.compile(rf"{CURRENCY}\s*({_N})"), re.compile(_N)
_WORDS = {ord(c): f" {w} " for i, w in enumerate(DIGIT_WORDS) for c in (DIGITS[i], str(i))}


class Spoken(NamedTuple):
    """status is ok, or quarantine with a reason; tts ends in a danda, asr has no marks."""

    status: str
    reason: str | None
    source: str
    tts: str | None = None
    asr: str | None = None
    steps: tuple[str, ...] = ()


def _spell(number: str) -> str:
    return " ".join(number.translate(_WORDS).split())


def _spaced(text: str) -> str:
    return " ".join(unicodedata.normalize("NFC", text).split())


def plain(text: str) -> str:
    """The form that recognition is scored on: Devanagari without marks and dandas."""
    return _spaced(re.sub(r"[^ऀ-ॿ\s]|[।॥]", " ", text))


def speak(text: str | None) -> Spoken:
    """Numbers are spelled digit by digit; a date needs its year first.  Two numbers with a slash,
    colon or hyphen between them that are no date can be read in two ways: such a text waits
    for a person.  No text counts as an empty one."""
    source = _spaced(text or "")
    steps: set[str] = set()

    def put(pattern: re.Pattern, said, step: str, value: str) -> str:
        value, n = pattern.subn(said, value)
        if n and step:
            steps.add(STEPS[step])
        return value

    def number(m: re.Match) -> str:
        whole, *part = re.split("[.,]", m[0], maxsplit=1)
        steps.add(STEPS["decimal" if part else "digits"])
        return " ".join([_spell(whole), POINT, _spell(part[0])] if part else [_spell(whole)])

    value = put(_DATE, lambda m: f"{_spell(m[1])} {YEAR} {_spell(m[2])} {MONTH} {_spell(m[3])} {DAY}", "date", source)
    if _TWO_WAYS.search(value):
        return Spoken("quarantine", UNCLEAR, source)
    value = put(_PERCENT, lambda m: f"{m[1]} {PERCENT}", "percent", value)
    value = put(_MONEY, lambda m: f"{m[1]} {RUPEES}", "money", value)
    asr = plain(put(_NUMBER, number, "", value))
    if not asr:
        return Spoken("quarantine", NOTHING, source)
    return Spoken("ok", None, source, asr + DANDA, asr, tuple(sorted(steps)))


_SCHEMA = StructType([StructField(c, StringType()) for c in ("status", "reason", "source", "tts", "asr")] + [StructField("steps", ArrayType(StringType()))])


@F.pandas_udf(_SCHEMA)
def spoken(text: pd.Series) -> pd.DataFrame:
    said = [speak(t) for t in text]
    return pd.DataFrame([s._replace(steps=list(s.steps)) for s in said], columns=list(Spoken._fields))
