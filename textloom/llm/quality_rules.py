"""Quality rules by compression bands.

Every whole text is compressed with zstandard, and again in fixed chunks.  Compressed size
over size says how much of a text repeats: a low ratio is repetitive, a high one is noise.
The ratio falls with length by itself, so each length class has a band of its own, and the
chunks catch a stretch of junk inside a text that looks sound as a whole: 4 KiB chunks from 8 KiB
on, 1 KiB chunks from 2 KiB on, 256-byte chunks from 512 bytes on (a shorter text is judged as a
whole).  The last chunk ends where the text ends, so every byte is in a chunk; one chunk out of
its band is enough.

The limits are 0.98 times the least and 1 / 0.98 times the greatest ratio that labelled sound
text of the class has, read from the labels that are not held out; above 64 KiB, where no sound
text is labelled, the low limit falls on by 0.01 an octave.  They fit Latin-script prose: other
scripts compress differently and need bands of their own.  Short texts spread widely, so random
lower-case letters are told apart from about 1 KiB on, random hex digits from about 4 KiB on.

A null or empty text has no words, fails the base rule (fewer than 50 words) and is not
kept.  White-space-only texts likewise.  Repeated rows get the same verdict each.  Columns
of the input whose names clash with a measure are replaced in ``annotate`` and left alone
in ``filter_rows``.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import common, textkit


@dataclass(frozen=True)
class Bands:
    """Limits: ``whole`` lists (bytes below which the row holds, lowest ratio, highest ratio)."""

    level: int = 3
    whole: tuple[tuple[float, float, float], ...] = (
        (384, 0.512, 0.759), (512, 0.527, 0.752), (640, 0.513, 0.703), (768, 0.506, 0.681), (1_024, 0.485, 0.664), (1_280, 0.476, 0.614), (1_536, 0.470, 0.584),
        (2_048, 0.452, 0.576), (2_560, 0.452, 0.561), (3_072, 0.445, 0.539), (4_096, 0.439, 0.527), (5_120, 0.429, 0.522), (6_144, 0.427, 0.500), (8_192, 0.418, 0.484),
        (12_288, 0.408, 0.471), (16_384, 0.406, 0.461), (32_768, 0.395, 0.449), (65_536, 0.385, 0.441), (131_072, 0.375, 0.441), (float("inf"), 0.365, 0.441),
    )
    chunks: tuple[tuple[int, float, float], ...] = ((4_096, 0.431, 0.508), (1_024, 0.487, 0.631), (256, 0.574, 0.829))
    """Chunk sizes, largest first, each with its lowest and highest ratio; a text takes the first that fits in it twice."""
    bad_chunks: int = 0
    """Chunks out of their band above which the text goes."""


MEASURES = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()), T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()), T.StructField("zstd_ratio", T.DoubleType()), T.StructField("n_chunks", T.LongType()), T.StructField("n_bad_chunks", T.LongType()), T.StructField("kept", T.BooleanType()),
])

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base measures of each text of a batch."""
    n = len(offsets) - 1
    text_of, start, end = textkit.word_spans(data, offsets)
    prefix = textkit.prefix_hash(data)
    word = textkit.span_hash(prefix, start, end)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    out = {"n_words": np.bincount(text_of, minlength=n), "word_chars": np.bincount(text_of, points[end] - points[start], n), "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]]}
    # lines that hold a word and equal an earlier line of their text
    stop = np.flatnonzero(data == 10)
    first = np.unique(np.concatenate((offsets[:-1][np.diff(offsets) > 0], stop + 1)))
    first = first[first < len(data)]
    owner = np.searchsorted(offsets, first, "right") - 1
    last = np.minimum(offsets[owner + 1], np.append(stop, len(data))[np.searchsorted(stop, first)]) if len(first) else first
    worded = np.searchsorted(start, last) > np.searchsorted(start, first)
    owner, first, last = owner[worded], first[worded], last[worded]
    t, _ = textkit.distinct_per_text(owner, textkit.span_hash(prefix, first, last))
    out["n_dup_lines"] = np.bincount(owner, minlength=n) - np.bincount(t, minlength=n)
    # words inside three-word windows that occur twice or more in their text
    repeated = np.zeros(len(word) + 2, bool)
    if len(word) >= 3:
        one = np.flatnonzero(text_of[:-2] == text_of[2:])
        h = textkit.mix(word[:-2][one] + textkit.mix(word[1:-1][one] + textkit.mix(word[2:][one])))
        order = np.lexsort((h, text_of[one]))
        a, b = order[:-1], order[1:]
        same = (h[a] == h[b]) & (text_of[one][a] == text_of[one][b])
        again = one[np.unique(np.concatenate((a[same], b[same])))]
        for k in range(3):
            repeated[again + k] = True
    out["n_repeat_words"] = np.bincount(text_of, repeated[: len(word)], n)
    return {k: v.astype(np.int64) for k, v in out.items()}


def compress(raw: memoryview, bands: Bands, packer) -> tuple[float, int, int, bool]:
    """Ratio of the whole, chunks, chunks out of band, and whether the bands hold."""
    size = len(raw)
    if not size:
        return 0.0, 0, 0, False
    ratio = len(packer.compress(raw)) / size
    low, high = next((lo, hi) for most, lo, hi in bands.whole if size < most)
    chunk, least, most = next((c for c in bands.chunks if size >= 2 * c[0]), (0, 0.0, 0.0))
    starts = [*range(0, size - chunk, chunk), size - chunk] if chunk else []
    bad = sum(not least <= len(packer.compress(raw[at : at + chunk])) / chunk <= most for at in starts)
    return ratio, len(starts), bad, low <= ratio <= high and bad <= bands.bad_chunks


def annotate(docs: DataFrame, bands: Bands = Bands(), columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (default: all) and the measures; one narrow pass, no shuffle."""
    common.ship(docs.sparkSession)
    keep = [c for c in (columns or docs.columns) if c not in MEASURES.names]
    src = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("__text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)
        for part in parts:
            got: dict[str, list] = {c: [] for c in MEASURES.names}
            for a, b, data, offsets in textkit.batches(part.column(len(keep))):
                m = measure(data, offsets)
                m["base_failed"] = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
                raw = memoryview(np.ascontiguousarray(data))
                zipped = [compress(raw[offsets[i] : offsets[i + 1]], bands, packer) for i in range(b - a)]
                m["zstd_ratio"] = np.array([z[0] for z in zipped], float)
                m["n_chunks"] = np.array([z[1] for z in zipped], np.int64)
                m["n_bad_chunks"] = np.array([z[2] for z in zipped], np.int64)
                m["kept"] = np.array([z[3] for z in zipped], bool) & ~m["base_failed"]
                for c in got:
                    got[c].append(m[c])
            arrays = [pa.array(np.concatenate(v) if v else np.zeros(0)) for v in got.values()]
            arrays = [x.cast(t) for x, t in zip(arrays, (pa.int64(),) * 5 + (pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)] if part.num_rows else []
            if arrays:
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *arrays], [*keep, *MEASURES.names])

    schema = T.StructType([*src.select(*keep).schema.fields, *MEASURES.fields])
    return src.mapInArrow(run, schema)


def filter_rows(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows that pass, with the columns of ``docs`` untouched."""
    clash = {c: f"__own_{c}" for c in docs.columns if c in MEASURES.names}
    got = annotate(docs.withColumnsRenamed(clash), bands).filter("kept").drop(*MEASURES.names)
    return got.withColumnsRenamed({v: k for k, v in clash.items()}).select(*docs.columns)
