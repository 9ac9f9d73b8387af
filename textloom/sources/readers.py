"""Readers by kind; each gives explicit columns and leaves pruning and splits to Spark."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from textloom.functions import text as T
from textloom.profile import WHITE


def _first(rows: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first rows by file and place; a limit of 0 or less is none."""
    return rows.orderBy(*order).limit(limit) if limit > 0 else rows


def parquet(spark: SparkSession, path: str | list[str], columns: list[str] | None = None, skip_corrupt: bool = False, limit: int = 0) -> DataFrame:
    """Projected scan; missing columns are an error before any row is read."""
    df = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(*([path] if isinstance(path, str) else path))
    if missing := set(columns or []) - set(df.columns):
        raise ValueError(f"columns not found: {sorted(missing)}")
    names = columns or df.columns
    if limit <= 0:
        return df.select(*names)
    at = {"__file": F.col("_metadata.file_path"), "__at": F.col("_metadata.row_index")}
    return _first(df.select(*names, *(v.alias(k) for k, v in at.items())), list(at), limit).select(*names)


def articles(spark: SparkSession, path: str, split: str = "", shards: int = 0, limit: int = 0) -> DataFrame:
    """text, source of Parquet shards with Article and Source, whose names begin with ``split``;
    the first ``shards`` of them by name (0: all).  Unreadable shards are passed over; no shard is an error."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path, f"{split}*.parquet")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    files = sorted(f.getPath().toString() for f in found)
    files = files[:shards] if shards > 0 else files
    if not files:
        raise FileNotFoundError(f"no shards {split}*.parquet at {path}")
    rows = spark.read.schema("Article string, Source string").option("ignoreCorruptFiles", "true").parquet(*files)
    at = {"__file": F.col("_metadata.file_path"), "__at": F.col("_metadata.row_index")}
    rows = rows.select(F.col("Article").alias("text"), F.col("Source").alias("source"), *(v.alias(k) for k, v in at.items()))
    return _first(rows, list(at), limit).select("text", "source")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, block (where its split begins) and at (rising within the split)."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def jsonl(spark: SparkSession, path: str, schema: str, keep_blank: bool = True, limit: int = 0) -> DataFrame:
    """One object a line; a blank line (white space alone) is an empty record, anything malformed an error."""
    lines = _lines(spark, path)
    blank = T.compact(F.col("value")) == ""
    if not keep_blank:
        lines = lines.filter(~blank)
    lines = _first(lines, ["file", "block", "at"], limit)
    return lines.select(F.when(~blank, F.from_json("value", schema, {"mode": "FAILFAST"})).alias("r")).select("r.*")


def text_lines(spark: SparkSession, path: str, skip: tuple[tuple[int, int], ...] = (), limit: int = 0) -> DataFrame:
    """file, line (from 1), text without its line end; ``skip`` lists ranges of lines.

    Files are split as Spark splits them: lines are numbered within a split and shifted by the
    lines of the splits before it, so a large file is many tasks' work."""
    rows = _lines(spark, path)
    w = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")).select("file", "block", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    rows = rows.withColumn("line", F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))).join(shift, ["file", "block"])
    rows = rows.select("file", (F.col("line") + F.col("before")).alias("line"), F.regexp_replace("value", "[\r\n]+$", "").alias("text"))
    for a, b in skip:
        rows = rows.filter(~F.col("line").between(a, b))
    return _first(rows, ["file", "line"], limit)


def book(spark: SparkSession, path: str, skip: tuple[tuple[int, int], ...] = ((1, 1), (782, 786)), limit: int = 0) -> DataFrame:
    """Text lines without their page marks (a slash and digits)."""
    return text_lines(spark, path, skip, limit).withColumn("text", F.regexp_replace("text", "/[०-९]+", ""))


def paragraphs_by_pattern(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """Everything between <p...> and the next </p>, any case, over lines; an open tail is lost."""
    return pages.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<p[^>]*>(.*?)</p>"), F.lit(1))).alias("pos", "text"))


class _Paragraphs(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.parts, self.found = 0, [], []

    def handle_starttag(self, tag, attrs) -> None:
        self.depth += tag == "p"

    def handle_data(self, data) -> None:
        if self.depth:
            self.parts.append(data)

    def handle_endtag(self, tag) -> None:
        if tag == "p" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.found.append(" ".join(self.parts))
                self.parts = []


def parse_paragraphs(html: str | None) -> list[str]:
    p = _Paragraphs()
    p.feed(html or "")
    return p.found


@F.pandas_udf(ArrayType(StringType()))
def _paragraphs(html: pd.Series) -> pd.Series:
    return html.map(parse_paragraphs)


def paragraphs(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """Paragraphs by a real parser; nested ones belong to the outermost."""
    return pages.select(*keep, F.posexplode(_paragraphs(html)).alias("pos", "text"))


def html_paragraphs(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """file, pos, text of the paragraphs of HTML files; none at all is an error."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    rows = paragraphs(pages, "value", ["file"])
    if rows.isEmpty():
        raise ValueError(f"no paragraphs in {path}")
    return _first(rows, ["file", "pos"], limit)


def stripped_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line, text: lines without white space around them; blank ones are passed over."""
    return text_lines(spark, path).withColumn("text", F.regexp_replace("text", f"^[{WHITE}]+|[{WHITE}]+$", "")).filter("text <> ''")


def hashes(spark: SparkSession, path: str) -> DataFrame:
    """hash: the first field of each line, once; a file that is not there holds none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "hash string")
    return spark.read.text(path).select(F.get(F.split(T.compact(F.col("value")), " "), F.lit(0)).alias("hash")).filter("hash <> ''").distinct()


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """The third field of each tab-separated line, else the last; distinct, sorted."""
    f = F.split("value", "\t")
    return spark.read.text(path).select(F.trim(F.when(F.size(f) >= 3, F.element_at(f, 3)).otherwise(F.element_at(f, -1))).alias("text")).filter("text <> ''").distinct().orderBy("text")


def speakers(spark: SparkSession, path: str) -> DataFrame:
    """file_id, speaker_id, transcript, trimmed; rows that lack one are passed over.  A line with
    fewer than three fields is an error; the first line of a file is a header if its first
    field speaks of a file.  Tabs beyond the second belong to the transcript."""
    rows = text_lines(spark, path).filter(T.compact(F.col("text")) != "").select("line", F.split(F.regexp_replace("text", "^\ufeff", ""), "\t", 3).alias("f"))
    header = (F.col("line") == 1) & F.lower(F.col("f")[0]).contains("file")
    rows = rows.filter(~header).withColumn("ok", F.assert_true(F.size("f") >= 3, F.lit("three fields are needed")))
    part = lambda i: F.regexp_replace(F.col("f")[i], f"^[{WHITE}]+|[{WHITE}]+$", "")
    rows = rows.filter(F.col("ok").isNull()).select(part(0).alias("file_id"), part(1).alias("speaker_id"), part(2).alias("transcript"))
    return rows.filter("file_id <> '' AND speaker_id <> '' AND transcript <> ''")


def index(spark: SparkSession, path: str) -> DataFrame:
    """key, value lines; a repeated key is an error."""
    rows = spark.read.text(path).filter(F.trim("value") != "").select(F.split("value", "\\s+", 2).alias("f"))
    rows = rows.groupBy(F.col("f")[0].alias("key")).agg(F.min(F.coalesce(F.get("f", F.lit(1)), F.lit(""))).alias("value"), F.count(F.lit(1)).alias("n"))
    return rows.withColumn("ok", F.assert_true(F.col("n") == 1, F.lit("a key is repeated"))).filter(F.col("ok").isNull()).select("key", "value")


def results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """QC results below a folder: Parquet if there is any, else JSON lines."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    found = reader.option("pathGlobFilter", "*.parquet").parquet(path)
    return found if not found.isEmpty() else reader.option("pathGlobFilter", "*.jsonl").json(path)


_WAV = "file string, frames long, rate long, channels int, bits int, duration double, peak double, rms double, clipping double, lead double, trail double, gap double"


def wav_metrics(spark: SparkSession, path: str, clip: float = 0.999) -> DataFrame:
    """Measures of WAV files: frames, rate, channels, bits, duration, peak, rms, clipping share,
    and seconds of silence at the start, at the end and the longest within.

    Silence is below a tenth of the rms, or below -50 dB; channels are averaged.  A file that
    is all silence has its duration thrice; other than 16 bits has no measures of samples.
    """
    import io
    import wave

    import numpy as np

    def measure(raw: bytes) -> tuple:
        with wave.open(io.BytesIO(raw)) as w:
            frames, rate, channels, bits = w.getnframes(), w.getframerate(), w.getnchannels(), 8 * w.getsampwidth()
            data = w.readframes(frames)
        duration = frames / rate if rate else 0.0
        if bits != 16:
            return frames, rate, channels, bits, duration, *[None] * 6
        x = np.frombuffer(data, "<i2").astype(float).reshape(-1, channels).mean(1) / 32768
        if not len(x):
            return frames, rate, channels, bits, 0.0, *[0.0] * 6
        loud, rms = np.abs(x), float(np.sqrt((x * x).mean()))
        active = np.flatnonzero(loud >= max(rms * 0.1, 10**-2.5))
        still = [active[0], len(x) - 1 - active[-1], max(0, np.diff(active).max(initial=1) - 1)] if len(active) else [len(x)] * 3
        return frames, rate, channels, bits, duration, float(loud.max()), rms, float((loud >= clip).mean()), *(float(n / rate) for n in still)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame([(file, *measure(raw)) for file, raw in zip(pdf.path, pdf.content, strict=True)], columns=[c.split()[0] for c in _WAV.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path).select("path", "content")
    return files.mapInPandas(run, _WAV)


def vocabulary(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Tokens of a vocabulary file, one a line; a line of one space is a token, an empty one is not."""
    return tuple(r["value"] for r in spark.read.text(path).filter("value <> ''").collect())  # a vocabulary


def coverage_targets(spark: SparkSession, path: str, skip: set[str]) -> DataFrame:
    """token: from a JSON list, a JSON object (``syllables``, else the keys of
    ``syllable_sentence_frequency``) or plain lines; none left is an error."""
    raw = bytes(spark.read.format("binaryFile").load(path).first()["content"]).decode()
    try:
        value = json.loads(raw)
    except json.JSONDecodeError:
        value = [line.strip() for line in raw.splitlines()]
    if isinstance(value, dict):
        value = value["syllables"] if value.get("syllables") is not None else list(value.get("syllable_sentence_frequency", {}))
    if not isinstance(value, list):
        raise ValueError("targets are a list, or an object that holds one")
    found = sorted({str(v) for v in value} - skip - {""})
    if not found:
        raise ValueError(f"no targets in {path}")
    return spark.createDataFrame([(v,) for v in found], "token string")


def validated(spark: SparkSession, name: str, kind: str, path: str, columns: tuple[str, ...] = (), glob: str = "*") -> dict:
    """Files and bytes of a source, looked at before any scan.  No file, an unknown kind or a
    Parquet source without a column that is asked for is an error."""
    if kind not in KINDS:
        raise ValueError(f"{name}: unknown kind {kind!r}")
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder = fs.exists(at) and fs.getFileStatus(at).isDirectory()
    found = (fs.globStatus(jvm.org.apache.hadoop.fs.Path(at, glob)) if folder else fs.globStatus(at)) or []
    found = [f for f in found if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    if not found:
        raise FileNotFoundError(f"{name}: no files at {path}")
    if kind == "parquet":
        for f in found:
            lacking = sorted(set(columns) - set(spark.read.parquet(f.getPath().toString()).columns))
            if lacking:
                raise ValueError(f"{name}: {f.getPath().getName()} lacks {', '.join(lacking)}")
    return {"name": name, "kind": kind, "files": len(found), "bytes": sum(f.getLen() for f in found)}


KINDS = {"parquet": parquet, "jsonl": jsonl, "text_lines": text_lines, "text": text_lines, "html_paragraphs": html_paragraphs, "book": book, "articles": articles}


def read(spark: SparkSession, kind: str, path: str, limit: int = 0, **options) -> DataFrame:
    """Dispatch by kind; the first ``limit`` rows by file and place, all if it is 0 or less."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    return KINDS[kind](spark, path, limit=limit, **options)


@dataclass(frozen=True)
class Corpus:
    """A corpus of a configuration; unknown keys are ignored."""

    name: str
    slug: str
    kind: str
    path: str
    text_column: str = "text"
    file_glob: str = "**/*.parquet"
    metadata_columns: dict[str, str] = field(default_factory=dict)

    def rows(self, spark: SparkSession, root: str = "", limit: int = 0) -> DataFrame:
        """corpus (the slug), text and metadata (a map, by the names that the configuration gives)."""
        path = self.path if "://" in self.path or self.path.startswith("/") or not root else f"{root.rstrip('/')}/{self.path}"
        columns = list(dict.fromkeys([self.text_column, *self.metadata_columns.values()]))
        if self.kind == "jsonl":
            got = read(spark, "jsonl", path, limit, schema=", ".join(f"`{c}` string" for c in columns))
        else:
            got = read(spark, self.kind, path, limit, **({"columns": columns} if self.kind == "parquet" else {}))
        entries = [x for k, c in self.metadata_columns.items() if c in got.columns for x in (F.lit(k), F.col(c).cast("string"))]
        metadata = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
        return got.select(F.lit(self.slug).alias("corpus"), F.col(self.text_column if self.text_column in got.columns else "text").alias("text"), metadata.alias("metadata"))


def corpora(config: dict) -> list[Corpus]:
    """The corpora of a configuration, in its order.  None, one without name, slug, kind or path,
    an unknown kind or a slug that comes twice is an error."""
    found = []
    for item in (config or {}).get("corpora") or []:
        if lacking := sorted({"name", "slug", "kind", "path"} - set(item)):
            raise ValueError(f"a corpus lacks {', '.join(lacking)}")
        if item["kind"] not in KINDS:
            raise ValueError(f"{item['name']}: unknown kind {item['kind']!r}")
        found.append(Corpus(**{k: v for k, v in item.items() if k in Corpus.__dataclass_fields__}))
    if not found:
        raise ValueError("no corpora are configured")
    if len({c.slug for c in found}) < len(found):
        raise ValueError("slugs of corpora must be unique")
    return found


def load_corpora(spark: SparkSession, path: str) -> list[Corpus]:
    """``corpora`` of a YAML file, wherever Spark can read it."""
    import yaml

    return corpora(yaml.safe_load("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())))  # one file


def union_in_order(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """All sources in one frame with their name and priority."""
    out = None
    for prio, (name, rows) in enumerate(sources):
        rows = rows.withColumns({"corpus": F.lit(name), "prio": F.lit(prio)})
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
