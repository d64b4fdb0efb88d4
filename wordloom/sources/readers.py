"""Scans of the corpus files, all with explicit schemas and lazy."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as T


def spread(df: DataFrame) -> DataFrame:
    """Deals rows out evenly where a scan has fewer splits than the cluster has cores (a small file of one row group); a scan
    of many splits stays as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a folder."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """SC1: file_no, value; the number comes from the file's name."""
    t = spark.read.text(path, wholetext=True).withColumn("name", F.input_file_name())
    return t.select(F.regexp_extract("name", r"(\d+)\.txt$", 1).cast("int").alias("file_no"), "value")


def transcript_words(t: DataFrame) -> DataFrame:
    """SC1: the clean and the natural words of each transcript, word for word the same length."""
    return t.select("file_no", T.words(T.clean_text(F.col("value"))).alias("clean"), T.words(T.align_text(F.col("value"))).alias("natural"))


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SC3: one document a file, with the file's name as order key."""
    return spark.read.schema(schema).option("multiLine", "true").json(path).withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SC4"""
    return spark.read.schema(schema).json(path)


def csv_rows(spark: SparkSession, path: str, schema: str | None = None, sep: str = ",") -> DataFrame:
    """SC5: with a header; without a schema all columns are text."""
    reader = spark.read.option("header", "true").option("sep", sep).option("escape", '"').option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).csv(path)


_SCORE = r"\(([0-9.]+)\)"


def labels(lines: DataFrame, value: str = "value") -> DataFrame:
    """SC6: start, end, word, score of label lines; lines of another form are skipped."""
    line, form = F.trim(F.col(value)), r"^([\d.]+)\t([\d.]+)\t(.+)"
    rest = F.regexp_extract(line, form, 3)
    score = F.nullif(F.regexp_extract(rest, _SCORE, 1), F.lit("")).cast("double")
    return lines.where(line.rlike(form)).select(
        *[c for c in lines.columns if c != value], F.regexp_extract(line, form, 1).cast("double").alias("start"), F.regexp_extract(line, form, 2).cast("double").alias("end"),
        F.trim(F.regexp_replace(rest, r"\s*\([0-9.]+\)", "")).alias("word"), score.alias("score"),
    )


def label_words(lines: DataFrame, value: str = "value") -> DataFrame:
    """SC6b: only the words: the third column without its last " (...)"."""
    parts = F.split(value, "\t")
    return lines.where(F.size(parts) >= 3).select(*[c for c in lines.columns if c != value], F.regexp_replace(F.get(parts, F.lit(2)), r" \([^(]*$", "").alias("word"))


def label_files(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.text(path).withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return labels(t)


class ShortHeader(ValueError):
    """More bytes are needed to find the samples."""


def wav_layout(head: bytes) -> tuple[int, int, int, int, int]:
    """Rate, channels, bits, data bytes and where the data begin, by walking the chunks of a RIFF file."""
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("no WAV file")
    at, rate, channels, bits = 12, 0, 0, 0
    while at + 8 <= len(head):
        name, size = head[at : at + 4], struct.unpack_from("<I", head, at + 4)[0]
        if name == b"fmt ":
            if at + 24 > len(head):
                break
            _, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", head, at + 8)
        elif name == b"data":
            if not rate:
                raise ValueError("no format before the data")
            return rate, channels, bits, size, at + 8
        at += 8 + size + size % 2
    raise ShortHeader("no data chunk")


def wav_info(head: bytes) -> tuple[int, int, int, int]:
    """Rate, channels, bits and data bytes from a RIFF header."""
    return wav_layout(head)[:4]


def wav_files(spark: SparkSession, path: str) -> DataFrame:
    """SC7: path and content of the WAV files below a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.wav").load(path).select("path", "content")


def _opened(path: str):
    """A file as a random-access stream."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _layout_of(stream) -> tuple[int, int, int, int, int]:
    """The layout from as much of a file as its chunks before the data take."""
    size, want = stream.size(), 4096
    while True:
        try:
            return wav_layout(stream.read_at(min(want, size), 0))
        except ShortHeader:
            if want >= size:
                raise
            want *= 8


def wav_durations(spark: SparkSession, path: str) -> DataFrame:
    """SC8: path and seconds of each file. Spark lists the files; tasks open them and read headers only."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p in b["path"]:
                with _opened(p) as stream:
                    rate, channels, bits, size, _ = _layout_of(stream)
                rows.append((p, size / (rate * channels * bits // 8)))
            yield pd.DataFrame(rows, columns=["path", "seconds"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.wav").load(path)
    return files.select("path").mapInPandas(read, "path string, seconds double")


def wav_ranges(rows: DataFrame, path: str = "path", start: str = "start_sample", stop: str = "stop_sample") -> DataFrame:
    """SC9: rows with `pcm`, the 16-bit samples of [start, stop) of a mono file; only that range is read."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "pcm binary"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = []
            for p, i, j in zip(b[path], b[start], b[stop], strict=True):
                with _opened(p) as stream:
                    _, channels, bits, size, at = _layout_of(stream)
                    if channels != 1 or bits != 16:
                        raise ValueError(f"{p}: {channels} channels, {bits} bits; expected mono, 16 bits")
                    i, j = max(0, int(i)) * 2, min(int(j) * 2, size)
                    found.append(bytes(stream.read_at(max(0, j - i), at + i)))
            yield b.assign(pcm=found)

    return rows.mapInPandas(read, schema)


def in_range(rows: DataFrame, start: int, end: int, file: str = "file_no") -> DataFrame:
    """SC11: files of [start, end)."""
    return rows.where((F.col(file) >= start) & (F.col(file) < end))


def file_ids(tokens) -> list[int]:
    """SC12: numbers, names and inclusive ranges -> sorted numbers."""
    found: set[int] = set()
    for token in tokens:
        ends = [int(x) for x in re.findall(r"\d+", str(token).lower().replace("audio_file_", ""))]
        if not 1 <= len(ends) <= 2:
            raise ValueError(f"not a file id: {token!r}")
        found.update(range(ends[0], ends[-1] + 1))
    return sorted(found)


def cached(spark: SparkSession, path: str, expected: int, make) -> DataFrame:
    """SC13: what is stored, if it has as many rows as expected; otherwise made and stored."""
    try:
        stored = spark.read.parquet(path)
        if stored.count() == expected:
            return stored
    except Exception as e:  # noqa: BLE001  only a missing path means that nothing is stored
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def assignment(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of speakers, or of splits with lists of speakers -> speaker, split."""
    text = spark.read.text(path, wholetext=True)
    keyed = F.explode(F.from_json("value", "map<string,struct<split:string,duration_s:double,segments:int>>"))
    listed = F.explode(F.from_json("value", "map<string,array<string>>"))
    a = text.select(keyed).select(F.col("key").alias("speaker"), F.col("value.split").alias("split")).where("split is not null")
    b = text.select(listed).select(F.col("key").alias("split"), F.explode("value").alias("speaker")).select("speaker", "split")
    return a.union(b)
