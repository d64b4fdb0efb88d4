"""Manifests and speaker-disjoint splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as T


def usable(rows: DataFrame, threshold: float, quarantined=()) -> DataFrame:
    """rows outside quarantined files whose score reaches the threshold; null scores go."""
    kept = rows.where(~F.col("file").isin(*quarantined)) if quarantined else rows
    return kept.where(F.col("avg_score") >= threshold)


def with_split(rows: DataFrame, assignment: DataFrame, default: str = "train") -> DataFrame:
    """Each row's split by its speaker; speakers without one get the default and are marked."""
    joined = rows.join(assignment.select("speaker", "split"), "speaker", "left")
    return joined.withColumn("unknown_speaker", F.col("split").isNull()).withColumn("split", F.coalesce("split", F.lit(default)))


def split_summary(rows: DataFrame) -> DataFrame:
    """A11"""
    return rows.groupBy("split").agg(F.count_distinct("speaker").alias("speakers"), F.count("*").alias("segments"), F.round(F.sum("duration") / 3600, 6).alias("hours"))


def unknown_speakers(rows: DataFrame) -> DataFrame:
    """A12"""
    return rows.where("unknown_speaker").groupBy("speaker").agg(F.count("*").alias("segments"), F.round(F.sum("duration") / 60, 6).alias("minutes"))


def shuffle_key(seed: int, key: Column) -> Column:
    """Sorting by this key shuffles rows the same way each time; the members of a split don't depend on it."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def shuffled_like_python(keys: list, seed: int) -> list:
    """S5 with the exact order of Python's generator, for key lists that fit the driver."""
    import random

    out = list(keys)
    random.Random(seed).shuffle(out)
    return out


def chunk_rows(timeline: DataFrame, chunks: DataFrame, file: str = "file_no", order=("start_abs", "event_id")) -> DataFrame:
    """A row for each chunk with the text of its words; chunks without text are dropped."""
    w = timeline.groupBy(file, "chunk_index").agg(T.join_words(F.transform(F.array_sort(F.collect_list(F.struct(*order, "word"))), lambda x: x["word"])).alias("text"))
    return chunks.join(w.where("text <> ''"), [file, "chunk_index"]).select(file, "chunk_index", F.col("chunk_file").alias("audio_filepath"), F.round(F.col("end_s") - F.col("start_s"), 3).alias("duration"), "text", F.lit("chunk").alias("unit"))


def segment_rows(segments: DataFrame, file: str = "file_no") -> DataFrame:
    """A row for each speaker segment."""
    name = T.segment_name(F.col(file), F.col("speaker"), F.col("seg_index"), F.col("start_abs"), F.col("end_abs"))
    return segments.select(file, name.alias("audio_filepath"), F.round("duration", 3).alias("duration"), T.join_words(F.col("words")).alias("text"), F.lit("segment").alias("unit"), "speaker", "seg_index", "avg_score", "min_score").where("text <> ''")


def all_rows(*parts: DataFrame) -> DataFrame:
    """Chunk and segment rows as one relation."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
