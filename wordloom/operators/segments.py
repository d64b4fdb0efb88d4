"""Speaker maps, timelines, segment manifests and label rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import text as T


def speaker_map(transcripts: DataFrame, file: str = "file_no", value: str = "value") -> DataFrame:
    """SC2: file, ref_word_idx, speaker_id, word. A label line starts a block; text before the first label is dropped.

    The lines of a block are joined before they are cleaned, and words are numbered through the file.
    """
    lines = transcripts.select(file, F.posexplode(F.split(F.regexp_replace(value, "^﻿", ""), "\r?\n")).alias("at", "line"))
    lines = lines.withColumn("line", F.regexp_replace("line", r"(?U)^\s+|\s+$", ""))
    label = F.when(F.col("line").rlike(r"(?U)^spk_\w+:$"), F.expr("substring(line, 1, length(line) - 1)"))
    w = Window.partitionBy(file).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("label", label).withColumn("block", F.count("label").over(w))
    blocks = lines.where("block > 0").groupBy(file, "block").agg(
        F.max("label").alias("speaker_id"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("label").isNull() & (F.col("line") != ""), F.struct("at", "line")))), lambda x: x["line"]), " ").alias("text"),
    )
    blocks = blocks.withColumn("words", T.words(T.speaker_text(F.col("text"))))
    before = F.coalesce(F.sum(F.size("words")).over(Window.partitionBy(file).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocks.withColumn("first", before).select(file, "speaker_id", "first", F.posexplode("words").alias("k", "word")).select(
        file, (F.col("first") + F.col("k")).alias("ref_word_idx"), "speaker_id", "word"
    )


def with_speakers(timeline: DataFrame, speakers: DataFrame, file: str = "file_no", order: str | None = None) -> DataFrame:
    """Each word's speaker by its reference index, UNKNOWN without one. Of several the last by `order` counts (without one,
    the last by name), so the order in which rows arrive doesn't matter."""
    s = speakers.groupBy(file, "ref_word_idx").agg(F.max_by("speaker_id", F.struct(*([order] if order else []), "speaker_id")).alias("speaker_id"))
    return timeline.join(s, [file, "ref_word_idx"], "left").withColumn("speaker_id", F.coalesce("speaker_id", F.lit("UNKNOWN")))


def timeline(chunks: DataFrame, words1: str = "words1", words2: str = "words2") -> DataFrame:
    """The words of the second correction (or the first), in absolute time, with their reference index."""
    c2 = F.coalesce(words2, words1)
    head = F.greatest(F.lit(0), F.size(words1) - F.size(c2))
    out = chunks.withColumn("head", head).select("file_no", "chunk_index", "start_s", "start_idx", "head", F.posexplode(c2).alias("i", "w"))
    return out.select(
        "file_no", "chunk_index", F.col("w.word").alias("word"), F.round(F.col("start_s") + F.col("w.start"), 4).alias("start_abs"), F.round(F.col("start_s") + F.col("w.end"), 4).alias("end_abs"),
        F.col("w.score").alias("score"), (F.col("start_idx") + F.col("head") + F.col("i")).alias("ref_word_idx"),
    )


def speaker_stats(segments: DataFrame, file: str = "file_no") -> DataFrame:
    """A9"""
    return segments.groupBy(file, "speaker").agg(F.count("*").alias("segments"), F.round(F.sum("duration"), 2).alias("total_duration_s"), F.sum("word_count").alias("total_words"))


def label_line(start: Column, end: Column, label: Column) -> Column:
    """SK5, N7: a line of a label file."""
    return F.format_string("%.3f\t%.3f\t%s", start, end, label)


def word_label(word: Column, score: Column) -> Column:
    return F.when(score.isNull(), word).otherwise(F.format_string("%s (%.3f)", word, score))
