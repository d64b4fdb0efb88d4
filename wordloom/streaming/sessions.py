"""An extension: speaker sessions over a stream of words, by time gap alone.

The batch segmentation also ends a segment where the speaker changes; a session window can't, so the speaker is part of
the key here and interleaved speakers give other sessions. The batch operator stays the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def speaker_sessions(words: DataFrame, gap: str = "8 hours", late: str = "1 hour", at: str = "ts") -> DataFrame:
    """words: file_no, speaker, ts, score -> a row for each session of a speaker; late words are bounded by the watermark."""
    w = words.withWatermark(at, late) if words.isStreaming else words
    g = w.groupBy("file_no", "speaker", F.session_window(at, gap).alias("session"))
    return g.agg(F.count("*").alias("words"), F.avg("score").alias("avg_score")).select("file_no", "speaker", F.col("session.start").alias("start"), F.col("session.end").alias("end"), "words", "avg_score")
