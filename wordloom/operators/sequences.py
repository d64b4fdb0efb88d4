"""Ordered-sequence operators: rolling means, hysteresis, runs, sessions.

Each works within a recording (`file`), ordered by `order` (a total order); the rows of one recording are sorted on one
task and spill if they must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(file: str, order) -> Window:
    return Window.partitionBy(file).orderBy(*order)


def expected_positions(chunks: DataFrame, file: str, order, speech: str, ref_words: str, fallback: float) -> DataFrame:
    """Reference position at which each chunk should start: words a second times the speech before it."""
    total = F.sum(speech).over(Window.partitionBy(file))
    before = F.coalesce(F.sum(speech).over(_by(file, order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    wps = F.when(total > 0, F.col(ref_words) / total).otherwise(F.lit(fallback))
    return chunks.withColumn("wps", wps).withColumn("expected_pos", (before * F.col("wps")).cast("long"))


def smooth(rows: DataFrame, value: str, file: str, order, window: int = 3, skip_nulls: bool = False, out: str = "smoothed") -> DataFrame:
    """Centred mean, shorter at both ends; nulls count as zero or, with skip_nulls, not at all."""
    half = window // 2
    v = F.col(value) if skip_nulls else F.coalesce(F.col(value), F.lit(0.0))
    return rows.withColumn(out, F.avg(v).over(_by(file, order).rowsBetween(-half, half)))


def hysteresis(rows: DataFrame, value: str, file: str, order, high: float, low: float, out: str = "state") -> DataFrame:
    """High from a value of `high` on, low again from `low` down; the last trigger decides, so no state is carried."""
    trigger = F.when(F.col(value) >= high, F.lit("high")).when(F.col(value) <= low, F.lit("low"))
    last = F.last(trigger, ignorenulls=True).over(_by(file, order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, F.coalesce(last, F.lit("low")))


def numbered_runs(rows: DataFrame, state: str, file: str, order, out: str = "run") -> DataFrame:
    """Numbers the maximal runs of equal state."""
    w = _by(file, order)
    change = F.when(F.col(state).eqNullSafe(F.lag(state).over(w)) & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1)
    return rows.withColumn(out, F.sum(change).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def drift_runs(rows: DataFrame, file: str, order, min_run: int, state: str = "state") -> DataFrame:
    """High runs of at least min_run rows: file, first and last position (0-based), length."""
    r = numbered_runs(rows, state, file, order).withColumn("pos", F.row_number().over(_by(file, order)) - 1)
    runs = r.groupBy(file, "run", state).agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count("*").alias("n"))
    return runs.where((F.col(state) == "high") & (F.col("n") >= min_run)).drop(state)


def regions(rows: DataFrame, file: str, order, value: str, state: str = "state") -> DataFrame:
    """All low and high regions with their mean value."""
    r = numbered_runs(rows, state, file, order).withColumn("pos", F.row_number().over(_by(file, order)) - 1)
    return r.groupBy(file, "run", state).agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count("*").alias("n"), F.avg(value).alias("mean_value"))


def top_jumps(rows: DataFrame, value: str, file: str, order, at: str, top: int = 5) -> DataFrame:
    """The largest rises from one row to the next in each recording."""
    w = _by(file, order)
    j = rows.withColumn("jump", F.col(value) - F.lag(value).over(w)).where("jump is not null")
    rank = F.row_number().over(Window.partitionBy(file).orderBy(F.desc("jump"), F.desc(at), *[F.desc(c) for c in order]))
    return j.withColumn("rank", rank).where(F.col("rank") <= top)


def brackets(rows: DataFrame, file: str, order, start: str, end: str, total: str, run: str = "run", state: str = "state", every: bool = False) -> DataFrame:
    """For each high row (or every row) the end of the row before its run and the start of the row after it."""
    w = _by(file, order)
    r = rows.withColumn("prev_end", F.lag(end).over(w)).withColumn("next_start", F.lead(start).over(w))
    inside = Window.partitionBy(file, run).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = r.withColumn("lo", F.coalesce(F.first("prev_end").over(inside), F.lit(0)))
    r = r.withColumn("hi", F.coalesce(F.last("next_start").over(inside), F.col(total))).drop("prev_end", "next_start")
    return r if every else r.where(F.col(state) == "high")


def segment_groups(words: DataFrame, file: str, order, speaker: str, gap: float | None, out: str = "grp") -> DataFrame:
    """A new group where the speaker changes or, with a gap, the pause after the previous word is longer."""
    w = _by(file, order)
    new = ~F.col(speaker).eqNullSafe(F.lag(speaker).over(w))
    if gap is not None:
        new = new | (F.col("start_abs") - F.lag("end_abs").over(w) > gap)
    return words.withColumn(out, F.sum(F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def speaker_segments(words: DataFrame, file: str = "file_no", order=("start_abs", "event_id"), speaker: str = "speaker", gap: float = 0.5, min_s: float = 1.0) -> DataFrame:
    """Segments with their span, words and scores; short ones go, and the rest are numbered anew."""
    key = F.struct(*order)
    g = segment_groups(words, file, order, speaker, gap).groupBy(file, "grp").agg(
        F.min_by(speaker, key).alias("speaker"), F.min("start_abs").alias("start_abs"), F.max_by("end_abs", key).alias("end_abs"), F.count("*").alias("word_count"),
        F.round(F.avg("score"), 4).alias("avg_score"), F.round(F.min("score"), 4).alias("min_score"), F.count("score").alias("scored_words"),
        F.transform(F.array_sort(F.collect_list(F.struct(*order, "word"))), lambda x: x["word"]).alias("words"),
    )
    g = g.withColumn("duration", F.col("end_abs") - F.col("start_abs")).where(F.col("duration") >= min_s)
    index = F.row_number().over(Window.partitionBy(file).orderBy("grp")) - 1
    return g.withColumn("seg_index", index.cast("long")).withColumn("duration", F.round("duration", 4)).drop("grp")


def commit_fold(rows: DataFrame, file: str, order, end: str, distance: str, limit: float) -> DataFrame:
    """The end of the last earlier chunk that matched within the limit."""
    w = _by(file, order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("committed", F.coalesce(F.last(F.when(F.col(distance) <= limit, F.col(end)), ignorenulls=True).over(w), F.lit(0)))


def stable_rank(col: Column, *ties: str) -> Column:
    """1.. by value, ties in the given order."""
    return F.row_number().over(Window.orderBy(col, *ties))
