"""Cutting low-confidence words off either end of a chunk, on arrays of scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.config import DEFAULTS


def top_half_mean(scores: Column) -> Column:
    """Mean of the larger half, of one score at least."""
    k = F.greatest(F.lit(1), F.floor(F.size(scores) / 2).cast("int"))
    half = F.slice(F.sort_array(scores, asc=False), 1, k)
    return F.aggregate(half, F.lit(0.0), lambda a, x: a + x) / k


def with_split(rows: DataFrame, scores: str, tail: bool, d=DEFAULTS) -> DataFrame:
    """W10 (tail), W11 (head): adds split, contrast, side_mean, top_half and trim, which is null if nothing is cut.

    The first of the splits with the largest contrast counts. One fold over the scores carries the running sum and the best
    split so far, so a row of any length takes one pass and no list is copied.
    """
    keep, cut = (d.trim_keep, d.trim_cut) if tail else (d.trim_cut, d.trim_keep)
    n, total = F.size(scores), F.col("__total")
    out = rows.withColumn("__total", F.aggregate(scores, F.lit(0.0), lambda a, x: a + x))
    none = F.lit(None).cast("struct<contrast:double,minus:int,side:double>")

    def step(state: Column, x: Column) -> Column:
        i, left_sum = state["i"] + 1, state["sum"] + x
        left, right = left_sum / i, (total - left_sum) / (n - i)
        here = F.struct((left - right if tail else right - left).alias("contrast"), (-i).alias("minus"), (right if tail else left).alias("side"))
        # greatest() skips nulls, so the first candidate replaces nothing
        best = F.when((i >= keep) & (i <= n - cut), F.greatest(state["best"], here)).otherwise(state["best"])
        return F.struct(i.alias("i"), left_sum.alias("sum"), best.alias("best"))

    start = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("sum"), none.alias("best"))
    enough = n >= d.trim_keep + d.trim_cut
    out = out.withColumn("__best", F.when(enough, F.aggregate(scores, start, step)["best"]))
    out = out.withColumn("__top", F.when(n > 0, top_half_mean(F.col(scores))))
    best, top = F.col("__best"), F.col("__top")
    guard = F.least(F.lit(d.trim_side_max), d.trim_side_factor * top)
    good = enough & (top >= d.trim_top_half) & (best["contrast"] > d.trim_contrast) & (best["side"] < guard)
    return out.withColumns(
        {
            "split": -best["minus"], "contrast": F.round(best["contrast"], 6), "side_mean": F.round(best["side"], 6), "top_half": F.round(top, 6),
            "trim": F.when(good, -best["minus"]),
        }
    ).drop("__total", "__best", "__top")


def keep_words(words: Column, trim: Column, tail: bool) -> Column:
    """What is left after the cut."""
    rest = F.slice(words, 1, trim) if tail else F.slice(words, trim + 1, F.greatest(F.size(words) - trim, F.lit(0)))
    return F.when(trim.isNull(), words).otherwise(rest)
