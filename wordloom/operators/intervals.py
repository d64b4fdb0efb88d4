"""Joins of intervals and points in time, within a recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of a time bucket, in seconds; chunks of speech are at most 30 s long.
BUCKET = 600.0


def clip_regions(regions: Column, lo: Column, hi: Column) -> Column:
    """J5 on an array of (start, end): the parts inside [lo, hi), relative to lo; touching ends don't count."""
    cut = F.transform(regions, lambda r: F.struct(F.greatest(r["start"], lo).alias("start"), F.least(r["end"], hi).alias("end")))
    return F.transform(F.filter(cut, lambda r: r["end"] > r["start"]), lambda r: F.struct(F.round(r["start"] - lo, 4).alias("start"), F.round(r["end"] - lo, 4).alias("end")))


def rounded(col: Column, places: int) -> Column:
    """Rounded as SQL engines round doubles: the scaled number as it is, not its decimal digits, so 0.15 * 10 decides."""
    return F.round(col * F.lit(10.0**places)) / F.lit(10.0**places)


def _cells(start: str, end: str, bucket_s: float) -> Column:
    return F.explode(F.sequence(F.floor(F.col(start) / bucket_s), F.floor(F.greatest(F.col(end), F.col(start)) / bucket_s)))


def overlaps(left: DataFrame, right: DataFrame, file: str, left_span=("start_abs", "end_abs"), right_span=("start_s", "end_s"), bucket_s: float = BUCKET) -> DataFrame:
    """Pairs that overlap, half-open. Both sides are dealt to time buckets, so that a long recording is no single group:
    the join is on (file, bucket), and a pair counts in the bucket where its overlap starts. Buckets should be about as
    long as the longer spans or longer."""
    (a, b), (c, d) = left_span, right_span
    meets = (F.col(c) < F.col(b)) & (F.col(d) > F.col(a))
    joined = left.withColumn("__b", _cells(a, b, bucket_s)).join(right.withColumn("__b", _cells(c, d, bucket_s)), [file, "__b"])
    return joined.where(meets & (F.floor(F.greatest(F.col(a), F.col(c)) / bucket_s) == F.col("__b"))).drop("__b")


def nearest(points: DataFrame, marks: DataFrame, file: str, key: str, order: str) -> DataFrame:
    """key and the `order` value of the mark nearest in time (the smallest of equals), by a merge of both in time order.

    points: file, key, at. marks: file, at, order. Each point sees the last mark before and the first after it, so a
    recording is one sort and not all pairs; marks at one time are one mark.
    """
    best = marks.groupBy(file, "at").agg(F.min(order).alias("m"))
    kind = F.lit(None).cast(points.schema[key].dataType)
    both = points.select(file, "at", F.col(key).alias("k"), F.lit(None).cast(marks.schema[order].dataType).alias("m"), F.lit(1).alias("is_point"))
    both = both.union(best.select(file, "at", kind, "m", F.lit(0)))
    mark = F.when(F.col("is_point") == 0, F.struct("at", "m"))
    past = Window.partitionBy(file).orderBy("at", "is_point").rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(file).orderBy(F.desc("at"), "is_point").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.select(file, "at", "k", "is_point", F.last(mark, ignorenulls=True).over(past).alias("a"), F.last(mark, ignorenulls=True).over(later).alias("b"))
    away = lambda side: F.struct(F.abs(F.col(f"{side}.at") - F.col("at")).alias("d"), F.col(f"{side}.m").alias("m"))
    choice = F.array_min(F.filter(F.array(away("a"), away("b")), lambda c: c["d"].isNotNull()))
    return seen.where((F.col("is_point") == 1) & (F.col("a").isNotNull() | F.col("b").isNotNull())).select(file, F.col("k").alias(key), choice["m"].alias(order))


def _beside(rows: DataFrame, chunks: DataFrame, file: str, order: str, cell: Column, bucket_s: float, meets: Column) -> DataFrame:
    """Rows with the chunks of their time buckets that they meet, and once without a chunk for each bucket that has none."""
    places = chunks.select(F.col(file).alias("__f"), order, "start_s", "end_s").withColumn("__c", _cells("start_s", "end_s", bucket_s))
    return rows.withColumn("__b", cell).join(places, (F.col(file) == F.col("__f")) & (F.col("__b") == F.col("__c")) & meets, "left")


def best_chunk(segments: DataFrame, chunks: DataFrame, file: str, key: str, span=("start_abs", "end_abs"), chunk_order: str = "chunk_index", bucket_s: float = BUCKET) -> DataFrame:
    """The chunk with the longest overlap (the first of equals), or else the one with the nearest centre.

    Overlaps come from time buckets; only segments without one look for the nearest centre, in time order. Segments are read
    once: those with and without an overlap are two parts of the same sums.
    """
    s, e = F.col(span[0]), F.col(span[1])
    meets = (F.col("start_s") < e) & (F.col("end_s") > s) & (F.floor(F.greatest(s, F.col("start_s")) / bucket_s) == F.col("__b"))
    each = _beside(segments.select(file, key, *span), chunks, file, chunk_order, _cells(*span, bucket_s), bucket_s, meets)
    lap = F.when(F.col("__f").isNotNull(), F.least(e, F.col("end_s")) - F.greatest(s, F.col("start_s")))
    rank = F.when(lap.isNotNull(), F.struct(-lap, F.col(chunk_order)))
    best = each.groupBy(file, key).agg(F.min_by(chunk_order, rank).alias(chunk_order), F.max(lap).alias("overlap"), ((F.min(s) + F.min(e)) * 0.5).alias("at"))
    centres = chunks.select(file, chunk_order, ((F.col("start_s") + F.col("end_s")) * 0.5).alias("at"))
    alone = nearest(best.where("overlap is null").select(file, key, "at"), centres, file, key, chunk_order)
    return best.where("overlap is not null").drop("at").unionByName(alone.withColumn("overlap", F.lit(0.0)))


def chunk_of_point(words: DataFrame, chunks: DataFrame, file: str, key: str, at: str = "start_abs", chunk_order: str = "chunk_index", bucket_s: float = BUCKET) -> DataFrame:
    """The first chunk that contains the time (ends included), or else the one with the nearest edge.

    A word falls into one time bucket and a chunk into those that it touches, whose chunks are one row; so words pass by the
    hashed buckets, neither sorted nor grouped. Those outside all chunks are merged with the edges. `key` tells words apart.
    """
    t = F.col(at)
    cells = chunks.select(F.col(file).alias("__f"), F.struct(chunk_order, "start_s", "end_s").alias("c"), _cells("start_s", "end_s", bucket_s).alias("__c"))
    cells = cells.groupBy("__f", "__c").agg(F.collect_list("c").alias("__near"))
    each = words.select(file, key, t.alias("at"), F.floor(t / bucket_s).alias("__b")).join(cells.hint("shuffle_hash"), (F.col(file) == F.col("__f")) & (F.col("__b") == F.col("__c")), "left")
    holding = F.filter("__near", lambda c: F.col("at").between(c["start_s"], c["end_s"]))
    best = each.select(file, key, F.array_min(F.transform(holding, lambda c: c[chunk_order])).alias(chunk_order), "at")
    edges = chunks.select(file, chunk_order, F.explode(F.array("start_s", "end_s")).alias("at"))
    alone = nearest(best.where(F.col(chunk_order).isNull()).select(file, key, "at"), edges, file, key, chunk_order)
    return best.where(F.col(chunk_order).isNotNull()).drop("at").unionByName(alone)


def silence_plan(duration: Column, regions: Column, threshold: float) -> Column:
    """AU1: the spans to silence: leading, inner and trailing gaps of at least the threshold; none without regions."""
    n = F.size(regions)
    spans = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        F.when(i == 0, F.lit(0.0)).otherwise(F.get(regions, i - 1)["end"]).alias("start"),
        F.when(i == n, duration).otherwise(F.get(regions, i)["start"]).alias("end")))
    kept = F.filter(spans, lambda s: s["end"] - s["start"] >= threshold)
    return F.when(n > 0, kept).otherwise(F.slice(kept, 1, 0))


def padded(rows: DataFrame, pad: float, root: str) -> DataFrame:
    """AU2, D12: metadata of rows whose audio gets silence at both ends."""
    out = rows.withColumn("orig_audio_filepath", F.col("audio_filepath"))
    out = out.withColumn("audio_filepath", F.concat(F.lit(root + "/"), "file", F.lit("/"), F.element_at(F.split("orig_audio_filepath", "/"), -1)))
    return out.withColumn("duration", F.round(F.col("duration") + 2 * pad, 3)).withColumn("pad_s", F.lit(pad))
