"""Reports on segments: durations, confidence, recovery, winners and stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.evaluate import passes, scored


def speaker_duration(rows: DataFrame, thresholds) -> DataFrame:
    """A5: by speaker over all files: distinct files, segments and seconds at each threshold; the total has no speaker.

    Files are counted from the (file, speaker) sums, so the second step reads a row for each pair only.
    """
    names = [str(t).replace(".", "_") for t in thresholds]
    sums = [F.sum(F.when(passes(F.col("avg_score"), t), F.col("duration")).otherwise(0.0)).alias(f"s_{n}") for t, n in zip(thresholds, names, strict=True)]
    pairs = rows.groupBy("file", "speaker").agg(F.count("*").alias("segs"), *sums)
    out = pairs.groupingSets([[F.col("speaker")], []], F.col("speaker")).agg(F.count_distinct("file").alias("files"), F.sum("segs").alias("segs"), *[F.sum(f"s_{n}").alias(f"s_{n}") for n in names])
    retain = F.coalesce(F.try_divide(F.col(f"s_{names[-1]}") * 100, F.col(f"s_{names[0]}")), F.lit(0.0))
    return out.select("speaker", "files", "segs", *[F.round(f"s_{n}", 4).alias(f"s_{n}") for n in names], F.round(retain, 6).alias("retain_pct"))


def confidence_histogram(rows: DataFrame, bins: int = 10) -> DataFrame:
    """Segments and seconds by score bin with cumulative shares. Null scores have no bin but count in every share."""
    spark = rows.sparkSession
    cell = F.when(F.col("avg_score").isNotNull(), F.least((F.col("avg_score") * bins).cast("int"), F.lit(bins - 1)))
    b = rows.groupBy(cell.alias("bin")).agg(F.count("*").alias("segs"), F.sum("duration").alias("dur"))
    total = b.agg(F.sum("segs").alias("all_segs"), F.sum("dur").alias("all_dur"))
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin")).join(b, "bin", "left").crossJoin(F.broadcast(total))  # ten rows and one row
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    share = lambda c, of: F.round(F.coalesce(c, F.lit(0)) * 100.0 / F.col(of), 6)
    return every.select(
        F.col("bin").cast("long").alias("bin"), F.coalesce("segs", F.lit(0)).alias("segs"), F.round(F.coalesce("dur", F.lit(0.0)), 4).alias("dur"),
        share(F.col("segs"), "all_segs").alias("seg_pct"), share(F.col("dur"), "all_dur").alias("dur_pct"),
        share(F.sum("segs").over(upto), "all_segs").alias("cum_seg_pct"), share(F.sum("dur").over(upto), "all_dur").alias("cum_dur_pct"),
    )


def threshold_tradeoff(histogram: DataFrame, tenths=(3, 4, 5, 6, 7)) -> DataFrame:
    """What each threshold drops, from the histogram's cumulative shares; null scores count as kept."""
    t = histogram.where(F.col("bin").isin(*[x - 1 for x in tenths]))
    return t.select(((F.col("bin") + 1) / F.lit(10.0)).alias("threshold"), F.col("cum_dur_pct").alias("dropped_pct"), F.round(100 - F.col("cum_dur_pct"), 6).alias("kept_pct"))


def speech_recovery(original: DataFrame, detected: DataFrame, mapped: DataFrame, file: str = "file_no") -> DataFrame:
    """Seconds of audio, detected and mapped speech by file that has all three, with a total row (no file)."""
    o = original.groupBy(file).agg(F.sum("seconds").alias("orig"))
    v = detected.groupBy(file).agg(F.sum("seconds").alias("vad"))
    m = mapped.groupBy(file).agg(F.sum("seconds").alias("mapped"))
    s = o.join(v, file).join(m, file).groupingSets([[F.col(file)], []], F.col(file)).agg(*[F.sum(c).alias(c) for c in ("orig", "vad", "mapped")])
    ratio = lambda a, b: F.round(F.try_divide(F.col(a) * 100, F.col(b)), 6)
    return s.select(file, *[F.round(c, 4).alias(c) for c in ("orig", "vad", "mapped")], ratio("vad", "orig").alias("vad_pct"), ratio("mapped", "vad").alias("mapped_vad_pct"), ratio("mapped", "orig").alias("mapped_pct"))


def winner_bucket(options, chosen):
    """Whose hypothesis a chunk used."""
    return F.when(F.size(options) < 2, "single_option").when(chosen == F.get(options, F.lit(1)), "second").otherwise("first")


def wer_by_winner(rows: DataFrame, chunk_counts: DataFrame) -> DataFrame:
    """Rows with `winner`; chunks, segments, words, edits, WER, minutes and share of words, with a TOTAL row."""
    s = scored(rows)
    g = s.groupingSets([[F.col("winner")], []], F.col("winner")).agg(F.count("*").alias("segments"), F.sum("ref_words").alias("ref_words"), F.sum("edits").alias("edits"), F.sum("duration").alias("dur"))
    c = chunk_counts.groupingSets([[F.col("winner")], []], F.col("winner")).agg(F.sum("n").alias("chunks"))
    j = g.join(c, g["winner"].eqNullSafe(c["winner"]), "left").select(g["winner"], "segments", "ref_words", "edits", "dur", "chunks")
    total = F.max(F.when(F.col("winner").isNull(), F.col("ref_words"))).over(Window.partitionBy())  # a row for each winner
    return j.select(
        F.coalesce("winner", F.lit("TOTAL")).alias("winner"), "chunks", "segments", "ref_words", "edits", F.round(F.try_divide(F.col("edits") * 100.0, F.col("ref_words").cast("double")), 6).alias("wer_pct"),
        F.round(F.col("dur") / 60, 6).alias("minutes"), F.round(F.col("ref_words") * 100.0 / total, 6).alias("pct_of_words"),
    )


def unmapped(rows: DataFrame, mapped: DataFrame, key: str = "seg_index") -> DataFrame:
    """How many rows no chunk could be found for."""
    return rows.join(mapped.select(key).withColumn("__found", F.lit(True)), key, "left").agg(F.count("*").alias("segments"), F.count_if(F.col("__found").isNull()).alias("unmapped"))


def stage_proxy_wer(stages: DataFrame, file: str = "file_no") -> DataFrame:
    """Stages: file, stage, ref and hyp (arrays): edits over recognised words by file and for the corpus (no file)."""
    from wordloom.functions import edit as E

    s = stages.where(F.size("hyp") > 0).select(file, "stage", E.word_distance(F.col("ref"), F.col("hyp")).alias("edits"), F.size("hyp").alias("asr_words"))
    g = s.groupingSets([[F.col(file), F.col("stage")], [F.col("stage")]], F.col(file), F.col("stage")).agg(F.sum("edits").alias("edits"), F.sum("asr_words").alias("asr_words"), F.count("*").alias("chunks"))
    return g.withColumn("proxy_wer", F.round(F.try_divide(F.col("edits").cast("double"), F.col("asr_words").cast("double")), 9))


def wer_buckets(rows: DataFrame, edges=(5, 10, 20, 40)) -> DataFrame:
    """Segments, words and seconds of each WER bucket (lower edge included)."""
    s = scored(rows).where("ref_words > 0").withColumn("pct", F.col("wer") * 100)
    bucket = F.when(F.col("pct") < edges[0], f"0-{edges[0]}")
    for a, b in zip(edges, edges[1:], strict=False):
        bucket = bucket.when(F.col("pct") < b, f"{a}-{b}")
    return s.groupBy(bucket.otherwise(f"{edges[-1]}+").alias("bucket")).agg(F.count("*").alias("segs"), F.sum("ref_words").alias("ref_words"), F.round(F.sum("duration"), 4).alias("seconds"))
