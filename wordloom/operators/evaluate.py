"""Scoring of rows with a reference and a hypothesis, as word arrays `ref` and `hyp`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import edit as E
from wordloom.functions import text as T


def scored(rows: DataFrame) -> DataFrame:
    """Adds ref_words, edits (null without reference) and wer."""
    n = F.size("ref").cast("long")
    out = rows.withColumn("ref_words", n)
    out = out.withColumn("edits", F.when(n > 0, E.word_distance(F.col("ref"), F.col("hyp")).cast("long")))
    return out.withColumn("wer", E.utterance_wer(F.col("edits"), F.col("ref_words")))


def _wer() -> Column:
    return F.try_divide(F.sum("edits").cast("double"), F.sum("ref_words").cast("double"))


def corpus_wer(rows: DataFrame, *keys: str, more: Sequence[Column] = ()) -> DataFrame:
    """A1, A3: corpus and mean utterance WER, overall or by keys; more: other sums of the same pass."""
    return scored(rows).groupBy(*keys).agg(
        F.sum("edits").alias("edits"), F.sum("ref_words").alias("ref_words"), _wer().alias("corpus_wer"), F.round(F.avg("wer"), 9).alias("mean_utt_wer"),
        F.count_if(F.expr("ref_words > 0")).alias("n_scored"), F.count_if(F.expr("ref_words = 0")).alias("n_empty_ref"), *more,
    )


def summary(rows: DataFrame, decode_s: float) -> DataFrame:
    """A2"""
    audio = F.sum("duration")
    return scored(rows).agg(
        F.count("*").alias("utterances"), F.count_if(F.expr("ref_words > 0")).alias("scored"), F.count_if(F.expr("ref_words = 0")).alias("empty_ref"),
        F.count_if(F.size("hyp") == 0).alias("empty_hyp"), F.round(audio / 60, 6).alias("audio_min"), F.round(audio / decode_s, 6).alias("rtfx"),
        _wer().alias("corpus_wer"), F.round(F.avg("wer"), 9).alias("mean_utt_wer"), F.min("avg_score").alias("min_score"), F.max("avg_score").alias("max_score"),
    )


def passes(score: Column, threshold: float) -> Column:
    """F2: thresholds up to zero let everything pass, null scores too."""
    return F.lit(True) if threshold <= 0 else F.coalesce(score >= threshold, F.lit(False))


def speaker_wer_at(rows: DataFrame, thresholds) -> DataFrame:
    """A4: by file and speaker, and overall, at every threshold in one pass over the rows."""
    s = scored(rows).where("ref_words > 0")
    aggs = []
    for t in thresholds:
        ok = passes(F.col("avg_score"), t)
        name = str(t).replace(".", "_")
        aggs += [
            F.count_if(ok).alias(f"segs_{name}"),
            F.try_divide(F.sum(F.when(ok, F.col("edits"))).cast("double"), F.sum(F.when(ok, F.col("ref_words"))).cast("double")).alias(f"wer_{name}"),
        ]
    return s.groupingSets([[F.col("file"), F.col("speaker")], []], F.col("file"), F.col("speaker")).agg(*aggs).withColumn("file", F.coalesce("file", F.lit("OVERALL")))


def speaker_table(rows: DataFrame, assignment: DataFrame, threshold: float) -> DataFrame:
    """WER and minutes of each speaker from rows at or above the threshold, worst first, without WER last."""
    s = scored(rows.where(F.col("avg_score") >= threshold))
    by = s.groupBy("speaker").agg(_wer().alias("wer"), F.round(F.sum("duration") / 60, 6).alias("duration_min"))
    out = by.join(assignment, "speaker", "left").select("speaker", F.coalesce("split", F.lit("unassigned")).alias("set"), "wer", "duration_min")
    return out.orderBy(F.desc_nulls_last("wer"), "speaker")


def operations(rows: DataFrame) -> DataFrame:
    """One row for each aligned operation of scored rows; an empty hypothesis deletes every word."""
    some = rows.where(F.size("ref") > 0)
    exploded = some.select("*", F.posexplode(E.packed_ops(F.col("ref"), F.col("hyp"))).alias("op_index", "x"))
    x, ref, hyp = F.col("x"), F.col("ref"), F.col("hyp")
    return exploded.select(
        *rows.columns, "op_index", E.op_name(x).alias("op"), E.ref_word(x, ref).alias("ref_word"), E.hyp_word(x, hyp).alias("hyp_word"),
        E.ref_place(x).alias("ref_pos"), E.hyp_place(x).alias("hyp_pos"),
    )


def segment_report(rows: DataFrame, key: str = "seg_index") -> DataFrame:
    """Correct, substituted, deleted, inserted and total words of each row, its ratios and number words.

    The operations are summed by array functions on the row itself: nothing is exploded or shuffled.
    """
    o = rows.withColumn("ops", F.when(F.size("ref") > 0, E.packed_ops(F.col("ref"), F.col("hyp"))).otherwise(F.array().cast("array<bigint>")))
    ref, hyp = (lambda x: F.get("ref", E.ref_place(x))), (lambda x: F.get("hyp", E.hyp_place(x)))
    tally = lambda cond: F.size(F.filter("ops", cond)).cast("long")
    of = lambda kind: lambda x: E.op_of(x) == kind
    out = o.select(
        "*", tally(of(E.EQUAL)).alias("C"), tally(of(E.SUBSTITUTE)).alias("S"), tally(of(E.DELETE)).alias("D"),
        tally(of(E.INSERT)).alias("I"), F.size("ref").cast("long").alias("T"),
        tally(lambda x: (E.op_of(x) == E.SUBSTITUTE) & T.is_plural_pair(ref(x), hyp(x))).alias("plural_subs"),
        F.size(F.filter("ref", T.is_number_word)).cast("long").alias("ref_number_words"),
        tally(lambda x: E.op_of(x).isin(E.SUBSTITUTE, E.DELETE) & T.is_number_word(ref(x))).alias("wrong_number_words"),
        tally(lambda x: (E.op_of(x) == E.INSERT) & T.is_number_word(hyp(x))).alias("number_insertions"),
    )
    ratio = lambda c: F.round(F.try_divide(c.cast("double"), F.col("T").cast("double")), 4)
    return out.drop("ops").withColumns(
        {"segment_wer": ratio(F.col("S") + F.col("D") + F.col("I")), "subst_ratio": ratio(F.col("S")), "deletion_ratio": ratio(F.col("D")), "insert_ratio": ratio(F.col("I"))}
    )


def wer_variants(report: DataFrame) -> DataFrame:
    """Five readings of WER from one pass over the segment report."""
    edits = F.col("S") + F.col("D") + F.col("I")
    bare = edits - F.col("plural_subs")
    some, two = F.col("T") > 0, F.col("T") >= 2
    numeric = two & (F.col("ref_number_words") > 0)
    cases = [("usual", some, edits), ("no_plural", some, bare), ("two_words", two, edits), ("two_words_no_plural", two, bare), ("numeric_no_plural", numeric, bare)]
    one = report.agg(*[x for n, c, e in cases for x in (F.sum(F.when(c, e)).alias(f"{n}_e"), F.sum(F.when(c, F.col("T"))).alias(f"{n}_w"), F.count_if(c).alias(f"{n}_s"))])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(n).alias("variant"), F.col(f"{n}_e").alias("e"), F.col(f"{n}_w").alias("w"), F.col(f"{n}_s").alias("s")) for i, (n, _, _) in enumerate(cases)])
    flat = one.select(F.explode(rows).alias("r"), F.try_divide(F.col("usual_e") * F.lit(100.0), F.col("usual_w").cast("double")).alias("base")).select("r.*", "base")
    wer = F.coalesce(F.try_divide(F.col("e") * F.lit(100.0), F.col("w").cast("double")), F.lit(0.0))
    return flat.select("variant", F.coalesce("e", F.lit(0)).alias("edits"), F.coalesce("w", F.lit(0)).alias("ref_words"), F.col("s").alias("segments"), F.round(wer, 6).alias("wer_pct"), F.round(wer - F.col("base"), 6).alias("delta_wer"))


def number_recognition(report: DataFrame) -> DataFrame:
    """A16"""
    return report.agg(
        F.count("*").alias("total_segments"), F.count_if(F.expr("ref_number_words > 0")).alias("segs_with_num"), F.sum("ref_number_words").alias("ref_num_total"),
        F.sum("wrong_number_words").alias("wrong_num"), F.sum("number_insertions").alias("num_ins"),
    )


def error_totals(ops: DataFrame) -> DataFrame:
    """Substitutions, deletions and insertions with their share of all edits, in that order."""
    wrong = ops.where("op <> 'equal'").groupBy("op").agg(F.count("*").alias("edits"))
    rank = F.when(F.col("op") == "substitute", 1).when(F.col("op") == "delete", 2).otherwise(3)
    share = F.round(F.col("edits") * F.lit(100.0) / F.sum("edits").over(Window.partitionBy()), 6)  # three rows
    return wrong.select("op", "edits", share.alias("pct_of_edits"), rank.alias("op_order")).orderBy("op_order")


def top_errors(ops: DataFrame, top: int) -> DataFrame:
    """The most frequent words or word pairs of each kind of error, ties by the words.

    Totals come from the three-row table, so only the ranking is a window, and Spark limits it before its shuffle.
    """
    n = ops.where("op <> 'equal'").groupBy("op", "ref_word", "hyp_word").agg(F.count("*").alias("n"))
    order = Window.partitionBy("op").orderBy(F.desc("n"), F.coalesce("ref_word", F.lit("")), F.coalesce("hyp_word", F.lit("")))
    best = n.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    kinds = n.groupBy("op").agg(F.sum("n").alias("of_type"))
    kinds = kinds.withColumn("of_all", F.sum("of_type").over(Window.partitionBy()))
    pct = lambda c: F.round(F.col("n") * F.lit(100.0) / F.col(c), 6)
    return best.join(kinds, "op").select("op", "rank", "ref_word", "hyp_word", "n", pct("of_type").alias("pct_of_type"), pct("of_all").alias("pct_of_edits"))
