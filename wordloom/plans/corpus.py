"""Queries on splits, manifests, reports, experiments, filters, joins, sets and nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from wordloom.config import DEFAULTS
from wordloom.functions import edit as E
from wordloom.functions import text as T
from wordloom.operators import evaluate as V
from wordloom.operators import experiments as X
from wordloom.operators import intervals as J
from wordloom.operators import reports as R
from wordloom.operators import segments as G
from wordloom.operators import sequences as S
from wordloom.operators import splits as P
from wordloom.plans import derive as D
from wordloom.plans.alignment import _BOTH, _SEGMENTS, DAYS, LOC_SQL, _segments, loc_turns
from wordloom.plans.derive import CHUNKS_SQL, TIMELINE_SQL, edits_sql, eval_sql, table
from wordloom.plans.scoring import _SCORE, _SCORED

QUERIES, ORACLE_SQL = {}, {}
QUARANTINED = ("audio_file_015",)


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def assignment(spark):
    k = F.col("id")
    split = F.when(k % 10 == 0, "dev").when((k % 10).isin(1, 2), "test").otherwise("train")
    return spark.range(37).where(k % 7 != 0).select(F.concat(F.lit("spk_"), k.cast("string")).alias("speaker"), split.alias("split"))


_ASSIGN = ", assignment AS (SELECT 'spk_' || k AS speaker, CASE WHEN k % 10 = 0 THEN 'dev' WHEN k % 10 IN (1, 2) THEN 'test' ELSE 'train' END AS split FROM (SELECT unnest(range(37)) AS k) WHERE k % 7 <> 0) "
_ROWS = "WITH " + eval_sql()
_KEPT = _ROWS + _ASSIGN + ", kept AS (SELECT e.*, coalesce(split, 'train') AS split, split IS NULL AS unknown FROM eval_rows e LEFT JOIN assignment a ON e.speaker = a.speaker WHERE file <> 'audio_file_015' AND avg_score >= 0.4) "


def _kept(spark, sf):
    return P.with_split(P.usable(D.eval_rows(spark, sf), DEFAULTS.split_threshold, QUARANTINED), assignment(spark))


@query("F1_confidence_filter", _ROWS + " SELECT seg_index, avg_score FROM eval_rows WHERE avg_score >= 0.4")
def f1(spark, sf):
    return P.usable(D.eval_rows(spark, sf), DEFAULTS.split_threshold).select("seg_index", "avg_score")


@query("F2_threshold_passes", _ROWS + " SELECT file, count(*) AS at_zero, count(*) FILTER (avg_score >= 0.4) AS at_04 FROM eval_rows GROUP BY file")
def f2(spark, sf):
    return D.eval_rows(spark, sf).groupBy("file").agg(F.count_if(V.passes(F.col("avg_score"), 0.0)).alias("at_zero"), F.count_if(V.passes(F.col("avg_score"), 0.4)).alias("at_04"))


@query("F3_quarantine", _ROWS + " SELECT file, count(*) AS n FROM eval_rows WHERE file <> 'audio_file_015' GROUP BY file")
def f3(spark, sf):
    bad = spark.createDataFrame([(q,) for q in QUARANTINED], "file string")
    return D.eval_rows(spark, sf).join(bad, "file", "left_anti").groupBy("file").agg(F.count("*").alias("n"))


@query("F4_empty_texts", _ROWS + " SELECT file, count(*) FILTER (len(ref) > 0) AS kept, count(*) FILTER (len(ref) = 0) AS skipped FROM eval_rows GROUP BY file")
def f4(spark, sf):
    has = F.size("ref") > 0
    return D.eval_rows(spark, sf).groupBy("file").agg(F.count_if(has).alias("kept"), F.count_if(~has).alias("skipped"))


@query("F6_reference_size", _ROWS + " SELECT seg_index, len(ref) AS n FROM eval_rows WHERE len(ref) >= 2")
def f6(spark, sf):
    return D.eval_rows(spark, sf).where(F.size("ref") >= 2).select("seg_index", F.size("ref").cast("long").alias("n"))


@query("F7_membership", _ROWS + " SELECT speaker, count(*) AS n FROM eval_rows WHERE speaker IN ('spk_3', 'spk_12') AND file IN ('audio_file_001', 'audio_file_004') GROUP BY speaker")
def f7(spark, sf):
    return D.eval_rows(spark, sf).where(F.col("speaker").isin("spk_3", "spk_12") & F.col("file").isin("audio_file_001", "audio_file_004")).groupBy("speaker").agg(F.count("*").alias("n"))


@query("F10_duration_window", _ROWS + " SELECT file, count(*) AS n FROM eval_rows WHERE duration BETWEEN 1 AND 16 GROUP BY file")
def f10(spark, sf):
    return D.eval_rows(spark, sf).where(F.col("duration").between(DEFAULTS.train_min_s, DEFAULTS.train_max_s)).groupBy("file").agg(F.count("*").alias("n"))


@query("J2_split_assignment", _KEPT + "SELECT seg_index, split, unknown AS unknown_speaker FROM kept")
def j2(spark, sf):
    return _kept(spark, sf).select("seg_index", "split", "unknown_speaker")


@query("A11_split_summary", _KEPT + "SELECT split, count(DISTINCT speaker) AS speakers, count(*) AS segments, round(sum(duration) / 3600, 6) AS hours FROM kept GROUP BY split")
def a11(spark, sf):
    return P.split_summary(_kept(spark, sf))


@query("A12_unknown_speakers", _KEPT + "SELECT speaker, count(*) AS segments, round(sum(duration) / 60, 6) AS minutes FROM kept WHERE unknown GROUP BY speaker")
def a12(spark, sf):
    return P.unknown_speakers(_kept(spark, sf))


@query("S5_seeded_order", _KEPT + "SELECT seg_index, split, md5('42:' || seg_index) AS order_key FROM kept")
def s5(spark, sf):
    return _kept(spark, sf).select("seg_index", "split", P.shuffle_key(DEFAULTS.split_seed, F.col("seg_index")).alias("order_key")).orderBy("split", "order_key")


@query("AU2_padded_rows", _ROWS + " SELECT seg_index, 'pad/' || file || '/' || string_split(audio_filepath, '/')[-1] AS audio_filepath, audio_filepath AS orig_audio_filepath, round(duration + 1.0, 3) AS duration, 0.5::DOUBLE AS pad_s FROM eval_rows")
def au2(spark, sf):
    return J.padded(D.eval_rows(spark, sf), DEFAULTS.pad, "pad").select("seg_index", "audio_filepath", "orig_audio_filepath", "duration", "pad_s")


@query("A5_speaker_duration", _ROWS + ", p AS (SELECT file, speaker, count(*) AS segs, sum(duration) AS a, coalesce(sum(duration) FILTER (avg_score >= 0.4), 0) AS b FROM eval_rows GROUP BY ALL) SELECT speaker, count(DISTINCT file) AS files, CAST(sum(segs) AS BIGINT) AS segs, round(sum(a), 4) AS s_0_0, round(sum(b), 4) AS s_0_4, round(CASE WHEN sum(a) > 0 THEN sum(b) * 100 / sum(a) ELSE 0 END, 6) AS retain_pct FROM p GROUP BY GROUPING SETS ((speaker), ())")
def a5(spark, sf):
    return R.speaker_duration(D.eval_rows(spark, sf), DEFAULTS.thresholds)


_HIST = _ROWS + ", b AS (SELECT CASE WHEN avg_score IS NOT NULL THEN least(CAST(trunc(avg_score * 10) AS BIGINT), 9) END AS bin, count(*) AS segs, sum(duration) AS dur FROM eval_rows GROUP BY 1), t AS (SELECT sum(segs) AS s, sum(dur) AS d FROM b), e AS (SELECT r.bin, coalesce(segs, 0) AS segs, coalesce(dur, 0) AS dur FROM (SELECT unnest(range(10)) AS bin) r LEFT JOIN b USING (bin)), h AS (SELECT bin, segs, round(dur, 4) AS dur, round(segs * 100.0::DOUBLE / s, 6) AS seg_pct, round(dur * 100.0::DOUBLE / d, 6) AS dur_pct, round(sum(segs) OVER (ORDER BY bin) * 100.0::DOUBLE / s, 6) AS cum_seg_pct, round(sum(dur) OVER (ORDER BY bin) * 100.0::DOUBLE / d, 6) AS cum_dur_pct FROM e, t) "


@query("A6_confidence_histogram", _HIST + "SELECT * FROM h")
def a6(spark, sf):
    return R.confidence_histogram(D.eval_rows(spark, sf))


@query("A7_threshold_tradeoff", _HIST + "SELECT (bin + 1) / 10.0::DOUBLE AS threshold, cum_dur_pct AS dropped_pct, round(100 - cum_dur_pct, 6) AS kept_pct FROM h WHERE bin IN (2, 3, 4, 5, 6)")
def a7(spark, sf):
    return R.threshold_tradeoff(R.confidence_histogram(D.eval_rows(spark, sf)))


@query("A8_speech_recovery", _BOTH + ", o AS (SELECT file_no, sum(end_s - start_s) + 30 * 3600 AS orig FROM chunks GROUP BY file_no), v AS (SELECT file_no, sum(duration_s) AS vad FROM chunks GROUP BY file_no), m AS (SELECT file_no, sum(duration) AS mapped FROM segments GROUP BY file_no), j AS (SELECT * FROM o JOIN v USING (file_no) JOIN m USING (file_no)), s AS (SELECT file_no, sum(orig) AS orig, sum(vad) AS vad, sum(mapped) AS mapped FROM j GROUP BY GROUPING SETS ((file_no), ())) SELECT file_no, round(orig, 4) AS orig, round(vad, 4) AS vad, round(mapped, 4) AS mapped, round(vad * 100 / orig, 6) AS vad_pct, round(mapped * 100 / vad, 6) AS mapped_vad_pct, round(mapped * 100 / orig, 6) AS mapped_pct FROM s")
def a8(spark, sf):
    c = D.chunks(spark, sf)
    return R.speech_recovery(c.select("file_no", (F.col("duration_s") + 3600).alias("seconds")), c.select("file_no", F.col("duration_s").alias("seconds")), _segments(spark, sf).select("file_no", F.col("duration").alias("seconds")))


_WIN = f", c AS (SELECT f, unnest(range(0, 32)) AS ci FROM (SELECT unnest(range(20)) AS f)), ch AS (SELECT format('audio_file_{{:03d}}', f) AS file, ci, ci * 30.0::DOUBLE AS s, ci * 30.0::DOUBLE + 28 AS e, CASE WHEN ci % 5 = 0 THEN 'single_option' WHEN ci % 3 = 1 THEN 'second' ELSE 'first' END AS winner FROM c), sg AS (SELECT *, regexp_extract(audio_filepath, 'start(\\d+)_end(\\d+)', 1)::DOUBLE AS a, regexp_extract(audio_filepath, 'start(\\d+)_end(\\d+)', 2)::DOUBLE AS b FROM eval_rows), p AS (SELECT seg_index, winner, least(b, e) - greatest(a, s) AS lap, abs((s + e) * 0.5::DOUBLE - (a + b) * 0.5::DOUBLE) AS away, ci FROM sg JOIN ch ON sg.file = ch.file), w AS (SELECT seg_index, arg_min(winner, (CASE WHEN lap > 0 THEN 0 ELSE 1 END, CASE WHEN lap > 0 THEN -lap ELSE away END, ci)) AS winner FROM p GROUP BY seg_index), sw AS (SELECT s.*, winner FROM scored s JOIN w USING (seg_index)) "


def _win_chunks(spark):
    c = spark.range(20).select(T.stem(F.col("id")).alias("file"), F.explode(F.sequence(F.lit(0), F.lit(31))).alias("chunk_index"))
    two, one = F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a"))
    c = c.withColumn("options", F.when(F.col("chunk_index") % 5 == 0, one).otherwise(two)).withColumn("chosen", F.when(F.col("chunk_index") % 3 == 1, "b").otherwise("a"))
    return c.select("file", "chunk_index", (F.col("chunk_index") * 30.0).alias("start_s"), (F.col("chunk_index") * 30.0 + 28).alias("end_s"), R.winner_bucket(F.col("options"), F.col("chosen")).alias("winner"))


_OPTIONS = f"""WITH {LOC_SQL}, o AS (SELECT file_no, chunk_index, array_to_string(said, ' ') AS s, array_to_string(flatten(list_transform(said, lambda x, i: CASE WHEN i % 7 = 3 THEN [] ELSE [x] END)), ' ') AS a,
  array_to_string(list_transform(said, lambda x, i: CASE WHEN i % 5 = 2 AND chunk_index % 2 = 0 THEN x || 'xxx' ELSE x END), ' ') AS b FROM loc_w),
d AS (SELECT *, round(levenshtein(a, s) / greatest(length(a), length(s), 1)::DOUBLE, 4) AS da, round(levenshtein(b, s) / greatest(length(b), length(s), 1)::DOUBLE, 4) AS db FROM o) """


@query("L11_option_lineage", _OPTIONS + "SELECT file_no, chunk_index, CASE WHEN a = b THEN 'single_option' WHEN db <= da THEN 'second' ELSE 'first' END AS winner FROM d")
def l11(spark, sf):
    """Each turn's two hypotheses without repeats; the one nearer to its words is chosen, of equals the later."""
    none = F.array().cast("array<string>")
    a = F.flatten(F.transform("said", lambda x, i: F.when((i + 1) % 7 == 3, none).otherwise(F.array(x))))
    b = F.transform("said", lambda x, i: F.when(((i + 1) % 5 == 2) & (F.col("chunk_index") % 2 == 0), F.concat(x, F.lit("xxx"))).otherwise(x))
    c = loc_turns(spark, sf).select("file_no", "chunk_index", F.array_join("said", " ").alias("s"), F.array_join(a, " ").alias("a"), F.array_join(b, " ").alias("b"))
    chosen = F.when(E.text_norm_distance(F.col("b"), F.col("s")) <= E.text_norm_distance(F.col("a"), F.col("s")), F.col("b")).otherwise(F.col("a"))
    return c.select("file_no", "chunk_index", R.winner_bucket(F.array_distinct(F.array("a", "b")), chosen).alias("winner"))


@query("J14_segment_winners", _ROWS + _SCORED + _WIN + "SELECT seg_index, winner FROM sw")
def j14(spark, sf):
    return _with_winner(spark, sf).select("seg_index", "winner")


def _with_winner(spark, sf):
    rows = D.eval_rows(spark, sf)
    a, b = T.name_times(F.col("audio_filepath"))
    rows, chunks = rows.withColumn("a", a.cast("double")).withColumn("b", b.cast("double")), _win_chunks(spark)
    best = J.best_chunk(rows, chunks, "file", "seg_index", ("a", "b"), bucket_s=60.0).select("file", "seg_index", "chunk_index")
    return rows.join(best, ["file", "seg_index"]).join(chunks.select("file", "chunk_index", "winner"), ["file", "chunk_index"])


@query("A17_wer_by_winner", _ROWS + _SCORED + _WIN + ", g AS (SELECT winner, count(*) AS segments, CAST(sum(ref_words) AS BIGINT) AS ref_words, CAST(sum(edits) AS BIGINT) AS edits, sum(duration) AS dur FROM sw GROUP BY GROUPING SETS ((winner), ())), n AS (SELECT winner, count(*) AS chunks FROM ch GROUP BY GROUPING SETS ((winner), ())) SELECT coalesce(g.winner, 'TOTAL') AS winner, chunks, segments, ref_words, edits, round(edits * 100.0::DOUBLE / ref_words, 6) AS wer_pct, round(dur / 60, 6) AS minutes, round(ref_words * 100.0::DOUBLE / (SELECT ref_words FROM g WHERE winner IS NULL), 6) AS pct_of_words FROM g JOIN n ON g.winner IS NOT DISTINCT FROM n.winner")
def a17(spark, sf):
    return R.wer_by_winner(_with_winner(spark, sf), _win_chunks(spark).groupBy("winner").agg(F.count("*").alias("n")))


@query("A18_stage_proxy_wer", _ROWS + f", st AS (SELECT file, stage, CASE stage WHEN 'pass1' THEN ref[1:12] WHEN 'resync' THEN ref[1:14] ELSE ref END AS ref, hyp FROM eval_rows, (SELECT unnest(['pass1', 'resync', 'headtrim']) AS stage) WHERE len(hyp) > 0), s AS (SELECT file, stage, CASE WHEN len(ref) = 0 THEN len(hyp) ELSE {edits_sql('ref', 'hyp')} END AS edits, len(hyp) AS w FROM st) SELECT file, stage, CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(w) AS BIGINT) AS asr_words, count(*) AS chunks, round(sum(edits) / sum(w)::DOUBLE, 9) AS proxy_wer FROM s GROUP BY GROUPING SETS ((file, stage), (stage))")
def a18(spark, sf):
    r = D.eval_rows(spark, sf).select("file", "hyp", F.explode(F.array(
        F.struct(F.lit("pass1").alias("stage"), F.slice("ref", 1, 12).alias("ref")), F.struct(F.lit("resync").alias("stage"), F.slice("ref", 1, 14).alias("ref")), F.struct(F.lit("headtrim").alias("stage"), F.col("ref").alias("ref")))).alias("s"))
    return R.stage_proxy_wer(r.select("file", "s.stage", "s.ref", "hyp"), "file")


@query("W18_match_rate", _ROWS + " SELECT file, round(avg(CASE WHEN ref[1] = hyp[1] THEN 1.0::DOUBLE ELSE 0 END), 9) AS rate FROM eval_rows WHERE len(ref) > 0 AND len(hyp) > 0 GROUP BY file")
def w18(spark, sf):
    r = D.eval_rows(spark, sf).where((F.size("ref") > 0) & (F.size("hyp") > 0))
    return r.groupBy("file").agg(F.round(F.avg(F.when(F.get("ref", F.lit(0)) == F.get("hyp", F.lit(0)), 1.0).otherwise(0.0)), 9).alias("rate"))


@query("A20_speaker_wer_table", _SCORE + _ASSIGN + ", k AS (SELECT speaker, sum(edits) / nullif(sum(ref_words), 0)::DOUBLE AS wer, round(sum(duration) / 60, 6) AS duration_min FROM scored WHERE avg_score >= 0.4 GROUP BY speaker) SELECT k.speaker, coalesce(split, 'unassigned') AS set, wer, duration_min FROM k LEFT JOIN assignment a ON k.speaker = a.speaker")
def a20(spark, sf):
    return V.speaker_table(D.eval_rows(spark, sf), assignment(spark), 0.4)


@query("A25_wer_buckets", _SCORE + ", b AS (SELECT *, edits * 1.0::DOUBLE / ref_words * 100 AS pct FROM scored WHERE ref_words > 0) SELECT CASE WHEN pct < 5 THEN '0-5' WHEN pct < 10 THEN '5-10' WHEN pct < 20 THEN '10-20' WHEN pct < 40 THEN '20-40' ELSE '40+' END AS bucket, count(*) AS segs, CAST(sum(ref_words) AS BIGINT) AS ref_words, round(sum(duration), 4) AS seconds FROM b GROUP BY 1")
def a25(spark, sf):
    return R.wer_buckets(D.eval_rows(spark, sf))


# --- experiments -------------------------------------------------------------------------------------------------------

EXPERIMENTS = {"base": (11, "gpu_a", 0.4), "tuned": (7, "gpu_a", 0.4), "tuned_lm": (5, "gpu_b", None)}


def manifest():
    """A digest of what was tested (how many rows and reference words, first and last name)."""
    parts = [F.count("*").cast("string"), F.sum(F.size("ref")).cast("string"), F.min("audio_filepath"), F.max("audio_filepath")]
    return F.md5(F.concat_ws("|", *parts).cast("binary")).alias("manifest_md5")


def _experiments(spark, sf):
    out = None
    for i, (name, (drop, gpu, threshold)) in enumerate(EXPERIMENTS.items()):
        s = V.corpus_wer(D.eval_rows(spark, sf, drop=drop), more=[manifest()]).select("corpus_wer", "mean_utt_wer", "n_scored", "manifest_md5")
        s = s.select(F.lit(name).alias("experiment"), F.lit(i).cast("long").alias("position"), F.lit("v1").alias("normalizer"), F.lit(threshold).cast("double").alias("conf_filter_threshold"), F.lit(True).alias("padded"), F.lit(gpu).alias("gpu"), "*")
        out = s if out is None else out.union(s)
    return out


_EXPS = "WITH " + ", ".join(eval_sql(f"rows_{n}", drop=d) for n, (d, _, _) in EXPERIMENTS.items()) + ", " + ", ".join(
    f"s_{n} AS (SELECT file, speaker, len(ref) AS ref_words, CASE WHEN len(ref) > 0 THEN {edits_sql('ref', 'hyp')} END AS edits FROM rows_{n})" for n in EXPERIMENTS
) + ", exps AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS experiment, CAST({i} AS BIGINT) AS position, '{g}' AS gpu, CAST({'NULL' if t is None else t} AS DOUBLE) AS conf_filter_threshold, sum(edits) / sum(ref_words)::DOUBLE AS corpus_wer FROM s_{n}" for i, (n, (_, g, t)) in enumerate(EXPERIMENTS.items())
) + ") "


_META = _EXPS + ", meta AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS experiment, md5(concat_ws('|', CAST(count(*) AS VARCHAR), CAST(sum(len(ref)) AS VARCHAR), min(audio_filepath), max(audio_filepath))) AS manifest_md5, '{g}' AS gpu, CAST({'NULL' if t is None else t} AS DOUBLE) AS threshold FROM rows_{n}" for n, (_, g, t) in EXPERIMENTS.items()
) + ") "


@query("A22_comparability", _META + "SELECT count(DISTINCT manifest_md5) = 1 AS same_manifest_md5, TRUE AS same_normalizer, count(DISTINCT coalesce(CAST(threshold AS VARCHAR), 'none')) = 1 AS same_conf_filter_threshold, TRUE AS same_padded, count(DISTINCT gpu) = 1 AS same_gpu, count(DISTINCT manifest_md5) = 1 AS wer_comparable, count(DISTINCT gpu) = 1 AS time_comparable FROM meta")
def a22(spark, sf):
    return X.comparability(_experiments(spark, sf))


@query("W14_experiment_ranks", _EXPS + "SELECT experiment, row_number() OVER (ORDER BY corpus_wer, position) AS rank, corpus_wer, round(corpus_wer - (SELECT corpus_wer FROM exps WHERE experiment = 'base'), 6) AS delta FROM exps")
def w14(spark, sf):
    return X.ranked(_experiments(spark, sf), "base").select("experiment", "rank", "corpus_wer", "delta")


def results(spark, sf):
    """WER of each speaker in each experiment."""
    out = None
    for n, (drop, _, _) in EXPERIMENTS.items():
        s = V.corpus_wer(D.eval_rows(spark, sf, drop=drop), "file", "speaker").select(F.lit(n).alias("experiment"), "file", "speaker", "corpus_wer", "ref_words")
        out = s if out is None else out.union(s)
    return out


_SPK = _EXPS + ", u AS (" + " UNION ALL ".join(f"SELECT '{n}' AS experiment, file, speaker, sum(edits) / nullif(sum(ref_words), 0)::DOUBLE AS wer, CAST(sum(ref_words) AS BIGINT) AS ref_words FROM s_{n} GROUP BY ALL" for n in EXPERIMENTS) + "), v AS (SELECT file, speaker, max(ref_words) AS ref_words, " + ", ".join(f"max(wer) FILTER (experiment = '{n}') AS {n}" for n in EXPERIMENTS) + " FROM u GROUP BY file, speaker) "


@query("J13_per_speaker_delta", _SPK + "SELECT file, speaker, ref_words, round(base, 6) AS wer_base, round(tuned, 6) AS wer_tuned, round(tuned_lm, 6) AS wer_tuned_lm, round(tuned - base, 6) AS delta_tuned, round(tuned_lm - base, 6) AS delta_tuned_lm FROM v")
def j13(spark, sf):
    return X.per_speaker(results(spark, sf), list(EXPERIMENTS), "base")


@query("X1_experiment_record")
def x1(spark, sf):
    return X.record(V.summary(D.eval_rows(spark, sf), 84.4), "base", {"name": "m", "is_finetuned": False}, {"manifest": "test", "padded": True}, {"gpu": "gpu_a"})


# --- manifests, nested data, sets --------------------------------------------------------------------------------------


def _timeline_chunks(spark, sf):
    t, c = D.timeline(spark, sf), D.chunks(spark, sf)
    return J.overlaps(t, c, "file_no", ("start_abs", "start_abs"), ("start_s", "end_s"), DAYS), c


_WORDS_IN = f"WITH {TIMELINE_SQL}, {CHUNKS_SQL}, w AS (SELECT t.*, chunk_index FROM timeline t JOIN chunks c ON t.file_no = c.file_no AND start_s < start_abs AND end_s > start_abs) "


@query("N1_chunk_rows", _WORDS_IN + "SELECT c.file_no, c.chunk_index, chunk_file AS audio_filepath, round(end_s - start_s, 3) AS duration, string_agg(word, ' ' ORDER BY start_abs, event_id) AS text, 'chunk' AS unit FROM w JOIN chunks c ON w.file_no = c.file_no AND w.chunk_index = c.chunk_index GROUP BY ALL")
def n1(spark, sf):
    t, c = _timeline_chunks(spark, sf)
    return P.chunk_rows(t, c)


_SEG_ROWS = _SEGMENTS + ", sr AS (SELECT file_no, format('audio_file_{:03d}_{}_seg_{:06d}_start{:06d}_end{:06d}.wav', file_no, speaker, seg_index, CAST(trunc(start_abs) AS BIGINT), CAST(trunc(end_abs) AS BIGINT)) AS audio_filepath, round(duration, 3) AS duration, text, 'segment' AS unit, speaker, seg_index, avg_score, min_score FROM segments) "


@query("N2_segment_rows", _SEG_ROWS + "SELECT * FROM sr")
def n2(spark, sf):
    return P.segment_rows(_segments(spark, sf))


@query("U1_all_rows", _SEG_ROWS + f", {CHUNKS_SQL}, w AS (SELECT t.*, chunk_index FROM timeline t JOIN chunks c ON t.file_no = c.file_no AND start_s < start_abs AND end_s > start_abs), cr AS (SELECT DISTINCT file_no, chunk_index FROM w) SELECT unit, count(*) AS n, count(speaker) AS with_speaker FROM (SELECT unit, speaker FROM sr UNION ALL SELECT 'chunk', NULL FROM cr) GROUP BY unit")
def u1(spark, sf):
    t, c = _timeline_chunks(spark, sf)
    return P.all_rows(P.segment_rows(_segments(spark, sf)), P.chunk_rows(t, c)).groupBy("unit").agg(F.count("*").alias("n"), F.count("speaker").alias("with_speaker"))


@query("U2_array_intersect", _ROWS + " SELECT seg_index, CAST(len(list_intersect(list_distinct(ref), list_distinct(hyp))) AS BIGINT) AS common FROM eval_rows")
def u2(spark, sf):
    return D.eval_rows(spark, sf).select("seg_index", F.size(F.array_intersect("ref", "hyp")).cast("long").alias("common"))


@query("U3_speaker_union", _ROWS + _ASSIGN + " SELECT speaker FROM eval_rows UNION SELECT speaker FROM assignment")
def u3(spark, sf):
    return D.eval_rows(spark, sf).select("speaker").union(assignment(spark).select("speaker")).distinct()


@query("U4_missing_keys", _ROWS + _ASSIGN + " SELECT speaker FROM eval_rows EXCEPT SELECT speaker FROM assignment")
def u4(spark, sf):
    return D.eval_rows(spark, sf).select("speaker").distinct().join(assignment(spark), "speaker", "left_anti")


@query("U5_number_vocabulary", "SELECT unnest([" + ", ".join(f"'{w}'" for w in T.NUMBER_WORDS) + "]) AS word")
def u5(spark, sf):
    return spark.range(1).select(F.explode(F.array_union(F.array(*map(F.lit, T.CARDINALS)), F.array(*map(F.lit, T.ORDINALS)))).alias("word"))


@query("N4_matched_text", _ROWS + " SELECT seg_index, array_to_string(ref[4:9], ' ') AS matched FROM eval_rows WHERE len(ref) >= 9")
def n4(spark, sf):
    return D.eval_rows(spark, sf).where(F.size("ref") >= 9).select("seg_index", F.array_join(F.slice("ref", 4, 6), " ").alias("matched"))


@query("N5_kept_words", _ROWS + " SELECT seg_index, array_to_string(CASE WHEN seg_index % 3 = 0 THEN ref[1:5] WHEN seg_index % 3 = 1 THEN ref[6:] ELSE ref END, ' ') AS kept FROM eval_rows WHERE len(ref) >= 5")
def n5(spark, sf):
    from wordloom.operators.trim import keep_words

    m = F.col("seg_index") % 3
    tail, head = keep_words(F.col("ref"), F.when(m == 0, 5), True), keep_words(F.col("ref"), F.when(m == 1, 5), False)
    return D.eval_rows(spark, sf).where(F.size("ref") >= 5).select("seg_index", F.array_join(F.when(m == 0, tail).otherwise(head), " ").alias("kept"))


@query("N6_relative_times", _WORDS_IN + "SELECT w.event_id, round(start_abs - start_s, 3) AS rel_start FROM w JOIN chunks c ON w.file_no = c.file_no AND w.chunk_index = c.chunk_index")
def n6(spark, sf):
    t, _ = _timeline_chunks(spark, sf)
    return t.select("event_id", F.round(F.col("start_abs") - F.col("start_s"), 3).alias("rel_start"))


@query("N7_label_lines", _WORDS_IN + ", f AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_no, chunk_index ORDER BY start_abs, event_id) THEN 0 ELSE 1 END AS new FROM w), g AS (SELECT *, sum(new) OVER (PARTITION BY file_no, chunk_index ORDER BY start_abs, event_id) AS grp FROM f), l AS (SELECT file_no, chunk_index, format('{} ({:.3f})', word, score) AS label FROM w UNION ALL SELECT file_no, chunk_index, '[' || min(speaker) || '] ' || string_agg(word, ' ' ORDER BY start_abs, event_id) FROM g GROUP BY file_no, chunk_index, grp) SELECT file_no, chunk_index, label, count(*) AS n FROM l GROUP BY ALL")
def n7(spark, sf):
    t, _ = _timeline_chunks(spark, sf)
    order = ("start_abs", "event_id")
    g = S.segment_groups(t.withColumn("__f", F.struct("file_no", "chunk_index")), "__f", order, "speaker", None)
    runs = g.groupBy("file_no", "chunk_index", "grp").agg(F.concat(F.lit("["), F.min("speaker"), F.lit("] "), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "word"))), lambda x: x["word"]), " ")).alias("label"))
    words = t.select("file_no", "chunk_index", G.word_label(F.col("word"), F.col("score")).alias("label"))
    return words.union(runs.select("file_no", "chunk_index", "label")).groupBy("file_no", "chunk_index", "label").agg(F.count("*").alias("n"))


@query("N8_json_equality", _ROWS + " SELECT file, count(DISTINCT (speaker, avg_score IS NULL)) AS kinds FROM eval_rows GROUP BY file")
def n8(spark, sf):
    key = F.to_json(F.struct("speaker", F.col("avg_score").isNull().alias("none")))
    return D.eval_rows(spark, sf).groupBy("file").agg(F.count_distinct(key).alias("kinds"))


@query("J3_hypothesis_join", "SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS hyp FROM documents d LEFT JOIN labels l USING (doc_id)")
def j3(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("")).alias("hyp"))


@query("J12_row_wer_join", _SCORE + ", k AS (SELECT seg_index, round(edits / nullif(ref_words, 0)::DOUBLE, 4) AS wer FROM scored WHERE seg_index % 9 <> 4) SELECT e.seg_index, k.wer, k.seg_index IS NULL AS missing FROM eval_rows e LEFT JOIN k USING (seg_index)")
def j12(spark, sf):
    rows = D.eval_rows(spark, sf)
    known = V.scored(rows).where("seg_index % 9 <> 4").select("seg_index", F.round("wer", 4).alias("wer"), F.lit(1).alias("there"))
    return rows.select("seg_index").join(known, "seg_index", "left").select("seg_index", "wer", F.col("there").isNull().alias("missing"))


@query("S2_speakers_by_duration", _ROWS + " SELECT speaker, round(sum(duration), 4) AS seconds FROM eval_rows GROUP BY speaker")
def s2(spark, sf):
    return D.eval_rows(spark, sf).groupBy("speaker").agg(F.round(F.sum("duration"), 4).alias("seconds")).orderBy(F.desc("seconds"), "speaker")


@query("F9_first_rows", _ROWS + " SELECT seg_index, speaker FROM eval_rows ORDER BY seg_index LIMIT 100")
def f9(spark, sf):
    """The first rows are the feature here."""
    return D.eval_rows(spark, sf).orderBy("seg_index").limit(100).select("seg_index", "speaker")


@query("N3_map_default", "SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' ELSE 'other' END AS name FROM documents")
def n3(spark, sf):
    names = F.create_map(F.lit("en"), F.lit("English"), F.lit("de"), F.lit("German"))
    return table(spark, sf, "documents").select("doc_id", F.coalesce(F.try_element_at(names, F.col("lang")), F.lit("other")).alias("name"))


@query("J4_chunk_speech", _WORDS_IN + ", n AS (SELECT file_no, chunk_index, count(*) AS n FROM w GROUP BY ALL) SELECT c.file_no, c.chunk_index, coalesce(n, 0) AS regions FROM chunks c LEFT JOIN n ON c.file_no = n.file_no AND c.chunk_index = n.chunk_index")
def j4(spark, sf):
    t, c = _timeline_chunks(spark, sf)
    regions = t.groupBy("file_no", "chunk_index").agg(F.collect_list(F.struct("start_abs", "end_abs")).alias("speech_segments"))
    joined = c.join(regions, ["file_no", "chunk_index"], "left")
    return joined.select("file_no", "chunk_index", F.coalesce(F.size("speech_segments"), F.lit(0)).cast("long").alias("regions"))


@query("J9_neighbours", f"WITH {CHUNKS_SQL}, k AS (SELECT * FROM chunks WHERE chunk_index % 5 <> 0) SELECT k.file_no, k.chunk_index, n.start_s AS next_start, p.end_s AS prev_end FROM k LEFT JOIN k n ON n.file_no = k.file_no AND n.chunk_index = k.chunk_index + 1 LEFT JOIN k p ON p.file_no = k.file_no AND p.chunk_index = k.chunk_index - 1")
def j9(spark, sf):
    k = D.chunks(spark, sf).where("chunk_index % 5 <> 0")
    after = k.select("file_no", (F.col("chunk_index") - 1).alias("chunk_index"), F.col("start_s").alias("next_start"))
    before = k.select("file_no", (F.col("chunk_index") + 1).alias("chunk_index"), F.col("end_s").alias("prev_end"))
    return k.join(after, ["file_no", "chunk_index"], "left").join(before, ["file_no", "chunk_index"], "left").select("file_no", "chunk_index", "next_start", "prev_end")


@query("J15_enriched_chunks", _BOTH + "SELECT s.file_no, seg_index, count(*) AS source_chunks, min(chunk_index) AS first_chunk, round(min(greatest(start_abs, start_s) - start_s), 4) AS first_in_chunk FROM segments s JOIN chunks c ON s.file_no = c.file_no AND start_s < end_abs AND end_s > start_abs GROUP BY ALL")
def j15(spark, sf):
    o = J.overlaps(_segments(spark, sf), D.chunks(spark, sf), "file_no", bucket_s=DAYS)
    at = F.greatest("start_abs", "start_s") - F.col("start_s")
    return o.groupBy("file_no", "seg_index").agg(F.count("*").alias("source_chunks"), F.min("chunk_index").alias("first_chunk"), F.round(F.min(at), 4).alias("first_in_chunk"))
