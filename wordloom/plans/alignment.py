"""Queries on sequences, intervals, localisation, trimming, timelines and segments."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wordloom.config import DEFAULTS
from wordloom.functions import edit as E
from wordloom.functions import text as T
from wordloom.operators import intervals as J
from wordloom.operators import localize as L
from wordloom.operators import segments as G
from wordloom.operators import sequences as S
from wordloom.operators import trim as R
from wordloom.plans import derive as D
from wordloom.plans.derive import CHUNKS_SQL, GAP, MIN_SEGMENT, TIMELINE_SQL, TRANSCRIPTS_SQL, table
from wordloom.plans.scoring import _sql_t1, _sql_t5

QUERIES, ORACLE_SQL = {}, {}
ORDER = ("start_abs", "event_id")
#: Time buckets for the day-long chunks of these tables.
DAYS = 3 * 86_400.0


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


# --- drift of a series: the words' scores as distances -----------------------------------------------------------------

_SERIES = f"""WITH {TIMELINE_SQL},
smooth AS (SELECT *, avg(coalesce(score, 0)) OVER (PARTITION BY file_no ORDER BY start_abs, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smoothed FROM timeline),
trig AS (SELECT *, CASE WHEN smoothed >= 0.55 THEN 'high' WHEN smoothed <= 0.45 THEN 'low' END AS trigger FROM smooth),
states AS (SELECT *, coalesce(last_value(trigger IGNORE NULLS) OVER (PARTITION BY file_no ORDER BY start_abs, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'low') AS state,
  row_number() OVER (PARTITION BY file_no ORDER BY start_abs, event_id) - 1 AS pos FROM trig),
marks AS (SELECT *, CASE WHEN state = lag(state) OVER (PARTITION BY file_no ORDER BY pos) THEN 0 ELSE 1 END AS change FROM states),
runs AS (SELECT *, sum(change) OVER (PARTITION BY file_no ORDER BY pos) AS run FROM marks) """


def _smoothed(spark, sf):
    return S.smooth(D.timeline(spark, sf), "score", "file_no", ORDER, DEFAULTS.drift_window)


def _states(spark, sf):
    return S.hysteresis(_smoothed(spark, sf), "smoothed", "file_no", ORDER, DEFAULTS.drift_high, DEFAULTS.drift_low)


@query("W2_rolling_mean", _SERIES + "SELECT event_id, round(smoothed, 9) AS smoothed FROM smooth")
def w2(spark, sf):
    return _smoothed(spark, sf).select("event_id", F.round("smoothed", 9).alias("smoothed"))


@query("W2b_rolling_mean_skip_nulls", f"WITH {TIMELINE_SQL}, n AS (SELECT *, CASE WHEN event_id % 4 <> 0 THEN score END AS s FROM timeline) SELECT event_id, round(avg(s) OVER (PARTITION BY file_no ORDER BY start_abs, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 9) AS smoothed FROM n")
def w2b(spark, sf):
    t = D.timeline(spark, sf).withColumn("s", F.when(F.col("event_id") % 4 != 0, F.col("score")))
    return S.smooth(t, "s", "file_no", ORDER, skip_nulls=True).select("event_id", F.round("smoothed", 9).alias("smoothed"))


@query("W3_hysteresis", _SERIES + "SELECT event_id, state FROM states")
def w3(spark, sf):
    return _states(spark, sf).select("event_id", "state")


@query("W4_drift_runs", _SERIES + "SELECT file_no, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n FROM runs WHERE state = 'high' GROUP BY file_no, run HAVING count(*) >= 2")
def w4(spark, sf):
    return S.drift_runs(_states(spark, sf), "file_no", ORDER, DEFAULTS.drift_min_run).select("file_no", F.col("first_pos").cast("long").alias("first_pos"), F.col("last_pos").cast("long").alias("last_pos"), "n")


@query("W5_regions", _SERIES + "SELECT file_no, state, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n, round(avg(score), 9) AS mean_value FROM runs GROUP BY file_no, run, state")
def w5(spark, sf):
    r = S.regions(_states(spark, sf), "file_no", ORDER, "score")
    return r.select("file_no", "state", F.col("first_pos").cast("long").alias("first_pos"), F.col("last_pos").cast("long").alias("last_pos"), "n", F.round("mean_value", 9).alias("mean_value"))


@query("W6_top_jumps", _SERIES + ", j AS (SELECT *, round(smoothed, 9) - round(lag(smoothed) OVER (PARTITION BY file_no ORDER BY start_abs, event_id), 9) AS jump FROM smooth), k AS (SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY jump DESC, start_abs DESC, event_id DESC) AS rank FROM j WHERE jump IS NOT NULL) SELECT file_no, event_id, rank, round(jump, 6) AS jump FROM k WHERE rank <= 5")
def w6(spark, sf):
    s = _smoothed(spark, sf).withColumn("smoothed", F.round("smoothed", 9))
    return S.top_jumps(s, "smoothed", "file_no", ORDER, "start_abs").select("file_no", "event_id", F.col("rank").cast("long").alias("rank"), F.round("jump", 6).alias("jump"))


@query("W6b_rising_edges", _SERIES + "SELECT file_no, min(start_abs) AS t FROM runs WHERE state = 'high' GROUP BY file_no, run HAVING min(pos) > 0")
def w6b(spark, sf):
    r = S.numbered_runs(_states(spark, sf), "state", "file_no", ORDER).withColumn("pos", F.row_number().over(Window.partitionBy("file_no").orderBy(*ORDER)) - 1)
    return r.where("state = 'high'").groupBy("file_no", "run").agg(F.min("start_abs").alias("t"), F.min("pos").alias("p")).where("p > 0").select("file_no", "t")


@query("W7_run_brackets", _SERIES + """, b AS (SELECT *, lag(pos * 3 + 2) OVER (PARTITION BY file_no ORDER BY pos) AS pe, lead(pos * 3) OVER (PARTITION BY file_no ORDER BY pos) AS ns FROM runs),
c AS (SELECT event_id, state, coalesce(first_value(pe) OVER r, 0) AS lo, coalesce(last_value(ns) OVER r, 999999) AS hi FROM b WINDOW r AS (PARTITION BY file_no, run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT event_id, lo, hi FROM c WHERE state = 'high'""")
def w7(spark, sf):
    r = S.numbered_runs(_states(spark, sf), "state", "file_no", ORDER).withColumn("pos", F.row_number().over(Window.partitionBy("file_no").orderBy(*ORDER)) - 1)
    r = r.withColumns({"s": F.col("pos") * 3, "e": F.col("pos") * 3 + 2, "total": F.lit(999_999)})
    return S.brackets(r, "file_no", ORDER, "s", "e", "total").select("event_id", F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))


# --- speaker segments --------------------------------------------------------------------------------------------------

_SEGMENTS = f"""WITH {TIMELINE_SQL},
flags AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER w AND start_abs - lag(end_abs) OVER w <= {GAP} THEN 0 ELSE 1 END AS new FROM timeline WINDOW w AS (PARTITION BY file_no ORDER BY start_abs, event_id)),
grps AS (SELECT *, sum(new) OVER (PARTITION BY file_no ORDER BY start_abs, event_id) AS grp FROM flags),
raw AS (SELECT file_no, grp, min(speaker) AS speaker, min(start_abs) AS start_abs, arg_max(end_abs, (start_abs, event_id)) AS end_abs, count(*) AS word_count, round(avg(score), 4) AS avg_score,
  round(min(score), 4) AS min_score, count(score) AS scored_words, string_agg(word, ' ' ORDER BY start_abs, event_id) AS text FROM grps GROUP BY file_no, grp),
segments AS (SELECT *, round(end_abs - start_abs, 4) AS duration, row_number() OVER (PARTITION BY file_no ORDER BY grp) - 1 AS seg_index FROM raw WHERE end_abs - start_abs >= {MIN_SEGMENT}) """


def _segments(spark, sf):
    return S.speaker_segments(D.timeline(spark, sf), gap=GAP, min_s=MIN_SEGMENT)


@query("W8_speaker_segments", _SEGMENTS + "SELECT file_no, seg_index, speaker, start_abs, end_abs, duration, word_count, text FROM segments")
def w8(spark, sf):
    return _segments(spark, sf).select("file_no", "seg_index", "speaker", "start_abs", "end_abs", "duration", "word_count", F.array_join("words", " ").alias("text"))


@query("F5_min_duration", _SEGMENTS + f"SELECT file_no, count(*) FILTER (end_abs - start_abs >= {MIN_SEGMENT}) AS kept, count(*) FILTER (end_abs - start_abs < {MIN_SEGMENT}) AS dropped FROM raw GROUP BY file_no")
def f5(spark, sf):
    r = S.speaker_segments(D.timeline(spark, sf), gap=GAP, min_s=float("-inf"))
    ok = F.col("end_abs") - F.col("start_abs") >= MIN_SEGMENT
    return r.groupBy("file_no").agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


@query("W9_speaker_runs", f"WITH {TIMELINE_SQL}, f AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY file_no ORDER BY start_abs, event_id) THEN 0 ELSE 1 END AS new FROM timeline), g AS (SELECT *, sum(new) OVER (PARTITION BY file_no ORDER BY start_abs, event_id) AS grp FROM f) SELECT file_no, CAST(grp AS BIGINT) AS grp, min(speaker) AS speaker, count(*) AS n FROM g GROUP BY file_no, grp")
def w9(spark, sf):
    g = S.segment_groups(D.timeline(spark, sf), "file_no", ORDER, "speaker", None)
    return g.groupBy("file_no", F.col("grp").cast("long").alias("grp")).agg(F.min("speaker").alias("speaker"), F.count("*").alias("n"))


@query("A9_speaker_stats", _SEGMENTS + "SELECT file_no, speaker, count(*) AS segments, round(sum(duration), 2) AS total_duration_s, CAST(sum(word_count) AS BIGINT) AS total_words FROM segments GROUP BY file_no, speaker")
def a9(spark, sf):
    return G.speaker_stats(_segments(spark, sf))


@query("A10_segment_confidence", _SEGMENTS + "SELECT file_no, seg_index, avg_score, min_score, scored_words FROM segments")
def a10(spark, sf):
    return _segments(spark, sf).select("file_no", "seg_index", "avg_score", "min_score", "scored_words")


@query("A24_timeline_stats", f"WITH {TIMELINE_SQL} SELECT file_no, count(*) AS words, min(start_abs) AS first_s, max(end_abs) AS last_s, round(median(score), 9) AS median_score FROM timeline GROUP BY file_no")
def a24(spark, sf):
    return D.timeline(spark, sf).groupBy("file_no").agg(F.count("*").alias("words"), F.min("start_abs").alias("first_s"), F.max("end_abs").alias("last_s"), F.round(F.median("score"), 9).alias("median_score"))


@query("S1_timeline_order", f"WITH {TIMELINE_SQL} SELECT event_id, row_number() OVER (PARTITION BY file_no ORDER BY start_abs, event_id) AS position FROM timeline")
def s1(spark, sf):
    return D.timeline(spark, sf).select("event_id", F.row_number().over(Window.partitionBy("file_no").orderBy(*ORDER)).cast("long").alias("position"))


# --- intervals ---------------------------------------------------------------------------------------------------------

_BOTH = _SEGMENTS.rstrip() + f", {CHUNKS_SQL} "


@query("J5_clip_regions", f"WITH {TIMELINE_SQL}, {CHUNKS_SQL}, o AS (SELECT c.file_no, chunk_index, round(greatest(start_abs, start_s) - start_s, 4) AS s, round(least(end_abs, end_s) - start_s, 4) AS e FROM timeline t JOIN chunks c ON t.file_no = c.file_no AND least(end_abs, end_s) > greatest(start_abs, start_s)) SELECT file_no, chunk_index, count(*) AS regions, round(sum(e - s), 0) AS speech_s, min(s) AS first_s FROM o GROUP BY ALL")
def j5(spark, sf):
    o = _laps(spark, sf)
    a, b = J.rounded(F.greatest("start_abs", "start_s") - F.col("start_s"), 4), J.rounded(F.least("end_abs", "end_s") - F.col("start_s"), 4)
    g = o.groupBy("file_no", "chunk_index").agg(F.count("*").alias("regions"), _in_order(b - a).alias("speech"), F.min(a).alias("first_s"))
    return g.select("file_no", "chunk_index", "regions", F.round("speech", 0).alias("speech_s"), "first_s")


def _laps(spark, sf):
    """Words that share time with a chunk; a word without a duration shares none."""
    return J.overlaps(D.timeline(spark, sf), D.chunks(spark, sf), "file_no", bucket_s=DAYS).where(F.least("end_abs", "end_s") > F.greatest("start_abs", "start_s"))


def _in_order(value):
    """A chunk's sum of doubles in the order of its events, so that it doesn't depend on how rows are dealt out."""
    return F.aggregate(F.transform(F.array_sort(F.collect_list(F.struct("event_id", value.alias("v")))), lambda x: x["v"]), F.lit(0.0), lambda a, x: a + x)


@query("J6_segment_chunks", _BOTH + "SELECT s.file_no, seg_index, chunk_index, round(greatest(start_abs, start_s), 4) AS overlap_start, round(least(end_abs, end_s), 4) AS overlap_end, round(greatest(start_abs, start_s) - start_s, 4) AS start_in_chunk FROM segments s JOIN chunks c ON s.file_no = c.file_no AND start_s < end_abs AND end_s > start_abs")
def j6(spark, sf):
    o = J.overlaps(_segments(spark, sf), D.chunks(spark, sf), "file_no", bucket_s=DAYS)
    a, b = F.greatest("start_abs", "start_s"), F.least("end_abs", "end_s")
    return o.select("file_no", "seg_index", "chunk_index", J.rounded(a, 4).alias("overlap_start"), J.rounded(b, 4).alias("overlap_end"), J.rounded(a - F.col("start_s"), 4).alias("start_in_chunk"))


@query("J7_max_overlap_chunk", _BOTH + ", p AS (SELECT s.file_no, seg_index, chunk_index, least(end_abs, end_s) - greatest(start_abs, start_s) AS lap, abs((start_s + end_s) * 0.5::DOUBLE - (start_abs + end_abs) * 0.5::DOUBLE) AS away FROM segments s JOIN chunks c ON s.file_no = c.file_no), r AS (SELECT *, row_number() OVER (PARTITION BY file_no, seg_index ORDER BY lap > 0 DESC, CASE WHEN lap > 0 THEN -lap ELSE away END, chunk_index) AS k FROM p) SELECT file_no, seg_index, chunk_index, round(greatest(lap, 0), 6) AS overlap FROM r WHERE k = 1")
def j7(spark, sf):
    return J.best_chunk(_segments(spark, sf), D.chunks(spark, sf), "file_no", "seg_index", bucket_s=DAYS).withColumn("overlap", F.round("overlap", 6))


@query("J8_word_chunk", f"WITH {TIMELINE_SQL}, {CHUNKS_SQL}, p AS (SELECT event_id, t.file_no, chunk_index, start_abs BETWEEN start_s AND end_s AS inside, least(abs(start_abs - start_s), abs(start_abs - end_s)) AS edge FROM timeline t JOIN chunks c ON t.file_no = c.file_no), r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY inside DESC, CASE WHEN inside THEN 0 ELSE edge END, chunk_index) AS k FROM p) SELECT event_id, chunk_index FROM r WHERE k = 1")
def j8(spark, sf):
    return J.chunk_of_point(D.timeline(spark, sf), D.chunks(spark, sf), "file_no", "event_id", bucket_s=DAYS).select("event_id", "chunk_index")


@query("A21_speaker_chunk_words", f"WITH {TIMELINE_SQL}, {CHUNKS_SQL}, p AS (SELECT event_id, speaker, t.file_no, chunk_index, chunk_file, start_abs BETWEEN start_s AND end_s AS inside, least(abs(start_abs - start_s), abs(start_abs - end_s)) AS edge FROM timeline t JOIN chunks c ON t.file_no = c.file_no), r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY inside DESC, CASE WHEN inside THEN 0 ELSE edge END, chunk_index) AS k FROM p) SELECT speaker, file_no, chunk_file, count(*) AS words FROM r WHERE k = 1 GROUP BY ALL")
def a21(spark, sf):
    t, c = D.timeline(spark, sf), D.chunks(spark, sf)
    found = J.chunk_of_point(t.withColumn("k", F.struct("event_id", "speaker")), c, "file_no", "k", bucket_s=DAYS)
    n = found.groupBy(F.col("k.speaker").alias("speaker"), "file_no", "chunk_index").agg(F.count("*").alias("words"))
    return n.join(c.select("file_no", "chunk_index", "chunk_file"), ["file_no", "chunk_index"]).select("speaker", "file_no", "chunk_file", "words")


@query("AU1_silence_plan", f"""WITH {TIMELINE_SQL}, {CHUNKS_SQL}, r AS (SELECT c.file_no, chunk_index, duration_s, start_abs - start_s AS s, end_abs - start_s AS e, event_id FROM timeline t JOIN chunks c ON t.file_no = c.file_no AND start_abs >= start_s AND start_abs < end_s),
g AS (SELECT *, coalesce(lag(e) OVER w, 0) AS gap_from, lead(s) OVER w IS NULL AS is_last FROM r WINDOW w AS (PARTITION BY file_no, chunk_index ORDER BY s, event_id)),
z AS (SELECT file_no, chunk_index, gap_from AS a, s AS b FROM g UNION ALL SELECT file_no, chunk_index, e, duration_s FROM g WHERE is_last)
SELECT file_no, chunk_index, count(*) FILTER (b - a >= 5000) AS spans, round(coalesce(sum(b - a) FILTER (b - a >= 5000), 0), 3) AS silent_s FROM z GROUP BY ALL""")
def au1(spark, sf):
    t = D.timeline(spark, sf)
    p = D.chunks(spark, sf).join(t, "file_no").where("start_abs >= start_s and start_abs < end_s")
    region = F.struct((F.col("start_abs") - F.col("start_s")).alias("start"), (F.col("end_abs") - F.col("start_s")).alias("end"), "event_id")
    c = p.groupBy("file_no", "chunk_index").agg(F.first("duration_s").alias("duration_s"), F.sort_array(F.collect_list(region)).alias("r"))
    c = c.withColumn("plan", J.silence_plan(F.col("duration_s"), F.sort_array(F.transform("r", lambda x: F.struct(x["start"].alias("start"), x["event_id"].alias("k"), x["end"].alias("end")))), 5000.0))
    return c.select("file_no", "chunk_index", F.size("plan").cast("long").alias("spans"), F.round(F.aggregate("plan", F.lit(0.0), lambda a, x: a + x["end"] - x["start"]), 3).alias("silent_s"))


@query("N9_speech_seconds", f"WITH {TIMELINE_SQL}, {CHUNKS_SQL}, o AS (SELECT c.file_no, c.chunk_index, sum(least(end_abs, end_s) - greatest(start_abs, start_s)) AS s FROM timeline t JOIN chunks c ON t.file_no = c.file_no AND least(end_abs, end_s) > greatest(start_abs, start_s) GROUP BY ALL) SELECT c.file_no, c.chunk_index, round(coalesce(s, duration_s), 3) AS speech_s FROM chunks c LEFT JOIN o ON c.file_no = o.file_no AND c.chunk_index = o.chunk_index")
def n9(spark, sf):
    s = _laps(spark, sf).groupBy("file_no", "chunk_index").agg(_in_order(F.least("end_abs", "end_s") - F.greatest("start_abs", "start_s")).alias("s"))
    return D.chunks(spark, sf).join(s, ["file_no", "chunk_index"], "left").select("file_no", "chunk_index", F.round(F.coalesce("s", "duration_s"), 3).alias("speech_s"))


# --- trimming ----------------------------------------------------------------------------------------------------------


def _trim_sql(tail: bool) -> str:
    side, other = ("(t - p) / (n - i)", "p / i") if tail else ("p / i", "(t - p) / (n - i)")
    lo, hi = (5, 5)
    return f"""WITH {TIMELINE_SQL}, numbered AS (SELECT file_no, score, row_number() OVER (PARTITION BY file_no ORDER BY start_abs, event_id) AS i, count(*) OVER (PARTITION BY file_no) AS n,
  sum(score) OVER (PARTITION BY file_no ORDER BY start_abs, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p, sum(score) OVER (PARTITION BY file_no) AS t,
  row_number() OVER (PARTITION BY file_no ORDER BY score DESC) AS by_score FROM timeline),
tops AS (SELECT file_no, avg(score) FILTER (by_score <= greatest(1, n // 2)) AS top FROM numbered GROUP BY file_no),
c AS (SELECT file_no, i, {other} - {side} AS contrast, {side} AS side FROM numbered WHERE i >= {lo} AND i <= n - {hi} AND n >= 10),
r AS (SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY round(contrast, 12) DESC, i) AS k FROM c)
SELECT file_no, i AS split, round(contrast, 6) AS contrast, round(side, 6) AS side_mean, round(top, 6) AS top_half,
  CASE WHEN top >= 0.5 AND contrast > 0.3 AND side < least(0.35, 0.45 * top) THEN i END AS trim FROM r JOIN tops USING (file_no) WHERE k = 1"""


def _trim(spark, sf, tail: bool):
    a = D.timeline(spark, sf).groupBy("file_no").agg(F.transform(F.array_sort(F.collect_list(F.struct(*ORDER, "score"))), lambda x: x["score"]).alias("scores"))
    t = R.with_split(a, "scores", tail)
    return t.where("split is not null").select("file_no", F.col("split").cast("long").alias("split"), "contrast", "side_mean", "top_half", F.col("trim").cast("long").alias("trim"))


@query("W10_tail_trim", _trim_sql(True))
def w10(spark, sf):
    return _trim(spark, sf, True)


@query("W11_head_trim", _trim_sql(False))
def w11(spark, sf):
    return _trim(spark, sf, False)


@query("W12_top_half_mean", f"WITH {TIMELINE_SQL}, n AS (SELECT file_no, score, count(*) OVER (PARTITION BY file_no) AS n, row_number() OVER (PARTITION BY file_no ORDER BY score DESC) AS k FROM timeline) SELECT file_no, round(avg(score), 9) AS top_half FROM n WHERE k <= greatest(1, n // 2) GROUP BY file_no")
def w12(spark, sf):
    a = D.timeline(spark, sf).groupBy("file_no").agg(F.collect_list("score").alias("scores"))
    return a.select("file_no", F.round(R.top_half_mean(F.col("scores")), 9).alias("top_half"))


# --- localisation: the turns of a conversation inside its whole text --------------------------------------------------

# the reach of the SQL's search
BACK, FORWARD = 600, 200


def loc_refs(spark, sf):
    """file_no, ref (the whole conversation)."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("file_no"), "turn", T.words(T.clean_text(F.col("text"))).alias("said"))
    return c.groupBy("file_no").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", "said"))), lambda x: x["said"])).alias("ref"))


def loc_turns(spark, sf):
    """file_no, chunk_index, said (the turn's words), hyp (said with errors), n, expected, total (words of the conversation)."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("file_no"), (F.col("turn") + 1).alias("chunk_index"), T.words(T.clean_text(F.col("text"))).alias("said"))
    c = c.withColumn("n", F.size("said"))
    w = Window.partitionBy("file_no").orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("expected", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("int")).withColumn("total", F.sum("n").over(Window.partitionBy("file_no")).cast("int"))
    none = F.array().cast("array<string>")
    hyp = F.flatten(F.transform("said", lambda x, i: F.when((i + 1) % 7 == 3, none).when((i + 1) % 11 == 5, F.array(F.concat(x, F.lit("s")))).otherwise(F.array(x))))
    return c.withColumn("hyp", hyp)


def loc_chunks(spark, sf):
    """loc_turns with ref (the whole conversation): only for what cuts its part out at once, as a long conversation would
    otherwise be sorted and dealt out with each of its turns."""
    return loc_turns(spark, sf).join(loc_refs(spark, sf), "file_no")


_W1 = f"list_filter(string_split({_sql_t1('text')}, ' '), lambda x: x <> '')"
LOC_SQL = f"""loc_w AS (SELECT conv_id AS file_no, turn + 1 AS chunk_index, {_W1} AS said FROM conversations),
loc_ref AS (SELECT file_no, flatten(list(said ORDER BY chunk_index)) AS ref FROM loc_w GROUP BY file_no),
loc AS (SELECT w.*, len(said) AS n, ref, flatten(list_transform(said, lambda x, i: CASE WHEN i % 7 = 3 THEN [] WHEN i % 11 = 5 THEN [x || 's'] ELSE [x] END)) AS hyp,
  CAST(coalesce(sum(len(said)) OVER (PARTITION BY w.file_no ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS expected FROM loc_w w JOIN loc_ref USING (file_no))"""


def match_sql(source: str, hyp: str = "hyp", key: str = "file_no, chunk_index") -> str:
    """After `source`: found (key, start_idx, end_idx, nd)."""
    return f"""bounds AS (SELECT *, greatest(0, expected - {BACK}) AS lo, array_to_string({hyp}, ' ') AS h FROM {source}),
spans AS (SELECT *, greatest(least(len(ref) - n + 1, expected + {FORWARD}), lo + 1) AS hi, least(n, len(ref) - lo) AS width FROM bounds),
places AS (SELECT {key}, h, width, n, expected, ref, unnest(range(lo, hi)) AS p FROM spans),
dist AS (SELECT {key}, p, n, width, expected, len(ref) AS total, length(h) AS lh, length(array_to_string(ref[p + 1:p + width], ' ')) AS lr, levenshtein(h, array_to_string(ref[p + 1:p + width], ' ')) AS d FROM places),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY d, p) AS k FROM dist),
found AS (SELECT {key}, CASE WHEN n <= 0 THEN expected ELSE p END AS start_idx, CASE WHEN n <= 0 THEN expected ELSE least(p + width, total) END AS end_idx,
  CASE WHEN n <= 0 THEN 1.0 ELSE round(d / greatest(lh, lr, 1)::DOUBLE, 4) END AS nd FROM ranked WHERE k = 1)"""


@query("L2_window_match", f"WITH {LOC_SQL}, {match_sql('loc')} SELECT * FROM found")
def l2(spark, sf):
    return L.with_match(loc_chunks(spark, sf), "ref", "hyp", "expected", "n").select("file_no", "chunk_index", "start_idx", "end_idx", "nd")


@query("W1_expected_position", f"WITH {LOC_SQL}, s AS (SELECT file_no, chunk_index, len(ref) AS total, len(hyp) * 0.5::DOUBLE AS speech FROM loc), p AS (SELECT *, coalesce(sum(speech) OVER (PARTITION BY file_no ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(speech) OVER (PARTITION BY file_no) AS all_s FROM s) SELECT file_no, chunk_index, CAST(trunc(before * (CASE WHEN all_s > 0 THEN total / all_s ELSE 1.71 END)) AS BIGINT) AS expected_pos FROM p")
def w1(spark, sf):
    c = loc_turns(spark, sf).withColumn("speech", F.size("hyp") * 0.5)
    return S.expected_positions(c, "file_no", ["chunk_index"], "speech", "total", DEFAULTS.words_per_second).select("file_no", "chunk_index", "expected_pos")


@query("L3_window_words", f"WITH {LOC_SQL} SELECT file_no, chunk_index, greatest(CAST(trunc(len(said) * 0.4::DOUBLE * 2.3::DOUBLE) AS BIGINT), len(hyp)) AS n FROM loc")
def l3(spark, sf):
    return loc_turns(spark, sf).select("file_no", "chunk_index", L.window_words(F.size("said") * F.lit(0.4), F.lit(2.3), F.col("hyp")).cast("long").alias("n"))


_OPTIONS_SQL = f"""options AS (SELECT file_no, chunk_index, expected, ref, said, unnest([0, 1]) AS option FROM loc),
opt AS (SELECT file_no, chunk_index, option, expected, ref, CASE WHEN option = 0 THEN flatten(list_transform(said, lambda x, i: CASE WHEN i % 7 = 3 THEN [] ELSE [x] END)) ELSE list_transform(said, lambda x, i: CASE WHEN i % 5 = 2 AND chunk_index % 2 = 0 THEN x || 'xxx' ELSE x END) END AS hyp, len(said) AS n0 FROM options),
opt2 AS (SELECT *, greatest(n0, len(hyp)) AS n FROM opt)"""


def two_options(spark, sf):
    """loc_chunks with options (two hypotheses of a turn), speech and wps."""
    none = F.array().cast("array<string>")
    a = F.flatten(F.transform("said", lambda x, i: F.when((i + 1) % 7 == 3, none).otherwise(F.array(x))))
    b = F.transform("said", lambda x, i: F.when(((i + 1) % 5 == 2) & (F.col("chunk_index") % 2 == 0), F.concat(x, F.lit("xxx"))).otherwise(x))
    c = loc_chunks(spark, sf).withColumn("options", F.array(F.array_join(a, " "), F.array_join(b, " ")))
    return c.select("file_no", "chunk_index", "options", "ref", "expected", F.size("said").cast("double").alias("speech"), F.lit(1.0).alias("wps"))


def _best(spark, sf):
    return L.best_option(two_options(spark, sf), ["file_no", "chunk_index"], "options", "ref", "expected", "speech", "wps")


_BEST = f"WITH {LOC_SQL}, {_OPTIONS_SQL}, {match_sql('opt2', key='file_no, chunk_index, option')}, best AS (SELECT *, row_number() OVER (PARTITION BY file_no, chunk_index ORDER BY nd, option DESC) AS r FROM found) "


@query("L4_best_option", _BEST + "SELECT file_no, chunk_index, option, start_idx, end_idx, nd FROM best WHERE r = 1")
def l4(spark, sf):
    return _best(spark, sf).select("file_no", "chunk_index", F.col("option").cast("long").alias("option"), "start_idx", "end_idx", "nd")


@query("A19_winner_counts", _BEST + ", two AS (SELECT file_no, chunk_index, max(nd) FILTER (option = 0) - max(nd) FILTER (option = 1) AS delta, arg_min(option, r) AS won FROM best GROUP BY ALL) SELECT file_no, count(*) AS chunks, count(*) FILTER (won = 0) AS first_wins, count(*) FILTER (won = 1) AS second_wins, sum(CAST(round(delta * 10000) AS BIGINT)) / (count(*) * 10000.0::DOUBLE) AS mean_delta FROM two GROUP BY file_no")
def a19(spark, sf):
    m = L.option_matches(two_options(spark, sf), "options", "ref", "expected", "speech", "wps")
    m = m.groupBy("file_no", "chunk_index").agg(*[F.max(F.when(F.col("option") == k, F.col("nd"))).alias(f"nd{k}") for k in (0, 1)])
    won = F.when(F.col("nd1") <= F.col("nd0"), 1).otherwise(0)
    return m.groupBy("file_no").agg(F.count("*").alias("chunks"), F.count_if(won == 0).alias("first_wins"), F.count_if(won == 1).alias("second_wins"), (F.sum(F.round((F.col("nd0") - F.col("nd1")) * 10000).cast("long")) / (F.count("*") * F.lit(10000.0))).alias("mean_delta"))


def _grams_sql(name: str, source: str, key: str, words: str, lengths) -> str:
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT {key}, {n} AS n, unnest(range(0, len({words}) - {n} + 1)) AS pos, unnest(list_transform(range(0, len({words}) - {n} + 1), lambda i: array_to_string({words}[i + 1:i + {n}], ' '))) AS gram FROM {source} WHERE len({words}) >= {n}" for n in lengths
    ) + ")"


@query("L1_unique_ngrams", f"WITH {LOC_SQL}, {_grams_sql('g', 'loc_ref', 'file_no', 'ref', (3, 4, 5, 6))} SELECT file_no, n, gram, min(pos) AS pos FROM g GROUP BY file_no, n, gram HAVING count(*) = 1")
def l1(spark, sf):
    return L.unique_ngrams(loc_refs(spark, sf), ["file_no"], "ref", (3, 4, 5, 6)).select("file_no", F.col("n").cast("long").alias("n"), "gram", F.col("pos").cast("long").alias("pos"))


@query("W15_first_positions", f"WITH {LOC_SQL}, {_grams_sql('g', 'loc_ref', 'file_no', 'ref', (3, 4, 5, 6))} SELECT file_no, n, gram, min(pos) AS first_pos FROM g GROUP BY file_no, n, gram")
def w15(spark, sf):
    return L.first_positions(loc_refs(spark, sf), ["file_no"], "ref", (3, 4, 5, 6)).select("file_no", F.col("n").cast("long").alias("n"), "gram", F.col("first_pos").cast("long").alias("first_pos"))


_VOTES = f"""WITH {LOC_SQL}, {_grams_sql('r', 'loc_ref', 'file_no', 'ref', (5, 4, 3))}, {_grams_sql('h', 'loc', 'file_no, chunk_index', 'hyp', (5, 4, 3))},
df AS (SELECT file_no, n, gram, count(*) AS df FROM r GROUP BY ALL),
votes AS (SELECT h.file_no, h.chunk_index, h.n, r.pos - h.pos AS start, CAST(1::DECIMAL(20,12) / df AS DECIMAL(20,12)) AS weight, h.pos AS j, r.pos AS p FROM h JOIN r ON h.file_no = r.file_no AND h.n = r.n AND h.gram = r.gram JOIN df ON df.file_no = h.file_no AND df.n = h.n AND df.gram = h.gram) """


@query("J10_gram_votes", _VOTES + "SELECT file_no, chunk_index, n, start, count(*) AS votes, round(CAST(sum(weight) AS DOUBLE), 6) AS weight FROM votes GROUP BY ALL")
def j10(spark, sf):
    v = L.gram_votes(loc_turns(spark, sf), loc_refs(spark, sf), "file_no", "chunk_index", "hyp", "ref")
    return v.groupBy("file_no", "chunk_index", F.col("n").cast("long").alias("n"), F.col("start").cast("long").alias("start")).agg(F.count("*").alias("votes"), F.round(F.sum("weight").cast("double"), 6).alias("weight"))


@query("L5_vote_start", _VOTES + ", s AS (SELECT file_no, chunk_index, n, start, sum(weight) AS w, min(j * 1000000 + p) AS first FROM votes GROUP BY ALL), near AS (SELECT *, sum(w) OVER (PARTITION BY file_no, chunk_index, n ORDER BY start RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS score FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY file_no, chunk_index ORDER BY n DESC, score DESC, first) AS r FROM near) SELECT file_no, chunk_index, start, round(CAST(score AS DOUBLE), 6) AS score, n AS n_used FROM k WHERE r = 1")
def l5(spark, sf):
    v = L.gram_votes(loc_turns(spark, sf), loc_refs(spark, sf), "file_no", "chunk_index", "hyp", "ref")
    return L.vote_start(v, ["file_no", "chunk_index"]).select("file_no", "chunk_index", F.col("start").cast("long").alias("start"), F.round("score", 6).alias("score"), F.col("n_used").cast("long").alias("n_used"))


def drifted(spark, sf):
    """Chunks matched too late in the middle of each conversation, with their distances and drift states."""
    c = loc_chunks(spark, sf)
    late = F.when((F.col("chunk_index") % 6).isin(2, 3, 4), 37).otherwise(0)
    c = c.withColumn("start_idx", F.least(F.col("expected") + late, F.col("total"))).withColumn("end_idx", F.least(F.col("start_idx") + F.col("n"), F.col("total")))
    found = F.array_join(F.slice("ref", F.col("start_idx") + 1, F.col("end_idx") - F.col("start_idx")), " ")
    c = c.select("file_no", "chunk_index", "hyp", "start_idx", "end_idx", "total", F.array_join("hyp", " ").alias("text"), found.alias("found"))
    c = c.repartition("file_no").withColumn("nd", E.text_norm_distance(F.col("text"), F.col("found"))).drop("text", "found")
    c = S.hysteresis(S.smooth(c, "nd", "file_no", ["chunk_index"]), "smoothed", "file_no", ["chunk_index"], DEFAULTS.drift_high, DEFAULTS.drift_low)
    c = S.numbered_runs(c, "state", "file_no", ["chunk_index"])
    return c.withColumn("run_n", F.count("*").over(Window.partitionBy("file_no", "run")))


@query("L6_resync_plan")
def l6(spark, sf):
    b = S.brackets(drifted(spark, sf), "file_no", ["chunk_index"], "start_idx", "end_idx", "total", every=True)
    run = F.when((F.col("state") == "high") & (F.col("run_n") >= DEFAULTS.drift_min_run), F.col("run"))
    rows = b.select("file_no", run.alias("run"), F.col("chunk_index").alias("pos"), "chunk_index", "hyp", "start_idx", "end_idx", "lo", "hi", "nd")
    return L.resync_runs(rows, "file_no", refs=loc_refs(spark, sf))


@query("A23_resync_report")
def a23(spark, sf):
    return l6(spark, sf).groupBy("status").agg(F.count("*").alias("chunks"), F.round(F.avg("old_nd"), 6).alias("mean_old_nd"), F.round(F.avg("new_nd"), 6).alias("mean_new_nd"))


@query("W16_commit_fold", f"WITH {LOC_SQL}, m AS (SELECT file_no, chunk_index, expected + n AS e, (chunk_index * 37 % 100) / 100.0::DOUBLE AS nd FROM loc) SELECT file_no, chunk_index, coalesce(last_value(CASE WHEN nd <= 0.35 THEN e END IGNORE NULLS) OVER (PARTITION BY file_no ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS committed FROM m")
def w16(spark, sf):
    c = loc_turns(spark, sf).withColumn("e", (F.col("expected") + F.col("n")).cast("long")).withColumn("nd", F.col("chunk_index") * 37 % 100 / F.lit(100.0))
    return S.commit_fold(c, "file_no", ["chunk_index"], "e", "nd", DEFAULTS.commit_distance).select("file_no", "chunk_index", "committed")


_GAPS = f"""WITH {LOC_SQL}, g AS (SELECT file_no, chunk_index, 30.0::DOUBLE AS duration_s, (chunk_index * 5 % 7)::DOUBLE AS first_start, 30.0::DOUBLE - (chunk_index * 3 % 8) AS last_end, expected + 2 AS start_idx, expected + n - 3 AS end_idx, len(ref) AS total_ref, 1.5::DOUBLE AS wps FROM loc),
j AS (SELECT g.*, a.start_idx AS next_start, b.end_idx AS prev_end, duration_s - last_end AS tail, first_start AS head FROM g LEFT JOIN (SELECT file_no AS fa, chunk_index - 1 AS ca, start_idx FROM g) a ON g.file_no = fa AND g.chunk_index = ca LEFT JOIN (SELECT file_no AS fb, chunk_index + 1 AS cb, end_idx FROM g) b ON g.file_no = fb AND g.chunk_index = cb),
k AS (SELECT *, least(end_idx + greatest(1, CAST(trunc(tail * wps * 1.1::DOUBLE) AS BIGINT)), total_ref, coalesce(next_start, total_ref)) AS te, greatest(0, start_idx - greatest(1, CAST(trunc(head * wps * 1.1::DOUBLE) AS BIGINT)), coalesce(prev_end, 0)) AS hs FROM j),
p AS (SELECT *, tail >= 3 AND end_idx < total_ref AND te > end_idx AND duration_s - greatest(0, last_end - 0.1::DOUBLE) >= 0.5 AS fill_tail, head >= 3 AND start_idx > 0 AND hs < start_idx AND least(duration_s, first_start + 0.1::DOUBLE) >= 0.5 AS fill_head FROM k) """


@query("L8_gap_plan", _GAPS + "SELECT file_no, chunk_index, round(tail, 4) AS tail_gap, round(head, 4) AS head_gap, fill_tail, fill_head, CASE WHEN fill_tail THEN te END AS tail_ref_end, CASE WHEN fill_head THEN hs END AS head_ref_start, CASE WHEN fill_tail THEN round(greatest(0, last_end - 0.1::DOUBLE), 4) END AS tail_audio_start, CASE WHEN fill_head THEN round(least(duration_s, first_start + 0.1::DOUBLE), 4) END AS head_audio_end FROM p")
def l8(spark, sf):
    i = F.col("chunk_index")
    c = loc_turns(spark, sf).select(
        "file_no", "chunk_index", F.lit(30.0).alias("duration_s"), (i * 5 % 7).cast("double").alias("first_start"), (F.lit(30.0) - i * 3 % 8).alias("last_end"), (F.col("expected") + 2).cast("long").alias("start_idx"),
        (F.col("expected") + F.col("n") - 3).cast("long").alias("end_idx"), F.col("total").cast("long").alias("total_ref"), F.lit(1.5).alias("wps"),
    )
    return L.gap_plan(c, "file_no")


@query("W13_timeline", f"WITH {LOC_SQL}, t AS (SELECT file_no, chunk_index, expected, said, least(chunk_index % 3, len(said)) AS head FROM loc), u AS (SELECT *, unnest(range(0, len(said) - head)) AS i FROM t) SELECT file_no, chunk_index, said[head + i + 1] AS word, round(chunk_index * 30 + (head + i) * 0.25::DOUBLE, 4) AS start_abs, expected + head + i AS ref_word_idx FROM u")
def w13(spark, sf):
    word = lambda w, i: F.struct(w.alias("word"), (i * F.lit(0.25)).alias("start"), (i * F.lit(0.25) + 0.2).alias("end"), F.lit(0.9).alias("score"))
    c = loc_turns(spark, sf).withColumn("words1", F.transform("said", word))
    head = F.least(F.col("chunk_index") % 3, F.size("said")).cast("int")
    c = c.withColumn("words2", F.slice("words1", head + 1, F.size("words1") - head)).withColumn("start_s", F.col("chunk_index") * F.lit(30.0)).withColumn("start_idx", F.col("expected"))
    return G.timeline(c).select("file_no", "chunk_index", "word", "start_abs", F.col("ref_word_idx").cast("long").alias("ref_word_idx"))


_SPEAKERS = f"""conv AS (SELECT conv_id, turn, role, list_filter(string_split({_sql_t5('text')}, ' '), lambda x: x <> '') AS ws FROM conversations),
spoken AS (SELECT *, coalesce(sum(len(ws)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM conv),
speaker_map AS (SELECT conv_id AS file_no, CAST(first + i AS BIGINT) AS ref_word_idx, 'spk_' || role AS speaker_id, ws[i + 1] AS word FROM (SELECT *, unnest(range(0, len(ws))) AS i FROM spoken))"""


@query("SC2_speaker_map", f"WITH {_SPEAKERS} SELECT * FROM speaker_map")
def sc2(spark, sf):
    return G.speaker_map(D.transcripts(spark, sf)).withColumn("ref_word_idx", F.col("ref_word_idx").cast("long"))


@query("J1_word_speakers", f"WITH {_SPEAKERS}, {TIMELINE_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY start_abs, event_id) * 9 - 1 AS ref_word_idx FROM timeline) SELECT event_id, coalesce(speaker_id, 'UNKNOWN') AS speaker_id FROM t LEFT JOIN speaker_map s ON t.file_no = s.file_no AND t.ref_word_idx = s.ref_word_idx")
def j1(spark, sf):
    t = D.timeline(spark, sf).withColumn("ref_word_idx", (F.row_number().over(Window.partitionBy("file_no").orderBy(*ORDER)) * 9 - 1).cast("long"))
    return G.with_speakers(t, sc2(spark, sf)).select("event_id", "speaker_id")


NEAR = 600


def _penalised(extra: str) -> str:
    return f"""WITH {LOC_SQL}, bounds AS (SELECT *, greatest(0, expected - {BACK}) AS lo, array_to_string(hyp, ' ') AS h, CASE WHEN len(hyp) >= 3 THEN least(10, len(hyp) // 3) ELSE 0 END AS k FROM loc WHERE n > 0),
spans AS (SELECT *, greatest(least(len(ref) - n + 1, expected + {FORWARD}), lo + 1) AS hi, least(n, len(ref) - lo) AS width FROM bounds),
places AS (SELECT file_no, chunk_index, h, hyp, k, width, expected, ref, unnest(range(lo, hi)) AS p FROM spans),
ends AS (SELECT *, array_to_string(hyp[1:k], ' ') AS h1, array_to_string(ref[p + 1:p + k], ' ') AS r1, array_to_string(hyp[len(hyp) - k + 1:len(hyp)], ' ') AS h2, array_to_string(ref[p + width - k + 1:p + width], ' ') AS r2 FROM places),
eff AS (SELECT file_no, chunk_index, p, levenshtein(h, array_to_string(ref[p + 1:p + width], ' '))::DOUBLE + {extra} AS e FROM ends),
ranked AS (SELECT *, row_number() OVER (PARTITION BY file_no, chunk_index ORDER BY round(e, 9), p) AS r FROM eff)
SELECT file_no, chunk_index, p AS start_idx, round(e, 6) AS effective FROM ranked WHERE r = 1"""


@query("L2a_overlap_penalty", _penalised("greatest(0, expected + 2 - p) * 40.0::DOUBLE"))
def l2a(spark, sf):
    c = loc_chunks(spark, sf).where("n > 0").withColumn("committed", F.col("expected") + 2)
    m = L.scored_match(c, "ref", "hyp", "expected", "n", committed="committed", overlap_weight=40.0)
    return m.select("file_no", "chunk_index", "start_idx", F.round("effective", 6).alias("effective"))


@query("L2b_boundary_penalty", _penalised("CASE WHEN k > 0 THEN (levenshtein(h1, r1) / greatest(length(h1), length(r1), 1)::DOUBLE + levenshtein(h2, r2) / greatest(length(h2), length(r2), 1)::DOUBLE) / 2 * length(h) * 0.5::DOUBLE ELSE 0 END"))
def l2b(spark, sf):
    c = loc_chunks(spark, sf).where("n > 0")
    m = L.scored_match(c, "ref", "hyp", "expected", "n", boundary_weight=0.5)
    return m.select("file_no", "chunk_index", "start_idx", F.round("effective", 6).alias("effective"))


@query("L2c_anchor_bonus")
def l2c(spark, sf):
    c = loc_chunks(spark, sf).where("n > 0")
    m = L.scored_match(c, "ref", "hyp", "expected", "n", anchor_weight=2.0)
    return m.select("file_no", "chunk_index", "start_idx", F.round("effective", 6).alias("effective"))


@query("L10_replay")
def l10(spark, sf):
    """First pass and re-sync from the cached options alone, beside what the first pass chose."""
    first = _best(spark, sf).select("file_no", "chunk_index", F.col("start_idx").alias("first_start"), F.col("nd").alias("first_nd"))
    return first.join(l6(spark, sf).select("file_no", "chunk_index", "new_start", "new_nd", "status"), ["file_no", "chunk_index"])
