"""Queries on lineage, replays, comparisons of experiments, and audio and text files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wordloom.config import DEFAULTS
from wordloom.functions import text as T
from wordloom.operators import audio as A
from wordloom.operators import evaluate as V
from wordloom.operators import experiments as X
from wordloom.operators import intervals as J
from wordloom.operators import localize as L
from wordloom.operators import models as M
from wordloom.operators import reports as R
from wordloom.operators import sequences as S
from wordloom.operators import trim as C
from wordloom.plans import derive as D
from wordloom.plans.alignment import _GAPS, _best, l8, loc_refs, loc_turns, two_options
from wordloom.plans.corpus import _ASSIGN, _EXPS, _ROWS, _SPK, EXPERIMENTS, _experiments, assignment, results
from wordloom.plans.derive import TIMELINE_SQL, eval_sql, table
from wordloom.plans.files import folder
from wordloom.plans.scoring import _SCORE, _WRONG
from wordloom.sources import readers, sinks

QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


# --- experiments -------------------------------------------------------------------------------------------------------


@query("X3_comparison", _EXPS + "SELECT experiment, row_number() OVER (ORDER BY corpus_wer, position) AS rank, round(corpus_wer, 9) AS corpus_wer, round(corpus_wer - (SELECT corpus_wer FROM exps WHERE experiment = 'tuned'), 6) AS delta, (SELECT count(DISTINCT gpu) FROM exps WHERE experiment <> 'base') = 1 AS time_comparable FROM exps WHERE experiment <> 'base'")
def x3(spark, sf):
    e = _experiments(spark, sf)
    found = X.compare(e, results(spark, sf), ["tuned", "tuned_lm"])
    return found.rows.crossJoin(F.broadcast(found.checks.select("time_comparable"))).select("experiment", "rank", F.round("corpus_wer", 9).alias("corpus_wer"), "delta", "time_comparable")  # a row for each experiment and one row


@query("X3_speaker_deltas", _SPK + "SELECT file, speaker, ref_words, round(tuned, 6) AS wer_tuned, round(tuned_lm, 6) AS wer_tuned_lm, round(tuned_lm - tuned, 6) AS delta_tuned_lm FROM v")
def x3_speakers(spark, sf):
    return X.compare(_experiments(spark, sf), results(spark, sf), ["tuned", "tuned_lm"]).speakers


@query("X5_same_test_set", "WITH " + ", ".join(eval_sql(f"rows_{n}", drop=d, empties=n != "tuned") for n, (d, _, _) in EXPERIMENTS.items()) + ", c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS experiment, {i} AS position, count(*) AS total_segments, CAST(sum(len(ref)) AS BIGINT) AS ref_num_total FROM rows_{n}" for i, n in enumerate(EXPERIMENTS)) + ") SELECT experiment, total_segments, ref_num_total, ref_num_total <> first(ref_num_total) OVER (ORDER BY position) OR total_segments <> first(total_segments) OVER (ORDER BY position) AS differs FROM c")
def x5(spark, sf):
    out = None
    for i, (n, (drop, _, _)) in enumerate(EXPERIMENTS.items()):
        s = D.eval_rows(spark, sf, drop=drop, empties=n != "tuned").agg(F.count("*").alias("total_segments"), F.sum(F.size("ref")).alias("ref_num_total"), F.lit(0).alias("wrong_num"))
        s = s.select(F.lit(n).alias("experiment"), F.lit(i).alias("position"), "*")
        out = s if out is None else out.union(s)
    return X.number_consistency(out).select("experiment", "total_segments", "ref_num_total", "differs")


@query("X1_flat_record", _SCORE + "SELECT 'base' AS experiment_name, 'm' AS model_name, 'gpu_a' AS gpu, 84.4::DOUBLE AS decode_s, 'greedy' AS decoding, count(*) AS utterances, sum(edits) / sum(ref_words)::DOUBLE AS corpus_wer FROM scored")
def x1_flat(spark, sf):
    r = X.record(V.summary(D.eval_rows(spark, sf), 84.4), "base", {"name": "m"}, {"manifest": "test"}, {"gpu": "gpu_a"}, {"decode_s": 84.4}, {"normalizer": "v1"}, {"decoding": "greedy"})
    return r.select("experiment_name", F.col("model.name").alias("model_name"), "compute.gpu", "timing.decode_s", "eval.decoding", "summary.utterances", "summary.corpus_wer")


# --- entries of their own ------------------------------------------------------------------------------------------------


@query("F8_gap_triggers", _GAPS + "SELECT file_no, count(*) FILTER (fill_tail) AS tails, count(*) FILTER (fill_head) AS heads, count(*) FILTER (tail >= 3) AS wide_tails FROM p GROUP BY file_no")
def f8(spark, sf):
    return l8(spark, sf).groupBy("file_no").agg(F.count_if("fill_tail").alias("tails"), F.count_if("fill_head").alias("heads"), F.count_if(F.col("tail_gap") >= DEFAULTS.gap).alias("wide_tails"))


@query("J2b_default_split", _ROWS + _ASSIGN + "SELECT e.speaker, coalesce(split, 'unassigned') AS split, count(*) AS n FROM eval_rows e LEFT JOIN assignment a ON e.speaker = a.speaker GROUP BY ALL")
def j2b(spark, sf):
    rows = D.eval_rows(spark, sf).groupBy("speaker").agg(F.count("*").alias("n"))
    return rows.join(assignment(spark), "speaker", "left").select("speaker", F.coalesce("split", F.lit("unassigned")).alias("split"), "n")


@query("S3_top_five", _WRONG + ", n AS (SELECT op, r, h, count(*) AS n FROM wrong GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY op ORDER BY n DESC, coalesce(r, ''), coalesce(h, '')) AS rank FROM n) SELECT op, rank, r AS ref_word, h AS hyp_word, n FROM k WHERE rank <= 5")
def s3(spark, sf):
    return V.top_errors(V.operations(D.eval_rows(spark, sf, numbers=True)), 5).select("op", "rank", "ref_word", "hyp_word", "n")


@query("S4_operation_order", _WRONG + ", n AS (SELECT op, CASE op WHEN 'substitute' THEN 1 WHEN 'delete' THEN 2 ELSE 3 END AS k, r, count(*) AS n FROM wrong WHERE r IS NOT NULL GROUP BY ALL) SELECT r AS ref_word, string_agg(op, ' ' ORDER BY k) AS kinds FROM n GROUP BY r")
def s4(spark, sf):
    o = V.operations(D.eval_rows(spark, sf, numbers=True)).where("op <> 'equal' and ref_word is not null")
    rank = F.when(F.col("op") == "substitute", 1).when(F.col("op") == "delete", 2).otherwise(3)
    kinds = F.transform(F.array_sort(F.collect_set(F.struct(rank.alias("k"), "op"))), lambda x: x["op"])
    return o.groupBy("ref_word").agg(F.array_join(kinds, " ").alias("kinds"))


# --- lineage and replay ----------------------------------------------------------------------------------------------------

def lineage(spark, sf):
    """Whose hypothesis each chunk of a conversation used: the two options of L4 without repeats, and its choice."""
    options = two_options(spark, sf).withColumn("several", F.array_distinct("options"))
    chosen = L.best_option(options, ["file_no", "chunk_index", "several"], "options", "ref", "expected", "speech", "wps")
    return chosen.select("file_no", "chunk_index", R.winner_bucket(F.col("several"), F.col("text")).alias("winner"))


@query("L11_chunk_winners")
def l11(spark, sf):
    return lineage(spark, sf).groupBy("file_no", "winner").agg(F.count("*").alias("chunks"))


def replayed(spark, sf):
    """The first pass from the cached options, its drift, and the re-sync of that, as an audit runs them again.

    Drift is found in the distances of the first pass itself; chunks outside drift keep their place.
    """
    total = loc_turns(spark, sf).select("file_no", "chunk_index", "total")
    c = _best(spark, sf).select("file_no", "chunk_index", "text", "start_idx", "end_idx", "nd").join(total, ["file_no", "chunk_index"])
    c = c.withColumn("hyp", F.filter(F.split("text", " "), lambda w: w != "")).drop("text")
    c = S.hysteresis(S.smooth(c, "nd", "file_no", ["chunk_index"]), "smoothed", "file_no", ["chunk_index"], DEFAULTS.drift_high, DEFAULTS.drift_low)
    c = S.numbered_runs(c, "state", "file_no", ["chunk_index"]).withColumn("run_n", F.count("*").over(Window.partitionBy("file_no", "run")))
    b = S.brackets(c, "file_no", ["chunk_index"], "start_idx", "end_idx", "total").where((F.col("run_n") >= DEFAULTS.drift_min_run)).withColumn("pos", F.col("chunk_index"))
    plan = L.resync_runs(b.select("file_no", "run", "pos", "chunk_index", "hyp", "start_idx", "end_idx", "lo", "hi"), "file_no", refs=loc_refs(spark, sf))
    moved = plan.where("status = 'resynced'").select("file_no", "chunk_index", "new_start", F.lit(True).alias("moved"))
    out = c.join(moved, ["file_no", "chunk_index"], "left")
    start = F.coalesce("new_start", "start_idx").cast("long")
    size = F.when(F.col("moved"), F.greatest(F.col("end_idx") - F.col("start_idx"), F.size("hyp"))).otherwise(F.col("end_idx") - F.col("start_idx"))
    return out.select("file_no", "chunk_index", "hyp", "total", "start_idx", "end_idx", "nd", start.alias("new_start"), F.least(start + size, F.col("total")).cast("long").alias("new_end"), F.coalesce("moved", F.lit(False)).alias("resynced"))


@query("L10_stage_replay")
def l10(spark, sf):
    return replayed(spark, sf).select("file_no", "chunk_index", "start_idx", "end_idx", "nd", "new_start", "new_end", "resynced")


def stages(replay, refs):
    """The reference of each chunk after each stage: found, re-synced, with the words of its gaps, without a weak tail and head.

    refs: file_no, ref; chunks meet it after all that is ordered. A word's confidence is 0.9 where the recogniser said it and 0.1 elsewhere, as an aligner would tell them apart.
    """
    near = Window.partitionBy("file_no").orderBy("chunk_index")
    cut = lambda a, b: F.slice("ref", (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    before, after = F.coalesce(F.lag("new_end").over(near), F.lit(0)), F.coalesce(F.lead("new_start").over(near), F.col("total"))
    r = replay.withColumn("lo", F.greatest(F.least(before, F.col("new_start")), F.col("new_start") - 5)).withColumn("hi", F.least(F.greatest(after, F.col("new_end")), F.col("new_end") + 5))
    r = r.join(refs, "file_no").select("file_no", "chunk_index", "hyp", cut(F.col("start_idx"), F.col("end_idx")).alias("pass1"), cut(F.col("new_start"), F.col("new_end")).alias("resync"), cut(F.col("lo"), F.col("hi")).alias("pass2"))
    score = lambda words: F.transform(words, lambda w: F.when(F.array_contains("hyp", w), 0.9).otherwise(0.1))
    r = C.with_split(r.withColumn("s", score("pass2")), "s", True).withColumn("tailtrim", C.keep_words(F.col("pass2"), F.col("trim"), True)).drop("split", "contrast", "side_mean", "top_half", "trim")
    r = C.with_split(r.withColumn("s", score("tailtrim")), "s", False).withColumn("headtrim", C.keep_words(F.col("tailtrim"), F.col("trim"), False))
    names = ("pass1", "resync", "pass2", "tailtrim", "headtrim")
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("ref")) for n in names])).alias("s")
    return r.select("file_no", "chunk_index", "hyp", each).select("file_no", "chunk_index", "s.stage", "s.ref", "hyp")


@query("A18_replayed_stages")
def a18(spark, sf):
    return R.stage_proxy_wer(stages(replayed(spark, sf), loc_refs(spark, sf)), "file_no")


@query("L9_merged_turns", f"""WITH w AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda x: x <> '') AS ws FROM conversations),
n AS (SELECT *, coalesce(lag(ws) OVER o, []::VARCHAR[]) AS b, coalesce(lead(ws) OVER o, []::VARCHAR[]) AS a FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY turn)),
m AS (SELECT *, b[greatest(len(b) - 1, 1):len(b)] AS h, a[1:2] AS t FROM n)
SELECT conv_id, turn, array_to_string(list_concat(list_concat(h, ws), t), ' ') AS merged, len(h) + len(t) AS second_pass, CASE WHEN len(t) > 0 THEN round(len(ws) * 0.5::DOUBLE, 3) END AS tail_start FROM m""")
def l9(spark, sf):
    """Each turn as a chunk whose gaps hold the last two words of the turn before and the first two of the next."""
    near = Window.partitionBy("conv_id").orderBy("turn")
    none = F.array().cast("array<string>")
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.filter(F.split("text", " "), lambda w: w != "").alias("ws"))
    c = c.withColumn("b", F.coalesce(F.lag("ws").over(near), none)).withColumn("a", F.coalesce(F.lead("ws").over(near), none))
    timed = lambda words: F.transform(words, lambda w, i: F.struct(w.alias("word"), (i * F.lit(0.5)).alias("start"), (i * F.lit(0.5) + 0.4).alias("end"), F.lit(0.9).alias("score"), F.lit(None).cast("int").alias("pass")))
    head = F.slice("b", F.greatest(F.size("b") - 1, F.lit(1)), F.lit(2))
    m = L.merge_gap_words(timed(F.col("ws")), timed(F.slice("a", 1, 2)), timed(head), F.size("ws") * F.lit(0.5))
    c = c.withColumn("m", m).withColumn("n_tail", F.least(F.size("a"), F.lit(2)))
    tail = F.when(F.col("n_tail") > 0, F.get("m", F.size("m") - F.col("n_tail"))["start"])
    return c.select("conv_id", "turn", F.array_join(F.transform("m", lambda w: w["word"]), " ").alias("merged"), F.size(F.filter("m", lambda w: w["pass"] == 2)).cast("long").alias("second_pass"), tail.alias("tail_start"))


@query("A17_unmapped", _ROWS + "SELECT count(*) AS segments, count(*) FILTER (file = 'audio_file_007') AS unmapped FROM eval_rows")
def a17_unmapped(spark, sf):
    rows = D.eval_rows(spark, sf)
    a, b = T.name_times(F.col("audio_filepath"))
    timed = rows.select("file", "seg_index", a.cast("double").alias("a"), b.cast("double").alias("b"))
    chunks = timed.where("file <> 'audio_file_007'").select("file", F.floor(F.col("a") / 30).alias("chunk_index")).distinct()
    chunks = chunks.withColumn("start_s", F.col("chunk_index") * F.lit(30.0)).withColumn("end_s", F.col("start_s") + 28)
    return R.unmapped(rows, J.best_chunk(timed, chunks, "file", "seg_index", ("a", "b"), bucket_s=60.0))


# --- models' slots ---------------------------------------------------------------------------------------------------------


@query("M1_merged_regions", f"""WITH {TIMELINE_SQL}, r AS (SELECT file_no, list({{'s': start_abs, 'e': end_abs}} ORDER BY start_abs, event_id) AS regions FROM timeline GROUP BY file_no),
f AS (SELECT file_no, list_reduce(list_prepend({{'s': regions[1].s, 'e': 0.0::DOUBLE, 'n': 1::BIGINT, 'd': 0.0::DOUBLE}}, list_transform(regions, lambda x: {{'s': x.s, 'e': x.e, 'n': 0::BIGINT, 'd': 0.0::DOUBLE}})),
  lambda a, x: CASE WHEN x.e - a.s > 86400 AND a.e > a.s THEN {{'s': x.s, 'e': x.e, 'n': a.n + 1, 'd': a.d + (a.e - a.s)}} ELSE {{'s': a.s, 'e': x.e, 'n': a.n, 'd': a.d}} END) AS z FROM r)
SELECT file_no, z.n AS chunks, round(z.d + (z.e - z.s), 3) AS covered_s FROM f""")
def m1(spark, sf):
    t = D.timeline(spark, sf).groupBy("file_no").agg(F.array_sort(F.collect_list(F.struct("start_abs", "event_id", "end_abs"))).alias("t"))
    regions = F.transform("t", lambda x: F.struct(x["start_abs"].alias("start"), x["end_abs"].alias("end")))
    c = t.withColumn("c", M.merged_regions(regions, 86_400.0))
    return c.select("file_no", F.size("c").cast("long").alias("chunks"), F.round(F.aggregate("c", F.lit(0.0), lambda a, x: a + (x["end"] - x["start"])), 3).alias("covered_s"))


def _broken_aligner(batch):
    if batch["text"].str.contains("the").any():
        raise RuntimeError("no alignment")
    return M.fake_aligner(batch)


@query("M4_aligned_words", "SELECT conv_id, turn, CASE WHEN contains(text, 'the') THEN 0 ELSE len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) END AS words FROM conversations")
def m4(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "text", F.lit(2.0).alias("duration"))
    return M.align(rows, _broken_aligner).select("conv_id", "turn", F.size("words").cast("long").alias("words"))


# --- files -----------------------------------------------------------------------------------------------------------------

SAMPLES = 160  # of each word, a hundredth of a second


def _tones(spark, sf):
    """16-bit samples for each turn: a word is SAMPLES times its length."""
    word = lambda w: F.repeat(F.lpad(F.hex(F.length(w)), 2, "0"), 1)
    ws = F.filter(F.split("text", " "), lambda w: w != "")
    pcm = F.unhex(F.array_join(F.transform(ws, lambda w: F.repeat(F.concat(word(w), F.lit("00")), SAMPLES)), ""))
    return table(spark, sf, "conversations").select("conv_id", "turn", ws.alias("ws"), pcm.alias("pcm"), F.format_string("%d_%d.wav", "conv_id", "turn").alias("name"))


_WORDS_OF = "w AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda x: x <> '') AS ws FROM conversations)"


@query("SC8_SK6_wav_durations", f"WITH {_WORDS_OF} SELECT conv_id, turn, len(ws) * {SAMPLES} / 16000.0::DOUBLE AS seconds FROM w")
def wav_durations(spark, sf):
    path = folder(spark, "wav")
    A.write_wavs(_tones(spark, sf), path).agg(F.sum("n_samples")).first()  # one row: the files are there
    d = readers.wav_durations(spark, path)
    at = F.split(F.regexp_extract("path", r"(\d+_\d+)\.wav$", 1), "_")
    return d.select(F.get(at, F.lit(0)).cast("long").alias("conv_id"), F.get(at, F.lit(1)).cast("long").alias("turn"), "seconds")


@query("SC7_SC9_wav_samples", f"WITH {_WORDS_OF} SELECT conv_id, turn, len(ws) * {SAMPLES} AS samples, greatest(0, least(len(ws) * {SAMPLES}, 200) - 40) AS ranged FROM w")
def wav_samples(spark, sf):
    path = folder(spark, "wav")
    A.write_wavs(_tones(spark, sf), path).agg(F.sum("n_samples")).first()
    whole = A.samples(readers.wav_files(spark, path)).withColumn("start_sample", F.lit(40)).withColumn("stop_sample", F.lit(200))
    found = readers.wav_ranges(whole.select("path", (F.octet_length("pcm") / 2).cast("long").alias("samples"), "start_sample", "stop_sample"))
    at = F.split(F.regexp_extract("path", r"(\d+_\d+)\.wav$", 1), "_")
    return found.select(F.get(at, F.lit(0)).cast("long").alias("conv_id"), F.get(at, F.lit(1)).cast("long").alias("turn"), "samples", (F.octet_length("pcm") / 2).cast("long").alias("ranged"))


@query("AU3_spliced_audio", f"""WITH {_WORDS_OF}, c AS (SELECT conv_id, turn, ws, coalesce(sum(len(ws)) OVER o, 0) AS first, sum(len(ws)) OVER (PARTITION BY conv_id) AS total FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
x AS (SELECT conv_id, first + i - 1 AS k, ws[i] AS word, turn, total FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM c)),
seg AS (SELECT DISTINCT conv_id, s, least(s + 37, total) AS e FROM (SELECT conv_id, total, unnest(range(0, CAST(total AS BIGINT), 50)) AS s FROM c))
SELECT seg.conv_id, s AS seg_index, count(*) * {SAMPLES} AS samples, count(DISTINCT turn) AS n_chunks, md5(string_agg(repeat(printf('%02X00', length(word)), {SAMPLES}), '' ORDER BY k)) AS digest FROM seg JOIN x ON seg.conv_id = x.conv_id AND k >= s AND k < e GROUP BY ALL""")
def au3(spark, sf):
    """Segments of 37 words, every 50 words of a conversation, out of the audio of its turns."""
    step = SAMPLES / A.RATE
    near = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    c = _tones(spark, sf).withColumn("at", F.coalesce(F.sum(F.size("ws")).over(near), F.lit(0)))
    chunks = c.where(F.size("ws") > 0).select("conv_id", F.col("turn").alias("chunk_index"), (F.col("at") * step).alias("start_s"), ((F.col("at") + F.size("ws")) * step).alias("end_s"), "pcm")
    total = c.groupBy("conv_id").agg(F.sum(F.size("ws")).alias("total"))
    seg = total.select("conv_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("total") - 1, F.lit(0)), F.lit(50).cast("long"))).alias("seg_index"))
    seg = seg.select("conv_id", "seg_index", (F.col("seg_index") * step).alias("start_abs"), (F.least(F.col("seg_index") + 37, F.col("total")) * step).alias("end_abs"))
    out = A.spliced(seg, chunks, "conv_id")
    return out.select("conv_id", "seg_index", (F.octet_length("pcm") / 2).cast("long").alias("samples"), "n_chunks", F.md5(F.hex("pcm").cast("binary")).alias("digest"))


@query("AU4_cut_audio", f"WITH {_WORDS_OF} SELECT conv_id, turn, greatest(0, least(len(ws), 5) - 2) * {SAMPLES} AS samples FROM w")
def au4(spark, sf):
    audio = _tones(spark, sf).select(F.concat_ws("_", "conv_id", "turn").alias("file"), "conv_id", "turn", "pcm")
    spans = audio.select("file", "conv_id", "turn", F.lit(2 * SAMPLES / A.RATE).alias("start_s"), F.lit(5 * SAMPLES / A.RATE).alias("end_s"))
    return A.cut(audio.select("file", "pcm"), spans, "file").select("conv_id", "turn", (F.octet_length("pcm") / 2).cast("long").alias("samples"))


@query("SC1_transcripts", r"SELECT conv_id AS file_no, CAST(sum(len(list_filter(regexp_split_to_array(text, '[ \n]+'), lambda x: x <> ''))) AS BIGINT) AS words FROM conversations GROUP BY conv_id")
def sc1(spark, sf):
    path = folder(spark, "transcripts")
    t = D.transcripts(spark, sf).select(F.format_string("transcript_%d.txt", "file_no").alias("name"), "value")
    sinks.text_documents(t, path).count()
    back = readers.transcripts(spark, path)
    spoken = F.filter(F.split(F.regexp_replace("value", r"(?m)^spk_\w+:$", " "), r"[ \n]+"), lambda w: w != "")
    return back.select(F.col("file_no").cast("long").alias("file_no"), F.size(spoken).cast("long").alias("words"))
