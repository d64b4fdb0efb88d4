"""The corpus operators on hand-made rows."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.functions import edit as E
from wordloom.functions import text as T
from wordloom.functions import windows
from wordloom.operators import audio, evaluate, intervals, localize, models, segments, sequences, splits, trim
from wordloom.operators import experiments as X
from wordloom.operators import reports as R
from wordloom.plans import alignment, files, records
from wordloom.sources import readers, sinks
from wordloom.streaming.sessions import speaker_sessions


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "f,text,want",
    [
        (T.clean_text, "spk_1023: I'll go, my Lords!", "ill go my lords"),
        (T.align_text, "spk_1042: I'll don't go.", "i'll don't go"),
        (T.align_text, "'quoted' rock 'n' roll don''t", "quoted rock n roll don t"),
        (T.score_text, "Hello, WORLD!  it's 12.", "hello world it s 12"),
        (T.speaker_text, "well <noise> it's 'so'", "well it's so"),
        (T.clean_text, "", ""),
    ],
)
def test_normalisers(spark, f, text, want):
    assert one(spark, f(F.col("t")), t=text) == want


def test_word_counts_agree_on_tricky_texts(spark):
    for t in ("spk_1: it's 12 o'clock - now", 'say "yes"\nplease', "a--b, c's", "'tis"):
        assert one(spark, F.size(T.words(T.clean_text(F.col("t")))), t=t) == one(spark, F.size(T.words(T.align_text(F.col("t")))), t=t)


def test_names(spark):
    name = T.chunk_name(F.lit(3), F.lit(12), F.lit(40), F.lit(70))
    assert one(spark, name, a=1) == "audio_file_003_chunk_000012_start000040_end000070.wav"
    a, b = T.name_times(name)
    assert (one(spark, a, x=1), one(spark, b, x=1)) == (40, 70) and one(spark, T.name_times(F.lit("none"))[0], x=1) is None
    assert one(spark, T.hms(F.lit(3661.5)), x=1) == "1:01:02" and one(spark, T.file_stem(F.lit("a/b.c.wav")), x=1) == "b.c"
    assert one(spark, T.options(F.array(F.lit(""), F.lit(None)))[0], x=1) == ""


def test_number_and_plural_words(spark):
    df = spark.createDataFrame([("lakh",), ("b2",), ("on",)], "w string")
    assert [r.n for r in df.select(T.is_number_word(F.col("w")).alias("n")).collect()] == [True, True, False]
    pairs = spark.createDataFrame([("lord", "lords"), ("lords", "lord"), ("lord", "lord"), ("s", "ss")], "r string, h string")
    assert [r.p for r in pairs.select(T.is_plural_pair(F.col("r"), F.col("h")).alias("p")).collect()] == [True, True, False, True]


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_word_distance_and_alignment(spark):
    rng = random.Random(1)
    pairs = [([rng.choice("abcde") for _ in range(rng.randint(0, 9))], [rng.choice("abcde") for _ in range(rng.randint(0, 9))]) for _ in range(60)] + [(["é", "漢字"], ["é"])]
    df = spark.createDataFrame(pairs, "ref array<string>, hyp array<string>")
    rows = df.select("*", E.word_distance(F.col("ref"), F.col("hyp")).alias("d"), E.word_ops(F.col("ref"), F.col("hyp")).alias("o")).collect()
    for r in rows:
        n = {k: sum(x.op == k for x in r.o) for k in ("equal", "substitute", "delete", "insert")}
        assert r.d == plain_distance(r.ref, r.hyp) == n["substitute"] + n["delete"] + n["insert"]
        assert n["equal"] + n["substitute"] + n["delete"] == len(r.ref) and n["equal"] + n["substitute"] + n["insert"] == len(r.hyp)
        assert [x.ref for x in r.o if x.ref is not None] == list(r.ref) and [x.hyp for x in r.o if x.hyp is not None] == list(r.hyp)


def test_corpus_and_mean_wer(spark):
    rows = spark.createDataFrame([(list("abcd"), list("abcx")), (["z"], ["q"]), ([], ["a"])], "ref array<string>, hyp array<string>")
    r = evaluate.corpus_wer(rows).first()
    assert (r.corpus_wer, r.mean_utt_wer, r.n_scored, r.n_empty_ref) == (2 / 5, 0.625, 2, 1)


def test_thresholds(spark):
    rows = spark.createDataFrame([("f", "s", ["a"], ["b"], None), ("f", "s", ["a"], ["a"], 0.4), ("f", "t", ["a"], ["b"], 0.39)], "file string, speaker string, ref array<string>, hyp array<string>, avg_score double")
    got = {(r.file, r.speaker): (r.segs_0_0, r.wer_0_0, r.segs_0_4, r.wer_0_4) for r in evaluate.speaker_wer_at(rows, (0.0, 0.4)).collect()}
    assert got == {("f", "s"): (2, 0.5, 1, 0.0), ("f", "t"): (1, 1.0, 0, None), ("OVERALL", None): (3, 2 / 3, 1, 0.0)}


def words(spark, rows):
    return spark.createDataFrame(rows, "file_no long, event_id long, speaker string, start_abs double, end_abs double, score double, word string")


def test_segments_at_the_limits(spark):
    w = words(spark, [(1, 0, "a", 0.0, 0.5, None, "x"), (1, 1, "a", 1.0, 1.5, 0.5, "y"), (1, 2, "a", 2.01, 2.2, 0.5, "z"), (1, 3, "b", 2.3, 3.3, 0.7, "u"), (1, 4, "a", 3.3, 4.2, 0.9, "v")])
    got = [(r.seg_index, r.speaker, r.start_abs, r.end_abs, list(r.words), r.scored_words) for r in sequences.speaker_segments(w).orderBy("seg_index").collect()]
    assert got == [(0, "a", 0.0, 1.5, ["x", "y"], 1), (1, "b", 2.3, 3.3, ["u"], 1)]  # a pause of 0.5 joins, 1.0 s is kept, 0.9 s goes


def test_hysteresis_equals_a_state_machine(spark):
    rng = random.Random(2)
    values = [rng.choice([0.3, 0.45, 0.5, 0.55, 0.7, None]) for _ in range(200)]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "f int, i int, v double")
    got = [r.state for r in sequences.hysteresis(df, "v", "f", ["i"], 0.55, 0.45).orderBy("i").collect()]
    state, want = "low", []
    for v in values:
        if v is not None and v >= 0.55:
            state = "high"
        elif v is not None and v <= 0.45:
            state = "low"
        want.append(state)
    assert got == want


def test_chunk_choice(spark):
    chunks = spark.createDataFrame([(1, 1, 0.0, 10.0), (1, 2, 10.0, 20.0), (1, 3, 30.0, 40.0)], "f int, chunk_index int, start_s double, end_s double")
    segs = spark.createDataFrame([(1, 0, 5.0, 15.0), (1, 1, 20.0, 24.0), (1, 2, 10.0, 11.0)], "f int, k int, a double, b double")
    assert {r.k: (r.chunk_index, r.overlap) for r in intervals.best_chunk(segs, chunks, "f", "k", ("a", "b")).collect()} == {0: (1, 5.0), 1: (2, 0.0), 2: (2, 1.0)}
    for bucket in (600.0, 7.0):
        laps = {(r.k, r.chunk_index) for r in intervals.overlaps(segs, chunks, "f", ("a", "b"), ("start_s", "end_s"), bucket).collect()}
        assert laps == {(0, 1), (0, 2), (2, 2)}
    points = spark.createDataFrame([(1, 0, 10.0), (1, 1, 27.0)], "f int, k int, t double")
    assert {r.k: r.chunk_index for r in intervals.chunk_of_point(points, chunks, "f", "k", "t").collect()} == {0: 1, 1: 3}


def test_chunk_choice_equals_all_pairs(spark):
    rng = random.Random(9)
    chunks = [(f, i, float(a), float(a + rng.randint(1, 40))) for f in (1, 2) for i, a in enumerate(rng.sample(range(900), 14))]
    segs = [(f, k, float(a), float(a + rng.randint(0, 30))) for f in (1, 2, 3) for k, a in enumerate(rng.sample(range(1000), 40))]
    c = spark.createDataFrame(chunks, "f int, chunk_index int, start_s double, end_s double")
    s = spark.createDataFrame(segs, "f int, k int, a double, b double")
    for bucket in (13.0, 600.0):
        got = {(r.f, r.k): (r.chunk_index, r.overlap) for r in intervals.best_chunk(s, c, "f", "k", ("a", "b"), bucket_s=bucket).collect()}
        held = {(r.f, r.k): r.chunk_index for r in intervals.chunk_of_point(s, c, "f", "k", "a", bucket_s=bucket).collect()}
        want, points = {}, {}
        for f, k, a, b in segs:
            mine = [(i, x, y) for g, i, x, y in chunks if g == f]
            if mine:
                laps = sorted((-(min(b, y) - max(a, x)), i) for i, x, y in mine if min(b, y) - max(a, x) > 0)
                want[f, k] = (laps[0][1], -laps[0][0]) if laps else (min((abs((x + y) / 2 - (a + b) / 2), i) for i, x, y in mine)[1], 0.0)
                inside = [i for i, x, y in mine if x <= a <= y]
                points[f, k] = min(inside) if inside else min((min(abs(a - x), abs(a - y)), i) for i, x, y in mine)[1]
        assert got == want and held == points


def test_silence(spark):
    regions = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0.0, 1.0), (1.5, 2.0), (3.0, 4.0))])
    plan = [(x.start, x.end) for x in one(spark, intervals.silence_plan(F.lit(5.0), regions, 0.8), a=1)]
    assert plan == [(2.0, 3.0), (4.0, 5.0)]
    none = F.array().cast("array<struct<start:double,end:double>>")
    assert one(spark, intervals.silence_plan(F.lit(5.0), none, 0.8), a=1) == []
    samples = np.ones(50, np.float32)
    assert audio.silence(samples, plan, 10).sum() == 30 and audio.pad(samples, 0.5, 10).shape == (60,)
    assert audio.splice([(samples, 5.0), (samples * 2, 0.0)], 4.0, 6.0, 10).tolist() == [2.0] * 10 + [1.0] * 10


def test_wav_round_trip(spark, tmp_path):
    samples = (np.arange(-8000, 8000) / 16000).astype(np.float32)
    raw = audio.write_wav(samples)
    assert np.abs(audio.read_wav(raw) - samples).max() < 1e-4 and len(audio.read_wav(raw, start=10, stop=20)) == 10
    (tmp_path / "a.wav").write_bytes(raw)
    assert readers.wav_durations(spark, str(tmp_path)).first().seconds == 1.0
    with pytest.raises(ValueError):
        audio.read_wav(audio.write_wav(samples, 8000))


def test_window_match_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(25):
        ref = [rng.choice(["aa", "ab", "ba", "c", "dd"]) for _ in range(rng.randint(1, 30))]
        at = rng.randrange(len(ref))
        hyp = [w for w in ref[at : at + 6] if rng.random() > 0.2]
        rows.append((i, ref, hyp, max(0, at + rng.randint(-4, 4)), rng.choice([0, 3, 6, 40])))
    df = spark.createDataFrame(rows, "i int, ref array<string>, hyp array<string>, expected int, n int")
    got = {r.i: (r.start_idx, r.end_idx, r.nd) for r in localize.with_match(df, "ref", "hyp", "expected", "n", back=5, forward=7).collect()}
    for i, ref, hyp, expected, n in rows:
        if n <= 0:
            assert got[i] == (expected, expected, 1.0)
            continue
        lo = max(0, expected - 5)
        hi = max(min(len(ref) - n + 1, expected + 7), lo + 1)
        width, said = min(n, len(ref) - lo), " ".join(hyp)
        d, p = min((plain_distance(said, " ".join(ref[p : p + width])), p) for p in range(lo, hi))
        end = min(p + width, len(ref))
        assert got[i] == (p, end, round(d / max(len(said), len(" ".join(ref[p:end])), 1), 4))


def test_vote_prefers_the_longest_and_the_first(spark):
    ref = "x a b c y a b c d e z".split()
    df = spark.createDataFrame([(1, 7, "a b c".split(), ref), (1, 8, "a b c d e".split(), ref)], "f int, c int, hyp array<string>, ref array<string>")
    votes = localize.gram_votes(df, df.select("f", "ref").limit(1), "f", "c", "hyp", "ref")
    got = {r.c: (r.start, r.n_used) for r in localize.vote_start(votes, ["f", "c"]).collect()}
    assert got == {7: (1, 3), 8: (5, 5)}


def test_resync_moves_the_lower_bound(spark):
    ref = [f"w{i}" for i in range(60)]
    rows = [(1, 1, k, k, ref[k * 10 : k * 10 + 8], ref, 50, 58, 0, 60) for k in range(3)] + [(1, 2, 9, 9, ["q"] * 5, ref, 0, 5, 0, 60)]
    df = spark.createDataFrame(rows, "f long, run long, pos long, chunk_index long, hyp array<string>, ref array<string>, start_idx long, end_idx long, lo long, hi long")
    got = {r.chunk_index: (r.new_start, r.status) for r in localize.resync_runs(df, "f").collect()}
    assert got == {0: (0, "resynced"), 1: (10, "resynced"), 2: (20, "resynced"), 9: (0, "failed_no_vote")}


def test_trims(spark):
    good, bad = [0.9] * 10, [0.1] * 6
    df = spark.createDataFrame([(0, good + bad), (1, bad + good), (2, good), (3, [0.9] * 4), (4, [])], "i int, s array<double>")
    tail = {r.i: r.trim for r in trim.with_split(df, "s", True).collect()}
    head = {r.i: r.trim for r in trim.with_split(df, "s", False).collect()}
    assert tail == {0: 10, 1: None, 2: None, 3: None, 4: None} and head == {0: None, 1: 6, 2: None, 3: None, 4: None}


def test_speaker_map(spark):
    text = "lost words\nspk_1:\nHello <noise> there\n\nit's me\nspk_2:\nspk_1:\nbye"
    got = [(r.ref_word_idx, r.speaker_id, r.word) for r in segments.speaker_map(spark.createDataFrame([(1, text)], "file_no int, value string")).orderBy("ref_word_idx").collect()]
    assert got == [(0, "spk_1", "hello"), (1, "spk_1", "there"), (2, "spk_1", "it's"), (3, "spk_1", "me"), (4, "spk_1", "bye")]


def test_labels_round_trip(spark):
    w = spark.createDataFrame([("a", 0.0, 1.0, 0.5), ("b", None, 1.0, 0.5), ("c", 1.25, 2.0, None)], "word string, start double, end double, score double")
    lines = sinks.label_lines(w)
    assert [r.value for r in lines.collect()] == ["0.000\t1.000\ta (0.500)", "1.250\t2.000\tc"]
    assert [(r.word, r.start, r.score) for r in readers.labels(lines).collect()] == [("a", 0.0, 0.5), ("c", 1.25, None)]
    odd = spark.createDataFrame([("-1.0\t2.0\tx",), ("text",)], "value string")
    assert readers.labels(odd).count() == 0 and readers.label_words(odd).count() == 1


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("a", "dev", 3600.0, "s1", 1), ("b", "train", 1800.0, "s2", 2)], "audio_filepath string, split string, duration double, speaker string, n int")
    sinks.dataset(rows, f"{tmp_path}/d")
    assert {r.split for r in spark.read.parquet(f"{tmp_path}/d").select("split").collect()} == {"validation", "train"}
    assert "| dev | 1 | 1.00 | 1 |" in sinks.dataset_card(rows, "corpus")
    side = sinks.wer_sidecar(rows, spark.createDataFrame([("a", 0.126)], "audio_filepath string, wer double"))
    assert {(r.audio, r.segment_wer) for r in side.collect()} == {("a", 0.13), ("b", None)}
    made = []
    make = lambda: made.append(1) or rows
    assert readers.cached(spark, f"{tmp_path}/c", 2, make).count() == readers.cached(spark, f"{tmp_path}/c", 2, make).count() == 2 and len(made) == 1
    (tmp_path / "a.json").write_text('{"spk_1": {"split": "dev", "duration_s": 1.0, "segments": 2}}')
    (tmp_path / "b.json").write_text('{"dev": ["spk_2"], "test": ["spk_3"]}')
    assert {(r.speaker, r.split) for n in "ab" for r in readers.assignment(spark, f"{tmp_path}/{n}.json").collect()} == {("spk_1", "dev"), ("spk_2", "dev"), ("spk_3", "test")}
    assert readers.file_ids(["2", "002", "audio_file_004", "6-8"]) == [2, 4, 6, 7, 8]


def test_splits_and_experiments(spark):
    rows = spark.createDataFrame([("f1", "s1", 0.4, 1.0), ("f1", "s2", 0.39, 1.0), ("f1", "s3", None, 1.0), ("f2", "s1", 0.9, 1.0), ("f1", "s9", 0.9, 2.0)], "file string, speaker string, avg_score double, duration double")
    kept = splits.with_split(splits.usable(rows, 0.4, ("f2",)), spark.createDataFrame([("s1", "dev")], "speaker string, split string"))
    assert {(r.speaker, r.split) for r in kept.collect()} == {("s1", "dev"), ("s9", "train")} and splits.unknown_speakers(kept).first().segments == 1
    assert splits.shuffled_like_python([1, 2, 3, 4], 42) == splits.shuffled_like_python([1, 2, 3, 4], 42)
    h = {r.bin: r.segs for r in R.confidence_histogram(rows).collect()}
    assert (h[4], h[3], h[9], sum(h.values())) == (1, 1, 2, 4)
    e = spark.createDataFrame([("a", 0, "m", None, "g", 0.5), ("b", 1, "m", None, "h", 0.25), ("c", 2, "m", None, "g", None)], "experiment string, position int, manifest_md5 string, normalizer string, gpu string, corpus_wer double")
    r = X.comparability(e, ("manifest_md5", "normalizer", "gpu")).first()
    assert (r.wer_comparable, r.time_comparable) == (True, False)
    assert [(x.experiment, x["rank"], x.delta) for x in X.ranked(e, "a").orderBy("position").collect()] == [("a", 2, 0.0), ("b", 1, -0.25), ("c", None, None)]
    with pytest.raises(LookupError):
        X.require(e, ["a", "nope"])


def test_model_slots(spark):
    rows = spark.createDataFrame([("one two three four five six", 6.0), (None, None)], "text string, duration double")
    heard = models.transcribe(rows, models.fake_transcriber)
    assert [r.hyp for r in heard.collect()] == ["one two three four six", ""]
    assert len(models.align(rows, models.fake_aligner).first().words) == 6


def test_stream_sessions(spark, tmp_path):
    from datetime import datetime, timedelta

    t = datetime(2024, 1, 1)
    rows = [(1, "a", t + timedelta(hours=h), 0.5) for h in (0, 1, 20, 21)]
    df = spark.createDataFrame(rows, "file_no long, speaker string, ts timestamp, score double")
    df.write.parquet(f"{tmp_path}/in")
    want = {(r.start, r.words) for r in speaker_sessions(df).collect()}
    q = speaker_sessions(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")).writeStream.outputMode("complete").format("memory").queryName("sessions").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {(r.start, r.words) for r in spark.table("sessions").collect()} == want and len(want) == 2


def test_anchor_bonus_equals_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for i in range(12):
        ref = [rng.choice("abcdef") for _ in range(30)]
        at = rng.randrange(20)
        rows.append((i, ref, [w if rng.random() > 0.15 else "z" for w in ref[at : at + 9]], at + rng.randint(-2, 2), 9))
    df = spark.createDataFrame(rows, "i int, ref array<string>, hyp array<string>, expected int, n int").withColumn("expected", F.greatest("expected", F.lit(0)))
    found = df.join(localize.anchors(df, ["i"], "ref", "hyp", "expected", "n", 4, 4), "i", "left")
    got = {r.i: (r.start_idx, r.effective) for r in localize.scored_match(found, "ref", "hyp", "expected", "n", anchor="anchors", anchor_weight=2.0, back=4, forward=4).collect()}
    for i, ref, hyp, expected, n in rows:
        lo = max(0, max(expected, 0) - 4)
        hi = max(min(len(ref) - n + 1, max(expected, 0) + 4), lo + 1)
        region, width = ref[lo : min(hi + n + 6, len(ref))], min(n, len(ref) - lo)
        grams = [tuple(region[a : a + k]) for k in range(3, 7) for a in range(len(region) - k + 1)]
        usable = sorted({(-len(g), next(x for x in range(len(hyp)) if tuple(hyp[x : x + len(g)]) == g), g) for g in set(grams) if grams.count(g) == 1 and any(tuple(hyp[x : x + len(g)]) == g for x in range(len(hyp)))})
        best = None
        for p in range(lo, hi):
            window, used, bonus = ref[p : p + width], set(), 0
            for minus, h, g in usable:
                k = -minus
                at = next((x for x in range(len(window) - k + 1) if tuple(window[x : x + k]) == g), None)
                if at is None or used & set(range(h, h + k)) or abs(h / max(len(hyp) - k, 1) - at / max(width - k, 1)) > 0.25:
                    continue
                bonus += k
                used |= set(range(h, h + k))
            e = plain_distance(" ".join(hyp), " ".join(window)) - min(2.0 * bonus, 60.0)
            best = min(best or (e, p), (e, p))
        assert got[i] == (best[1], best[0])


def test_registered_searches_reach_600_back_and_200_forward(spark, tmp_path):
    """A conversation that says its first turn again 45 words later: each search against brute force over the whole reach."""
    rng = random.Random(3)
    said = [[rng.choice("bcdfgklmn") + rng.choice("aeiou") + rng.choice("rstvz") for _ in range(n)] for n in (15, 30, 12)]
    turns = [said[0], said[1], said[0], said[2]]
    spark.createDataFrame([(1, t, "user", " ".join(w)) for t, w in enumerate(turns)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    ref = [w for t in turns for w in t]
    run = lambda name: {r.chunk_index: r for r in alignment.QUERIES[name](spark, str(tmp_path)).collect()}
    plain, penalised, bounded, anchored, best, replay = (run(q) for q in ("L2_window_match", "L2a_overlap_penalty", "L2b_boundary_penalty", "L2c_anchor_bonus", "L4_best_option", "L10_replay"))
    deltas, winners = [], []
    for c, words in enumerate(turns, 1):
        expected, n = sum(map(len, turns[: c - 1])), len(words)
        places = range(max(0, expected - 600), max(min(len(ref) - n + 1, expected + 200), max(0, expected - 600) + 1))
        away = lambda h, p: plain_distance(" ".join(h), " ".join(ref[p : p + n]))  # noqa: B023, E731
        share = lambda h, p: away(h, p) / max(len(" ".join(h)), len(" ".join(ref[p : p + n])), 1)  # noqa: B023, E731
        ends = lambda a, b: plain_distance(" ".join(a), " ".join(b)) / max(len(" ".join(a)), len(" ".join(b)), 1)
        hyp = [w + "s" * (i % 11 == 5) for i, w in enumerate(words, 1) if i % 7 != 3]
        d, p = min((away(hyp, p), p) for p in places)
        assert (plain[c].start_idx, plain[c].end_idx, plain[c].nd) == (p, p + n, round(share(hyp, p), 4))
        e, p = min((away(hyp, p) + max(0, expected + 2 - p) * 40.0, p) for p in places)
        assert (penalised[c].start_idx, penalised[c].effective) == (p, e)
        k = min(10, len(hyp) // 3)
        e, p = min((round(away(hyp, p) + (ends(hyp[:k], ref[p : p + k]) + ends(hyp[-k:], ref[p + n - k : p + n])) / 2 * len(" ".join(hyp)) * 0.5, 6), p) for p in places)
        assert (bounded[c].start_idx, bounded[c].effective) == (p, e)
        grams = [tuple(ref[a : a + m]) for m in range(3, 7) for a in range(len(ref) - m + 1)]
        usable = sorted((-m, h, ref_at) for m in range(3, 7) for h in range(len(hyp) - m + 1) for ref_at in range(len(ref) - m + 1) if ref[ref_at : ref_at + m] == hyp[h : h + m] and grams.count(tuple(hyp[h : h + m])) == 1)

        def bonus(p):
            used, total = set(), 0
            for minus, h, g in usable:  # noqa: B023
                m = -minus
                if p <= g and g + m <= p + n and not used & set(range(h, h + m)) and abs(h / max(len(hyp) - m, 1) - (g - p) / max(n - m, 1)) <= 0.25:  # noqa: B023
                    total += m
                    used |= set(range(h, h + m))
            return min(2.0 * total, 60.0)

        e, p = min((away(hyp, p) - bonus(p), p) for p in places)
        assert (anchored[c].start_idx, anchored[c].effective) == (p, e)
        options = [w for i, w in enumerate(words, 1) if i % 7 != 3], [w + "xxx" * (i % 5 == 2 and c % 2 == 0) for i, w in enumerate(words, 1)]
        found = [min((away(h, p), p) for p in places)[1] for h in options]
        nds = [round(share(h, p), 4) for h, p in zip(options, found, strict=True)]
        won = int(nds[1] <= nds[0])
        assert (best[c].option, best[c].start_idx, best[c].nd) == (won, found[won], nds[won]) and replay[c].first_start == found[won]
        deltas.append(nds[0] - nds[1])
        options = list(dict.fromkeys(" ".join(o) for o in options))
        winners.append("single_option" if len(options) == 1 else "second" if won else "first")
    assert plain[3].start_idx == best[3].start_idx == 0 and penalised[1].start_idx == 45
    counted = {(r.winner, r.chunks) for r in records.QUERIES["L11_chunk_winners"](spark, str(tmp_path)).collect()}
    assert counted == set(collections.Counter(winners).items())
    won = alignment.QUERIES["A19_winner_counts"](spark, str(tmp_path)).collect()
    assert [(r.chunks, r.second_wins) for r in won] == [(4, sum(x >= 0 for x in deltas))] and won[0].mean_delta == pytest.approx(sum(deltas) / 4)


def test_replay_and_stages_equal_a_plain_version(spark, tmp_path):
    """Two conversations, one that says a passage twice, so that its later chunks drift; each stage by lists."""
    rng = random.Random(21)
    word = lambda: rng.choice("bcdfgklmn") + rng.choice("aeiou") + rng.choice("rstvz") + rng.choice("aeiou")
    turns = {f: [[word() for _ in range(rng.randint(8, 20))] for _ in range(9)] for f in (1, 2)}
    turns[1][5] = turns[1][1]
    rows = [(f, t, "user", " ".join(w)) for f, x in turns.items() for t, w in enumerate(x)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    replay = records.replayed(spark, str(tmp_path))
    got = {(r.file_no, r.chunk_index): r for r in replay.collect()}
    best = {(r.file_no, r.chunk_index): r for r in alignment.QUERIES["L4_best_option"](spark, str(tmp_path)).collect()}
    assert set(got) == set(best) and all((got[k].start_idx, got[k].end_idx, got[k].nd) == (best[k].start_idx, best[k].end_idx, best[k].nd) for k in got)
    for f in turns:
        order = sorted(k for k in got if k[0] == f)
        near = [got[k].nd for k in order]
        smooth = [sum(near[max(0, i - 1) : i + 2]) / len(near[max(0, i - 1) : i + 2]) for i in range(len(near))]
        state, states = "low", []
        for x in smooth:
            state = "high" if x >= 0.55 else "low" if x <= 0.45 else state
            states.append(state)
        drifting = {i for i in range(len(order)) if states[i] == "high" and (states[i - 1 : i] == ["high"] or states[i + 1 : i + 2] == ["high"])}
        for i, k in enumerate(order):
            r = got[k]
            if i not in drifting:
                assert not r.resynced
            if not r.resynced:
                assert (r.new_start, r.new_end) == (r.start_idx, r.end_idx)
    ref = {f: [w for t in x for w in t] for f, x in turns.items()}
    want = collections.defaultdict(lambda: [0, 0])
    for f in turns:
        order = sorted(k for k in got if k[0] == f)
        for i, k in enumerate(order):
            r = got[k]
            before, after = (got[order[i - 1]].new_end if i else 0), (got[order[i + 1]].new_start if i + 1 < len(order) else len(ref[f]))
            lo, hi = max(min(before, r.new_start), r.new_start - 5), min(max(after, r.new_end), r.new_end + 5)
            stage = {"pass1": ref[f][r.start_idx : r.end_idx], "resync": ref[f][r.new_start : r.new_end], "pass2": ref[f][lo:hi]}
            stage["tailtrim"] = plain_trim(stage["pass2"], set(r.hyp), True)
            stage["headtrim"] = plain_trim(stage["tailtrim"], set(r.hyp), False)
            for name, words in stage.items():
                ids = {w: chr(256 + n) for n, w in enumerate(dict.fromkeys([*words, *r.hyp]))}
                for key in ((f, name), (None, name)):
                    want[key][0] += plain_distance("".join(map(ids.get, words)), "".join(map(ids.get, r.hyp)))
                    want[key][1] += len(r.hyp)
    found = {(r.file_no, r.stage): [r.edits, r.asr_words] for r in records.QUERIES["A18_replayed_stages"](spark, str(tmp_path)).collect()}
    assert found == dict(want)


def plain_trim(words, heard, tail):
    scores, best = [0.9 if w in heard else 0.1 for w in words], None
    n = len(scores)
    for i in range(5, n - 4):
        left, right = sum(scores[:i]) / i, sum(scores[i:]) / (n - i)
        contrast, side = (left - right, right) if tail else (right - left, left)
        if best is None or contrast > best[0] + 1e-12:
            best = contrast, side, i
    top = sorted(scores, reverse=True)[: max(1, n // 2)]
    mean = sum(top) / len(top) if top else 0
    if best and n >= 10 and mean >= 0.5 and best[0] > 0.3 and best[1] < min(0.35, 0.45 * mean):
        return words[: best[2]] if tail else words[best[2] :]
    return words


def test_audio_frames(spark, tmp_path):
    chunks = [(1, 0, 0.0, 1.0), (1, 1, 1.5, 2.0), (2, 0, 0.0, 0.5)]
    pcm = {(f, i): (np.arange(round((e - s) * 10)) + 100 * i + 1000 * f).astype("<i2") for f, i, s, e in chunks}
    c = spark.createDataFrame([(*x, bytearray(pcm[x[:2]].tobytes())) for x in chunks], "file_no int, chunk_index int, start_s double, end_s double, pcm binary")
    s = spark.createDataFrame([(1, 0, 0.5, 1.7), (1, 1, 1.1, 1.4), (2, 0, 0.0, 9.0)], "file_no int, seg_index int, start_abs double, end_abs double")
    got = {(r.file_no, r.seg_index): np.frombuffer(bytes(r.pcm), "<i2").tolist() for r in audio.spliced(s, c, rate=10).collect()}
    assert got == {(1, 0): [1005, 1006, 1007, 1008, 1009, 1100, 1101], (2, 0): [2000, 2001, 2002, 2003, 2004]}
    spans = spark.createDataFrame([(2, 0.1, 0.3), (2, 0.4, 9.0)], "file_no int, start_s double, end_s double")
    assert sorted(np.frombuffer(bytes(r.pcm), "<i2").tolist() for r in audio.cut(c.where("file_no = 2").select("file_no", "pcm"), spans, "file_no", rate=10).collect()) == [[2001, 2002], [2004]]
    plan = c.where("file_no = 2").withColumn("plan", F.array(F.struct(F.lit(0.1).alias("start"), F.lit(0.3).alias("end"))))
    assert np.frombuffer(bytes(audio.masked(plan, rate=10).first().pcm), "<i2").tolist() == [2000, 0, 0, 2003, 2004]
    raw = audio.write_wav(np.zeros(16000, np.float32))
    listed = raw[:36] + b"LIST" + (8).to_bytes(4, "little") + b"datadata" + raw[36:]  # a chunk that holds the name of another
    assert len(audio.read_wav(listed)) == 16000
    (tmp_path / "b.wav").write_bytes(raw[:36] + b"LIST" + (9000).to_bytes(4, "little") + b"x" * 9000 + raw[36:])
    assert readers.wav_durations(spark, f"file://{tmp_path}").first().seconds == 1.0
    with pytest.raises(ValueError):
        readers.wav_layout(b"RIFF0000WAVEdata" + b"\0" * 8)


def test_merged_regions_and_failing_aligner(spark):
    regions = lambda *x: F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in x])
    merged = lambda *x: [(r.start, r.end) for r in one(spark, models.merged_regions(regions(*x), 10.0), a=1)]
    assert merged((0.0, 3.0), (4.0, 9.0), (9.5, 12.0), (30.0, 50.0), (51.0, 52.0)) == [(0.0, 9.0), (9.5, 12.0), (30.0, 50.0), (51.0, 52.0)]
    none = F.array().cast("array<struct<start:double,end:double>>")
    assert one(spark, models.merged_regions(none), a=1) == []

    def broken(batch):
        if (batch["text"] == "bad").any():
            raise RuntimeError("no")
        return models.fake_aligner(batch)

    rows = spark.createDataFrame([(1, "a b", 1.0), (2, "bad", 1.0), (3, "c", 1.0)], "i int, text string, duration double").coalesce(1)
    assert {r.i: len(r.words) for r in models.align(rows, broken).collect()} == {1: 2, 2: 0, 3: 1}


def test_comparison_of_experiments(spark, tmp_path):
    e = spark.createDataFrame([("a", 0, "m", "v", 0.4, True, "g1", 0.3), ("b", 1, "m", "v", None, True, "g2", 0.2), ("c", 2, "other", "v", None, True, "g2", None)], "experiment string, position int, manifest_md5 string, normalizer string, conf_filter_threshold double, padded boolean, gpu string, corpus_wer double")
    r = spark.createDataFrame([("a", "f", "s", 0.5, 10), ("b", "f", "s", 0.25, 10), ("b", "f", "t", 0.1, 4)], "experiment string, file string, speaker string, corpus_wer double, ref_words int")
    found = X.compare(e, r, ["b"], baseline="a")
    assert found.names == ["a", "b"] and {(x.file, x.speaker, x.delta_b) for x in found.speakers.collect()} == {("f", "s", -0.25), ("f", "t", None)}
    assert X.compare(e, r, ["a", "c"]).speakers is None
    record = X.comparison_record(found, "cmp", "now", command=X.reproduce_command(["python", "-m", "x"], {"exps": ["a", "b c"], "dry_run": True, "none": None}))
    assert [x["experiment"] for x in record["rows"]] == ["b", "a"] and record["reproduce_command"] == "python -m x --exps a 'b c' --dry-run"
    assert "-10.00" in X.comparison_summary(record) and set(record["git"]) >= {"commit", "dirty"}
    with pytest.raises(LookupError):
        X.compare(e, r, ["zz"])
    (tmp_path / "a.metadata.json").write_text('{"experiment": "a", "corpus_wer": 0.5}')
    stored = X.stored_experiments(spark, f"file://{tmp_path}", ["a"], "experiment string, corpus_wer double").first()
    assert stored.corpus_wer == 0.5 and len(stored.metadata_md5) == 32
    with pytest.raises(LookupError):
        X.stored_experiments(spark, f"file://{tmp_path}", ["a", "b"], "experiment string")
    assert {"python", "spark", "platform"} <= set(X.fingerprint())
    n = spark.createDataFrame([("a", 0, 5, 8, 2), ("b", 1, 5, 9, 0)], "experiment string, position int, total_segments int, ref_num_total int, wrong_num int")
    assert {(x.experiment, x.wrong_pct, x.differs) for x in X.number_consistency(n).collect()} == {("a", 25.0, False), ("b", 0.0, True)}


def test_alignment_of_long_pairs_is_the_same_and_small(spark, monkeypatch):
    rng = random.Random(8)
    for _ in range(60):
        ref, hyp = ([rng.choice("abc") for _ in range(rng.randint(0, 40))] for _ in range(2))
        monkeypatch.setattr(E, "SMALL", 4096)
        small = E.align_words(ref, hyp)
        monkeypatch.setattr(E, "SMALL", 0)
        assert E.align_words(ref, hyp) == small
        assert sum(o[0] != "equal" for o in small) == plain_distance("".join(ref), "".join(hyp))
    import tracemalloc

    ref, hyp = ([str(rng.randint(0, 3000)) for _ in range(6000)] for _ in range(2))
    tracemalloc.start()
    E.align_words(ref, hyp)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_window_search_is_exact_and_computes_few_distances():
    rng = random.Random(31)
    for _ in range(150):
        words = [rng.choice(["aa", "ab", "ba", "c", "dd", "é"]) for _ in range(rng.randint(1, 40))]
        width = rng.randint(0, len(words))
        count = rng.randint(1, len(words) - width + 1)
        at, first = rng.randrange(count), rng.randrange(count)
        w = windows.Windows(" ".join(x for x in words[at : at + width] if rng.random() > 0.2), words, width, count)
        extra = [rng.choice([0, 0.5, 3.0, -2.0]) for _ in range(count)]
        away = [plain_distance(w.said, w.text(i)) for i in range(count)]
        places = np.array(sorted(rng.sample(range(count), rng.randint(1, count))))
        assert (w.bounds() <= away).all() and all(e <= away[i] for e, i in zip(w.ends(places), places, strict=True))
        assert w.best(first) == min((d, i) for i, d in enumerate(away))
        assert w.best(first, np.minimum(extra, 1.0), extra.__getitem__) == min((d + extra[i], i) for i, d in enumerate(away))
    text = [rng.choice("bcdfglmn") + rng.choice("aeiou") + rng.choice("rstvz") for _ in range(900)]
    w = windows.Windows(" ".join(x for i, x in enumerate(text[600:680]) if i % 7 != 2), text, 80, 800)
    best = w.best(600)
    assert len(w.known) < 20  # of 800
    assert best == min((windows.char_distance(w.said, w.text(i)), i) for i in range(800))


def test_whole_texts_are_neither_broadcast_nor_sorted(spark, tmp_path):
    """N-grams of a text were joined with a broadcast, and texts went through windows with each of their chunks."""
    rows = [(f, t, "user", f"aa bb{t} cc dd{f} ee ff gg{t}") for f in range(3) for t in range(5)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for name in ("J10_gram_votes", "L5_vote_start", "L1_unique_ngrams", "W15_first_positions"):
        plan = alignment.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "first(ref" not in plan
    assert "ref" not in alignment.drifted(spark, str(tmp_path)).columns and "ref" not in records.replayed(spark, str(tmp_path)).columns


def test_votes_equal_a_plain_version(spark):
    rng = random.Random(12)
    refs = [(f, [rng.choice("abc") for _ in range(n)]) for f, n in ((1, 40), (2, 3), (3, 0))]
    chunks = [(f, c, [rng.choice("abcx") for _ in range(rng.randint(0, 9))]) for f in (1, 2, 3, 4) for c in range(4)]
    c, r = spark.createDataFrame(chunks, "f int, c int, hyp array<string>"), spark.createDataFrame(refs, "f int, ref array<string>")
    got = collections.Counter((v.f, v.c, v.n, v.start, round(float(v.weight), 9), v.j, v.p) for v in localize.gram_votes(c, r, "f", "c", "hyp", "ref").collect())
    want = collections.Counter()
    for f, k, hyp in chunks:
        ref = dict(refs).get(f, [])
        for n in (3, 4, 5):
            for j in range(len(hyp) - n + 1):
                places = [p for p in range(len(ref) - n + 1) if ref[p : p + n] == hyp[j : j + n]]
                want.update((f, k, n, p - j, round(1 / len(places), 9), j, p) for p in places)
    assert got == want


def test_batches_are_aligned_as_single_pairs_are():
    import pyarrow as pa

    rng = random.Random(4)
    for most, alphabet in ((9, "abcde"), (0, "a"), (130, "abcdefgh")):
        pairs = [([rng.choice(alphabet) for _ in range(rng.randint(0, most))], [rng.choice(alphabet) for _ in range(rng.randint(0, most))]) for _ in range(80)] + [(None, ["a"]), (["a"], None)]
        ref, hyp = (pa.array([["x"], *[p[k] for p in pairs]], pa.list_(pa.string()))[1:] for k in (0, 1))
        for (r, h), ops, edits in zip(pairs, E.aligned(ref, hyp, True).to_pylist(), E.aligned(ref, hyp, False).to_pylist(), strict=True):
            want = None if r is None or h is None else E.align_words(r, h)
            assert ops == (want and [E.OP_NAMES.index(o) | i << 2 | j << 32 for o, _, _, i, j in want])
            assert edits == (None if want is None else sum(o[0] != "equal" for o in want))


def test_words_are_cut_out_in_one_pass(spark):
    for t in ("Hello, WORLD!  it's 12.", "", " -a\tb\nÉcİ d- ", "...", "ß1 2 3"):
        assert one(spark, T.score_words(F.col("t")), t=t) == one(spark, T.words(T.score_text(F.col("t"))), t=t)
    assert one(spark, T.score_text(F.col("t")), t=" -a\tb\nÉc ") == "a b c" and one(spark, T.clean_text(F.col("t")), t="é1a\n\tb' 2C ") == "a b c"


def test_comparison_computes_experiments_and_results_once(spark):
    e = spark.createDataFrame([("a", 0, "m", "v", 0.4, True, "g1", 0.3), ("b", 1, "m", "v", None, True, "g2", 0.2)], "experiment string, position int, manifest_md5 string, normalizer string, conf_filter_threshold double, padded boolean, gpu string, corpus_wer double")
    r = spark.createDataFrame([("a", "f", "s", 0.5, 10), ("b", "f", "s", 0.25, 12)], "experiment string, file string, speaker string, corpus_wer double, ref_words int")
    times = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            times.add(len(b))
            yield b

    found = X.compare(e.mapInPandas(counted, e.schema), r, ["a", "b"])
    assert found.rows.count() == 2 and found.checks.first().wer_comparable and times.value == 2
    assert "Join" not in found.speakers._jdf.queryExecution().executedPlan().toString()
    assert [(x.ref_words, x.wer_a, x.wer_b, x.delta_b) for x in found.speakers.collect()] == [(12, 0.5, 0.25, -0.25)]


def test_words_without_a_duration_share_no_time_with_a_chunk(spark, tmp_path):
    from datetime import datetime

    rows = [(0, datetime(2024, 1, 1, 3), 1, "view", 0.0), (1, datetime(2024, 1, 2, 3), 1, "view", 1.5), (2, datetime(2024, 1, 2, 3, 0, 0, 123450), 1, "view", 0.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    speech = {r.chunk_index: r.speech_s for r in alignment.QUERIES["N9_speech_seconds"](spark, str(tmp_path)).collect()}
    assert (speech[1], speech[2], len(speech)) == (82_800.0, 30.0, 30)
    assert [(r.chunk_index, r.regions, r.speech_s, r.first_s) for r in alignment.QUERIES["J5_clip_regions"](spark, str(tmp_path)).collect()] == [(2, 1, 30.0, 10_800.0)]
    # as in SQL, where the scaled number is 352345394.49999994
    assert one(spark, intervals.rounded(F.col("x"), 4), x=35234.53945) == round(35234.53945 * 1e4) / 1e4 == 35234.5394


def test_recordings_are_files_beside_each_other(spark, tmp_path, monkeypatch):
    """A folder for each recording and task took most of the time."""
    from datetime import datetime, timedelta

    rows = [(k, datetime(2024, 1, 1) + timedelta(hours=k), k % 5, "view", 90_000.0) for k in range(60)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").repartition(7).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(files, "folder", lambda s, what: f"file://{tmp_path}/{what}")
    for name, kind, n in (("SC6_SK5_labels", "txt", "n"), ("SC3_SK1_json_documents", "json", "words")):
        got = files.QUERIES[name](spark, str(tmp_path)).collect()
        made = list((tmp_path / ("labels" if kind == "txt" else "documents")).rglob("*." + kind))
        assert {r.file_no for r in got} == set(range(5)) and len(made) == 5 and len({m.parent for m in made}) == 1
        assert sum(r[n] for r in got) == (60 if kind == "json" else sum(k % 11 != 0 for k in range(60)))


def test_samples_and_words_pass_by_hashed_rows(spark):
    """Both were sorted, and words grouped, in the task that joined them."""
    c = spark.createDataFrame([(1, 1, 0.0, 10.0), (1, 2, 5.0, 20.0)], "f int, chunk_index int, start_s double, end_s double")
    w = spark.createDataFrame([(1, 0, 7.0), (1, 1, 12.0), (1, 2, 30.0), (2, 3, 1.0)], "f int, k int, t double")
    found = intervals.chunk_of_point(w, c, "f", "k", "t", bucket_s=4.0)
    assert {r.k: r.chunk_index for r in found.collect()} == {0: 1, 1: 2, 2: 2}
    audio_rows = spark.createDataFrame([(1, bytearray(b"aabbcc"))], "f int, pcm binary")
    cut = audio.cut(audio_rows, spark.createDataFrame([(1, 0.1, 0.2)], "f int, start_s double, end_s double"), "f", rate=10)
    assert bytes(cut.first().pcm) == b"bb"
    for df in (found, cut):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_aligner_sees_few_rows_at_once(spark):
    most = models.ALIGNED_AT_ONCE

    def model(batch):
        assert len(batch) <= most
        return models.fake_aligner(batch)

    rows = spark.range(most * 2 + 5).coalesce(1).select("id", F.lit("a b").alias("text"), F.lit(1.0).alias("duration"))
    assert {len(r.words) for r in models.apply_model(rows, model, f"words {models.WORDS}", most).collect()} == {2}
    with pytest.raises(Exception, match="AssertionError"):
        models.apply_model(rows, model, f"words {models.WORDS}").collect()
    sizes = spark.sparkContext.accumulator(0)

    def counted(batch):
        sizes.add(len(batch) > most)
        return models.fake_aligner(batch)

    assert models.align(rows, counted).where("size(words) = 2").count() == most * 2 + 5 and sizes.value == 0
