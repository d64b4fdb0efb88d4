"""What the operators share: bounds, names, long and empty inputs, and a plain version of the learner and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wordloom.llm import simhash_dedup as D
from wordloom.llm import toxicity_ftrl as X
from wordloom.llm.common import Remembered, free_names, shared_dir
from wordloom.llm.hmm_lm import score_texts
from wordloom.llm.html_paths import extract
from wordloom.llm.line_quality import MAX_LOST_PCT, clean_rows
from wordloom.llm.mix_sources import mix_rows
from wordloom.llm.prefix_bpe import PrefixBpe, digest_table
from wordloom.llm.token_counts import PieceCounter, count_tokens, piece_scores

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_long_keys_are_not_remembered():
    counter = PieceCounter(piece_scores(public_tokenizers.path("piece_bpe_32k.model")))
    hashes = X.Hasher()
    for i in range(50):
        text = f"{i}" + "漢字文章" * 2000
        counter.count(text)
        X.features(text, hashes)
    held = [*counter.known, *counter.known.old, *hashes.words, *hashes.words.old, *hashes.stems, *hashes.stems.old]
    assert sum(map(len, held)) < 1000


def test_remembered_is_bounded_in_keys_and_length():
    r = Remembered(len, 10, longest=3)
    assert [r["x" * (i % 7)] for i in range(500)] == [i % 7 for i in range(500)]
    assert len(r) + len(r.old) <= 20 and all(len(k) <= 3 for k in [*r, *r.old])


def test_free_names(spark):
    df = spark.range(1).select(F.lit(1).alias("ROW"), F.lit(2).alias("row_"), F.lit(3).alias("x"))
    assert free_names(df, "row", "x", "y") == ["row__", "x_", "y"]


def test_the_shared_folder_is_a_full_address(spark):
    assert shared_dir(spark).startswith("file:/")


OWN = ["__score", "__fp", "__row", "__copy", "__s", "s", "fp", "row", "score", "h", "copies", "edge", "whole", "cut"]


def wide(spark, n=40):
    rows = [(i, " ".join(f"w{i * 7 + k}" for k in range(60)), "en", f"s{i % 3}") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({c: F.lit(c) for c in OWN})


def test_stages_keep_columns_of_any_name(spark):
    df = wide(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    for out in (clean_rows(df), X.keep_clean(df, labels), D.keep_one(df), mix_rows(df)):
        assert out.columns == df.columns
        got = out.limit(3).collect()
        assert got and all(r[c] == c for r in got for c in OWN)


def test_long_texts_pass_every_operator_on_documents(spark):
    rng = random.Random(3)
    long = " ".join(f"Word{rng.randint(0, 5000)}," for _ in range(200_000)) + "\n" + "x" * 300_000
    df = spark.createDataFrame([(1, long, "a"), (2, long, "b"), (3, "short text", "a")], "doc_id long, text string, source string")
    n = len(long.split())
    assert {r.n_tokens for r in score_texts(df).where("doc_id < 3").collect()} == {n + 1}
    assert {r.fp for r in D.with_fingerprint(df).where("doc_id < 3").collect()} == {D._signed(D.fingerprint(long))}
    assert D.keep_one(df).count() == 2
    assert mix_rows(df).count() >= 1 and clean_rows(df).count() <= 2
    labels = spark.createDataFrame([(i, 0) for i in (1, 2, 3)], "doc_id long, toxic int")
    assert X.keep_clean(df, labels).count() == 3
    counter = PieceCounter(piece_scores(public_tokenizers.path("piece_bpe_32k.model")))
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert count_tokens(df, counter).where("doc_id = 1").first().n_tokens == len(sp.encode(long))
    assert digest_table(df, PrefixBpe.load(public_tokenizers.path("byte_bpe_50k.json"))).count() == 3
    pages = spark.createDataFrame([(1, "u", "<p>" + "so it is, then. " * 200_000)], "page_id long, url string, html string")
    assert extract(pages).first().n_chars == 16 * 200_000 - 1


# --- op9: the learner by its formulas, a weight at a time


def plain_ftrl(rows, epochs):
    z, n, seen = collections.defaultdict(float), collections.defaultdict(float), collections.Counter(i for x, _ in rows for i in x)
    rows = [([i for i in x if seen[i] >= X.MIN_ROWS], y) for x, y in rows]
    toxic = sum(y for _, y in rows)
    prior = math.log((toxic + 0.5) / (len(rows) - toxic + 1.5))

    def weight(i):
        if abs(z[i]) <= X.L1:
            return 0.0
        return (math.copysign(X.L1, z[i]) - z[i]) / ((X.BETA + math.sqrt(n[i])) / X.ALPHA + X.L2)

    for _ in range(epochs):
        for x, y in rows:
            w = {i: weight(i) for i in x}
            g = (1 / (1 + math.exp(-(prior + sum(w.values())))) - y) * (X.TOXIC_WEIGHT if y else 1.0)
            for i in x:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / X.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z if weight(i)}, prior


def plain_features(text):
    """Words, beginnings, neighbours, and pairs with one or two words between, each hashed by the operator's word hash."""
    words = text.encode().lower().split()
    mult, mask = [int(m) for m in X._MULT], 2**64 - 1
    top = lambda v: ((v & mask) * mult[0] & mask) >> (64 - X.BITS)
    h = [X.word_hash(w) for w in words]
    out = {top(v) for v in h} | {top(X.word_hash(w, X.STEM)) for w in words}
    for gap in (1, 2, 3):
        out |= {top(a * mult[1] + b * mult[2] + mult[gap + 1]) for a, b in zip(h, h[gap:])}
    return out


def test_learner_equals_its_formulas():
    rng = random.Random(5)
    texts = [(" ".join(rng.choice(["good", "day", "sun,", "Rain"]) for _ in range(8)) + (" vile thing" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(90)]
    hashes = X.Hasher()
    rows = [(np.unique(X.features(t, hashes)).astype(np.int32), y) for t, y in texts]
    assert [set(x.tolist()) for x, _ in rows] == [plain_features(t) for t, _ in texts]
    want, prior = plain_ftrl([(x.tolist(), y) for x, y in rows], 4)
    at, w, got_prior = X.train(list(rows), epochs=4)
    assert got_prior == pytest.approx(prior) and dict(zip(at.tolist(), w.tolist())) == pytest.approx(want) and len(want) > 3


def test_a_score_of_one_half_is_toxic(spark):
    df = spark.createDataFrame([(0, "a")], "doc_id long, text string")
    score = X.scorer(spark, (np.empty(0, np.int64), np.empty(0), 0.0))
    assert [(r.score, r.predicted) for r in df.select(score("text").alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int")).collect()] == [(0.5, 1)]


# --- the pipeline, plainly: lists, all pairs, sorting, and the library's encoder


def plain_pipeline(rows, labels):
    from wordloom.llm.line_quality import assess_text

    rows = [(i, x[8], src) for i, t, src in rows for x in [assess_text(t, MAX_LOST_PCT)] if x[6]]
    toxic = {}
    for i, y in labels:
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 0:
            toxic[i] = max(toxic.get(i, 0), y)
    signed = lambda i: D._signed(xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), 42))  # noqa: E731  as the engine hashes a long
    train = sorted((signed(i), str(i), sorted(plain_features(t)), toxic[i]) for i, t, _ in rows if i in toxic)
    at, w, prior = X.train([(np.array(x, np.int32), y) for _, _, x, y in train])
    weight = dict(zip(at.tolist(), w.tolist()))
    rows = [(i, t, src) for i, t, src in rows if prior + sum(weight.get(k, 0.0) for k in plain_features(t)) < 0]
    fps = [D.fingerprint(t) for _, t, _ in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if bin(fps[a] ^ fps[b]).count("1") <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    best = {}
    for r, (i, _, _) in zip(root, rows):
        best[r] = min(best.get(r, i), i)
    rows = [x for r, x in zip(root, rows) if best[r] == x[0]]
    size = collections.Counter()
    for _, t, src in rows:
        size[src] += len(t.split())
    order = sorted(size)
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    weights = {src: (3, 1, 2)[k % 3] for k, src in enumerate(order)}
    while True:
        level = left / sum(weights[x] for x in open_)
        over = {x for x in open_ if level * weights[x] > 2 * size[x]}
        if not over:
            break
        for x in over:
            target[x] = 2.0 * size[x]
            left -= target[x]
        open_ -= over
        if not open_:
            break
    target |= {x: level * weights[x] for x in open_}
    out = []
    for src in order:
        mine = sorted((int(hashlib.md5(f"{i}:{t}".encode()).hexdigest()[:15], 16), i, t) for i, t, x in rows if x == src)
        whole = int(target[src] // size[src])
        rest, under = target[src] - whole * size[src], 0
        for _, i, t in mine:
            n = len(t.split())
            if under <= rest:
                once = 1 if under + n <= rest or under + n - rest < rest - under else 0
                under += n
            else:
                once = 0
            out += [(i, t)] * (whole + once)
    import tokenizers

    lib = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coded = [(i, lib.encode(t, add_special_tokens=False).ids) for i, t in out]
    return sorted((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()) for i, ids in coded)


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    pool = [f"word{i}" for i in range(900)]
    rows, labels = [], []
    for i in range(160):
        ws, y = [rng.choice(pool) for _ in range(rng.randint(55, 120))], int(rng.random() < 0.3)
        for _ in range(4 * y):
            ws.insert(rng.randrange(len(ws)), rng.choice(["awful", "nasty"]))
        rows.append((i, " ".join(ws) + ".\nAll rights reserved.", f"s{i % 4}"))
        labels.append((i, y))
    rows += [(200 + i, rows[i][1], "s1") for i in range(12)] + [(300, rows[3][1].replace("word1", "word2", 1), "s2"), (400, "too short", "s0"), (None, None, None)]
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    want = plain_pipeline(rows, labels)
    assert got == want and len({i for i, *_ in want}) < 150


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
