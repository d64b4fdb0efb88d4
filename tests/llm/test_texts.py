"""Extraction, quality rules, token counts, encoding and language model."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from wordloom.llm import hmm_lm as H
from wordloom.llm import prefix_bpe
from wordloom.llm.common import Remembered, words_of
from wordloom.llm.html_paths import extract, extract_text
from wordloom.llm.line_quality import assess, assess_text, clean_rows, repeat_words
from wordloom.llm.prefix_bpe import PrefixBpe, decode_table, digest_table
from wordloom.llm.token_counts import PieceCounter, count_tokens, piece_scores

public_tokenizers = pytest.importorskip("public_tokenizers")
LONG = "word sentence, more. " * 20_000
DOCS = "doc_id long, text string, extra string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)


def test_words_split_on_ascii_white_space_only():
    assert words_of("a\x1cb c d\te") == [b"a\x1cb", "c d".encode(), b"e"]
    assert words_of(None) == words_of(" \n ") == []


def test_remembered_keeps_frequent_keys():
    made = []
    r = Remembered(lambda k: made.append(k) or k * 2, 3)
    for k in [1, 2, 3, 1, 4, 1, 5, 6, 1]:
        assert r[k] == 2 * k
    assert made.count(1) == 1 and len(r) + len(r.old) <= 6


# --- op1


def test_extract_drops_furniture_and_keeps_short_blocks():
    page = """<html><head><title>x</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies, ok.</div><div id=sidebar><p>Long side text, with commas, and dots.</div>
    <article><h1>Title</h1><p><b>First &amp; <i>fore</i>most<br>text.<p>Yes.<script>var x="</p>";</script><p>A&#233;&nbsp;b.</p>
    <form>Mail <input></form><section id="comments"><p>I think so, too. Really, I do, believe me.</p></section></article><footer>end</footer>"""
    assert extract_text(page) == "Title\n\nFirst & foremost text.\n\nYes.\n\nAé b."


def test_extract_edges(spark):
    assert extract_text(None) == extract_text("") == extract_text("<p> </p>") == extract_text("<script>x") == ""
    assert extract_text("bare") == "bare"
    assert extract_text("<div>" * 3000 + "deep text, here." + "</div>" * 3000) == "deep text, here."
    rows = [(1, "u", "<article><p>a b.</p></article>", 1), (1, "u", "<article><p>a b.</p></article>", 1), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(extract(df).collect(), key=str)
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, "a b.", 4), (1, "a b.", 4), (None, "", 0)]
    assert extract(df.limit(0)).count() == 0


# --- op2


def brute_repeats(ws):
    windows = collections.Counter(zip(ws, ws[1:], ws[2:]))
    return len({i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)})


def test_repeat_words_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        ws = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 14))]
        assert repeat_words(ws) == brute_repeats(ws)


def test_line_rules():
    prose = " ".join(f"Word{i}, again" for i in range(60))
    nav = " | ".join(f"item{i}" for i in range(40))
    assert assess_text(prose)[6] and assess_text(prose + "\nAll rights reserved.")[8] == prose
    assert not assess_text(f"{prose}\n{nav} {nav}")[6]  # loses over 30 %
    assert not assess_text(" ".join(f"LOUD{i}!!" for i in range(80)))[6]
    assert not assess_text("same " * 80)[6]
    assert assess_text("short")[5] and assess_text(None)[:6] == (0, 0, 0, 0, 0, True)


def test_lines_from_outside_the_tables():
    prose = "\n".join(f"Sentence {i} of the report says, among much else, that {i} things went well." for i in range(20))
    menu = "Home\nAbout us\n\nOur products\nNews\nContact\nJobs"
    clean = lambda t: assess_text(t)[8]
    assert clean(f"{menu}\n{prose}") == "\n" + prose
    for short in ("Home\nAbout us\nNews\nContact", "One:\nTwo.\nThree!\n\"Four\"\n(Five)\nSix;", "A heading\n" + prose + "\nAnother heading"):
        assert clean(short) == short
    assert clean(f"{prose}\nhttps://example.org/a WWW.example.org see") == prose and clean("see www.example.org for more of it") == "see www.example.org for more of it"
    for line in ("Skip to content", "This site uses cookies, as most do.", "Home > Products > Chairs > Red > Large", "### $$$ ***"):
        assert clean(f"{line}\n{prose}") == prose
    verse = "\n".join(f"line {i} goes on," for i in range(30))
    assert not assess_text(verse)[6]  # short lines that no sentence ends; the price of the menu rule
    assert clean(prose + "\n中文句子在这里。\n好的！") == prose + "\n中文句子在这里。\n好的！"


def test_quality_frames(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = docs(spark, [(1, text), (1, text), (None, None), (2, ""), (3, LONG)])
    got = {(r.doc_id, r.n_words, r.kept) for r in assess(df).collect()}
    assert got == {(1, 80, True), (None, 0, False), (2, 0, False), (3, 60_000, False)}
    clash = df.withColumnRenamed("extra", "kept")
    kept = clean_rows(clash)
    assert kept.columns == clash.columns and kept.count() == 2
    assert assess(df.limit(0)).count() == clean_rows(df.limit(0)).count() == 0


# --- op4, op10


@pytest.fixture(scope="module")
def samples():
    rng = random.Random(1)
    pool = list("aaabbtheing  \n\t'sDL01.,!?#|é漢🙂▁ \x00\x1c\x85　") + ["<|endoftext|>", "<s>", "<0x0A>", " the", "ing"]
    out = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    return [*out, "", " ", "a" * 2000, "\n" * 500, "ha" * 5000, LONG]


def test_token_counts_equal_the_library(samples):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    counter, sp = PieceCounter(piece_scores(path)), sentencepiece.SentencePieceProcessor(model_file=path)
    assert [counter.count(t) for t in samples] == [len(x) for x in sp.encode(samples)]
    assert len(counter.whole) > 30_000 and all(len(sp.encode(p.replace("▁", " ")[1:])) == 1 for p in list(counter.whole)[:2000] if p[0] == "▁" and len(p) > 1 and p[1] != "▁")


def test_encoding_equals_the_library(samples):
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe, lib = PrefixBpe.load(path), tokenizers.Tokenizer.from_file(path)
    for t in samples:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert bpe.encode(t) == ids if t else not ids
        assert bpe.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_what_a_worker_knows_of_the_vocabulary_outlives_a_task(samples, monkeypatch):
    bpe, checks = PrefixBpe.load(public_tokenizers.path("byte_bpe_50k.json")), []
    inner = bpe._apart
    monkeypatch.setattr(bpe, "_apart", lambda *pair: checks.append(pair) or inner(*pair))
    first = [bpe.digest(t) for t in samples]
    assert len(checks) == len(set(checks)) > 0
    bpe.forget()
    assert not bpe.known and not bpe.known.old
    checks.clear()
    assert [bpe.digest(t) for t in samples] == first and not checks


def test_encoding_within_small_bounds_equals_the_library(samples, monkeypatch):
    import tokenizers

    monkeypatch.setattr(prefix_bpe, "FACTS", 40)
    monkeypatch.setattr(prefix_bpe, "BEGINNINGS", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe, lib = PrefixBpe.load(path), tokenizers.Tokenizer.from_file(path)
    for t in samples:
        assert bpe.encode(t) == lib.encode(t, add_special_tokens=False).ids
        assert bpe.held == sum(map(len, [*bpe.states.values(), *bpe.pairs.values()])) <= 40


def test_the_quick_split_equals_the_pattern():
    import regex

    slow, quick = regex.compile(prefix_bpe.SPLIT), prefix_bpe.plane_split()
    plane = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(3)
    mixed = ["".join(rng.choice(["'", "s", "ll", " ", "\n", "1", "é", "!", *rng.sample(plane, 9)]) for _ in range(60)) for _ in range(500)]
    for text in ["".join(plane), *(f"{c} {c}a{c}1{c}'{c}  {c}\t" for c in plane), *mixed]:
        assert quick.findall(text) == slow.findall(text)


def test_token_frames(spark):
    df = docs(spark, [(1, "hello world"), (1, "hello world"), (None, None), (2, "")])
    counter = PieceCounter(piece_scores(public_tokenizers.path("piece_bpe_32k.model")))
    got = sorted(count_tokens(df, counter, limit=1).collect(), key=str)
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got] == [(1, 11, 3, True), (1, 11, 3, True), (2, 0, 0, False), (None, 0, 0, False)]
    bpe = PrefixBpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    rows = digest_table(df.withColumnRenamed("extra", "n_tokens"), bpe, with_ids=True).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.ids_sha256 for r in rows if r.n_tokens == 0} == {empty} and all(len(r.ids) == r.n_tokens for r in rows)
    back = {(r.doc_id, r.text) for r in decode_table(digest_table(df, bpe, with_ids=True), bpe).collect()}
    assert back == {(1, "hello world"), (None, ""), (2, "")}
    assert digest_table(df.limit(0), bpe).count() == count_tokens(df.limit(0), counter).count() == 0


# --- op3


def brute_likelihood(model, obs):
    k, total = len(model.start), 0.0
    for path in itertools.product(range(k), repeat=len(obs)):
        p = model.start[path[0]] * model.emit[path[0], obs[0]]
        for a, b, o in zip(path, path[1:], obs[1:]):
            p *= model.step[a, b] * model.emit[b, o]
        total += p
    return math.log10(total)


def test_forward_is_exact_for_several_texts_in_a_stream():
    rng = np.random.default_rng(5)
    model = H.from_counts(rng.random(3), rng.random((3, 3)) * 5, rng.random((3, 6)) * 9)
    texts = [[*rng.integers(1, 6, size=n), 0] for n in (0, 1, 4, 7, 3, 0, 5)]
    logs = H._Stream(model, np.concatenate([np.array(t, np.int64) for t in texts])).log10()
    at = 0
    for t in texts:
        assert logs[at : at + len(t)].sum() == pytest.approx(brute_likelihood(model, t), abs=1e-10)
        at += len(t)


def test_expected_counts_equal_brute_force_and_raise_the_likelihood():
    rng = np.random.default_rng(6)
    model = H.from_counts(rng.random(2), rng.random((2, 2)) * 5, rng.random((2, 4)) * 9)
    texts = [[1, 2, 3, 0], [2, 0], [3, 3, 1, 2, 1, 0]]
    start, step, emit = H._Stream(model, np.concatenate([np.array(t) for t in texts])).expected()
    s, a, e = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 4))
    for obs in texts:
        paths = {}
        for path in itertools.product(range(2), repeat=len(obs)):
            p = model.start[path[0]] * model.emit[path[0], obs[0]]
            for x, y, o in zip(path, path[1:], obs[1:]):
                p *= model.step[x, y] * model.emit[y, o]
            paths[path] = p
        z = sum(paths.values())
        for path, p in paths.items():
            s[path[0]] += p / z
            for x, y in zip(path, path[1:]):
                a[x, y] += p / z
            for x, o in zip(path, obs):
                e[x, o] += p / z
    np.testing.assert_allclose(start, s)
    np.testing.assert_allclose(step, a)
    np.testing.assert_allclose(emit, e)


def test_language_model_frame(spark):
    rng = random.Random(2)
    vocab = ["alpha", "beta", "gamma", "delta"], ["uno", "dos", "tres", "cuatro"]
    rows = [(i, " ".join(rng.choice(vocab[i % 2]) for _ in range(40))) for i in range(80)]
    rows += [(None, None), (200, ""), (7, rows[7][1]), (300, "unseen tokens")]
    got = H.score_texts(docs(spark, rows)).collect()
    train, counts = [t for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2], collections.Counter()
    for t in train:
        counts.update((t or "").split() + [""])
    n, v = sum(counts.values()), len(counts)
    base = lambda t: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in (t or "").split() + [""])
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {n}
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        assert by[i].base_score == pytest.approx(base(t), abs=1e-9) and by[i].score <= 0
        assert by[i].n_known == sum(counts[w] > 0 for w in (t or "").split() + [""])
    held = [r for r in got if r.held_out and r.n_tokens > 10]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_equal_brute_force_end_to_end(spark, monkeypatch):
    """Every path of states, with the trained parameters and the corpus counts taken anew."""
    models, train = [], H.train_model
    monkeypatch.setattr(H, "train_model", lambda *a, **k: models.append(train(*a, **k)) or models[-1])
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["a", "bb", "ccc", "Dddd", "e\u00e9"]) for _ in range(rng.randint(0, 6)))) for i in range(60)] + [(90, "never seen")]
    got = {r.doc_id: r for r in H.score_texts(docs(spark, rows).repartition(3), states=2).collect()}
    fold = lambda t: [w for w in t.encode().lower().split()] + [b""]
    counts = collections.Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in fold(t))
    cls = lambda w: H.word_class(w) if w else 0
    size, kinds = collections.Counter(), collections.Counter()
    for w, c in counts.items():
        size[cls(w)] += c
        kinds[cls(w)] += 1
    for i, t in rows:
        words = fold(t)
        share = sum(math.log10((counts[w] + 1) / (size[cls(w)] + kinds[cls(w)] + 1)) for w in words if w)
        assert got[i].score == pytest.approx(brute_likelihood(models[0], [cls(w) for w in words]) + share, abs=1e-9)


def test_words_of_a_bucket_are_summed_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(H, "TOTAL_WORDS", 3)
    rows = [(i, " ".join(f"w{(i * j) % 37}" for j in range(20))) for i in range(60)]
    got = {r.doc_id: r.base_score for r in H.score_texts(docs(spark, rows).coalesce(1)).collect()}
    monkeypatch.undo()
    assert got == pytest.approx({r.doc_id: r.base_score for r in H.score_texts(docs(spark, rows)).collect()})


def test_language_model_of_nothing(spark):
    assert H.score_texts(docs(spark, []).limit(0)).count() == 0
    only_held = [(i, "a b") for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    assert {(r.train_tokens, r.base_score) for r in H.score_texts(docs(spark, only_held)).collect()} == {(0, 0.0)}


def test_expected_counts_side_by_side_equal_the_stream(monkeypatch):
    rng = np.random.default_rng(8)
    model = H.from_counts(rng.random(3), rng.random((3, 3)) * 5, rng.random((3, 6)) * 9)
    stream = np.concatenate([[*rng.integers(1, 6, size=n), 0] for n in (0, 1, 40, 7, 90, 0, 5, 39)])
    want = H._pack(*H._Stream(model, stream).expected())
    for side in (0, 1, 40, 1000):
        monkeypatch.setattr(H, "SIDE_TOKENS", side)
        np.testing.assert_allclose(H.expected_counts(model, stream), want)


def test_every_round_covers_all_training_texts(spark):
    rows = [(i, " ".join(f"w{i * j % 23}" for j in range(i % 50))) for i in range(120)]
    training = H.stage_texts(docs(spark, rows).repartition(3))[2]
    every = np.concatenate(list(H._classes_of(training.toArrow().to_batches())))
    assert (every == 0).sum() == sum(zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows)
    tokens = np.bincount(every, minlength=H.CLASSES)
    want = H.first_model(tokens, H.STATES)
    for _ in range(H.ROUNDS):
        want = H._unpack(H.expected_counts(want, every), H.STATES, H.CLASSES)
    for a, b in zip(H.train_model(training, tokens), want, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-3, atol=1e-5)


def test_few_long_training_texts_teach_the_states(spark):
    """Both training texts were missing from the bounded sample of old, and the states stayed alike."""
    half = ["alpha", "beta", "gamma", "delta"] * 12 + ["uno", "dos", "tres", "cuatro"] * 13
    rows = [(i, " ".join(half * 3000)) for i in (41, 145)] + [(141, " ".join(half * 3))]
    held = {r.doc_id: r for r in H.score_texts(docs(spark, rows)).collect()}[141]
    assert held.held_out and held.score > held.base_score + 0.2 * held.n_tokens
