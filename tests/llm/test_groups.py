"""Near duplicates, components, mixing, archives, toxicity and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from wordloom.llm import embedding_dedup as M
from wordloom.llm import simhash_dedup as D
from wordloom.llm import toxicity_ftrl as X
from wordloom.llm import warc_zstd as W
from wordloom.llm.common import connected_components
from wordloom.llm.mix_sources import mix_rows, mix_table


def union(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chains_stars_and_cliques(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(a, b) for a in range(200, 208) for b in range(200, 208)]
    df = spark.createDataFrame([*edges, *edges[:5], (None, 3), (50, 50)], "u long, v long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, **{i: 200 for i in range(200, 208)}}


# --- op5


def test_fingerprint_by_its_definition():
    text = "A b C d\ne  f"
    ws = text.lower().split()
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 3]), 42) for i in range(len(ws) - 2)]
    bits = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))
    assert D.fingerprint(text) == bits
    assert D.fingerprint("x Y") == xxhash.xxh64_intdigest("x y", 42) and D.fingerprint(None) == D.fingerprint(" \n") == 0


@pytest.mark.parametrize("max_list", [1024, 6, 2])
def test_links_equal_brute_force_in_every_tier(spark, max_list):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(fps)[:3]:
        for _ in range(40):
            fps.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 3))}))
    fps = sorted(D._signed(x) for x in fps)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= 3]
    want = union(len(fps), pairs)
    links = D.fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp long"), max_list).collect()
    place = {x: i for i, x in enumerate(fps)}
    assert all(want[place[r.u]] == want[place[r.v]] and r.u != r.v for r in links)
    assert union(len(fps), [(place[r.u], place[r.v]) for r in links]) == want


def test_simhash_frames(spark):
    base = [f"w{i}" for i in range(300)]
    near = base[:150] + ["changed"] + base[151:]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (None, " ".join(base)), (7, None), (8, ""), (4, "other text of its own")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = {(r.doc_id, r.component_id) for r in D.simhash_components(df).collect()}
    linked = bin(D.fingerprint(rows[0][1]) ^ D.fingerprint(rows[1][1])).count("1") <= 3
    low = 3 if linked else 5
    assert {(9, low), (None, low), (7, 7), (8, 7), (4, 4)} <= got
    kept = D.keep_one(df.union(df))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted({low, 7, 4} | ({3} if not linked else set()))
    assert D.simhash_components(df.limit(0)).count() == D.keep_one(df.limit(0)).count() == 0
    nobody = spark.createDataFrame([(None, "a b c d")] * 3, "doc_id long, text string")
    assert D.keep_one(nobody).count() == 1


# --- op8


@pytest.mark.parametrize("block,run,span", [(1024, 16, 64), (7, 2, 2)])
def test_embedding_links_equal_brute_force(spark, block, run, span):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    v = np.concatenate([c + rng.normal(scale=0.09, size=(9, 16)) for c in centres]).astype(np.float32)
    v = np.concatenate([v, v[:20], v[:5] * 3])
    label = rng.integers(0, 2, size=len(v))
    rows = [(i, [float(x) for x in y], int(c)) for i, (y, c) in enumerate(zip(v, label, strict=True))]
    odd = [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, rows[0][1], None), (1004, [], 0), (1005, [None] * 16, 0), (1006, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in M.embedding_components(df, block=block, run=run, span=span).collect()}
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(links, False)
    want = union(len(v), list(zip(*np.nonzero(links), strict=True)))
    for i in range(len(v)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i].sum(), want[i], want[i] == i)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _, _ in odd)
    assert M.embedding_components(df.limit(0)).count() == M.embedding_components(df.where("vec_id = 1001")).count() - 1 == 0


def test_embedding_ties_and_repeated_ids(spark):
    cos = 0.98
    a, b, below = [1.0, 0.0, 0.0], [0.98, 0.19899748742132398, 0.0], [0.9799999, 0.19899797986, 0.0]
    rows = [(1, a, 0), (2, b, 0), (3, below, 1), (4, a, 1), (4, a, 1), (4, [0.0, 0.0, 1.0], 1)]
    got = M.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    tied = M.exact_cosine(np.array(a), np.array(b)) >= cos
    by = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got)
    want = [(1, int(tied), 1, True), (2, int(tied), 1 if tied else 2, not tied), (3, 0, 3, True), (4, 0, 4, True), (4, 1, 4, True), (4, 1, 4, True)]
    assert by == sorted(want)


def test_intervals_over_eps_apart_hold_no_links():
    rng = np.random.default_rng(3)
    u = M.unit(rng.normal(size=(3000, 6)))
    u = u[np.lexsort(np.floor(u[:, ::-1] / 0.2).T)]
    got = M.interval_links(u, u[:, :3], u, u[:, :3], True, 0.98, 0.2 + 1e-9)
    want = np.nonzero(np.triu(u @ u.T >= 0.98, 1))
    assert set(zip(*got)) == set(zip(*want))
    assert M.apart(np.array([[0.0, 0.0]]), np.array([[0.15, 0.15]]), 0.2) and not M.apart(np.array([[0.0, 0.0]]), np.array([[0.15, 0.1]]), 0.2)


# --- op6


def test_mix_targets_and_takings(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)] + [(None, None, "a"), (1, "w", "empty")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, target double")
    got = mix_table(df).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        open_ -= over
    want |= {s: level * w[s] for s in open_}
    source = {i: s for i, _, s in rows if i is not None}
    taken, most = dict.fromkeys(order, 0), max(len((t or "").split()) for _, t, _ in rows)
    for r in got:
        s = source.get(r.doc_id, "a") if r.doc_id != 1 else next(x for x in order if sizes[x] == r.source_size)
        assert r.target == pytest.approx(want[s]) and r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= most for s in order)
    assert sorted(map(str, got)) == sorted(map(str, mix_table(df.repartition(7)).collect()))
    mixed = mix_rows(df)
    assert mixed.columns == df.columns and sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mix_table(df.limit(0)).count() == mix_rows(df.limit(0)).count() == 0
    silent = spark.createDataFrame([(1, None, None), (2, "", "s")], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mix_table(silent).collect()} == {(0.0, 0)}


@pytest.mark.parametrize("copies", [1000, 3])
def test_equal_rows_are_told_apart_at_the_edge(spark, copies):
    rows = [(1, "a b c d e", "x")] * copies + [(i, "w w w", "y") for i in range(100)] + [(7, "w w", None)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mix_table(df).collect()
    for size in {r.source_size for r in got}:
        mine = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine) / 2
        assert all(r.taken <= 2 * r.size for r in mine)
    assert sorted(map(str, got)) == sorted(map(str, mix_table(df.repartition(3)).collect()))
    clash = df.withColumns({c: F.lit(c) for c in ("s", "whole", "edge", "H", "row", "copies", "__copy", "size")})
    mixed = mix_rows(clash)
    assert mixed.columns == clash.columns and {(r.s, r.H, r.row, r.copies) for r in mixed.collect()} == {("s", "H", "row", "copies")}
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert words(mixed.collect()) == sum(r.taken for r in got)


# --- op7


def archive(records, dictionary=b""):
    how = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    packer = zstandard.ZstdCompressor(write_checksum=True, **how)
    return (W.dictionary_frame(dictionary) if dictionary else b"") + b"".join(map(packer.compress, records))


def test_archive_round_trip_with_and_without_dictionary():
    payloads = [f"<html><body>page {i} {'text ' * (i % 7)}</body></html>".encode() for i in range(200)]
    records = [W.make_record(i, f"http://x.org/{i} a\r\n", p) for i, p in enumerate(payloads)]
    dictionary = zstandard.train_dictionary(2048, records * 3).as_bytes()
    for raw in (archive(records), archive(records, dictionary)):
        assert [(r["page_id"], r["payload"]) for r in W.read_archive(raw)] == list(enumerate(payloads))


def test_broken_records_are_found():
    good = W.make_record(1, "http://x", b"payload")
    bad = [good.replace(b"payload", b"paYload"), good[:-1], good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"WARC-Date", b"WARC-Dare"), good.replace(b"WARC-Type: response", b"WARC-Type: other")]
    for b in bad:
        with pytest.raises(W.WarcError):
            list(W.read_archive(archive([good, b])))
        rows = list(W.read_archive(archive([good, b, good]), on_error="report"))
        assert [r["error"] is None for r in rows] == [True, False, True]
    with pytest.raises(W.WarcError):
        list(W.read_archive(archive([good])[:-6]))
    with pytest.raises(W.WarcError):
        list(W.read_archive(archive([good]) + b"junk"))


def test_warc_frames(spark, tmp_path):
    big = "<p>" + "x" * 2000
    rows = [(1, "u1", big), (5, "u5", big), (3, None, big), (None, "n", big), (4, "s", "small"), (6, "s", "small"), (7, "e", None), (7, "e", None), (8, "l", "y" * 9_000_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    folder = f"file://{tmp_path}/warc"
    made = W.write_archives(W.planned_records(df), folder, W.train_dictionary(df), archive_bytes=10_000)
    assert sum(r.records for r in made.collect()) == len(rows)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in W.read_archives(spark, folder).collect()), key=str)
    import hashlib

    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = [(i, "revisit" if t == big and i != 5 else "response", 5 if t == big and i != 5 else None, len((t or "").encode()), sha(t)) for i, _, t in rows]
    assert got == sorted(want, key=str)
    assert W.write_archives(W.planned_records(df.limit(0)), f"file://{tmp_path}/none").count() == 0


# --- op9


def toxic_docs(n, seed):
    rng = random.Random(seed)
    plain, bad = [f"word{i}" for i in range(400)], ["awful", "nasty", "vile"]
    out = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        ws = [rng.choice(plain) for _ in range(40)]
        for _ in range(3 * y):
            ws.insert(rng.randrange(len(ws)), rng.choice(bad) + rng.choice(["", ".", ","]))
        out.append((i, " ".join(ws), y))
    return out


def test_toxicity_learns_from_its_folds_only(spark):
    rows = toxic_docs(400, 1)
    df = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows] + [(None, None, 0.0), (9999, "", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(rows[0][0], rows[0][2]), (None, 1), (5, None)], "doc_id long, toxic int")
    got = X.score_rows(df, labels).collect()
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got) and len(got) == len(rows) + 2
    flipped = labels.selectExpr("doc_id", "case when pmod(crc32(cast(doc_id as string)), 5) = 0 then 1 - toxic else toxic end as toxic")
    assert sorted(map(str, X.score_rows(df, flipped).collect())) == sorted(map(str, got))
    kept = X.keep_clean(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(not r.predicted for r in got)
    assert X.score_rows(df.limit(0), labels).count() == 0
    assert {r.predicted for r in X.score_rows(df, labels.limit(0)).collect()} == {0}


# --- the pipeline


def test_pipeline_equals_its_stages_one_by_one(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    rng = random.Random(7)
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t, _ in toxic_docs(200, 2)]
    rows = [(i, " ".join(f"{w}" for w in t.split()) + " " + " ".join(f"tail{rng.randint(0, 9999)}" for _ in range(20)), *r) for i, t, *r in rows]
    rows += [(500 + i, rows[i][1], "en", "s1", 1) for i in range(10)] + [(600, "too short", "en", "s0", 9), (None, None, None, None, None), (601, "loud!! " * 90, "en", "s2", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in toxic_docs(200, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r.doc_id for r in docs.collect()})
    quality, toxicity, neardup, mix, _ = seen
    assert not {600, 601, None} & quality and set(range(200)) <= quality
    truth = {i: y for i, _, y in toxic_docs(200, 2)}
    assert sum(truth[i] == (i not in toxicity) for i in range(200)) > 185
    assert not {500 + i for i in range(10) if i in toxicity} & neardup and mix <= neardup
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, docs.collect()))
