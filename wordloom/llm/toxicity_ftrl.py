"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: words, word beginnings (five characters), pairs of neighbours, and pairs with one
or two words between them; words have A-Z lower-cased and ASCII punctuation cut off at both ends. They are hashed to
2**BITS coordinates; those of fewer than MIN_ROWS training rows are left out. FTRL-proximal keeps a learning rate for
each coordinate, and its L1 term leaves most weights at exactly zero, so the model is a short list: at most 2**BITS
pairs (12 MB at 20 bits), a bound that doesn't depend on the data. Errors on toxic rows weigh TOXIC_WEIGHT times.

The classifier is fitted on a bounded sample of labelled rows: rows whose hash lies under MAX_TRAIN / (labelled rows),
about MAX_TRAIN (8000) rows at any size of the corpus. The hash is of the id and drawn before labels and texts are
joined. Texts become their coordinates where they are read; training is one task over those of the sample in hash order,
a few passes, so reruns give the same weights. Labels, lang, source and ids are never inputs of a score.

Defined results: null and empty texts score the prior; null ids are never trained on and count as held out by
crc32 of the empty text (0); several labels of an id count as toxic if one is; without any labelled row the prior is
1/4 and nothing is toxic; extra columns are ignored by `score_rows` and kept by `keep_clean`; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import Remembered, doc_hash_mod, free_names, give_back, read_table

BITS = 20
MAX_TRAIN = 8000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 16.0, 0.01
EPOCHS = 8
MIN_ROWS = 3
TOXIC_WEIGHT = 8.0
STEM = 5
FOLDS = 5
_EDGES = b".,;:!?\"'()[]{}|<>*#$%&-_/\\"
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


REMEMBERED = 100_000
LONGEST_REMEMBERED = 64


def word_hash(word: bytes, stem: int | None = None) -> int:
    bare = word.strip(_EDGES) or word
    if stem:
        bare = b"^" + bare.decode()[:stem].encode()
    return (zlib.crc32(bare) << 32) | zlib.adler32(bare[::-1] + b"~")


class Hasher:
    """The word and word-beginning hashes of a task."""

    def __init__(self):
        self.words = Remembered(word_hash, REMEMBERED, LONGEST_REMEMBERED)
        self.stems = Remembered(lambda w: word_hash(w, STEM), REMEMBERED, LONGEST_REMEMBERED)


def features(text: str | None, hashes: Hasher, bits: int = BITS) -> np.ndarray:
    """Hashed coordinates of a text, with repeats."""
    words = text.encode().lower().split() if text else []
    h = np.fromiter(map(hashes.words.__getitem__, words), np.uint64, len(words))
    stems = np.fromiter(map(hashes.stems.__getitem__, words), np.uint64, len(words))
    shift = np.uint64(64 - bits)
    parts = [(h * _MULT[0]) >> shift, (stems * _MULT[0]) >> shift]
    for gap in (1, 2, 3):
        if len(h) > gap:
            parts.append(((h[:-gap] * _MULT[1] + h[gap:] * _MULT[2] + _MULT[gap + 1]) * _MULT[0]) >> shift)
    return np.concatenate(parts).astype(np.int64)


def train(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Unique coordinates and label of each row -> indices and values of the nonzero weights, and the bias."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    seen = np.zeros(1 << bits, np.int32)
    for x, _ in rows:
        seen[x] += 1
    for k, (x, y) in enumerate(rows):
        rows[k] = x[seen[x] >= MIN_ROWS], y
    toxic = sum(y for _, y in rows)
    prior = float(np.log((toxic + 0.5) / (len(rows) - toxic + 1.5)))
    for _ in range(epochs):
        for x, y in rows:
            zx, nx = z[x], n[x]
            w = np.where(np.abs(zx) > L1, (np.sign(zx) * L1 - zx) / ((BETA + np.sqrt(nx)) / ALPHA + L2), 0.0)
            p = 1.0 / (1.0 + np.exp(-np.clip(prior + w.sum(), -35, 35)))
            g = (p - y) * (TOXIC_WEIGHT if y else 1.0)
            sigma = (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA
            z[x] += g - sigma * w
            n[x] += g * g
    at = np.flatnonzero(np.abs(z) > L1)
    w = (np.sign(z[at]) * L1 - z[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
    return at, w, prior


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN) -> tuple[np.ndarray, np.ndarray, float]:
    """The model, learnt in one executor task from the sample and returned as its nonzero weights."""
    usable = labels.select(F.col(id_col).alias("id"), F.col("toxic")).where("id is not null and toxic is not null")
    usable = usable.where(doc_hash_mod(F.col("id"), FOLDS) != 0)
    rate = min(1.0, max_train / max(1, usable.count()))
    draw = (F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    truth = usable.where(draw).groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null").where(draw)
    sample = texts.join(truth, "id").select(F.xxhash64("id").alias("h"), F.col("id").cast("string").alias("id"), "text", "y")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hasher()
        for b in batches:
            x = [np.unique(features(t.as_py(), hashes)).astype("<i4").tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.binary()), b.column(3)], ["h", "id", "x", "y"])
        del hashes
        give_back()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(x.as_py(), "<i4"), y) for b in batches for x, y in zip(b.column(2), b.column(3).to_pylist(), strict=True)]
        at, w, prior = train(rows)
        del rows
        give_back()
        yield pa.RecordBatch.from_arrays(
            [pa.array([at.astype("<i4").tobytes()]), pa.array([w.astype("<f8").tobytes()]), pa.array([prior])], ["at", "w", "prior"]
        )

    one = sample.mapInArrow(hashed, "h long, id string, x binary, y int").repartition(1).sortWithinPartitions("h", "id", "x")
    got = one.mapInArrow(learn, "at binary, w binary, prior double").first()
    if got is None:
        return np.empty(0, np.int64), np.empty(0), float(np.log(1 / 3))
    return np.frombuffer(bytes(got["at"]), "<i4").astype(np.int64), np.frombuffer(bytes(got["w"]), "<f8"), got["prior"]


def score_text(text: str | None, table: np.ndarray, prior: float, hashes: Hasher, bits: int = BITS) -> float:
    x = features(text, hashes, bits)
    x = np.unique(x[table[x] != 0])
    return float(1.0 / (1.0 + np.exp(-np.clip(prior + table[x].sum(), -35, 35))))


def score_any(text, table: np.ndarray, prior: float, hashes: Hasher) -> float:
    return score_text(text if isinstance(text, str) else None, table, prior, hashes)


def score_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    spark = docs.sparkSession
    score = scorer(spark, fit(spark, docs, labels, id_col, text_col))
    out = docs.select(F.col(id_col), (doc_hash_mod(F.col(id_col), FOLDS) == 0).alias("held_out"), score(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def scorer(spark: SparkSession, model):
    """A column function: text -> score, with the model's short weight list broadcast."""
    import pandas as pd

    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, prior = sent.value
        table, hashes = np.zeros(1 << BITS), Hasher()
        table[at] = w
        for texts in batches:
            yield texts.map(partial(score_any, table=table, prior=prior, hashes=hashes)).astype("float64")
        del table, hashes
        give_back()

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(score, "double")


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows that aren't predicted toxic, with their columns as they are."""
    spark = docs.sparkSession
    score = scorer(spark, fit(spark, docs, labels, id_col, text_col))
    own = free_names(docs, "score")[0]
    return docs.withColumn(own, score(F.col(text_col))).where(F.col(own) < 0.5).drop(own)


def op9_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_rows(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"))
