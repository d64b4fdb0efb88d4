"""A hidden Markov language model: Baum-Welch over partitions, exact likelihood by the scaled forward recursion.

A text is its words and one end token. Latent states emit word classes (a hash of a word's first byte and last three,
the end token has its own), and a class emits its words by their corpus counts plus one, with one share for all unseen
words: P(token | state) = P(class | state) * (c + 1) / (N_k + V_k + 1). So the states' parameters are bounded
(STATES x CLASSES), while the counts of words are exact, cover all training texts and grow with the corpus.

One pass tokenises all texts into blocks of about BLOCK_TOKENS tokens and stages them: for each text its words as
numbers of the block's dictionary, and for each block the classes of its training texts and its dictionary with
training counts, dealt to buckets by a hash of the word and packed. A word is there once for each block, so no word is
hot and no text is exploded. Each bucket adds up its words over all blocks, which pass by one at a time, so a task holds
the distinct words of one bucket (at most BUCKETS of them: some 100,000 words each at 100 TB). A second pass answers
every block with the corpus counts of its words; the answers then meet the texts by block. Totals of at most CLASSES
rows come to the driver.

Each Baum-Welch round reads the staged classes of all training texts, every task adds up its expected counts, and their
sums (whole numbers, added as decimals, so neither the order of adding nor the size matters) give the next parameters. All
ROUNDS rounds do so, whatever the size. They start from the class totals of all training texts, each class dealt to the
states in seeded random shares (raised to SHARPNESS, so that states differ enough to part in few rounds): shares by text
or position would even out as the corpus grows, and the states would start alike.

The forward recursion is exact for texts of any length: a task's texts form one stream that restarts after each end
token; it is cut into equal pieces whose transfer matrices are computed side by side, chained, and then filled in.
Training takes that way for texts over SIDE_TOKENS only; shorter ones are laid side by side, which needs no transfers.

Defined results: null and empty texts are one end token; null ids are trained on (crc32 of the empty text); repeated
ids and rows are texts of their own; without training texts every count is 0 and the parameters are uniform; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import doc_hash_mod, materialize, read_table, scratch_path

STATES = 6
CLASSES = 4096
ROUNDS = 7
SHARPNESS = 3
BLOCK_TOKENS = 500_000
BUCKETS = 4096
TOTAL_WORDS = 65_536
STREAM_TOKENS = 1_000_000
SIDE_TOKENS = 2048
FOLDS, HELD_OUT = 7, 2
UNIT = 1 << 20
END = b""


class Model(NamedTuple):
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def word_class(word: bytes, classes: int = CLASSES) -> int:
    """1 .. classes - 1; class 0 is the end token's."""
    return 1 + zlib.crc32(word[:1] + b"~" + word[-3:]) % (classes - 1)


def from_counts(start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> Model:
    """Parameters from expected counts, each smoothed so that nothing is impossible."""
    start, step, emit = start + 1.0, step + 1.0, emit + 0.05
    return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def uniform(states: int = STATES, classes: int = CLASSES) -> Model:
    return from_counts(np.zeros(states), np.zeros((states, states)), np.zeros((states, classes)))


class _Stream:
    """Texts laid end to end as pieces of equal length; class 0 ends a text, and padding repeats it.

    Everything is held time-major, (place in the piece, piece, ...), so each step works on contiguous memory.
    """

    def __init__(self, model: Model, obs: np.ndarray):
        self.model, self.n = model, len(obs)
        self.len = int(min(128, max(1, np.sqrt(self.n))))
        self.rows = -(-self.n // self.len)
        padded = np.zeros(self.rows * self.len, np.int64)
        padded[: self.n] = obs
        self.obs = np.ascontiguousarray(padded.reshape(self.rows, self.len).T)
        flat = np.concatenate([[True], padded[:-1] == 0])  # a text starts here
        self.starts = [np.flatnonzero(x) for x in flat.reshape(self.rows, self.len).T]
        self.first = flat[: self.n]
        self.emit = np.ascontiguousarray(model.emit.T)  # (classes, states)

    def _in_order(self, x: np.ndarray) -> np.ndarray:
        """(len, rows, ...) -> by token."""
        return np.ascontiguousarray(x.swapaxes(0, 1)).reshape(-1, *x.shape[2:])[: self.n]

    def _advance(self, x: np.ndarray, t: int) -> np.ndarray:
        """x (rows, ..., states) at t - 1 -> t, before scaling; texts that start at t forget x but for its mass."""
        y = (x.reshape(-1, x.shape[-1]) @ self.model.step).reshape(x.shape)
        new = self.starts[t]
        if len(new):
            y[new] = x[new].sum(-1, keepdims=True) * self.model.start
        e = self.emit[self.obs[t]]
        y *= e if y.ndim == 2 else e[:, None, :]
        return y

    def transfers(self) -> np.ndarray:
        """(rows, states, states): what each piece does to the state before it, each up to a factor."""
        k = len(self.model.start)
        m = np.broadcast_to(np.eye(k), (self.rows, k, k)).copy()
        for t in range(self.len):
            m = self._advance(m, t)
            if t % 8 == 7 or t == self.len - 1:
                m /= m.sum((1, 2), keepdims=True)
        return m

    def forward(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled state weights (len, rows, states) and scales (len, rows)."""
        k = len(self.model.start)
        entry = np.empty((self.rows, k))
        x = np.full(k, 1.0 / k)
        for r in range(self.rows):
            entry[r] = x
            x = x @ m[r]
            x = x / x.sum()
        alpha, scale = np.empty((self.len, self.rows, k)), np.empty((self.len, self.rows))
        x = entry
        for t in range(self.len):
            x = self._advance(x, t)
            s = x.sum(1)
            x /= s[:, None]
            alpha[t], scale[t] = x, s
        return alpha, scale

    def log10(self) -> np.ndarray:
        """log10 P(class | what came before in its text) of each token."""
        return np.log10(self._in_order(self.forward(self.transfers())[1]))

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, steps and emissions."""
        model, k = self.model, len(self.model.start)
        m = self.transfers()
        alpha, _ = self.forward(m)
        leave = np.empty((self.rows, k))
        x = np.ones(k)
        for r in range(self.rows - 1, -1, -1):
            leave[r] = x
            x = m[r] @ x
            x = x / x.sum()
        step, beta = np.zeros((k, k)), leave
        before = np.vstack([np.full((1, k), 1.0 / k), alpha[-1, :-1]])  # the state weights ahead of each piece
        back_step = np.ascontiguousarray(model.step.T)
        for t in range(self.len - 1, -1, -1):
            eb = self.emit[self.obs[t]]
            eb *= beta
            g = alpha[t]
            g *= beta
            g /= g.sum(1, keepdims=True)  # alpha[t] is now the posterior of its states
            back, new = eb @ back_step, self.starts[t]
            a = alpha[t - 1] if t else before
            r = 1.0 / (a * back).sum(1)
            r[new] = 0.0
            step += (a * r[:, None]).T @ eb
            back[new] = (eb[new] @ model.start)[:, None]
            back /= back.sum(1, keepdims=True)
            beta = back
        gamma, obs = self._in_order(alpha), self._in_order(self.obs)
        emit = np.stack([np.bincount(obs, weights=gamma[:, s], minlength=model.emit.shape[1]) for s in range(k)])
        return gamma[self.first].sum(0), step * model.step, emit


def _side_by_side(model: Model, obs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of texts laid end to end in obs: all first tokens, then all second ones, the longest text first.

    Everything is held by state, (state, token), so each step works on the texts that reach so far in long rows.
    """
    k = len(model.start)
    rank = np.empty(len(sizes), np.int64)
    rank[np.argsort(-sizes, kind="stable")] = np.arange(len(sizes))
    left = len(sizes) - np.cumsum(np.bincount(sizes))[:-1]  # the texts that have a token at each place
    at = np.concatenate([[0], np.cumsum(left)])
    place = np.arange(len(obs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    laid = np.empty(len(obs), np.int64)
    laid[at[place] + np.repeat(rank, sizes)] = obs
    emit = np.take(model.emit, laid, axis=1)
    alpha, scale = np.empty_like(emit), np.empty(len(obs))
    x = np.repeat(model.start[:, None], left[0], axis=1)
    onward = np.ascontiguousarray(model.step.T)
    for t, m in enumerate(left):
        if t:
            x = onward @ x[:, :m]
        a, b = at[t], at[t + 1]
        x *= emit[:, a:b]
        s = x.sum(0, out=scale[a:b])
        x /= s
        alpha[:, a:b] = x
    emit /= scale
    step, beta = np.zeros((k, k)), np.ones((k, left[-1]))
    for t in range(len(left) - 1, 0, -1):
        a, b, m = at[t], at[t + 1], left[t]
        eb = emit[:, a:b]
        eb *= beta
        before = at[t - 1]
        step += alpha[:, before : before + m] @ eb.T
        alpha[:, a:b] *= beta  # the posterior of its states from here on
        beta = np.ones((k, left[t - 1]))
        np.matmul(model.step, eb, out=beta[:, :m])
    alpha[:, : at[1]] *= beta
    out = np.stack([np.bincount(laid, weights=g, minlength=model.emit.shape[1]) for g in alpha])
    return alpha[:, : at[1]].sum(1), step * model.step, out


def expected_counts(model: Model, stream: np.ndarray) -> np.ndarray:
    """Packed expected counts of a stream of whole texts, each closed by its end token."""
    ends = np.flatnonzero(stream == 0)
    sizes = np.diff(ends, prepend=-1)
    short = sizes <= SIDE_TOKENS
    here = np.repeat(short, sizes)
    total = np.zeros(len(model.start) * (1 + model.step.shape[1] + model.emit.shape[1]))
    if short.any():
        total += _pack(*_side_by_side(model, stream[here], sizes[short]))
    if not short.all():
        total += _pack(*_Stream(model, stream[~here]).expected())
    return total


def _streams(texts: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    held, n = [], 0
    for x in texts:
        held.append(x)
        n += len(x)
        if n >= STREAM_TOKENS:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def _shut(x: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes, which are mostly alike from the second on."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _open(raw: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).reshape(-1)


def _classes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        for x in b.column(0):
            yield _open(x.as_py(), "<u2").astype(np.int64)


class Numbers(dict):
    """word -> its number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = x = len(self)
        return x


def _part_dictionary(words: list[bytes], buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Words dealt to buckets by their hash: the order by bucket and word, and (bucket, from, to) of each."""
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    return order, [(int(bucket[order[i]]), int(i), int(j)) for i, j in zip(cuts, cuts[1:], strict=False)]


def stage_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, dictionaries, training), staged once. texts: block, doc_id, held_out, loc; dictionaries: block, bucket, words, counts;
    training: cls, the classes of a block's training texts, each text closed by its end token.

    A block's dictionary is dealt to buckets by a hash of the word and packed, a row for each bucket; the numbers in
    `loc` follow the order of buckets and of words in them.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    buckets = min(BUCKETS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    picked = docs.select(
        F.col(id_col).alias("doc_id"), (doc_hash_mod(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    schema = f"kind int, block long, doc_id {kind.simpleString()}, held_out boolean, c binary, loc binary, bucket int, words binary, counts binary"
    names = ["kind", "block", "doc_id", "held_out", "c", "loc", "bucket", "words", "counts"]

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq, id_type = TaskContext.get().partitionId() << 24, 0, None
        numbers, ids, held, locs, tokens = Numbers(), [], [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            words = list(numbers)
            order, parts = _part_dictionary(words, buckets)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            cls = np.array([word_class(words[i]) if words[i] else 0 for i in order], "<u2")
            moved = [place[x] for x in locs]
            training = [x for x, out in zip(moved, held, strict=True) if not out]
            counts = np.bincount(np.concatenate(training), minlength=len(words)) if training else np.zeros(len(words), np.int64)
            packer = zstandard.ZstdCompressor(level=1)
            rows = [
                (j, packer.compress(b"\n".join([words[i] for i in order[a:b]])), _shut(counts[a:b].astype("<i4"))) for j, a, b in parts
            ]
            k, m = len(ids), len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(k, np.int32)), pa.array(np.full(k, base + seq)), pa.array(ids, id_type), pa.array(held, pa.bool_()),
                    pa.nulls(k, pa.binary()),
                    pa.array([_shut(x.astype("<i4")) for x in moved], pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()),
                ],
                names,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(m, np.int32)), pa.array(np.full(m, base + seq)), pa.nulls(m, id_type), pa.nulls(m, pa.bool_()),
                    pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()),
                ],
                names,
            )
            if training:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([2], pa.int32()), pa.array([base + seq]), pa.nulls(1, id_type), pa.nulls(1, pa.bool_()), pa.array([_shut(cls[np.concatenate(training)])], pa.binary()),
                        pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                    ],
                    names,
                )

        for b in batches:
            id_type = b.schema.field(0).type
            for i, out, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                words = (text.as_py() or "").encode().lower().split()
                words.append(END)
                locs.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                ids.append(i)
                held.append(out)
                tokens += len(words)
                if tokens >= BLOCK_TOKENS:
                    yield from close()
                    numbers, ids, held, locs, tokens, seq = Numbers(), [], [], [], 0, seq + 1
        if ids:
            yield from close()

    path = scratch_path(spark, "texts")
    staged = picked.mapInArrow(tokenise, schema)
    staged.write.partitionBy("kind").parquet(path)
    stored = [spark.read.schema(staged.schema).parquet(path).where(F.col("kind") == k) for k in (0, 1, 2)]  # reads of their own, so that they can meet
    texts = stored[0].select("block", "doc_id", "held_out", "loc")
    return texts, stored[1].select("block", "bucket", "words", "counts"), stored[2].select(F.col("c").alias("cls"))


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[dict]]]:
    """Rows sorted by bucket, a bucket at a time and a row at a time."""

    def rows():
        for b in batches:
            for i, bucket in enumerate(b.column("bucket").to_pylist()):
                yield bucket, {n: c[i].as_py() for n, c in zip(b.schema.names, b.columns, strict=True)}

    for bucket, held in itertools.groupby(rows(), key=lambda r: r[0]):
        yield bucket, (r for _, r in held)


def _unpacked(words: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(words).split(b"\n")


def sum_words(dictionaries: DataFrame) -> DataFrame:
    """Corpus counts of each bucket's words: bucket, words, counts (packed, at most TOTAL_WORDS a row); and rows without words
    that have a bucket's class totals: bucket (the class), tokens, known.

    A task holds the distinct words of one bucket; the parts of the blocks pass by.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            numbers, total = Numbers(), np.zeros(1024, np.int64)
            for r in rows:
                split = _unpacked(r["words"])
                at = np.fromiter(map(numbers.__getitem__, split), np.int64, len(split))
                if len(numbers) > len(total):
                    total = np.concatenate([total, np.zeros(len(numbers), np.int64)])
                total[at] += _open(r["counts"], "<i4")
            total, words = total[: len(numbers)], list(numbers)
            cls = np.array([word_class(w) if w else 0 for w in words], np.int64)
            tokens, known = np.bincount(cls, weights=total).astype(np.int64), np.bincount(cls[total > 0], minlength=int(cls.max()) + 1)
            has, packer = np.flatnonzero(tokens), zstandard.ZstdCompressor(level=1)
            cuts = range(0, len(words), TOTAL_WORDS)
            k, m = len(cuts), len(has)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.full(k, bucket), has]).astype(np.int32)),
                    pa.array([packer.compress(b"\n".join(words[i : i + TOTAL_WORDS])) for i in cuts] + [None] * m, pa.binary()),
                    pa.array([_shut(total[i : i + TOTAL_WORDS].astype("<i8")) for i in cuts] + [None] * m, pa.binary()),
                    pa.array([None] * k + tokens[has].tolist(), pa.int64()),
                    pa.array([None] * k + known[has].tolist(), pa.int64()),
                ],
                ["bucket", "words", "counts", "tokens", "known"],
            )

    ordered = _dealt(dictionaries.select("bucket", "words", "counts"), "bucket")
    return materialize(ordered.mapInArrow(add_up, "bucket int, words binary, counts binary, tokens long, known long"), "totals")


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "bucket").sortWithinPartitions(*order)


def count_words(dictionaries: DataFrame, totals: DataFrame) -> DataFrame:
    """The corpus counts of each block's words: block, bucket, counts, cls. A bucket's totals come first, then its blocks."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            counts: dict[bytes, int] = {}
            found = []
            for r in rows:
                split = _unpacked(r["words"])
                if r["block"] < 0:
                    counts.update(zip(split, _open(r["counts"], "<i8").tolist(), strict=True))
                    continue
                count = np.fromiter(map(counts.__getitem__, split), "<i8", len(split))
                cls = np.fromiter((word_class(w) if w else 0 for w in split), "<u2", len(split))
                found.append((r["block"], bucket, _shut(count), _shut(cls)))
                if len(found) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), kinds, strict=True)], names)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), kinds, strict=True)], names)

    names, kinds = ["block", "bucket", "counts", "cls"], [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    known = totals.where("words is not null").select(F.lit(-1).cast("long").alias("block"), "bucket", "words", "counts")
    both = _dealt(known.union(dictionaries.select("block", "bucket", "words", "counts")), "bucket", "block")
    return both.mapInArrow(answer, "block long, bucket int, counts binary, cls binary")


def _pack(start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> np.ndarray:
    return np.concatenate([start, step.ravel(), emit.ravel()])


def _unpack(flat: np.ndarray, states: int, classes: int) -> Model:
    a, b = states, states + states * states
    return from_counts(flat[:a], flat[a:b].reshape(states, states), flat[b:].reshape(states, classes))


def first_model(tokens: np.ndarray, states: int, seed: int = 7) -> Model:
    """From class totals: emissions dealt to the states in random shares, and steps that mostly stay."""
    share = np.random.default_rng(seed).exponential(size=(states, len(tokens))) ** SHARPNESS
    n = tokens.sum() / states
    return from_counts(np.zeros(states), np.full((states, states), 0.02 * n / states) + np.eye(states) * n, tokens * share / share.sum(0))


def train_model(training: DataFrame, tokens: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch; training: cls as staged, tokens: the number of training tokens of each class."""
    spark, classes = training.sparkSession, len(tokens)
    if not tokens.sum():
        return uniform(states, classes)
    model = first_model(tokens, states)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for stream in _streams(_classes_of(batches)):
                one = expected_counts(sent.value, stream)
                total = one if total is None else total + one
            if total is not None:
                whole = np.rint(total * UNIT).astype(np.int64)
                at = np.flatnonzero(whole)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(whole[at])], ["k", "v"])

        sums = training.mapInArrow(count, "k long, v long").groupBy("k").agg(F.sum(F.col("v").cast("decimal(28,0)")).alias("v")).collect()
        flat = np.zeros(states + states * states + states * classes)
        for r in sums:
            flat[r["k"]] = int(r["v"]) / UNIT
        model = _unpack(flat, states, classes)
        sent.unpersist()
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, classes: int = CLASSES) -> DataFrame:
    spark = docs.sparkSession
    texts, dictionaries, training = stage_texts(docs, id_col, text_col)
    totals = sum_words(dictionaries)
    by_class = totals.where("words is null").groupBy("bucket").agg(F.sum("tokens").alias("n"), F.sum("known").alias("v")).collect()
    tokens, known = np.zeros(classes), np.zeros(classes)
    for r in by_class:
        tokens[r["bucket"]], known[r["bucket"]] = r["n"], r["v"]
    n, v = int(tokens.sum()), int(known.sum())
    inside = -np.log10(tokens + known + 1)  # of a word's share in its class, but for log10(c + 1)
    model = train_model(training, tokens, states)
    sent = spark.sparkContext.broadcast((model, inside))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        model, inside = sent.value
        ids, held = left.column("doc_id"), left.column("held_out")
        rows = sorted(zip(right.column("bucket").to_pylist(), right.column("counts"), right.column("cls"), strict=True), key=lambda r: r[0])
        count = np.concatenate([_open(c.as_py(), "<i8") for _, c, _ in rows])
        cls = np.concatenate([_open(c.as_py(), "<u2") for _, _, c in rows]).astype(np.int64)
        logs = np.log10(count + 1.0)
        locs = [_open(x.as_py(), "<i4") for x in left.column("loc")]
        obs = [cls[x] for x in locs]
        sizes = np.array([len(x) for x in locs], np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        flat, seen = np.concatenate(obs), np.concatenate(locs)
        shares = np.where(flat == 0, 0.0, logs[seen] + inside[flat])
        hidden = np.concatenate([_Stream(model, x).log10() for x in _streams(iter(obs))])
        base = np.add.reduceat(logs[seen], at) - sizes * np.log10(n + v + 1.0)
        return pa.table(
            {
                "doc_id": ids, "held_out": held, "n_tokens": pa.array(sizes), "n_known": pa.array(np.add.reduceat((count[seen] > 0).astype(np.int64), at)),
                "train_tokens": pa.array(np.full(len(sizes), n, np.int64)), "base_score": pa.array(base),
                "score": pa.array(np.add.reduceat(hidden + shares, at)),
            }
        )

    found = count_words(dictionaries, totals)
    met = texts.select("block", "doc_id", "held_out", "loc").groupBy("block").cogroup(found.groupBy("block"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return met.applyInArrow(score, out)


def op3_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
