"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints at three or fewer differing bits differ in at most
three bytes, so they share at least five of the eight, and at least three of any six. Postings are keyed by three
positional bytes out of the first six (20 keys of 2**24 values for each distinct fingerprint). Inside a posting list
every pair's shared positional bytes are tallied, pairs below five are dropped, and the rest are verified on bits.

Only distinct fingerprints are indexed, so exact copies never meet. A list longer than `max_list` is not compared: its
fingerprints move to keys of five positional bytes (56), and lists that are still longer to masked keys, each of which
blanks three of the 24 bits left: fingerprints with an equal masked key are linked without any comparison. Every tier
is exact; the length of a list decides only where its pairs are found.

Defined results: null and empty texts (and texts of white space) have fingerprint zero and link like any other; a text
of one or two words has one shingle; rows with equal text share a fingerprint whatever their ids; a component whose
ids are all null has a null component_id; extra columns pass through, and those named like a result column are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import connected_components, free_names, materialize, read_table

SEED = 42
MAX_BITS = 3
MIN_SHARED = 5
MAX_LIST = 1024


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        parts, n = [b" ".join(words)], 1
    else:
        parts, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)), len(words) - shingle + 1
    digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts, repeat(SEED))), np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        ones += np.unpackbits(digests[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fp") -> DataFrame:
    """Adds the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(texts):
        return texts.map(lambda t: _signed(fingerprint(t)) if isinstance(t, str) else 0).astype("int64")

    return docs.withColumn(out, fp(F.col(text_col)))


def _bytes_of(fps: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(fps.astype(">i8")).view(np.uint8).reshape(-1, 8)


def _keys(fps: np.ndarray, positions: int, take: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint and each choice of `take` of the first `positions` bytes: the posting key."""
    by = _bytes_of(fps).astype(np.int64)
    keys = []
    for k, chosen in enumerate(combinations(range(positions), take)):
        key = np.full(len(fps), k, np.int64)
        for p in chosen:
            key = (key << 8) | by[:, p]
        keys.append(key)
    return np.concatenate(keys), np.tile(fps, len(keys))


def _postings(fps: DataFrame, positions: int, take: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, fp = _keys(b.column(0).to_numpy(zero_copy_only=False), positions, take)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], ["key", "fp"])

    return fps.select("fp").mapInArrow(emit, "key long, fp long")


def _link_runs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys, reduced to one edge from each fingerprint to its run's smallest reachable one."""
    n = len(fp)
    by, bits = _bytes_of(fp), fp.view(np.uint64)
    left, right, d = [], [], 1
    live = np.flatnonzero(key[1:] == key[:-1]) if n > 1 else np.empty(0, np.int64)
    while len(live):
        tally = (by[live] == by[live + d]).sum(axis=1)
        close = live[tally >= MIN_SHARED]
        close = close[np.bitwise_count(bits[close] ^ bits[close + d]) <= MAX_BITS]
        left.append(close)
        right.append(close + d)
        d += 1
        live = live[live + d < n]
        live = live[key[live] == key[live + d]]
    if not left:
        return fp[:0], fp[:0]
    i, j = np.concatenate(left), np.concatenate(right)
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if np.array_equal(low, root):
            break
        root = low
    moved = np.flatnonzero(root != np.arange(n))
    return fp[moved], fp[root[moved]]


def _run_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; what may go on in the next batch waits, which is one list of at most `max_list` rows."""
    key, fp = np.empty(0, np.int64), np.empty(0, np.int64)
    for b in batches:
        key = np.concatenate([key, b.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([fp, b.column(1).to_numpy(zero_copy_only=False)])
        cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
        u, v = _link_runs(key[:cut], fp[:cut])
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
        key, fp = key[cut:], fp[cut:]
    u, v = _link_runs(key, fp)
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _blanks(chosen: tuple[int, ...]) -> np.ndarray:
    """For a choice of five bytes: the masks that leave three of the other 24 bits out."""
    places = [8 * (7 - p) + i for p in range(8) if p not in chosen for i in range(8)]
    return np.array([~((1 << x) | (1 << y) | (1 << z)) & (2**64 - 1) for x, y, z in combinations(places, MAX_BITS)], np.uint64)


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A five-byte key and its fingerprint -> that key with each choice of three of the 24 bits left blanked."""
    masks = [_blanks(chosen) for chosen in combinations(range(8), MIN_SHARED)]
    for b in batches:
        for key, fp in zip(b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False), strict=True):
            mask = masks[key >> 40]
            bare = (mask & np.int64(fp).view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bare), pa.array(~mask.view(np.int64)), pa.array(np.full(len(mask), fp, np.int64))], ["bare", "mask", "fp"]
            )


def _apart(postings: DataFrame, max_list: int) -> tuple[DataFrame, DataFrame]:
    """Postings of lists up to `max_list`, and of longer ones. Lists are counted with map-side sums."""
    long = postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max_list).select("key")
    return postings.join(long, "key", "left_anti"), postings.join(long, "key", "left_semi")


def fingerprint_links(fps: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """Distinct (fp long) -> (u, v): links at three or fewer bits, enough of them to span every component."""
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def linked(short: DataFrame) -> DataFrame:
        return short.repartition(n, "key").sortWithinPartitions("key", "fp").mapInArrow(_run_links, "u long, v long")

    short, hot = _apart(_postings(fps, 6, 3), max_list)
    hot = materialize(hot.select("fp").distinct(), "hot")
    links = materialize(linked(short), "links")
    if hot.isEmpty():
        return links
    short5, hot5 = _apart(_postings(hot, 8, MIN_SHARED), max_list)
    hot5 = materialize(hot5, "hot")
    links = links.union(materialize(linked(short5), "links"))
    if hot5.isEmpty():
        return links
    masked = materialize(hot5.mapInArrow(_masked, "bare long, mask long, fp long"), "masked")
    low = materialize(masked.groupBy("bare", "mask").agg(F.min("fp").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n"), "low")
    return links.union(masked.join(low, ["bare", "mask"]).select(F.col("fp").alias("u"), "v").where("u <> v").distinct())


def fingerprint_components(marks: DataFrame, id_col: str = "doc_id", max_list: int = MAX_LIST) -> DataFrame:
    """(id, fp) of every row -> one row for each fingerprint: fp, fp_root (of its component), component_id (least id)."""
    least = materialize(marks.groupBy("fp").agg(F.min(id_col).alias("least")), "least")
    parts = connected_components(fingerprint_links(least.select("fp"), max_list))
    rooted = least.join(parts, least.fp == parts.node, "left").select("fp", F.coalesce("root", "fp").alias("fp_root"), "least")
    rooted = materialize(rooted, "rooted")
    ids = rooted.groupBy("fp_root").agg(F.min("least").alias("component_id"))
    return materialize(rooted.join(ids, "fp_root").select("fp", "fp_root", "component_id"), "found")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_list: int = MAX_LIST) -> DataFrame:
    """docs plus `fp` (signed long), `fp_root` and `component_id`; only ids and fingerprints are staged."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("fp", "fp_root", "component_id")])
    wide = with_fingerprint(docs, text_col)
    marks = materialize(wide.select(id_col, "fp"), "marks")
    found = fingerprint_components(marks, id_col, max_list)
    return (marks if set(docs.columns) <= {id_col, text_col} else wide).join(found, "fp")


def hex_fingerprint(fp="fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_components(docs).select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that of the least id (null ids last; among equal ids, the first row).

    The rows get a row number while they are staged once; what goes is decided on (id, fp, row number) alone and taken
    out by an anti join on the unique row number, so no text is grouped and no hot component meets in a task.
    """
    fp, row = free_names(docs, "fp", "row")
    staged = materialize(with_fingerprint(docs, text_col, fp).withColumn(row, F.monotonically_increasing_id()), "docs")
    marks = staged.select(F.col(id_col).alias("id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    found = fingerprint_components(marks.select("id", "fp"), "id").select("fp", "fp_root")
    placed = materialize(marks.join(found, "fp").select("fp_root", "id", "row"), "placed")
    first = placed.groupBy("fp_root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("best"))
    goes = placed.select("row").join(first.select(F.col("best.row").alias("row")), "row", "left_anti")
    goes = materialize(goes.select(F.col("row").alias(row)), "goes")
    return staged.join(goes, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
