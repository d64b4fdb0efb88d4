"""Edit distances and word alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions import windows as bits

OPS_SCHEMA = "array<struct<op:string,ref:string,hyp:string,ref_pos:int,hyp_pos:int>>"


def char_distance(a: Column, b: Column, at_most: int | None = None) -> Column:
    """Unit-cost distance in code points; over `at_most` it is -1."""
    return F.levenshtein(a, b) if at_most is None else F.levenshtein(a, b, at_most)


def norm_distance(a: Column, b: Column) -> Column:
    """Distance over the longer length (1 at least), to 4 places."""
    return F.round(F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1)), 4)


def text_norm_distance(a: Column, b: Column) -> Column:
    """E3 for texts of hundreds of characters: the distance by bit vectors, in Python; equal texts aren't computed."""

    def away(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([bits.char_distance(x, y) for x, y in zip(left, right, strict=True)])

    away.__annotations__ = {"left": pd.Series, "right": pd.Series, "return": pd.Series}
    return F.round(F.pandas_udf(away, "int")(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1)), 4)


def word_distance(ref: Column, hyp: Column) -> Column:
    """Word edits of each pair, for a batch of pairs at once (see `aligned`)."""

    def edits(refs: pa.Array, hyps: pa.Array) -> pa.Array:
        return aligned(refs, hyps, False)

    edits.__annotations__ = {"refs": pa.Array, "hyps": pa.Array, "return": pa.Array}
    return F.arrow_udf(edits, "int")(ref, hyp)


def utterance_wer(edits: Column, ref_words: Column) -> Column:
    """E5: null without reference words; may exceed 1."""
    return F.try_divide(edits.cast("double"), ref_words.cast("double"))


EQUAL, SUBSTITUTE, DELETE, INSERT = range(4)
OP_NAMES = ("equal", "substitute", "delete", "insert")
SMALL = 4096


def _rows(first: np.ndarray, r: np.ndarray, h: np.ndarray, start: int) -> Iterator[np.ndarray]:
    """The rows of the cost table that follow `first`, that of place `start`."""
    steps, row = np.arange(len(h) + 1, dtype=np.int32), first
    for i, x in enumerate(r, start + 1):
        best = np.minimum(row[:-1] + (h != x), row[1:] + 1)
        # an insertion chain adds one for each step: the running minimum of (value - position) has them all
        row = np.minimum.accumulate(np.concatenate([[i], best]).astype(np.int32) - steps) + steps
        yield row


def _cost_rows(ref: str, hyp: str):
    """Row by place of the cost table. Long pairs keep every k-th row and compute those between again, a stretch at a time,
    so the memory is that of about 2 sqrt(n) rows."""
    n, m = len(ref), len(hyp)
    if n * m <= SMALL:
        rows = [list(range(m + 1))]
        for i, x in enumerate(ref, 1):
            above, left, row = rows[-1], i, [i]
            for j, y in enumerate(hyp):
                left = above[j] if x == y else 1 + min(above[j], above[j + 1], left)
                row.append(left)
            rows.append(row)
        return rows.__getitem__
    r, h = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (ref, hyp))
    k = max(64, int(n**0.5))
    kept, row = {0: np.arange(m + 1, dtype=np.int32)}, None
    for i, row in enumerate(_rows(kept[0], r, h, 0), 1):
        if i % k == 0:
            kept[i] = row
    stretch: dict[int, np.ndarray] = {}

    def at(i: int) -> np.ndarray:
        if i not in stretch:
            start = i // k * k
            above = stretch.get(start + k)  # the step back across the border needs both its rows
            stretch.clear()
            stretch[start] = kept[start]
            stretch.update(enumerate(_rows(kept[start], r[start : start + k], h, start), start + 1))
            if above is not None:
                stretch[start + k] = above
        return stretch[i]

    return at


def align(ref: str, hyp: str) -> list[tuple[int, int, int]]:
    """E6 for one pair with a character for each word: operation, place in ref, place in hyp.

    Among predecessors of equal cost the diagonal wins, then a deletion, then an insertion. Equal last words are always on
    the diagonal, so equal ends need no table.
    """
    i, j, ops = len(ref), len(hyp), []
    while i and j and ref[i - 1] == hyp[j - 1]:
        i, j = i - 1, j - 1
        ops.append((EQUAL, i, j))
    cost = _cost_rows(ref[:i], hyp[:j]) if i and j else None
    while i and j:
        here, above = cost(i), cost(i - 1)
        c = here[j]
        same = ref[i - 1] == hyp[j - 1]
        if c == above[j - 1] + (not same):
            i, j = i - 1, j - 1
            ops.append((EQUAL if same else SUBSTITUTE, i, j))
        elif c == above[j] + 1:
            i -= 1
            ops.append((DELETE, i, j))
        else:
            j -= 1
            ops.append((INSERT, i, j))
    ops += [(DELETE, k, 0) for k in range(i - 1, -1, -1)] + [(INSERT, 0, k) for k in range(j - 1, -1, -1)]
    return ops[::-1]


def align_words(ref: list[str], hyp: list[str]) -> list[tuple[str, str | None, str | None, int, int]]:
    """E6 for one pair of lists."""
    return [(OP_NAMES[o], None if o == INSERT else ref[i], None if o == DELETE else hyp[j], i, j) for o, i, j in align(*_as_text(ref, hyp))]


def packed_ops(ref: Column, hyp: Column) -> Column:
    """E6 as whole numbers, see `op_of`, `ref_place` and `hyp_place`.

    Only the traceback is Python, as it has no built-in; it gives back numbers, and words are put in by the engine.
    """

    def ops(refs: pa.Array, hyps: pa.Array) -> pa.Array:
        return aligned(refs, hyps, True)

    ops.__annotations__ = {"refs": pa.Array, "hyps": pa.Array, "return": pa.Array}
    return F.arrow_udf(ops, "array<bigint>")(ref, hyp)


#: Pairs of sides up to SHORT words are computed together, BLOCK at a time; their costs fit into 8 bits.
SHORT, BLOCK = 100, 4096


def aligned(refs: pa.Array, hyps: pa.Array, ops: bool) -> pa.Array:
    """Edits or packed operations of each pair of a batch; null where a side is.

    Words become numbers for the whole batch. Short pairs of about the same length share one cost table, whose rows and
    steps back are operations on all of them; long pairs are computed one by one.
    """
    null = (refs.is_null().to_numpy(zero_copy_only=False)) | (hyps.is_null().to_numpy(zero_copy_only=False))
    n_ref, n_hyp = (np.where(null, 0, x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) for x in (refs, hyps))
    at_ref, at_hyp = (np.asarray(x.offsets)[:-1] for x in (refs, hyps))
    words = pa.concat_arrays([refs.values, hyps.values]).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    of_ref, of_hyp = words[: len(refs.values)], words[len(refs.values) :]
    longest = np.maximum(n_ref, n_hyp)
    found: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    order = np.argsort(longest, kind="stable")
    short = order[: np.searchsorted(longest[order], SHORT, "right")]
    for k in range(0, len(short), BLOCK):
        rows = short[k : k + BLOCK]
        r, h = _padded(of_ref, at_ref[rows], n_ref[rows], -1), _padded(of_hyp, at_hyp[rows], n_hyp[rows], -2)
        cost = _cost_tables(r, h)
        if ops:
            found.append((rows, *_steps_back(cost, r, h, n_ref[rows], n_hyp[rows])))
        else:
            found.append((rows, cost[n_ref[rows], n_hyp[rows], np.arange(len(rows))], None))
    for row in order[len(short) :]:
        ids = np.unique(np.concatenate([of_ref[at_ref[row] :][: n_ref[row]], of_hyp[at_hyp[row] :][: n_hyp[row]]]), return_inverse=True)[1]
        text = "".join(chr(65536 + i) for i in ids.tolist())
        a, b = text[: n_ref[row]], text[n_ref[row] :]
        if ops:
            x = np.array([o | i << 2 | j << 32 for o, i, j in align(a, b)], np.int64)
            found.append((np.array([row]), np.array([len(x)]), x))
        else:
            found.append((np.array([row]), np.array([bits.char_distance(a, b)]), None))
    rows, n = np.concatenate([f[0] for f in found]).astype(np.int64), np.concatenate([f[1] for f in found]).astype(np.int64)
    if not ops:
        edits = np.zeros(len(null), np.int32)
        edits[rows] = n
        return pa.array(edits, mask=null)
    counts = np.zeros(len(null), np.int64)
    counts[rows] = n
    offsets = np.zeros(len(null) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    flat = np.concatenate([f[2] for f in found])
    values = np.empty(len(flat), np.int64)
    values[np.repeat(offsets[rows] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(null))


def _padded(words: np.ndarray, at: np.ndarray, n: np.ndarray, fill: int) -> np.ndarray:
    """A column for each pair: its words, then the fill."""
    place = np.arange(n.max(initial=0))[:, None]
    inside = place < n
    return np.where(inside, words[np.where(inside, at + place, 0)] if len(words) else fill, fill)


def _cost_tables(r: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The cost tables of a block of pairs, [place in ref, place in hyp, pair]."""
    steps = np.arange(len(h) + 1, dtype=np.int8)[:, None]
    cost = np.empty((len(r) + 1, len(h) + 1, r.shape[1]), np.int8)
    cost[0] = steps
    for i, word in enumerate(r, 1):
        row = cost[i]
        row[0] = i
        np.minimum(cost[i - 1][:-1] + (h != word), cost[i - 1][1:] + np.int8(1), out=row[1:])
        # an insertion chain adds one for each step: the running minimum of (value - position) has them all
        row -= steps
        np.minimum.accumulate(row, axis=0, out=row)
        row += steps
    return cost


def _steps_back(cost: np.ndarray, r: np.ndarray, h: np.ndarray, n_ref: np.ndarray, n_hyp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many operations each pair of a block has, and the packed operations of one pair after the other."""
    i, j, pair = n_ref.astype(np.int64), n_hyp.astype(np.int64), np.arange(len(n_ref))
    count = np.zeros(len(pair), np.int64)
    out = np.zeros((len(r) + len(h), len(pair)), np.int64)
    for step in out:
        if not len(pair):
            break
        both = (i > 0) & (j > 0)
        a, b = np.maximum(i - 1, 0), np.maximum(j - 1, 0)
        here, above = cost[i, j, pair], cost[a, j, pair]
        same = (r[a, pair] == h[b, pair]) if len(r) and len(h) else np.zeros(len(pair), bool)
        diagonal = both & (here == cost[a, b, pair] + ~same)
        delete = ~diagonal & ((j == 0) | (both & (here == above + 1)))
        op = np.where(diagonal, np.where(same, EQUAL, SUBSTITUTE), np.where(delete, DELETE, INSERT))
        i, j = np.where(diagonal | delete, a, i), np.where(delete, j, b)
        live = (n_ref[pair] + n_hyp[pair]) > 0
        step[pair] = op | i << 2 | j << 32
        count[pair] += live
        left = (i + j) > 0
        i, j, pair = i[left], j[left], pair[left]
    of = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    return count, out[count[of] - 1 - place, of]


def _as_text(ref: list[str], hyp: list[str]) -> tuple[str, str]:
    """A character for each word, those of the supplementary planes."""
    ids: dict[str, str] = {}
    for w in [*ref, *hyp]:
        if w not in ids:
            ids[w] = chr(65536 + len(ids))
    return "".join(map(ids.__getitem__, ref)), "".join(map(ids.__getitem__, hyp))


def op_of(x: Column) -> Column:
    return x.bitwiseAND(3).cast("int")


def op_name(x: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, OP_NAMES)), op_of(x) + 1)


def ref_place(x: Column) -> Column:
    return F.shiftright(x, 2).bitwiseAND((1 << 30) - 1).cast("int")


def hyp_place(x: Column) -> Column:
    return F.shiftright(x, 32).cast("int")


def ref_word(x: Column, ref: Column) -> Column:
    return F.when(op_of(x) != INSERT, F.get(ref, ref_place(x)))


def hyp_word(x: Column, hyp: Column) -> Column:
    return F.when(op_of(x) != DELETE, F.get(hyp, hyp_place(x)))


def word_ops(ref: Column, hyp: Column) -> Column:
    """The aligned operations of each pair, in order, as structs."""

    def one(x: Column) -> Column:
        return F.struct(op_name(x).alias("op"), ref_word(x, ref).alias("ref"), hyp_word(x, hyp).alias("hyp"), ref_place(x).alias("ref_pos"), hyp_place(x).alias("hyp_pos"))

    return F.transform(packed_ops(ref, hyp), one).cast(OPS_SCHEMA)
