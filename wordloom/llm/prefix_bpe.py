"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token exactly one vocabulary token can be the last of its encoding. An automaton finds the
tokens that end at each byte; a token is the last one if the token before it (stored for the shorter prefix) is
compatible with it, that is, if no merge would ever join across their border. Following the stored tokens back from
the end gives the ids. No merge queue is run. Encodings of pre-tokens are remembered for the task, up to a bound, and so
are the last tokens of the prefixes of their first bytes, from which other pre-tokens go on. The automaton's moves and the
pairs of tokens found compatible or not belong to the vocabulary; a worker keeps those it met, up to a bound.

Compatibility is decided by undoing the two tokens' merges in reverse order of time: at each moment the two symbols at
the border are known, and a merge of them that comes before the merge that uses up either of them joins the tokens.

The vocabulary is read on the driver and broadcast; its size is that of the file (1.5 MB), not of the data.

Defined results: null and empty texts have no ids (the hash of the empty text); added tokens in a text become their
own id, as the library's default has it; very long texts and pre-tokens take time in proportion to their length;
every row gives one result, repeated ids and rows included; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import Remembered, give_back, read_table

REMEMBERED = 150_000
LONGEST_REMEMBERED = 64
#: Moves and pairs that a worker keeps.
FACTS = 300_000
#: Pre-tokens that agree in so many first bytes share the work on them.
BEGINNING = 6
BEGINNINGS = 40_000
SLICE = 1000
NEVER = 1 << 60
#: The history of a token that no merge makes.
BYTE = (-1, -1, -1)
#: Fixed value: the published split pattern of byte-level BPE, with white space spelled as a Unicode property.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> dict[int, str]:
    """The printable stand-in for each byte: itself where printable, else the next free letter from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def plane_split() -> re.Pattern[str]:
    """SPLIT for texts without characters above U+FFFF, in half the time: `re` with the classes as `regex` knows them."""
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)

    def runs(kind: str) -> str:
        return "".join(f"\\u{ord(m[0]):04x}-\\u{ord(m[-1]):04x}" for m in regex.findall(rf"\p{{{kind}}}+", every))

    space, letters, numbers = map(runs, ("White_Space", "L", "N"))
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


class _State(dict):
    """A state of the automaton: byte -> next state, filled on demand. text: the longest end of what was read that begins
    a token; ends: length, id and pairs of each token that ends here, longest first."""

    __slots__ = ("ends", "owner", "text")

    def __missing__(self, byte: int) -> _State:
        return self.owner._move(self, byte)


class _Pairs(dict):
    """token before -> whether `token` may follow it, filled on demand; -1 is the begin of the pre-token."""

    __slots__ = ("owner", "token")

    def __missing__(self, left: int) -> bool:
        return self.owner._follows(self, left)


class PrefixBpe:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int]):
        self.vocab, self.added = vocab, added
        self.rank = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(merges)}
        self.parts = {vocab[a + b]: (vocab[a], vocab[b], r) for r, (a, b) in enumerate(merges)}
        if len(self.parts) != len(merges):
            raise ValueError("a token that two merges make has no single history")
        letters = byte_letters()
        self.table = {b: c for b, c in letters.items()}
        back = {c: b for b, c in letters.items()}
        self.bytes_of = {i: bytes(back[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in added.items()}
        self.valid = self._valid()
        self._ready()

    @classmethod
    def load(cls, path: str) -> PrefixBpe:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only byte-level BPE without normaliser or put-in space is encoded")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must match as they are")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls(model["vocab"], merges, {t["content"]: t["id"] for t in spec["added_tokens"]})

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("vocab", "added", "rank", "parts", "table", "bytes_of", "valid")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _ready(self) -> None:
        """What each process builds for itself: the tokens' bytes and their beginnings, the patterns and empty memories."""
        back = {c: b for b, c in self.table.items()}
        self.whole = {bytes(back[c] for c in t): i for t, i in self.vocab.items() if i in self.valid}
        self.prefixes = {t[:k] for t in self.whole for k in range(len(t) + 1)}
        ids = range(max(self.bytes_of) + 1)
        self.size, self.decimal = [len(self.bytes_of.get(i, b"")) for i in ids], [str(i) for i in ids]
        self.split, self.quick_split = regex.compile(SPLIT), plane_split()
        ordered = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.begun = Remembered(self._begin, BEGINNINGS)
        self.known = Remembered(self._piece, REMEMBERED, LONGEST_REMEMBERED)
        self.states = {}
        self._restart()

    def _restart(self) -> None:
        """An automaton without moves, and no pairs."""
        self.begun.forget()
        for state in self.states.values():
            state.clear()  # states lead to each other, so they would stay until the next collection
        self.held, self.states, self.pairs = 0, {}, {}
        self.root = self._state(b"")

    def forget(self) -> None:
        """Drops what a task has remembered of its texts; the broadcast object outlives the task in its worker."""
        self.known.forget()
        self.begun.forget()
        give_back()

    def _state(self, text: bytes) -> _State:
        found = self.states.get(text)
        if found is None:
            found = self.states[text] = _State()
            found.owner, found.text, ends = self, text, []
            for k in range(len(text)):
                token = self.whole.get(text[k:])
                if token is not None:
                    pairs = self.pairs.get(token)
                    if pairs is None:
                        pairs = self.pairs[token] = _Pairs()
                        pairs.owner, pairs.token = self, token
                    ends.append((len(text) - k, token, pairs))
            found.ends = tuple(ends)
        return found

    def _move(self, state: _State, byte: int) -> _State:
        text = state.text + bytes((byte,))
        while text not in self.prefixes:
            text = text[1:]
        found = self._state(text)
        if self.held < FACTS:
            state[byte] = found
            self.held += 1
        return found

    def _follows(self, pairs: _Pairs, left: int) -> bool:
        found = left < 0 or self._apart(left, pairs.token, NEVER)
        if self.held < FACTS:
            pairs[left] = found
            self.held += 1
        return found

    def _apart(self, left: int, right: int, until: int) -> bool:
        """Whether no merge across the border comes before `until`, the time at which the two tokens are used up."""
        rank, parts = self.rank, self.parts
        left_until = right_until = until
        left_parts, right_parts = parts.get(left, BYTE), parts.get(right, BYTE)
        while True:
            r = rank.get(left << 32 | right)
            if r is not None and r < left_until and r <= right_until:
                return False
            if left_parts[2] > right_parts[2]:
                _, left, left_until = left_parts
                left_parts = parts.get(left, BYTE)
            elif right_parts[2] >= 0:
                right, _, right_until = right_parts
                right_parts = parts.get(right, BYTE)
            else:
                return True

    def _valid(self) -> set[int]:
        """Tokens whose own bytes encode to them: both parts do, and nothing joins across before they merge."""
        found = {i for t, i in self.vocab.items() if i not in self.parts}
        for i, (a, b, r) in self.parts.items():  # in order of merging, so parts come first
            if a in found and b in found and self._apart(a, b, r):
                found.add(i)
        return found

    def _go_on(self, state: _State, last: list[int], raw: bytes) -> _State:
        """Adds to `last`, which has an entry for each shorter prefix, the last token of each prefix that ends in raw."""
        for byte in raw:
            state = state[byte]
            for length, token, pairs in state.ends:
                if pairs[last[-length]]:
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token for byte {byte}")
        return state

    def _begin(self, raw: bytes) -> tuple[_State, list[int]]:
        last = [-1]
        return self._go_on(self.root, last, raw), last

    def encode_bytes(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        one = self.whole.get(raw)
        if one is not None:
            return [one]
        if self.held >= FACTS:
            self._restart()
        state, last = self.begun[raw[:BEGINNING]]
        last = last.copy()
        self._go_on(state, last, raw[BEGINNING:])
        ids, end, size = [], len(raw), self.size
        while end:
            token = last[end]
            ids.append(token)
            end -= size[token]
        ids.reverse()
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")

    def _piece(self, piece: str) -> tuple[str, bytes]:
        """The decimal ids of a pre-token, and the bytes that its ids decode to."""
        ids = self.encode_bytes(piece.encode())
        decimal, bytes_of = self.decimal, self.bytes_of
        return ",".join([decimal[i] for i in ids]), b"".join([bytes_of[i] for i in ids])

    def pieces(self, text: str) -> list[tuple[str, bytes]]:
        """What each pre-token and added token gives, in order."""
        found, known = [], self.known.__getitem__
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                found.append((str(self.added[part]), part.encode()))
            elif part:
                plane = part.isascii() or len(part.encode("utf-16-le")) == 2 * len(part)
                found += map(known, (self.quick_split if plane else self.split).findall(part))
        return found

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.pieces(text) for i in ids.split(",")]

    def digest(self, text: str | None) -> tuple[int, str, str, str]:
        """Number of ids, hash of the ids, hash of the decoded text; and the ids as decimals."""
        found = self.pieces(text) if text else []
        ids = ",".join(map(itemgetter(0), found))
        decoded = b"".join(map(itemgetter(1), found)).decode("utf-8", errors="replace")
        return (
            ids.count(",") + 1 if ids else 0,
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
            ids,
        )


def digest_table(docs: DataFrame, bpe: PrefixBpe, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """docs -> id, number of ids, hash of the ids, hash of the text that they decode to; with_ids: the ids too."""
    sent = docs.sparkSession.sparkContext.broadcast(bpe)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = sent.value
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
        for b in (batch.slice(at, SLICE) for batch in batches for at in range(0, batch.num_rows, SLICE)):
            counts, ids, decoded, numbers = [], [], [], []
            for t in b.column(1):
                n, x, y, decimals = bpe.digest(t.as_py())
                counts.append(n)
                ids.append(x)
                decoded.append(y)
                if with_ids:
                    numbers.append(np.fromstring(decimals, np.int32, sep=",") if n else np.empty(0, np.int32))
            arrays = [b.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(numbers))))
            yield pa.RecordBatch.from_arrays(arrays, names)
        bpe.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        emit, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    )


def decode_table(encoded: DataFrame, bpe: PrefixBpe, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and ids -> id and the text that they decode to; null ids decode to null."""
    sent = encoded.sparkSession.sparkContext.broadcast(bpe)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if ids is None else sent.value.decode(ids) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(emit, f"`{id_col}` {kind}, text string")


def load_default() -> PrefixBpe:
    import public_tokenizers

    return PrefixBpe.load(public_tokenizers.path("byte_bpe_50k.json"))


def op10_prefix_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    bpe = PrefixBpe.load(path) if path else load_default()
    return digest_table(read_table(spark, sf_dir, "documents").select("doc_id", "text"), bpe)
