"""Token counts by the whole-token shortcut, for byte-fallback BPE piece models.

Before any text is read, each vocabulary string is merged alone; those that end as one token are proven whole. A text
is cut where no merge can reach across: before a space that follows another character (no piece holds one inside), and
around line ends (no piece of several characters holds one). Cuts that are whole tokens count one and are never
merged; the rest are merged by score, leftmost first, and remembered for the task, up to a number and a length. The model is read on the driver and
broadcast; its size is that of the vocabulary file (under 1 MB for 32,000 pieces), not of the data.

Defined results: null and empty texts have no bytes and no tokens; very long texts and words are merged in
n log n; special strings in a text are plain text, as the library's default has it; every row gives one result; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import Remembered, give_back, read_table

SPACE = "▁"
LIMIT = 4096
REMEMBERED = 200_000
LONGEST_REMEMBERED = 64


class PieceCounter:
    """Counts the tokens of texts. `scores` has the normal pieces only; other single characters cost their bytes."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        inner = [p for p in scores if any(b == SPACE != a for a, b in zip(p, p[1:], strict=False))]
        if inner:
            raise ValueError(f"pieces with a space after another character can't be cut at spaces: {inner[:3]}")
        alone = all("\n" not in p for p in scores if len(p) > 1)
        self.cuts = re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if alone else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.whole = frozenset(p for p in scores if self.merge(p) == 1)
        self._ready()

    def _ready(self) -> None:
        self.known = Remembered(self.merge, REMEMBERED, LONGEST_REMEMBERED)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def merge(self, text: str) -> int:
        """Tokens of one cut: the best-scored adjacent pair merges first, of equals the leftmost."""
        n = len(text)
        end = list(range(1, n + 1))  # of the symbol that starts here
        prev, live = list(range(-1, n - 1)), [True] * n
        scores = self.scores
        heap = [(-scores[p], i, i + 2) for i in range(n - 1) if (p := text[i : i + 2]) in scores]
        heapify(heap)
        count = n
        while heap:
            _, i, e = heappop(heap)
            if not live[i] or end[i] >= e:
                continue
            j = end[i]
            if j >= n or end[j] != e:
                continue
            live[j] = False
            end[i] = e
            count -= 1
            if e < n:
                prev[e] = i
                if (p := text[i : end[e]]) in scores:
                    heappush(heap, (-scores[p], i, end[e]))
            if (h := prev[i]) >= 0 and (p := text[h:e]) in scores:
                heappush(heap, (-scores[p], h, e))
        extra, i = 0, 0
        while i < n:
            if end[i] == i + 1 and text[i] not in scores:
                extra += len(text[i].encode()) - 1
            i = end[i]
        return count + extra

    def count(self, text: str) -> int:
        if not text:
            return 0
        total, known, whole = 0, self.known, self.whole
        for cut in self.cuts.findall(SPACE + text.replace(" ", SPACE)):
            total += 1 if cut in whole else known[cut]
        return total


def piece_scores(path: str) -> dict[str, float]:
    """The normal pieces of a model file, after checks that this operator counts as the library does."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    t, norm = model.trainer_spec, model.normalizer_spec
    kinds = {p.type for p in model.pieces}
    if t.model_type != 2 or not t.byte_fallback or t.treat_whitespace_as_suffix or kinds - {1, 2, 3, 6}:
        raise ValueError("only BPE models with byte fallback and without user-defined or unused pieces are counted")
    if norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only models with identity normalisation and a space put before the text are counted")
    return {p.piece: p.score for p in model.pieces if p.type == 1}


def count_tokens(docs: DataFrame, counter: PieceCounter, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(counter)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = sent.value
        for b in batches:
            sizes, tokens = [], []
            for t in b.column(1):
                text = t.as_py() or ""
                sizes.append(len(text.encode()))
                tokens.append(counter.count(text))
            over = [n > limit for n in tokens]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over, pa.bool_())],
                [id_col, "n_bytes", "n_tokens", "over_limit"],
            )
        counter.known.forget()
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        emit, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )


def op4_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), PieceCounter(piece_scores(path)))
