r"""Line-first quality rules: failing lines go, then documents that lose too much text.

A line of n words (n > 0) fails on the first rule that holds:
  symbols     at least 3 characters of [#*$%&|<>], and one for every two words or more
  shouting    at least 4 words that end in "!", and half of the words or more
  navigation  at least 3 words that are only a separator (| / > - or a bullet), and a sixth of the words or more
  links       a word that begins like an address (http://, https://, www.), and half of the words or more
  menu        at most 4 words without a mark of ENDS at the end, in a run of 5 such lines or more (lines without words
              aside): a list of places to go and no text
  repetition  10 words or more, of which at most a third are distinct
  boilerplate 20 words or fewer, and a phrase of BOILERPLATE in the line with A-Z lower-cased
  repeated    3 words or more, equal to an earlier line of the text
Lines without words are never removed. A document that fails the base checks, or that loses over `max_lost_pct` of its
words with the failing lines, is rejected.

Defined results: null and empty texts have no words and fail the base checks; very long texts are judged whole; every
input row gives one result, repeated ids and rows included; extra columns are ignored by `assess` and kept by
`clean_rows`; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import WORD_SQL, read_table

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LOST_PCT = 30
SYMBOLS = b"#*$%&|<>"
SEPARATORS = ("|", "/", ">", "-", "•", "·", "»", "›")
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under", "terms of use", "terms of service", "privacy policy",
    "accept cookies", "uses cookies", "enable javascript", "subscribe to our newsletter", "alle rechte vorbehalten",
    "tous droits r", "todos los derechos reservados", "lorem ipsum", "skip to content", "back to top", "share this article", "cookie policy",
    "sign up for our",
)
#: What ends a sentence, a quotation or an introduction.
ENDS = (".", "!", "?", ":", ";", "…", '"', "'", ")", "]", "。", "！", "？", "；", "：", "”", "’", "»")
MENU_WORDS, MENU_LINES = 4, 5
_ENDS = tuple(e.encode() for e in ENDS)
_ADDRESS = (b"http://", b"https://", b"www.")
_SEPARATORS = frozenset(s.encode() for s in SEPARATORS)
_BOILERPLATE = tuple(p.encode() for p in BOILERPLATE)
_BLANKS = " \t\n\r\x0b\x0c"


def line_fails(line: bytes, words: list[bytes]) -> bool:
    """Whether a line with these words fails by itself; the rules on repeated lines and menus need the text."""
    n = len(words)
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if symbols >= 3 and 2 * symbols >= n:
        return True
    if b"!" in line:
        shouted = sum(w.endswith(b"!") for w in words)
        if shouted >= 4 and 2 * shouted >= n:
            return True
    if b"://" in line or b"ww." in line.lower():
        if 2 * sum(w.lower().startswith(_ADDRESS) for w in words) >= n:
            return True
    bars = sum(map(_SEPARATORS.__contains__, words))
    if bars >= 3 and 6 * bars >= n:
        return True
    if n >= 10 and 3 * len(set(words)) <= n:
        return True
    if n <= 20:
        low = line.lower()
        return any(p in low for p in _BOILERPLATE)
    return False


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts, last, total = Counter(windows), -1, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 2 - max(last, i - 1)
            last = i + 2
    return total


def assess_text(text: str | None, max_lost_pct: int = MAX_LOST_PCT) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lost_words, cleaned text."""
    text = text or ""
    raw = text.encode()
    seen: set[bytes] = set()
    lines, everything, dups, run = [], [], 0, []
    for line in raw.split(b"\n"):
        words = line.split()
        everything += words
        fails = False
        if words:
            again = line in seen
            seen.add(line)
            dups += again
            fails = (again and len(words) >= 3) or line_fails(line, words)
            if len(words) > MENU_WORDS or words[-1].endswith(_ENDS):
                run = []
            else:
                run.append(len(lines))
                if len(run) == MENU_LINES:
                    for i in run[:-1]:
                        lines[i][2] = True
                fails = fails or len(run) >= MENU_LINES
        lines.append([line, len(words), fails])
    lost = sum(k for _, k, fails in lines if fails)
    stays = [line for line, _, fails in lines if not fails]
    n = len(everything)
    chars = len(text) - sum(map(text.count, _BLANKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    repeats = repeat_words(everything)
    base_failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PCT * n
    kept = not base_failed and 100 * lost <= max_lost_pct * n
    return n, chars, symbols, dups, repeats, base_failed, kept, lost, b"\n".join(stays).decode()


_FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lost_words", pa.int64()),
]


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost_pct: int = MAX_LOST_PCT) -> DataFrame:
    """One row for each document: its id, the measures, the verdict and how many words its failing lines held."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [assess_text(t.as_py(), max_lost_pct)[:-1] for t in b.column(1)]
            cols = zip(*rows, strict=True) if rows else [[] for _ in _FIELDS]
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(cols, _FIELDS, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], [id_col, *(n for n, _ in _FIELDS)])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lost_words long"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(emit, schema)


def clean_rows(docs: DataFrame, text_col: str = "text", max_lost_pct: int = MAX_LOST_PCT) -> DataFrame:
    """Kept documents with their failing lines removed; n_chars, where there is one, follows the text."""
    names = docs.columns
    at = names.index(text_col)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [assess_text(t.as_py(), max_lost_pct) for t in b.column(at)]
            stay = pa.array([x[6] for x in found], pa.bool_())
            texts = pa.array([x[8] for x in found], b.schema.field(at).type)
            yield b.set_column(at, b.schema.field(at), texts).filter(stay)

    out = docs.mapInArrow(emit, docs.schema)
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _any_phrase(line: str) -> str:
    return "(" + " OR ".join(f"contains({line}, '{p}')" for p in BOILERPLATE) + ")"


_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT rid, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
split AS (SELECT *, regexp_extract_all(line, {WORD_SQL}) AS ws FROM lines),
judged AS (
  SELECT rid, line, pos, ws, len(ws) AS n, length(line) - length(translate(line, '#*$%&|<>', '')) AS sym,
         len(list_filter(ws, lambda w: suffix(w, '!'))) AS bang,
         len(list_filter(ws, lambda w: w IN ({", ".join(f"'{s}'" for s in SEPARATORS)}))) AS bars,
         len(list_distinct(ws)) AS uniq, len(list_filter(ws, lambda w: regexp_matches(w, '^(?i:https?://|www\\.)'))) AS urls, row_number() OVER (PARTITION BY rid, line ORDER BY pos) > 1 AS again
  FROM split WHERE len(ws) > 0),
marked AS (
  SELECT *, n <= {MENU_WORDS} AND right(ws[n], 1) NOT IN ({", ".join("'" + e.replace("'", "''") + "'" for e in ENDS)}) AS open FROM judged),
islands AS (SELECT *, sum(CASE WHEN open THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY pos) AS island FROM marked),
menus AS (SELECT *, open AND sum(CASE WHEN open THEN 1 ELSE 0 END) OVER (PARTITION BY rid, island) >= {MENU_LINES} AS menu FROM islands),
failed AS (
  SELECT rid, n, again, menu OR (urls >= 1 AND 2 * urls >= n) OR (again AND n >= 3) OR (sym >= 3 AND 2 * sym >= n) OR (bang >= 4 AND 2 * bang >= n)
    OR (bars >= 3 AND 6 * bars >= n) OR (n >= 10 AND 3 * uniq <= n)
    OR (n <= 20 AND {_any_phrase(_ASCII_LOWER.format("line"))}) AS fails
  FROM menus),
by_line AS (
  SELECT rid, sum(n) AS n_words, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(n) FILTER (fails), 0) AS n_lost_words
  FROM failed GROUP BY rid),
words AS (
  SELECT rid, unnest(ws) AS w, pos, generate_subscripts(ws, 1) AS k FROM split WHERE len(ws) > 0),
placed AS (
  SELECT rid, w, row_number() OVER (PARTITION BY rid ORDER BY pos, k) AS p FROM words),
windows AS (
  SELECT rid, p, w AS a, lead(w) OVER d AS b, lead(w, 2) OVER d AS c FROM placed WINDOW d AS (PARTITION BY rid ORDER BY p)),
counted AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM windows WHERE c IS NOT NULL),
covered AS (SELECT DISTINCT rid, unnest([p, p + 1, p + 2]) AS p FROM counted WHERE n > 1),
repeats AS (SELECT rid, count(*) AS n_repeat_words FROM covered GROUP BY rid),
joined AS (
  SELECT d.doc_id, coalesce(l.n_words, 0) AS n_words, length(regexp_replace(d.text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(d.text) - length(translate(d.text, '#*$%&|<>', '')) AS n_symbols, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
         coalesce(r.n_repeat_words, 0) AS n_repeat_words, coalesce(l.n_lost_words, 0) AS n_lost_words
  FROM docs d LEFT JOIN by_line l USING (rid) LEFT JOIN repeats r USING (rid)),
based AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM joined)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_lost_words <= {MAX_LOST_PCT} * n_words AS kept, CAST(n_lost_words AS BIGINT) AS n_lost_words
FROM based
"""
