"""Text normalisation and naming as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The spoken numbers that count as number words.
CARDINALS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion trillion lakh crore dozen "
    "hundreds thousands millions billions lakhs crores dozens"
).split()
ORDINALS = (
    "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth "
    "eighteenth nineteenth twentieth thirtieth fortieth fiftieth sixtieth seventieth eightieth ninetieth hundredth thousandth millionth"
).split()
NUMBER_WORDS = (*CARDINALS, *ORDINALS)


def _squeezed(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def words(col: Column) -> Column:
    """The words of a normalised text; the empty text has none."""
    return F.filter(F.split(col, " "), lambda w: w != "")


def clean_text(col: Column) -> Column:
    """Labels off, apostrophes deleted, everything but letters to spaces, lower case."""
    col = F.regexp_replace(col, r"(?U)spk_\w+:\s*", "")
    col = F.regexp_replace(col, "'", "")
    return F.lower(F.trim(F.regexp_replace(col, "[^a-zA-Z]+", " ")))


def _without_edge_apostrophes(col: Column) -> Column:
    return F.regexp_replace(col, r"(?<!\w)'|'(?!\w)", " ")


def align_text(col: Column) -> Column:
    """As T1, but apostrophes inside words stay."""
    col = F.regexp_replace(col, r"(?U)spk_\w+:\s*", "")
    return F.lower(_squeezed(_without_edge_apostrophes(F.regexp_replace(col, "[^a-zA-Z']", " "))))


def score_text(col: Column) -> Column:
    """T4: lower case, everything but letters, digits and spaces to spaces."""
    return F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))


def score_words(col: Column) -> Column:
    """T3 of T4 in one pass: the words of the text are cut out of it, without the text between."""
    return F.filter(F.split(F.lower(col), "[^a-z0-9]+"), lambda w: w != "")


def speaker_text(col: Column) -> Column:
    """T5: tags off, apostrophes inside words stay; labels stay."""
    return F.lower(_squeezed(_without_edge_apostrophes(F.regexp_replace(F.regexp_replace(col, "<[^>]+>", " "), "[^a-zA-Z']", " "))))


def join_words(arr: Column) -> Column:
    """The words that aren't blank, trimmed, with single spaces."""
    return F.array_join(F.filter(F.transform(arr, lambda w: F.trim(w)), lambda w: w != ""), " ")


def stem(file_no: Column) -> Column:
    return F.format_string("audio_file_%03d", file_no.cast("int"))


def chunk_name(file_no: Column, index: Column, start: Column, end: Column) -> Column:
    return F.format_string("audio_file_%03d_chunk_%06d_start%06d_end%06d.wav", *[c.cast("int") for c in (file_no, index, start, end)])


def segment_name(file_no: Column, speaker: Column, index: Column, start: Column, end: Column) -> Column:
    """T7; times are truncated."""
    whole = [c.cast("int") for c in (index, start, end)]
    return F.concat(stem(file_no), F.lit("_"), speaker, F.format_string("_seg_%06d_start%06d_end%06d.wav", *whole))


def name_times(name: Column) -> tuple[Column, Column]:
    """The seconds in a file name; null where there are none."""
    return tuple(F.nullif(F.regexp_extract(name, r"start(\d+)_end(\d+)", k), F.lit("")).cast("long") for k in (1, 2))


def file_number(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"_(\d+)$", 1), F.lit("")).cast("long")


def is_number_word(word: Column) -> Column:
    """T9"""
    return word.isin(*NUMBER_WORDS) | word.rlike("[0-9]")


def is_plural_pair(ref: Column, hyp: Column) -> Column:
    """The two differ by one final s."""
    return (ref != hyp) & ((F.concat(ref, F.lit("s")) == hyp) | (F.concat(hyp, F.lit("s")) == ref))


def hms(seconds: Column) -> Column:
    """H:MM:SS after rounding half to even."""
    s = F.bround(seconds, 0).cast("long")
    return F.format_string("%d:%02d:%02d", F.expr("0").cast("long") + F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)


def base_name(path: Column) -> Column:
    """T13"""
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def options(arr: Column) -> Column:
    """Distinct options in order without empty ones; never without any."""
    kept = F.array_distinct(F.filter(arr, lambda x: x.isNotNull() & (x != "")))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit("")))
