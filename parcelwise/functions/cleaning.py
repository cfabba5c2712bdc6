"""Trimming, NULL markers and tolerant casts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words the typed CSV reader treats as missing, and those the table load treats as missing.
CSV_NULL_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
LOAD_NULL_WORDS = ("", "NULL", "NaN", "<NA>")

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?inf(inity)?\s*$"


def strip_text(text: Column) -> Column:
    """Drop Unicode white space at both ends (``trim`` alone knows only the space character)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def null_words(text: Column, words: Iterable[str] = LOAD_NULL_WORDS) -> Column:
    return F.when(~text.isin(*words), text)


def to_stamp(text: Column) -> Column:
    """Unreadable dates become NULL."""
    return strip_text(text).try_cast("timestamp_ntz")


def to_real(text: Column) -> Column:
    """Unreadable numbers become NULL; the pattern keeps out spellings only the JVM accepts, such as ``1d``."""
    return F.when(text.rlike(_NUMBER), F.trim(text)).try_cast("double")


def to_whole(text: Column) -> Column:
    """As :func:`to_real`, then rounded half to even."""
    return F.rint(to_real(text)).try_cast("bigint")


def null_if_blank(text: Column) -> Column:
    """Line breaks to one space, outer spaces dropped, nothing left means NULL."""
    return F.nullif(F.trim(F.regexp_replace(text, "[\n\r]+", " ")), F.lit(""))


def join_text(title: Column, message: Column, strict: bool = False) -> Column:
    """``title. message``. ``strict`` yields NULL when either part is missing, else the parts present are kept."""
    joined = F.trim(F.concat_ws(". ", title, message))
    if strict:
        return F.when(title.isNotNull() & message.isNotNull(), joined)
    return F.nullif(joined, F.lit(""))


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL when ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def equality_flag(left: Column, right: Column) -> Column:
    """1 when equal, 0 otherwise, NULL counting as not equal."""
    return F.when(left == right, 1).otherwise(0)
