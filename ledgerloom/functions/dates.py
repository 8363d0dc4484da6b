"""J2 clean_dates: free-text date -> DATE (``date_iso``).

Native expressions only.  Steps:
  D1 trim Unicode whitespace; empty -> NULL
  D2 strip ordinal suffixes after a digit (1st, 2nd, 3rd, 4th ...), a leading
     weekday name and a trailing time of day after a space or comma
  D3 numeric ``m/d/yy`` (``/`` or ``-``) gets a four-digit year: yy <= pivot
     -> 20yy, else 19yy; the parts are re-joined with ``/``
  D4 ISO date or ISO timestamp (``T``/space, optional ``Z`` or offset) -> the
     date as written (wall clock kept; never through the session zone)
  D5 numeric month-first, day-first when the month is impossible
  D6 year-first with ``-``, ``/`` or ``.``
  D7 month names, short or long, day before or after, commas and quote marks,
     trailing two-digit year with the same pivot
  D8 anything else -> NULL
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.common import strip_ws

DEFAULT_PIVOT = 25  # two-digit years 00..25 -> 2000s, 26..99 -> 1900s

# a leading weekday name and a trailing time of day carry no date information
WEEKDAY = r"(?i)^(monday|tuesday|wednesday|thursday|friday|saturday|sunday|mon|tues|tue|wed|thurs|thur|thu|fri|sat|sun)\b[.,]?\s*"
TIME_OF_DAY = r"(?i)(?:\s*,\s*|\s+)\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:am|pm)?(?:\s*(?:z|utc|gmt|[+-]\d{2}(?::?\d{2})?))?$"

WORD_FORMATS = ("MMM d yyyy", "MMMM d yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyy MMM d", "yyyy MMMM d")

_ISO = r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
_YMD = r"^\d{4}[./-]\d{1,2}[./-]\d{1,2}$"
_COMPACT = r"^\d{8}$"
_MDY = r"^\d{1,2}[./-]\d{1,2}[./-]\d{4}$"


def _two_digit_years(c: Column, pivot: int) -> Column:
    lo = _year_alternation(0, pivot)
    hi = _year_alternation(pivot + 1, 99)
    head = r"\b(\d{1,2})[/-](\d{1,2})[/-]"
    c = F.regexp_replace(c, head + "(" + lo + r")\b", "$1/$2/20$3") if lo else c
    c = F.regexp_replace(c, head + "(" + hi + r")\b", "$1/$2/19$3") if hi else c
    return c


def _year_alternation(lo: int, hi: int) -> str:
    """Regex alternation of two-digit years lo..hi (both inclusive)."""
    if lo > hi:
        return ""
    return "|".join(f"{y:02d}" for y in range(lo, hi + 1))


def _trailing_year(c: Column, pivot: int) -> Column:
    lo = _year_alternation(0, pivot)
    hi = _year_alternation(pivot + 1, 99)
    if lo:
        c = F.regexp_replace(c, r"(\s)(" + lo + r")$", "$120$2")
    if hi:
        c = F.regexp_replace(c, r"(\s)(" + hi + r")$", "$119$2")
    return c


def _steps(raw: Column, pivot: int) -> list[tuple[str, Column]]:
    """(name, expression) steps; each may read the names before it."""
    s3 = F.col("_d_s3")
    words = F.regexp_replace(F.regexp_replace(s3, r"[,.’‘'/\-]", " "), r"(?i)\bsept\b", "Sep")
    words = F.trim(F.regexp_replace(words, r"(?U)\s+", " "))
    words = F.when(words.rlike(r"^\d{4} "), words).otherwise(_trailing_year(words, pivot))
    return [
        ("_d_s1", F.nullif(strip_ws(raw), F.lit(""))),
        ("_d_s2", F.regexp_replace(F.col("_d_s1"), r"(?i)(\d)(st|nd|rd|th)", "$1")),
        ("_d_s2", F.regexp_replace(F.regexp_replace(F.col("_d_s2"), WEEKDAY, ""), TIME_OF_DAY, "")),
        ("_d_s3", _two_digit_years(F.col("_d_s2"), pivot)),
        ("_d_words", F.when(s3.rlike("[A-Za-z]"), words)),
        ("_d_mdy", F.when(s3.rlike(_MDY), F.translate(s3, ".-", "//"))),
    ]


def _final() -> Column:
    s3 = F.col("_d_s3")
    iso = F.when(s3.rlike(_ISO), F.try_to_date(F.regexp_extract(s3, _ISO, 1), "yyyy-M-d"))
    compact = F.when(s3.rlike(_COMPACT), F.try_to_date(s3, "yyyyMMdd"))
    ymd = F.when(s3.rlike(_YMD), F.try_to_date(F.translate(s3, "/.", "--"), "yyyy-M-d"))
    mdy = F.coalesce(F.try_to_date(F.col("_d_mdy"), "M/d/yyyy"), F.try_to_date(F.col("_d_mdy"), "d/M/yyyy"))
    named = F.coalesce(
        *[F.try_to_date(F.col("_d_words"), fmt) for fmt in WORD_FORMATS]
    )
    return F.coalesce(iso, compact, ymd, mdy, named)



def clean_dates(df: DataFrame, date_col: str = "date", out_col: str = "date_iso", pivot: int = DEFAULT_PIVOT) -> DataFrame:
    """Add ``date_iso`` (DATE) unless the column is already there.  Each
    step is its own projection, so every regex runs once per row; a
    generator ends the chain so pushed filters never inline it."""
    if out_col in df.columns:
        return df
    keep = list(df.columns)
    for name, e in _steps(F.col(date_col), pivot):
        df = df.withColumn(name, e)
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(F.struct(_final().alias(out_col)))))


def expand_two_digit_year_expr(raw: Column, pivot: int = DEFAULT_PIVOT) -> Column:
    """D1-D3 only: the text handed to the parsers (for inspection)."""
    s1 = F.nullif(strip_ws(raw), F.lit(""))
    return _two_digit_years(F.regexp_replace(s1, r"(?i)(\d)(st|nd|rd|th)", "$1"), pivot)
