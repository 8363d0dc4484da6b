"""Merchant text cleaning (M1-M9) as column expressions.

Only NFKC (M1) needs Python: Spark has no NFKC function.  It runs as an Arrow
``pandas_udf`` and only on the distinct non-ASCII strings (see
``operators.merchants``); ASCII strings are already NFKC-normal.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES — cleaning patterns for merchant text.
PUNCT_CLASS = r"[\u2000-\u206F\u2E00-\u2E7F'\"·•*/\\(),@!?:;_\[\]#$%^&=+<>`~]+"
NOISE_WORDS = r"(?U)\b(store|store\s*#|atm|pos|terminal)\b"
LONG_NUMBERS = r"(?U)\b\d{4,}\b"
SPACED_LETTERS = r"(?U)\b([a-zA-Z])\s+(?=[a-zA-Z]\b)"
AGGRESSIVE_WORDS = r"(?U)\b(supercenter|super ctr|super ctr\.|super ctr|store|store\b|branch|branch\b|center|ctr|centre)\b"
SHORT_NUMBERS = r"(?U)\b\d{2,}\b"


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


# the optimizer would move a deterministic function below the distinct that feeds it, where it meets every row, and repeat it
nfkc = nfkc.asNondeterministic()


def is_ascii(c: Column) -> Column:
    return ~c.rlike(r"[^\x00-\x7F]")


def collapse_ws(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"(?U)\s+", " "), F.lit(" "))


def clean_merchant_expr(normalized: Column) -> Column:
    """M2-M8 on text that is already NFKC-normal; NULL -> ''."""
    s = F.lower(F.coalesce(normalized, F.lit("")))
    s = F.regexp_replace(s, PUNCT_CLASS, " ")
    s = F.regexp_replace(s, NOISE_WORDS, " ")
    s = F.regexp_replace(s, LONG_NUMBERS, " ")
    s = F.regexp_replace(s, SPACED_LETTERS, "$1")
    return collapse_ws(s)


def aggressive_clean_expr(cleaned: Column) -> Column:
    """M9: stronger pass for low-confidence strings."""
    s = F.regexp_replace(cleaned, AGGRESSIVE_WORDS, " ")
    s = F.regexp_replace(s, SHORT_NUMBERS, " ")
    return collapse_ws(s)
