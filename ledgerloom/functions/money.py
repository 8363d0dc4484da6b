"""Money helpers: HALF_UP rounding (Spark ``round`` on decimals) and USD text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_usd(amount: Column, decimals: int = 2, use_symbol: bool = True) -> Column:
    """``$1,234.56`` (negative: ``$-23.40``) or ``1,234.56 USD``; NULL stays NULL.
    The value is rounded HALF_UP first, so formatting never rounds again."""
    txt = F.format_number(F.round(amount.cast("decimal(38,10)"), decimals), decimals)
    return F.concat(F.lit("$"), txt) if use_symbol else F.concat(txt, F.lit(" USD"))
