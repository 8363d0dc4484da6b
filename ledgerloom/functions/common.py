"""Small column helpers shared by the cleaning stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whitespace() -> str:
    """Every character Python's ``str.strip()`` removes (built from the rule)."""
    return "".join(chr(c) for c in range(0x3100) if chr(c).isspace())


WHITESPACE = _whitespace()


def strip_ws(c: Column) -> Column:
    """Trim Unicode whitespace at both ends (plain ``trim`` only removes
    spaces): a character-set trim, no regex."""
    return F.btrim(c, F.lit(WHITESPACE))
