"""J6 convert_to_usd: ``amount_usd = amount_decimal * rate(currency)``.

The rates table is a dimension of a few rows: broadcast left join, the big
side is never shuffled.  Symbol-like codes (``$``, ``C$``, ``Ξ`` ...) are
upper-cased and mapped to ISO codes first.  A missing currency means USD
unless ``assume_missing_usd=False``; a currency without a rate gives NULL, and
so does a value of more than 22 digits before the point (``fx_unconvertible``
counts both).  A caller's rates, dict or table, override the defaults by the
same rules (``dims.merge_rates``) and have one row per currency, so no row of
the big side is ever multiplied.

The product is exact to 16 decimals: amount and rate have 38 + 17 digits
together, more than a decimal holds, so whole and fractional part of the
amount are multiplied separately.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources import dims

USD_TYPE = T.DecimalType(38, 16)
USD_SQL_TYPE = "decimal(38,16)"


def _code_map():
    return F.create_map(*[F.lit(x) for pair in dims.CODE_ALIASES for x in pair])


def normalize_code(c):
    up = F.upper(c)
    return F.coalesce(F.element_at(_code_map(), up), up)


def convert_to_usd(
    df: DataFrame,
    amount_col: str = "amount_decimal",
    currency_col: str = "currency",
    *,
    rates: DataFrame | dict | None = None,
    assume_missing_usd: bool = True,
    out_col: str = "amount_usd",
    issue_col: str | None = None,
) -> DataFrame:
    spark = df.sparkSession
    if rates is None or isinstance(rates, dict):
        # a table the driver holds already: a few rows, or as many as the caller's dict
        side = F.broadcast(dims.rates_df(spark, rates))
    else:
        side = dims.merge_rates(dims.default_rates(spark), rates)  # Spark picks the join by its size
    reason = F.col("rate_issue") if "rate_issue" in side.columns else F.lit(None).cast("string")
    side = side.select(F.col("currency").alias("_fx_cur"), F.col("rate").alias("_fx_rate"), reason.alias("_fx_issue"))
    df = df.withColumn("_fx_code", normalize_code(F.col(currency_col)))
    df = df.withColumn("_fx_amount", F.col(amount_col).cast("decimal(38,18)"))
    df = df.withColumn("_fx_whole", F.expr("CAST(CASE WHEN _fx_amount < 0 THEN ceil(_fx_amount) ELSE floor(_fx_amount) END AS decimal(20,0))"))
    df = df.join(side, F.col("_fx_code") == F.col("_fx_cur"), "left")
    missing = F.col(currency_col).isNull() | (F.col(currency_col) == "")
    rate = F.when(missing, F.lit("1") if assume_missing_usd else F.lit(None)).otherwise(F.col("_fx_rate")).cast(dims.RATE_TYPE)
    if issue_col:
        no_rate = F.when((F.col("_fx_cur").isNull() & ~missing) | (missing & F.lit(not assume_missing_usd)), "no_rate")
        df = df.withColumn(issue_col, F.when(missing & F.lit(assume_missing_usd), F.lit(None)).otherwise(F.coalesce("_fx_issue", no_rate)))
    df = df.withColumn("_fx_rate", rate)
    usd = F.expr(
        f"try_add(try_cast(_fx_whole * _fx_rate AS {USD_SQL_TYPE}), "
        f"CAST(CAST(_fx_amount % CAST(1 AS decimal(1,0)) AS decimal(18,18)) * _fx_rate AS {USD_SQL_TYPE}))"
    )
    return df.withColumn(out_col, usd.cast(USD_TYPE)).drop("_fx_code", "_fx_cur", "_fx_rate", "_fx_issue", "_fx_amount", "_fx_whole")
