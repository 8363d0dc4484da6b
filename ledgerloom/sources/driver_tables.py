"""Driver tables and the messy transaction view ``tx`` derived from them.

The driver tables hold no messy transactions, so ``tx`` is derived from
``orders`` with fixed rules (one projection, no shuffle): the date text
takes one of eight shapes by ``o_orderkey % 8``, the amount text one of ten
by ``o_orderkey % 10`` and the merchant one of twelve by ``o_custkey % 12``
(plus a ``#n`` store suffix on every third order).  The same rules are
written in SQL for the oracle (``plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# FIXED VALUES — merchant strings of the derived view, by o_custkey % 12.
TX_MERCHANTS = [
    "UBER *TRIP",
    "Uber Technologies",
    "AMZN Mkt US",
    "WAL-MART SUPERCENTER 3301",
    "Walmart Super Ctr",
    "Starbucks",
    "SHELL OIL CO.",
    "NETFLIX.COM",
    "Monthly Rent - Landlord",
    "ATM Withdrawal",
    "Some Random Vendor 999",
    "",
]

# FIXED VALUES — date shapes by o_orderkey % 8 (Spark patterns).
TX_DATE_FORMATS = [
    "yyyy-MM-dd",
    "MM/dd/yy",
    "MMM d, yyyy",
    "yyyy.MM.dd",
    "yyyy-MM-dd'T23:30:00-05:00'",
    "d MMM yyyy",
    "yyyy/MM/dd",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a small, unsplittable input (one file, one row group) one task
    per core.  A large input already has many more scan tasks than cores,
    so it is left alone (no shuffle at scale)."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        n = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD access: leave the plan as is
        return df
    return df.repartition(target) if n < target else df


def messy_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx(tx_id, account_id, date, amount, merchant)``, all text but ids."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))
    k8 = F.col("o_orderkey") % 8
    date = F.lit("not a date")
    for i in reversed(range(len(TX_DATE_FORMATS))):
        date = F.when(k8 == i, F.date_format("o_orderdate", TX_DATE_FORMATS[i])).otherwise(date)
    t = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    k10 = F.col("o_orderkey") % 10
    amount = (
        F.when(k10 == 0, F.concat(F.lit("$"), t))
        .when(k10 == 1, F.concat(F.lit("("), t, F.lit(")")))
        .when(k10 == 2, F.concat(t, F.lit(" USD")))
        .when(k10 == 3, F.concat(F.lit("EUR"), t))
        .when(k10 == 4, F.concat(F.lit("€"), F.replace(t, F.lit("."), F.lit(","))))
        .when(k10 == 5, F.concat(F.lit("-£"), t))
        .when(k10 == 6, F.concat(t, F.lit(" JPY")))
        .when(k10 == 7, F.lit("12..00"))
        .when(k10 == 8, F.lit(""))
        .otherwise(F.concat(F.lit("ZZZ "), t))
    )
    base = F.element_at(F.array(*[F.lit(m) for m in TX_MERCHANTS]), (F.col("o_custkey") % 12 + 1).cast("int"))
    merchant = F.when(
        (F.col("o_orderkey") % 3 == 0) & (base != ""),
        F.concat(base, F.lit(" #"), (F.col("o_custkey") % 50).cast("string")),
    ).otherwise(base)
    return o.select(
        F.col("o_orderkey").alias("tx_id"),
        F.col("o_custkey").alias("account_id"),
        date.alias("date"),
        amount.alias("amount"),
        merchant.alias("merchant"),
    )


def precise_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx_id, amount``: amount texts from ``orders`` that test precision,
    signs after symbols, other digits and separators, and the limits of the
    amount type; the shape follows ``o_orderkey % 9``."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"))
    t = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    key = F.col("o_orderkey").cast("string")
    shapes = [
        F.concat(F.lit("Ξ0."), F.lpad(key, 18, "0")),
        F.concat(F.lit("£−"), t),
        F.concat(F.lit("€–"), F.replace(t, F.lit("."), F.lit(","))),
        F.concat(F.lpad(key, 17, "9"), F.lit(".25 JPY")),
        F.concat(F.lpad(key, 21, "9"), F.lit(" JPY")),
        F.concat(F.lit("0."), F.lpad(key, 19, "0"), F.lit("5 ETH")),
        F.translate(t, "0123456789.", "٠١٢٣٤٥٦٧٨٩٫"),
        F.concat(F.lit("7’000"), F.lit("\u2009"), t, F.lit(" CHF")),
        F.concat(F.lit("1."), t, F.lit(" INR")),
    ]
    amount = F.element_at(F.array(*shapes), (F.col("o_orderkey") % 9 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("tx_id"), amount.alias("amount"))


def varied_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx`` whose merchants grow in number with the customers: a word spelled
    from the customer number follows the merchant of ``tx``, on every third
    customer with an accented letter."""
    tx = messy_transactions(spark, sf_dir).drop("merchant")
    base = F.element_at(F.array(*[F.lit(m) for m in TX_MERCHANTS]), (F.col("account_id") % 12 + 1).cast("int"))
    word = F.translate(F.col("account_id").cast("string"), "0123456789", "bdfglmnprt")
    accent = F.when(F.col("account_id") % 3 == 0, "é").otherwise("")
    return tx.withColumn("merchant", F.trim(F.concat(base, F.lit(" "), word, accent)))


def worded_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx_id, amount``: amount texts from ``orders`` with both separators,
    currency words, symbols of several letters and symbols that no built-in
    table has; the shape follows ``o_orderkey % 12``."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"))
    t = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    three = F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")
    shapes = [
        F.concat(F.lit("€1."), three, F.lit(",25")),
        F.concat(F.lit("1,"), three, F.lit(".25 dollars")),
        F.concat(F.lit("(2 "), three, F.lit(" Euros)")),
        F.concat(t, F.lit(" pounds sterling")),
        F.concat(t, F.lit(" yen")),
        F.concat(F.lit("kr "), t),
        F.concat(F.lit("CA$"), t),
        F.concat(t, F.lit(" zł")),
        F.concat(F.lit("us$ "), t, F.lit(" $")),
        F.concat(F.lit("₿"), t),
        F.concat(t, F.lit(" star credits")),
        F.concat(F.lit("poundstore "), t),
    ]
    amount = F.element_at(F.array(*shapes), (F.col("o_orderkey") % 12 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("tx_id"), amount.alias("amount"))


def worded_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx_id, date``: the order date with ordinals, weekdays, month names, day
    first, compact and with a two-digit year after a name, by ``o_orderkey % 6``."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    day = F.dayofmonth("o_orderdate")
    suffix = F.when(day.isin(11, 12, 13), "th").when(day % 10 == 1, "st").when(day % 10 == 2, "nd").when(day % 10 == 3, "rd").otherwise("th")
    nth = F.concat(day.cast("string"), suffix)
    text = lambda pattern: F.date_format("o_orderdate", pattern)
    shapes = [
        F.concat(text("MMMM "), nth, text(", yyyy")),
        F.concat(nth, text(" MMM yyyy")),
        text("EEEE, d MMMM yyyy"),
        text("d.M.yyyy"),
        text("yyyyMMdd"),
        F.concat(text("MMM "), nth, text(" yy")),
    ]
    date = F.element_at(F.array(*shapes), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("tx_id"), date.alias("date"))
