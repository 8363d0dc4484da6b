"""J7 spending_report: group sums, shares, top group, report object.

* ``group_totals``  groupBy(key) sum with partial (map-side) aggregation;
  the NULL key is kept; an all-NULL group sums to 0.  Amounts are rounded
  HALF_UP to ``round_digits`` (None = off); listing order is by the
  *unrounded* sum, then key ascending with NULL last.
* ``with_share``    pct = amount / total, total = sum of the *rounded* group
  amounts, taken as a scalar subquery (no window over one partition, no join).
* ``top_group``     greatest rounded amount; ties go to the alphabetically
  first key, NULL counting as "" (so NULL wins a tie).  A distributed top-1.
* ``report_row``    the one-row report ``top_category, amount, top_amount,
  by_category[], total_usd`` with money text like ``$1,234.56`` (always two
  decimals).  Its list is one array: meant for categories.
* ``report_rows``   the same listing as rows, for groupings of any size.
* ``ranked_rows``   those rows with their place in the listing: range
  partitions by the listing order, a row number inside each, and the sizes of
  the partitions before it (one number per partition) - no single sorted task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import format_usd
from ledgerloom.session import materialize


def group_totals(
    df: DataFrame,
    group_col: str = "category",
    amount_col: str = "amount_usd",
    round_digits: int | None = 2,
) -> DataFrame:
    """``(group_col, amount_raw, amount, n_tx)``.  An unknown ``group_col``
    falls back to ``category``."""
    key = group_col if group_col in df.columns else "category"
    g = df.groupBy(F.col(key)).agg(
        F.coalesce(F.sum(amount_col), F.lit(0)).alias("amount_raw"),
        F.count(F.lit(1)).alias("n_tx"),
    )
    amount = F.round("amount_raw", round_digits) if round_digits is not None else F.col("amount_raw")
    return g.select(key, "amount_raw", amount.alias("amount"), "n_tx")


def total_of(grouped: DataFrame) -> Column:
    """Scalar subquery: sum of the (rounded) group amounts."""
    return grouped.select(F.coalesce(F.sum("amount"), F.lit(0))).scalar()


def pct_expr(amount: Column, total: Column) -> Column:
    return F.when(total != 0, amount.cast("double") / total.cast("double")).otherwise(F.lit(0.0))


def with_share(grouped: DataFrame) -> DataFrame:
    total = total_of(grouped)
    return grouped.withColumn("total", total).withColumn("pct", pct_expr(F.col("amount"), F.col("total")))


def top_group(grouped: DataFrame, key: str) -> DataFrame:
    return grouped.orderBy(F.col("amount").desc(), F.coalesce(F.col(key), F.lit("")).asc()).limit(1)



def report_rows(grouped: DataFrame, key: str) -> DataFrame:
    """``key, amount`` (text), ``pct``: one row per group, nothing gathered."""
    shared = with_share(grouped)
    return shared.select(key, format_usd(F.col("amount")).alias("amount"), "pct")


def ranked_rows(grouped: DataFrame, key: str) -> DataFrame:
    """``rank, key, amount`` (text), ``pct``: the listing with places from 1, by the unrounded
    sum downwards, then the key upwards, NULL last.  The ranges are written to the checkpoint folder."""
    order = [F.col("amount_raw").desc(), F.col(key).asc_nulls_last()]
    dealt = materialize(grouped.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = sorted(tuple(r) for r in dealt.groupBy("_part").count().collect())  # one row per range partition
    before = [(part, sum(n for _, n in sizes[:i])) for i, (part, _) in enumerate(sizes)]
    offsets = grouped.sparkSession.createDataFrame(before, "_part int, _before long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    total = total_of(dealt)
    ranked = dealt.withColumn("_place", place).join(F.broadcast(offsets), "_part")
    return ranked.select(
        (F.col("_before") + F.col("_place")).alias("rank"), key, format_usd(F.col("amount")).alias("amount"), pct_expr(F.col("amount"), total).alias("pct")
    )


def report_row(grouped: DataFrame, key: str, formatted: bool = True) -> DataFrame:
    """One-row report DataFrame.  ``formatted=False`` keeps every amount
    numeric (the raw summary)."""
    money = format_usd if formatted else (lambda c: c.cast("double"))
    item = F.struct(
        (-F.col("amount_raw")).alias("neg_raw"),
        F.col(key).isNull().alias("key_null"),
        F.col(key).cast("string").alias("k"),
        F.col("amount").alias("amt"),
    )
    tie_item = F.struct(
        (-F.col("amount")).alias("neg_amt"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("kk"),
        F.col(key).cast("string").alias("k"),
        F.col("amount").alias("amt"),
    )
    row = grouped.agg(
        F.sort_array(F.collect_list(item)).alias("items"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total"),
        F.min(tie_item).alias("top"),
    )
    by_cat = F.transform(
        F.col("items"),
        lambda it: F.struct(
            it["k"].alias("category"),
            money(it["amt"]).alias("amount"),
            pct_expr(it["amt"], F.col("total")).alias("pct"),
        ),
    )
    return row.select(
        F.col("top.k").alias("top_category"),
        F.coalesce(money(F.col("top.amt")), money(F.lit(0))).alias("amount"),
        F.coalesce(F.col("top.amt").cast("double"), F.lit(0.0)).alias("top_amount"),
        by_cat.alias("by_category"),
        money(F.col("total")).alias("total_usd"),
    )


def report_json(report: DataFrame) -> DataFrame:
    """``report_row`` -> one JSON string column ``report``.  Numbers are written
    as decimals (amounts with 2 places, shares with 6), never in exponents."""
    by_category = F.transform(
        "by_category", lambda x: F.struct(x["category"].alias("category"), x["amount"].alias("amount"), x["pct"].cast("decimal(12,6)").alias("pct"))
    )
    out = report.withColumn("by_category", by_category).withColumn("top_amount", F.col("top_amount").cast("decimal(38,2)"))
    cols = [F.col(c) for c in report.columns]
    return out.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("report"))
