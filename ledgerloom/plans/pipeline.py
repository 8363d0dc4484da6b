"""End-to-end plans built from the jobs.

``spend_report_plan`` is the report path: amounts -> USD -> (merchant
resolution) -> category -> group totals.  Categories are a function of the
merchant, so the plan first aggregates USD per raw merchant (partial
aggregation before the shuffle: a merchant holding a third of all rows
becomes one row per map task), resolves and categorises only the distinct
merchants, and then sums per category.  No join back to the big table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.amounts import clean_amounts
from ledgerloom.functions.dates import clean_dates
from ledgerloom.operators.categorize import categorize
from ledgerloom.operators.fx import convert_to_usd
from ledgerloom.operators.merchants import resolve_distinct
from ledgerloom.operators.report import group_totals


def clean_transactions(df: DataFrame, *, default_currency: str | None = None) -> DataFrame:
    """Entry B: raw columns + ``date_iso, amount_decimal, currency, issues``."""
    if "date" in df.columns:
        df = clean_dates(df)
    if "amount" in df.columns and not {"amount_decimal", "currency", "issues"} <= set(df.columns):
        df = clean_amounts(df)
    if default_currency:
        df = df.withColumn("currency", F.coalesce(F.col("currency"), F.lit(default_currency)))
    return df


def usd_rows(df: DataFrame, *, rates=None, assume_missing_usd: bool = True) -> DataFrame:
    if "amount_decimal" not in df.columns or "currency" not in df.columns:
        df = clean_amounts(df)
    return convert_to_usd(df, rates=rates, assume_missing_usd=assume_missing_usd)


def merchant_totals(df: DataFrame, merchant_col: str = "merchant") -> DataFrame:
    """USD total and row count per raw merchant, and per canonical merchant
    where the rows carry one (partial + final hash agg).  Rows without a
    merchant column count as a NULL merchant; an all-NULL group sums to 0."""
    if merchant_col not in df.columns:
        df = df.withColumn(merchant_col, F.lit(None).cast("string"))
    keys = [c for c in (merchant_col, "merchant_canonical") if c in df.columns]
    total = F.coalesce(F.sum("amount_usd"), F.lit(0)).cast("decimal(38,16)")
    return df.groupBy(*keys).agg(total.alias("amount_usd"), F.count(F.lit(1)).alias("n_tx"))


def categorized_merchant_totals(
    df: DataFrame,
    *,
    resolve: bool = False,
    rates=None,
    aliases=None,
    threshold: int = 85,
    category_map=None,
    rules=None,
) -> DataFrame:
    """Per distinct raw merchant: USD total, count, canonical and category.  A
    canonical that the rows carry is used, unless ``resolve`` finds it anew."""
    if resolve:
        df = df.drop("merchant_canonical")
    per_merchant = merchant_totals(usd_rows(df, rates=rates))
    if resolve:
        # the second read of the source sees its merchant column only
        res = resolve_distinct(per_merchant, "merchant", aliases=aliases, threshold=threshold)
        per_merchant = per_merchant.join(
            res.select("merchant", "merchant_canonical"), per_merchant["merchant"].eqNullSafe(res["merchant"]), "left"
        ).drop(res["merchant"])
    return categorize(per_merchant, category_map=category_map, rules=rules)


def transactions_enriched(df: DataFrame, *, rates=None, aliases=None, threshold: int = 85, default_currency: str | None = None) -> DataFrame:
    """Every transaction with ``date_iso``, amount columns, ``merchant_canonical``,
    ``category`` and ``amount_usd``.  Merchants are resolved and categorised
    once per distinct string and joined back."""
    rows = convert_to_usd(clean_transactions(df, default_currency=default_currency), rates=rates)
    if "merchant" not in rows.columns:
        return rows.withColumns({c: F.lit(None).cast("string") for c in ("merchant_canonical", "category")})
    found = categorize(resolve_distinct(df, "merchant", aliases=aliases, threshold=threshold))
    found = found.select(F.col("merchant").alias("_raw"), "merchant_canonical", "merchant_score", "merchant_issues", "category")
    kept = [c for c in rows.columns if c not in found.columns]
    return rows.select(*kept).join(found, F.col("merchant").eqNullSafe(F.col("_raw")), "left").drop("_raw")


def spend_report_plan(
    df: DataFrame,
    *,
    group_by: str = "category",
    resolve: bool = False,
    rates=None,
    aliases=None,
    threshold: int = 85,
    round_digits: int | None = 2,
) -> DataFrame:
    """Group totals ``(key, amount_raw, amount, n_tx)`` for the report.

    ``group_by`` may name an input column or a derived one (``currency``,
    ``amount_decimal``, ``amount_usd``, ``merchant_canonical``, ``category``);
    any other name falls back to ``category``."""
    rows = usd_rows(df, rates=rates)
    by_merchant = ["category"] + ["merchant_canonical"] * (resolve or "merchant_canonical" in df.columns)
    if group_by in rows.columns and group_by not in by_merchant:
        return group_totals(rows, group_by, round_digits=round_digits)
    key = group_by if group_by in by_merchant else "category"
    per_merchant = categorized_merchant_totals(df, resolve=resolve, rates=rates, aliases=aliases, threshold=threshold)
    g = per_merchant.groupBy(key).agg(
        F.coalesce(F.sum("amount_usd"), F.lit(0)).alias("amount_raw"), F.sum("n_tx").alias("n_tx")
    )
    amount = F.round("amount_raw", round_digits) if round_digits is not None else F.col("amount_raw")
    return g.select(key, "amount_raw", amount.alias("amount"), "n_tx")


def report_from_csv(
    spark,
    paths,
    out_path: str | None = None,
    *,
    resolve: bool = True,
    group_by: str = "category",
    rates=None,
    aliases=None,
    threshold: int = 85,
    round_digits: int | None = 2,
    sample: int | None = None,
) -> dict:
    """Entry A as a library call: CSV file(s) -> formatted report dict
    (written as one pretty JSON file when ``out_path`` is given)."""
    from ledgerloom.operators.report import report_row
    from ledgerloom.sources.csv_ingest import read_transactions
    from ledgerloom.sources.sinks import report_dict, write_report_json

    df = read_transactions(spark, paths, sample=sample)
    grouped = spend_report_plan(
        df, group_by=group_by, resolve=resolve, rates=rates, aliases=aliases, threshold=threshold, round_digits=round_digits
    )
    key = grouped.columns[0]
    rep = report_row(grouped, key)
    return write_report_json(rep, out_path) if out_path else report_dict(rep)


def clean_csv(spark, paths, out_dir: str, *, default_currency: str | None = None, sample: int | None = None) -> None:
    """Entry B as a library call: CSV file(s) -> cleaned CSV directory (raw
    columns + date_iso, amount_decimal, currency, issues)."""
    from ledgerloom.sources.csv_ingest import read_transactions
    from ledgerloom.sources.sinks import write_cleaned_csv

    df = read_transactions(spark, paths, sample=sample)
    write_cleaned_csv(clean_transactions(df, default_currency=default_currency), out_dir)


def report_rows_from_csv(spark, paths, out_dir: str, *, group_by: str, resolve: bool = True, rates=None, aliases=None, round_digits: int | None = 2) -> None:
    """The report's listing for a grouping of any size: CSV file(s) -> a JSON dataset, one ranked line per group."""
    from ledgerloom.operators.report import ranked_rows
    from ledgerloom.sources.csv_ingest import read_transactions
    from ledgerloom.sources.sinks import write_report_rows

    grouped = spend_report_plan(read_transactions(spark, paths), group_by=group_by, resolve=resolve, rates=rates, aliases=aliases, round_digits=round_digits)
    write_report_rows(ranked_rows(grouped, grouped.columns[0]), out_dir)


def clean_csv_counted(spark, paths, out_dir: str, *, default_currency: str | None = None, rates=None) -> dict[str, int]:
    """``clean_csv`` with quarantine and counts in the same pass: rows go to
    ``quarantined=false`` and ``quarantined=true`` (long rows, with the row as
    it was in ``raw_row``) under ``out_dir``, and what is returned was counted
    while they were written."""
    from pyspark.sql import Observation

    from ledgerloom.sources.csv_ingest import RAW, read_transactions
    from ledgerloom.sources.sinks import write_cleaned_csv

    rows = read_transactions(spark, paths, on_long_rows="keep").withColumnsRenamed({"_long_row": "quarantined", RAW: "raw_row"})
    clean = clean_transactions(rows, default_currency=default_currency)
    usd = convert_to_usd(clean, rates=rates, out_col="_usd") if "amount_decimal" in clean.columns else clean.withColumn("_usd", F.lit(None))
    good = ~F.col("quarantined")
    given = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    number = lambda cond: F.coalesce(F.sum((good & cond).cast("long")), F.lit(0))
    counts = [F.count(F.lit(1)).alias("rows_read"), F.coalesce(F.sum(F.col("quarantined").cast("long")), F.lit(0)).alias("rows_quarantined")]
    if "date_iso" in usd.columns and "date" in usd.columns:
        counts.append(number(given("date") & F.col("date_iso").isNull()).alias("dates_unparseable"))
    if "amount_decimal" in usd.columns and "amount" in usd.columns:
        counts.append(number(given("amount") & F.col("amount_decimal").isNull()).alias("amounts_unparseable"))
        counts.append(number(F.col("amount_decimal").isNotNull() & F.col("_usd").isNull()).alias("amounts_unconvertible"))
    seen = Observation("clean_csv")
    write_cleaned_csv(usd.observe(seen, *counts).drop("_usd"), out_dir, partition_by="quarantined")
    return dict(seen.get)
