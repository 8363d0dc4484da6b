"""The stateless stages on a streaming source.

The reference reads one whole file; nothing in it is stateful.  Dates,
amounts, FX and the rule-based categories are per-row expressions plus
stream-static broadcast joins, so the same jobs accept a streaming
DataFrame unchanged.  Merchant resolution needs the distinct merchants of
a batch, so on a stream it runs per micro-batch (``foreachBatch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.amounts import clean_amounts
from ledgerloom.functions.dates import clean_dates
from ledgerloom.operators.categorize import categorize
from ledgerloom.operators.fx import convert_to_usd


def read_csv_stream(spark: SparkSession, directory: str, columns: list[str], max_files: int = 100) -> DataFrame:
    """New CSV files in ``directory`` as an all-string stream."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxFilesPerTrigger", max_files)
        .csv(directory)
    )


def clean_stream(stream: DataFrame, rates=None) -> DataFrame:
    """Row-level cleaning of a stream: date_iso, amount, currency, USD, category."""
    df = clean_dates(stream) if "date" in stream.columns else stream
    df = convert_to_usd(clean_amounts(df), rates=rates)
    return categorize(df)


def running_spend_by_category(stream: DataFrame, rates=None) -> DataFrame:
    """Streaming aggregate (``complete`` or ``update`` mode): USD per category."""
    df = clean_stream(stream, rates)
    return df.groupBy("category").agg(
        F.coalesce(F.sum("amount_usd"), F.lit(0)).alias("amount_raw"), F.count(F.lit(1)).alias("n_tx")
    )


def resolve_each_batch(out_path: str, **resolve_kw):
    """``foreachBatch`` function: full merchant resolution of one micro-batch,
    appended to a parquet table (idempotent per batch id on retry)."""
    from ledgerloom.plans.pipeline import categorized_merchant_totals

    def run(batch: DataFrame, batch_id: int) -> None:
        totals = categorized_merchant_totals(batch, resolve=True, **resolve_kw)
        totals.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return run
