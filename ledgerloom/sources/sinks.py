"""Sinks: cleaned CSV (S11), formatted report JSON (S12), raw summary (S13).

The CSV sink is a distributed write (one part file per task).  The report is
a single row by construction (see ``operators.report.report_row``) and is
written as one pretty-printed file through the Hadoop file system, so any
path that Spark can write works.  Listings of any size go through
``write_report_rows``, a distributed JSON dataset.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLEAN_OUTPUT_COLS = ["date_iso", "amount_decimal", "currency", "issues"]


def cleaned_for_csv(df: DataFrame) -> DataFrame:
    """Raw columns + ``date_iso, amount_decimal, currency, issues`` as text;
    issues as a JSON array."""
    out = df
    if "date_iso" in out.columns:
        out = out.withColumn("date_iso", F.date_format("date_iso", "yyyy-MM-dd"))
    if "amount_decimal" in out.columns:
        out = out.withColumn("amount_decimal", F.col("amount_decimal").cast("string"))
    if "issues" in out.columns:
        out = out.withColumn("issues", F.to_json("issues"))
    keep = [c for c in out.columns if c not in CLEAN_OUTPUT_COLS] + [c for c in CLEAN_OUTPUT_COLS if c in out.columns]
    return out.select(*keep)


def write_cleaned_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    writer = cleaned_for_csv(df).write.mode(mode)
    (
        (writer.partitionBy(partition_by) if partition_by else writer)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(path)
    )


def write_report_rows(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``operators.report.report_rows`` or ``ranked_rows`` as a JSON dataset (directory), one line per group."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def report_dict(report: DataFrame) -> dict:
    """The one-row report as a Python dict (nested rows converted)."""
    row = report.first()
    if row is None:
        raise ValueError("empty report")
    return _plain(row.asDict(recursive=True))


def _plain(v):
    if isinstance(v, dict):
        return {k: _plain(x) for k, x in v.items()}
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return v


def write_report_json(report: DataFrame, path: str) -> dict:
    """Single pretty-printed JSON file (parents created), like the reference
    report; returns the dict."""
    d = report_dict(report)
    spark = report.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target, True)
    try:
        out.write(json.dumps(d, indent=2).encode("utf-8"))
    finally:
        out.close()
    return d
