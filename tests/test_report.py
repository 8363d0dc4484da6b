import json
import math

from ledgerloom.operators.report import report_row
from ledgerloom.plans.pipeline import spend_report_plan
from ledgerloom.sources.sinks import report_dict, write_report_json

# published report of the 36-row sample (default rates, threshold 85)
GOLDEN = {
    "top_category": "Shopping",
    "amount": "$223,417.04",
    "top_amount": 223417.04,
    "by_category": [
        ("Shopping", "$223,417.04", 0.9921184113585608),
        ("Groceries", "$964.67", 0.004283768453316107),
        ("Food", "$608.50", 0.0027021396994234828),
        ("Fuel", "$139.42", 0.0006191163794472013),
        ("Transport", "$85.68", 0.000380475479780779),
        ("Entertainment", "$-23.40", -0.000103911370528364),
    ],
    "total_usd": "$225,191.91",
}


def test_golden_report(sample_df):
    rep = report_dict(report_row(spend_report_plan(sample_df, resolve=True), "category"))
    assert rep["top_category"] == GOLDEN["top_category"]
    assert rep["amount"] == GOLDEN["amount"]
    assert rep["top_amount"] == GOLDEN["top_amount"]
    assert rep["total_usd"] == GOLDEN["total_usd"]
    got = [(b["category"], b["amount"], b["pct"]) for b in rep["by_category"]]
    assert [g[:2] for g in got] == [g[:2] for g in GOLDEN["by_category"]]
    for (_, _, p), (_, _, q) in zip(got, GOLDEN["by_category"]):
        assert math.isclose(p, q, rel_tol=1e-12)


def test_simple_report_and_file(spark, tmp_path):
    df = spark.createDataFrame(
        [("Uber", "$10.00", "Uber"), ("Starbucks", "€5.00", "Starbucks"), ("Amazon", "USD20.00", "Amazon")],
        "merchant string, amount string, merchant_canonical string",
    )
    rep = report_row(spend_report_plan(df), "category")
    out = tmp_path / "nested" / "report.json"
    d = write_report_json(rep, str(out))
    data = json.loads(out.read_text())
    assert {"top_category", "by_category", "total_usd", "amount", "top_amount"} <= set(data)
    assert d["top_category"] == "Shopping" and data["total_usd"] == "$35.40"


def test_tie_break_alphabetical(spark):
    df = spark.createDataFrame(
        [("A", "$10.00", "Alpha"), ("B", "$10.00", "Beta")], "merchant string, amount string, merchant_canonical string"
    )
    grouped = spend_report_plan(df, group_by="merchant_canonical")
    assert report_dict(report_row(grouped, "merchant_canonical"))["top_category"] == "Alpha"


def test_null_group_kept_and_wins_tie(spark):
    df = spark.createDataFrame(
        [("Some Weird Shop", "$10.00"), ("UBER", "$10.00")], "merchant string, amount string"
    )
    rep = report_dict(report_row(spend_report_plan(df), "category"))
    assert rep["top_category"] is None
    assert [b["category"] for b in rep["by_category"]] == ["Transport", None]


def test_empty_input(spark):
    df = spark.createDataFrame([], "merchant string, amount string")
    rep = report_dict(report_row(spend_report_plan(df), "category"))
    assert rep["top_category"] is None and rep["by_category"] == [] and rep["amount"] == "$0.00"


def test_unknown_group_falls_back_to_category(spark):
    df = spark.createDataFrame([("UBER", "$1.00")], "merchant string, amount string")
    assert "category" in spend_report_plan(df, group_by="nope").columns


def test_raw_summary_is_numeric(sample_df):
    rep = report_dict(report_row(spend_report_plan(sample_df, resolve=True), "category", formatted=False))
    assert rep["amount"] == 223417.04 and rep["total_usd"] == 225191.91


def test_by_category_sums_to_total(spark):
    from ledgerloom.sources.driver_tables import messy_transactions

    tx = messy_transactions(spark, "/root/testdata/sf0.001")
    rep = report_dict(report_row(spend_report_plan(tx, resolve=True), "category", formatted=False))
    assert math.isclose(sum(b["amount"] for b in rep["by_category"]), rep["total_usd"], rel_tol=1e-12)
    assert math.isclose(sum(b["pct"] for b in rep["by_category"]), 1.0, rel_tol=1e-9)


def test_report_from_csv_end_to_end(spark, tmp_path):
    from conftest import SAMPLE_CSV
    from ledgerloom.plans.pipeline import clean_csv, report_from_csv

    out = tmp_path / "report" / "top_spending.json"
    rep = report_from_csv(spark, SAMPLE_CSV, str(out))
    data = json.loads(out.read_text())
    assert data["top_category"] == "Shopping" and data["total_usd"] == "$225,191.91" and rep == data
    clean_csv(spark, SAMPLE_CSV, str(tmp_path / "clean"), default_currency="USD")
    back = spark.read.option("header", True).csv(str(tmp_path / "clean"))
    assert back.count() == 36 and back.where("currency IS NULL").count() == 0


def test_money_text_and_unrounded_report(spark):
    from ledgerloom.functions.money import format_usd
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("1234.565",), ("-23.4",)], "x string")
    got = [r.t for r in df.select(format_usd(F.col("x").cast("decimal(20,3)"), 2, use_symbol=False).alias("t")).collect()]
    assert got == ["1,234.57 USD", "-23.40 USD"]
    rows = spark.createDataFrame([("UBER", "$1.005"), ("UBER", "$1.005")], "merchant string, amount string")
    rep = report_dict(report_row(spend_report_plan(rows, round_digits=None), "category", formatted=False))
    assert rep["top_amount"] == 2.01 and rep["top_category"] == "Transport"


def test_existing_canonical_comes_first(spark):
    df = spark.createDataFrame([("Starbucks #1", "$1", "Uber")], "merchant string, amount string, merchant_canonical string")
    assert [r.category for r in spend_report_plan(df).collect()] == ["Transport"]
    assert [r.category for r in spend_report_plan(df, resolve=True).collect()] == ["Food"]
    assert [r.merchant_canonical for r in spend_report_plan(df, group_by="merchant_canonical").collect()] == ["Uber"]


def test_group_by_a_derived_column(spark):
    df = spark.createDataFrame([("a", "$1"), ("b", "€2"), ("c", "x")], "merchant string, amount string")
    got = {r.currency: (str(r.amount), r.n_tx) for r in spend_report_plan(df, group_by="currency").collect()}
    assert got == {"USD": ("1.00", 1), "EUR": ("2.16", 1), None: ("0.00", 1)}


def test_no_merchant_column(spark):
    df = spark.createDataFrame([("$1",), ("$2",)], "amount string")
    for resolve in (False, True):
        assert [(r.category, str(r.amount)) for r in spend_report_plan(df, resolve=resolve).collect()] == [(None, "3.00")]
    assert spend_report_plan(df.limit(0)).collect() == []


def test_money_text_has_two_decimals_whatever_the_rounding(spark):
    df = spark.createDataFrame([("UBER", "$1234.6")], "merchant string, amount string")
    assert report_row(spend_report_plan(df, round_digits=0), "category").first().total_usd == "$1,235.00"


def test_rows_listing_equals_the_array(sample_df):
    from ledgerloom.operators.report import report_rows

    grouped = spend_report_plan(sample_df)
    listed = {b["category"]: b["amount"] for b in report_dict(report_row(grouped, "category"))["by_category"]}
    assert {r.category: r.amount for r in report_rows(grouped, "category").collect()} == listed
