from decimal import Decimal

import pytest

from ledgerloom.operators.fx import convert_to_usd
from ledgerloom.sources import dims


def _conv(spark, rows, **kw):
    df = spark.createDataFrame(rows, "i int, amount_decimal decimal(24,8), currency string")
    return {r.i: r.amount_usd for r in convert_to_usd(df, **kw).collect()}


def test_default_rates(spark):
    got = _conv(
        spark,
        [(0, Decimal("10"), "EUR"), (1, Decimal("5"), "GBP"), (2, Decimal("1000"), "JPY"), (3, Decimal("100"), "INR"),
         (4, Decimal("2"), "ETH")],
    )
    assert got == {0: Decimal("10.80"), 1: Decimal("6.25"), 2: Decimal("7"), 3: Decimal("1.2"), 4: Decimal("3600")}


def test_custom_rates_unknown_and_missing(spark):
    rates = {"EUR": "1.1", "GBP": "1.3"}
    rows = [(0, Decimal("10"), "EUR"), (1, Decimal("10"), "ZZZ"), (2, Decimal("5"), None), (3, Decimal("7"), "c$")]
    got = _conv(spark, rows, rates=rates)
    assert got[0] == Decimal("11.0") and got[1] is None and got[2] == Decimal("5")
    assert got[3] == Decimal("7") * Decimal("0.74")
    strict = _conv(spark, rows, rates=rates, assume_missing_usd=False)
    assert strict[2] is None


def test_user_rates_upper_cased_and_bad_values_ignored(spark):
    r = {row.currency: row.rate for row in dims.rates_df(spark, {"eur": "2", "usd": "oops"}).collect()}
    assert r["EUR"] == Decimal("2") and r["USD"] == Decimal("1")


def test_rates_join_is_broadcast(spark):
    df = spark.createDataFrame([(0, Decimal("1"), "EUR")], "i int, amount_decimal decimal(24,8), currency string")
    plan = convert_to_usd(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan or "AdaptiveSparkPlan" in plan


def test_large_and_small_rates(spark):
    rows = [(0, Decimal("0.5"), "BTC"), (1, Decimal("1000000"), "SHIB"), (2, Decimal("-0.000000000000000001"), "BTC")]
    df = spark.createDataFrame(rows, "i int, amount_decimal decimal(38,18), currency string")
    got = {r.i: r.amount_usd for r in convert_to_usd(df, rates={"BTC": 105000, "shib": "0.0000123456"}).collect()}
    assert got == {0: Decimal("52500"), 1: Decimal("12.3456"), 2: Decimal("-0.0000000000001050")}


def test_rates_that_do_not_fit_are_an_error(spark):
    for bad in ("10000000", "0.00000000001"):
        with pytest.raises(ValueError):
            dims.rates_df(spark, {"XXX": bad})


def test_last_key_wins(spark):
    r = {row.currency: row.rate for row in dims.rates_df(spark, {"eur": 1.1, "EUR": 2}).collect()}
    assert r["EUR"] == Decimal("2")


def test_rates_table_by_the_same_rules(spark):
    table = spark.createDataFrame([("eur", "1.5", 1), ("EUR", "1.2", 2), ("chf", "n/a", 1), (None, "3", 1)], "currency string, rate string, pos int")
    rows = [(0, Decimal("10"), "EUR"), (1, Decimal("10"), "GBP"), (2, Decimal("10"), "CHF")]
    got = _conv(spark, rows, rates=table)
    assert got == {0: Decimal("12"), 1: Decimal("12.5"), 2: None}  # one row each, defaults fill the gaps
    assert _conv(spark, rows[:1], rates=table.drop("pos"))[0] == Decimal("15")


def test_product_beyond_the_type_is_null(spark):
    rows = [(0, Decimal("99999999999999999999"), "AAA")]
    df = spark.createDataFrame(rows, "i int, amount_decimal decimal(38,18), currency string")
    assert convert_to_usd(df, rates={"AAA": "1000"}).first().amount_usd is None


def test_rates_that_do_not_fit_convert_nothing(spark):
    from ledgerloom.operators.fx import convert_to_usd

    table = [("EUR", "20000000"), ("btc", "0.00000000000123"), ("GBP", " 1.5 "), ("JPY", "n/a"), ("CHF", "NaN"), ("SEK", "0.1234567890"), ("NOK", "0"), ("ETH", "1e-40"), (None, "2"), ("CAD", None)]
    rates = spark.createDataFrame(table, "currency string, rate string")
    codes = ["EUR", "BTC", "GBP", "JPY", "SEK", "NOK", "ETH", "QQQ", None, "CAD"]
    df = spark.createDataFrame([(c, "10") for c in codes], "currency string, a string").selectExpr("currency", "CAST(a AS decimal(38,18)) AS amount_decimal")
    got = {r.currency: (r.amount_usd and float(r.amount_usd), r.why) for r in convert_to_usd(df, rates=rates, issue_col="why").collect()}
    default = dict(dims.DEFAULT_RATES)
    assert got == {
        "EUR": (None, "rate_out_of_range"), "BTC": (None, "rate_too_fine"), "GBP": (15.0, None), "JPY": (10 * float(default["JPY"]), None), "SEK": (1.23456789, None),
        "NOK": (0, None), "ETH": (None, "rate_too_fine"), "QQQ": (None, "no_rate"), None: (10.0, None), "CAD": (10 * float(default["CAD"]), None),
    }
