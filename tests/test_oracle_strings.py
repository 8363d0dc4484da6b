"""The SQL oracles agree with the Spark jobs on the unit and golden strings,
not only on the driver data."""

import csv

import duckdb

import test_amounts as TA
import test_dates as TD
from conftest import SAMPLE_CSV
from ledgerloom.functions.amounts import clean_amounts
from ledgerloom.functions.dates import clean_dates
from ledgerloom.plans import oracle as O


def _duck(ctes, col, values, out):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE src(i INTEGER, {col} VARCHAR)")
    con.executemany("INSERT INTO src VALUES (?, ?)", list(enumerate(values)))
    last = ctes[-1].split(" AS ")[0]
    return dict(con.execute(O.with_ctes(*ctes) + f"SELECT i, {out} FROM {last}").fetchall())


def _sample(col):
    with open(SAMPLE_CSV, encoding="utf-8", newline="") as fh:
        return [r[col] for r in csv.DictReader(fh)]


def test_dates_oracle_matches_spark(spark):
    values = [d for _, d, _ in TD.STEPS] + _sample("date")
    df = spark.createDataFrame(list(enumerate(values)), "i int, date string")
    got = {r.i: (r.date_iso.isoformat() if r.date_iso else None) for r in clean_dates(df).collect()}
    ref = _duck(O.dates_ctes("src"), "date", values, "strftime(date_iso, '%Y-%m-%d')")
    assert [(values[i], got[i], ref[i]) for i in got if got[i] != ref[i]] == []


def test_amounts_oracle_matches_spark(spark):
    values = [a for _, a, *_ in TA.STEPS] + _sample("amount")
    df = spark.createDataFrame(list(enumerate(values)), "i int, amount string")
    got = {r.i: (r.amount_decimal, r.currency, ",".join(r.issues)) for r in clean_amounts(df).collect()}
    raw = _duck(O.amounts_ctes("src"), "amount", values,
                "struct_pack(a := amount_decimal, c := currency, s := array_to_string(issues, ','))")
    ref = {k: (v["a"], v["c"], v["s"]) for k, v in raw.items()}
    assert [(values[i], got[i], ref[i]) for i in got if got[i] != ref[i]] == []
