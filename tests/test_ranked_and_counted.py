"""The ranked listing and the cleaning pass that counts while it writes."""

import json

from ledgerloom.operators.report import group_totals, ranked_rows, report_row
from ledgerloom.plans.pipeline import clean_csv_counted, report_rows_from_csv
from ledgerloom.sources.csv_ingest import read_transactions

from conftest import SAMPLE_CSV


def test_ranks_over_many_partitions_follow_the_listing(spark):
    rows = [(None if i % 97 == 0 else f"k{i % 500:03}", float(i % 7) - 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v double").selectExpr("k", "CAST(v AS decimal(38,16)) AS amount_usd").repartition(7)
    grouped = group_totals(df, "k")
    got = ranked_rows(grouped, "k").orderBy("rank").collect()
    want = report_row(grouped, "k").first()["by_category"]
    assert [(r["rank"], r["k"], r["amount"], r["pct"]) for r in got] == [(i + 1, w["category"], w["amount"], w["pct"]) for i, w in enumerate(want)]
    assert ranked_rows(group_totals(df.limit(0), "k"), "k").collect() == []


def test_report_rows_from_csv(spark, tmp_path):
    report_rows_from_csv(spark, SAMPLE_CSV, str(tmp_path / "r"), group_by="category", resolve=False)
    rows = [json.loads(line) for f in (tmp_path / "r").glob("*.json") for line in f.read_text().splitlines()]
    assert sorted(r["rank"] for r in rows) == list(range(1, len(rows) + 1)) and {"category", "amount", "pct"} <= set(rows[0])


def test_one_pass_quarantine_and_counts(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('date,merchant,amount\n2025-01-01,A,$1\nnot a date,B,ZZZ 5\n,C,oops\n2025-01-02,D,$2,extra\n"2025-01-03","E\nF",\n', encoding="utf-8")
    counts = clean_csv_counted(spark, str(p), str(tmp_path / "out"))
    assert counts == {"rows_read": 5, "rows_quarantined": 1, "dates_unparseable": 1, "amounts_unparseable": 1, "amounts_unconvertible": 1}
    clean = read_transactions(spark, str(tmp_path / "out" / "quarantined=false" / "*.csv")).collect()
    assert sorted(r.merchant for r in clean) == ["A", "B", "C", "E\nF"]
    bad = read_transactions(spark, str(tmp_path / "out" / "quarantined=true" / "*.csv")).collect()
    assert [r.raw_row for r in bad] == ["2025-01-02,D,$2,extra"]
