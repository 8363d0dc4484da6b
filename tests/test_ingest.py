import pytest

from conftest import SAMPLE_CSV
from ledgerloom.sources.alias_json import read_alias_json
from ledgerloom.sources.csv_ingest import preview, read_transactions
from ledgerloom.sources.sinks import write_cleaned_csv


def test_reads_all_rows_as_strings(sample_df):
    assert sample_df.count() == 36
    assert all(t == "string" for _, t in sample_df.dtypes)
    first = sample_df.first()
    assert first.merchant == "UBER *TRIP" and first.amount == "(€12.50)"


def test_spaces_are_data(sample_df):
    amounts = [r.amount for r in sample_df.collect()]
    assert "$13.00 " in amounts and "  £25.4" in amounts


def test_sample_first_n(spark):
    df = read_transactions(spark, SAMPLE_CSV, sample=3)
    assert [r.merchant for r in df.collect()] == ["UBER *TRIP", "Uber Technologies", "UBER EATS"]
    assert read_transactions(spark, SAMPLE_CSV, sample=0).count() == 36


def test_missing_file(spark, tmp_path):
    with pytest.raises(ValueError):
        read_transactions(spark, str(tmp_path / "does_not_exist.csv"))


def test_latin1_fallback(spark, tmp_path):
    p = tmp_path / "latin1.csv"
    p.write_bytes("when,händler,amount\n3/4/2019,Bäckerei Öhm,7 EUR\n".encode("latin-1"))
    row = read_transactions(spark, str(p)).first()
    assert row["händler"] == "Bäckerei Öhm"


def test_mixed_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("date,merchant,amount\n2025-01-01,CAFÉ,$1\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("date,merchant,amount\n2025-01-02,CAFÉ,$2\n".encode("utf-8"))
    rows = read_transactions(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()
    assert sorted(r.merchant for r in rows) == ["CAFÉ", "CAFÉ"]


def test_header_only(spark, tmp_path):
    p = tmp_path / "empty.csv"
    p.write_text("when,shop,paid\n", encoding="utf-8")
    df = read_transactions(spark, str(p))
    assert df.count() == 0 and df.columns == ["when", "shop", "paid"]
    p.write_text("", encoding="utf-8")
    assert read_transactions(spark, str(p)).count() == 0


def test_bom_and_quotes(spark, tmp_path):
    p = tmp_path / "bom.csv"
    p.write_text('﻿date,merchant,amount\n2025-01-01,"Say ""hi""\nthere",$1\n', encoding="utf-8")
    df = read_transactions(spark, str(p))
    assert df.columns[0] == "date"
    assert df.first().merchant == 'Say "hi"\nthere'


def test_long_rows(spark, tmp_path):
    p = tmp_path / "long.csv"
    p.write_text("date,merchant,amount\n2025-01-01,A,$1\n2025-01-02,B,$2,extra\n2025-01-03,C\n", encoding="utf-8")
    with pytest.raises(Exception, match="more fields"):
        read_transactions(spark, str(p)).collect()
    kept = read_transactions(spark, str(p), on_long_rows="drop").collect()
    assert [r.merchant for r in kept] == ["A", "C"] and kept[1].amount in ("", None)


def test_every_extra_field_makes_a_row_long(spark, tmp_path):
    p = tmp_path / "long.csv"
    p.write_text('date,merchant,amount\n2025-01-01,A,$1,,x\n2025-01-02,"B, C","$2"\n2025-01-03,D,$3,\n2025-01-04,E\n', encoding="utf-8")
    kept = read_transactions(spark, str(p), on_long_rows="drop").collect()
    assert [r.merchant for r in kept] == ["B, C", "E"]
    from ledgerloom.sources.csv_ingest import quarantined_rows

    assert sorted(r.raw for r in quarantined_rows(spark, str(p)).collect()) == ["2025-01-01,A,$1,,x", "2025-01-03,D,$3,"]
    flagged = read_transactions(spark, str(p), on_long_rows="keep").collect()
    assert [r._long_row for r in flagged] == [True, False, True, False]


def test_sample_does_not_meet_a_late_long_row(spark, tmp_path):
    p = tmp_path / "late.csv"
    p.write_text("date,merchant,amount\n2025-01-01,A,$1\n2025-01-02,B,$2,x\n", encoding="utf-8")
    assert [r.merchant for r in read_transactions(spark, str(p), sample=1).collect()] == ["A"]


def test_each_file_has_its_own_header_and_odd_names_work(spark, tmp_path):
    (tmp_path / "a 1.csv").write_text("date,merchant,amount\n2025-01-01,A,$1\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("merchant,date,amount\nB,2025-01-02,$2\n", encoding="utf-8")
    (tmp_path / "c [x] é%20.csv").write_bytes("amount,merchant,note\n$3,Café,n\n".encode("latin-1"))
    rows = read_transactions(spark, str(tmp_path)).collect()
    got = sorted((r.date, r.merchant, r.amount, r.note) for r in rows)
    assert got == [("", "Café", "$3", "n"), ("2025-01-01", "A", "$1", ""), ("2025-01-02", "B", "$2", "")]


def test_large_file_makes_several_tasks(spark, tmp_path):
    p = tmp_path / "big.csv"
    p.write_text("date,merchant,amount\n" + "2025-01-01,A shop,$1.00\n" * 200_000, encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = read_transactions(spark, str(p))
        assert df.rdd.getNumPartitions() > 1 and df.count() == 200_000
        quoted = tmp_path / "quoted.csv"
        quoted.write_text('date,merchant,amount\n2025-01-01,"A\nB",$1\n', encoding="utf-8")
        assert sorted({r.merchant for r in read_transactions(spark, [str(p), str(quoted)]).distinct().collect()}) == ["A\nB", "A shop"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_empty_field_stays_empty_string(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text("date,merchant,amount\n2025-01-01,,$1\n", encoding="utf-8")
    assert read_transactions(spark, str(p)).first().merchant == ""


def test_preview(sample_df):
    assert preview(sample_df, 2).count() == 2 and preview(sample_df, -1).count() == 0
    assert preview(sample_df, 1, clean=True).columns == ["date", "date_iso", "amount", "amount_decimal", "currency", "issues"]


def test_cleaned_csv_sink(spark, sample_df, tmp_path):
    from ledgerloom.plans.pipeline import clean_transactions

    out = tmp_path / "clean"
    write_cleaned_csv(clean_transactions(sample_df), str(out))
    back = read_transactions(spark, str(out / "*.csv"))
    assert back.count() == 36
    assert back.columns[-4:] == ["date_iso", "amount_decimal", "currency", "issues"]
    row = [r for r in back.collect() if r.merchant == "TGT 445"][0]
    assert row.date_iso == "1987-01-07" and row.issues == '["comma_as_decimal"]'


def test_alias_json(spark, tmp_path):
    p = tmp_path / "m.json"
    p.write_text('{"Uber": ["UBER *TRIP", "UBER EATS"], "Solo": "ONLY ONE"}', encoding="utf-8")
    rows = read_alias_json(spark, str(p)).orderBy("choice_idx").collect()
    assert [(r.canonical, r.alias) for r in rows] == [
        ("Uber", "Uber"), ("Uber", "UBER *TRIP"), ("Uber", "UBER EATS"), ("Solo", "Solo"), ("Solo", "ONLY ONE")
    ]
    assert read_alias_json(spark, str(tmp_path / "missing.json")).collect() == []
    bad = tmp_path / "bad.json"
    bad.write_text("{not json", encoding="utf-8")
    assert read_alias_json(spark, str(bad)).collect() == []
    odd = tmp_path / "odd.json"
    odd.write_text('{"Foo": "[Foo] Shop", "Num": 5, "Mix": ["a", 7, null, "b"], "Nil": null}', encoding="utf-8")
    rows = read_alias_json(spark, str(odd)).orderBy("choice_idx").collect()
    assert [(r.canonical, r.alias) for r in rows] == [
        ("Foo", "Foo"), ("Foo", "[Foo] Shop"), ("Num", "Num"), ("Mix", "Mix"), ("Mix", "a"), ("Mix", "b"), ("Nil", "Nil")
    ]
