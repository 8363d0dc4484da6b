"""The CSV reader's splits, samples and headers, against Python's csv module and hand lists."""

import csv
import io
import random

import pytest

from ledgerloom.sources import csv_ingest, csv_records
from ledgerloom.sources.csv_ingest import columns_of, quarantined_rows, read_transactions


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_to
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [17, 64, 1000])
def test_any_split_size_gives_the_same_records(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    pieces = ["a", "b c", '"', '""', ",", "\n", "\n\n", "é", '5" pipe', ""]
    want = []
    for f in range(3):
        rows = [[f"{f}-{i}"] + ["".join(rng.choices(pieces, k=rng.randint(0, 5))) for _ in range(2)] for i in range(40)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows([["id", "x", "y"], *rows])
        (tmp_path / f"{f}.csv").write_text(out.getvalue(), encoding="utf-8")
        want += [tuple(r) for r in rows]
    small_splits(size)
    df = read_transactions(spark, str(tmp_path))
    assert rows_of(df) == sorted(want)


def test_a_large_file_with_newlines_in_quotes_makes_many_tasks(spark, tmp_path, small_splits):
    p = tmp_path / "big.csv"
    p.write_text("date,merchant,amount\n" + '2025-01-01,A shop,$1.00\n2025-01-02,"two\nlines",$2\n' * 60_000, encoding="utf-8")
    small_splits("256k")
    df = read_transactions(spark, str(p))
    assert df.rdd.getNumPartitions() > 8
    assert {r["merchant"]: r["count"] for r in df.groupBy("merchant").count().collect()} == {"A shop": 60_000, "two\nlines": 60_000}


def test_a_stray_quote_opens_nothing(spark, tmp_path, small_splits):
    p = tmp_path / "stray.csv"
    p.write_text("date,merchant,amount\n" + "2025-01-01,A shop,$1.00\n" * 30_000 + '2025-01-02,5" pipe,$2\n' + "2025-01-01,A shop,$1.00\n" * 30_000, encoding="utf-8")
    small_splits("256k")
    df = read_transactions(spark, str(p))
    assert df.rdd.getNumPartitions() > 4 and df.count() == 60_001
    assert df.where("amount = '$2'").first().merchant == '5" pipe'
    assert not [x for x in df._jdf.queryExecution().executedPlan().toString().split() if "MapInArrow" in x]


def test_a_quote_that_never_closes_is_read_line_by_line(spark, tmp_path):
    p = tmp_path / "endless.csv"
    p.write_text('a,b\n1,x\n2,"y\n3,z\n', encoding="utf-8")
    (tmp_path / "good.csv").write_text('a,b\n4,"p\nq"\n', encoding="utf-8")
    assert rows_of(read_transactions(spark, str(tmp_path))) == [("1", "x"), ("2", "y"), ("3", "z"), ("4", "p\nq")]
    assert [tuple(r) for r in read_transactions(spark, str(p), sample=3).collect()] == [("1", "x"), ("2", "y"), ("3", "z")]


def test_records_that_cross_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(60))
    (tmp_path / "l.csv").write_text(f'a,b\n1,"{long}"\n2,short\n3,"{long}"\n', encoding="utf-8")
    small_splits(50)
    assert rows_of(read_transactions(spark, str(tmp_path))) == [("1", long), ("2", "short"), ("3", long)]


def test_many_files_join_by_shuffle_gives_the_same(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n2,z\n' * 1 + '5,"m\nn"\n' * 30, encoding="utf-8")
    (tmp_path / "b.csv").write_bytes('b,a\nCafé,3\n"é\né",4\n'.encode("latin-1"))
    small_splits(40)
    want = rows_of(read_transactions(spark, str(tmp_path)))
    monkeypatch.setattr(csv_ingest, "FEW_FILES", 0)
    assert rows_of(read_transactions(spark, str(tmp_path))) == want
    assert ("3", "Café") in want and ("4", "é\né") in want and len(want) == 34


@pytest.mark.parametrize("n, want", [(2, ["F00R0", "F00R1"]), (4, ["F00R0", "F00R1", "F01R0", "F01R1"]), (55, None)])
def test_sample_follows_file_name_and_place(spark, tmp_path, monkeypatch, n, want):
    names = []
    for f in range(24):
        rows = 2 if f == 0 else 50
        (tmp_path / f"a{f:02}.csv").write_text("merchant,amount\n" + "".join(f"F{f:02}R{i},$1\n" for i in range(rows)), encoding="utf-8")
        names += [f"F{f:02}R{i}" for i in range(rows)]
    opened = []
    first = csv_ingest._first_records
    monkeypatch.setattr(csv_ingest, "_first_records", lambda s, file, *a: opened.append(file) or first(s, file, *a))
    assert [r.merchant for r in read_transactions(spark, str(tmp_path), sample=n).collect()] == (want or names[:n])
    assert len(opened) == {2: 1, 4: 2, 55: 3}[n]  # later files are not read
    monkeypatch.setattr(csv_ingest, "SMALL_SAMPLE", 0)
    assert [r.merchant for r in read_transactions(spark, str(tmp_path), sample=n).collect()] == (want or names[:n])


def test_sample_of_one_large_file_reads_its_first_split_only(spark, tmp_path, small_splits):
    p = tmp_path / "big.csv"
    p.write_text("merchant,amount\n" + '"R\n0",$1\n' + "".join(f"R{i},$1\n" for i in range(1, 100_000)), encoding="utf-8")
    small_splits("64k")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sample-test", "sample")
    try:
        got = [r.merchant for r in read_transactions(spark, str(p), sample=5).collect()]
        infos = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("sample-test")]
        tasks = sum(tracker.getStageInfo(s).numTasks for info in infos for s in info.stageIds if tracker.getStageInfo(s))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == ["R\n0", "R1", "R2", "R3", "R4"]
    assert 0 < tasks < 12  # the file has about 15 splits


def test_sample_drops_long_rows_and_takes_later_ones(spark, tmp_path):
    (tmp_path / "a.csv").write_text("m,a\nA,1,x\nB,2\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("a,m\n3,C\n4,D\n", encoding="utf-8")
    got = read_transactions(spark, str(tmp_path), sample=2, on_long_rows="drop").collect()
    assert [(r.m, r.a) for r in got] == [("B", "2"), ("C", "3")]


def test_duplicate_and_case_variant_headers(spark, tmp_path):
    assert columns_of("date,amount,amount") == ["date", "amount", "amount_1"]
    assert columns_of("Amount,amount,,AMOUNT") == ["Amount_1", "amount", "_c2", "AMOUNT_2"]
    assert columns_of("a,a,a_1") == ["a", "a_2", "a_1"]
    assert columns_of("_raw_row,_file,_place_1") == ["_raw_row_1", "_file_1", "_place_1"]
    for head, want in [("date,amount,amount", ("d", "1", "2")), ("Amount,amount,x.y", ("d", "1", "2"))]:
        p = tmp_path / "dup.csv"
        p.write_text(f"{head}\nd,1,2\n", encoding="utf-8")
        df = read_transactions(spark, str(p))
        assert tuple(df.first()) == want and len({c.lower() for c in df.columns}) == 3


def test_long_rows_with_stray_quotes_and_newlines(spark, tmp_path):
    (tmp_path / "l.csv").write_text('a,b\n5" x,5" y,z\n"p\nq",r,s\n\n  \nok,"1,2"\n', encoding="utf-8")
    assert rows_of(read_transactions(spark, str(tmp_path), on_long_rows="drop")) == [("ok", "1,2")]
    assert sorted(r.raw for r in quarantined_rows(spark, str(tmp_path)).collect()) == ['"p\nq",r,s', '5" x,5" y,z']


def test_encodings(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_bytes('m,a\n€uro,1\n"l\n€",2\n'.encode("cp1252"))
    assert rows_of(read_transactions(spark, str(p), encoding="cp1252")) == [("l\n€", "2"), ("€uro", "1")]
    with pytest.raises(ValueError):
        read_transactions(spark, str(p), encoding="utf-16")


def test_state_functions_agree(spark):
    lines = ['a,b', '"', 'a,"b', '"a""', '"a""",b', 'x"y,"z', '"a"x,"b', '"a,"x",y', ',"', '""', '"""', ',,"a","b""c,', "", 'é,"ü']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(csv_records.ends_open(df.line)).collect()]
    assert got == [csv_records.state_after(x.encode(), False) for x in lines]
    assert csv_records.state_after(b'x",y', True) is False and csv_records.state_after(b"x", True) is True
