import os
import tempfile

from pyspark.sql import functions as F

from ledgerloom.streaming.stream import read_csv_stream, resolve_each_batch, running_spend_by_category

ROWS_A = 'date,merchant,amount\n2020-01-05,UBER *TRIP,$10.00\n2020-01-06,Starbucks #4421,"€5,00"\n'
ROWS_B = "date,merchant,amount\n2020-01-07,UBER TRIP,$2.50\n2020-01-08,Some Unknown,$1.00\n"


def test_running_totals(spark):
    d = tempfile.mkdtemp(prefix="ll-stream-in-")
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8") as fh:
        fh.write(ROWS_A)
    with open(os.path.join(d, "b.csv"), "w", encoding="utf-8") as fh:
        fh.write(ROWS_B)
    stream = read_csv_stream(spark, d, ["date", "merchant", "amount"])
    q = running_spend_by_category(stream).writeStream.outputMode("complete").format("memory").queryName("ll_spend").start()
    try:
        q.processAllAvailable()
        got = {r.category: (r.amount_raw, r.n_tx) for r in spark.sql("SELECT * FROM ll_spend").collect()}
    finally:
        q.stop()
    assert float(got["Transport"][0]) == 12.5 and got["Transport"][1] == 2
    assert float(got["Food"][0]) == 5.4
    assert got[None][1] == 1


def test_foreach_batch_resolution(spark):
    d = tempfile.mkdtemp(prefix="ll-stream-in-")
    out = tempfile.mkdtemp(prefix="ll-stream-out-")
    ck = tempfile.mkdtemp(prefix="ll-stream-ck-")
    with open(os.path.join(d, "a.csv"), "w", encoding="utf-8") as fh:
        fh.write(ROWS_A)
    stream = read_csv_stream(spark, d, ["date", "merchant", "amount"])
    q = stream.writeStream.foreachBatch(resolve_each_batch(out)).option("checkpointLocation", ck).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.read.parquet(out).collect()
    cats = {r.merchant: r.category for r in rows}
    assert cats["UBER *TRIP"] == "Transport" and cats["Starbucks #4421"] == "Food"
