import collections
import hashlib

import numpy as np

from llm_cases import SF0001, no_docs, odd_docs  # noqa: F401
from ledgerloom.llm import exact_dedup
from ledgerloom.llm.queries import QUERIES


def brute(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = {}
    for text, ids in groups.items():
        out[hashlib.sha256(text.encode()).hexdigest()] = (max((i for i in ids if i is not None), default=None), len(ids))
    return out


def check(rows, got):
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == want[r["text_sha256"]]
    kept = collections.Counter(r["text_sha256"] for r in got if r["kept"])
    assert kept == collections.Counter(want) .__class__({k: 1 for k in want})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_op3_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    check(rows, QUERIES["op3_exact_dedup"](spark, SF0001).collect())


def test_odd_rows_and_saturated_filter(spark, odd_docs, no_docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check(rows, exact_dedup.exact_groups(odd_docs).collect())
    monkeypatch.setattr(exact_dedup, "HASHES", 1)
    monkeypatch.setattr(exact_dedup, "_slots", lambda h, bits: np.zeros((len(h), 1), np.uint64))  # every slot collides
    check(rows, exact_dedup.exact_groups(odd_docs).collect())
    assert exact_dedup.exact_groups(no_docs).collect() == []


def test_drop_keeps_columns_and_one_row_per_text(spark, odd_docs, no_docs):
    out = exact_dedup.drop_exact_duplicates(odd_docs)
    assert out.columns == odd_docs.columns
    got, want = out.collect(), brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert sorted((hashlib.sha256((r["text"] or "").encode()).hexdigest(), r["doc_id"]) for r in got) == sorted((k, v[0]) for k, v in want.items())
    assert exact_dedup.drop_exact_duplicates(no_docs).collect() == []


def test_filter_has_no_false_negatives(spark):
    df = spark.range(4000).selectExpr("unhex(sha2(cast(id % 3000 as string), 256)) AS sha")
    bits = exact_dedup.filter_bits(4000)
    flag = exact_dedup.may_repeat(spark, exact_dedup.repeated_slots(df.repartition(5), "sha", bits))
    got = df.withColumn("m", flag("sha")).groupBy("sha").agg({"m": "min", "*": "count"}).collect()
    assert all(r["min(m)"] for r in got if r["count(1)"] > 1)
    assert sum(r["min(m)"] for r in got if r["count(1)"] == 1) < 40
