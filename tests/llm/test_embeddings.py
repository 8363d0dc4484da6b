import numpy as np
import pytest

from llm_cases import SF0001
from ledgerloom.llm import embedding_dedup
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.queries import QUERIES


def brute(rows):
    out = []
    vs = []
    for i, v, label in rows:
        a = None if v is None or any(x is None for x in v) or label is None or i is None else np.array(v, float)
        vs.append(a if a is not None and np.isfinite(a).all() and a.any() else None)
    n = len(rows)
    linked = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = vs[i], vs[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    linked[i].append(j)
                    linked[j].append(i)
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in linked[todo.pop()]:
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((rows[i][0], len(linked[i]), least, True if vs[i] is None else rows[i][0] == least))
    return out


def same(got, want):
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


@pytest.mark.parametrize("block", [1024, 7])
def test_op2_query(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same(QUERIES["op2_embedding_dedup"](spark, SF0001).collect(), brute(rows))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1),
            (8, [None, 1.0], 1), (9, [1.0, -0.0], 1), (10, [2.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [], 1), (13, [1.0, 0.0], None), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS row", "2 AS cls", "3 AS digest")
    same(embedding_dedup.near_vectors(df).collect(), brute(rows))
    assert embedding_dedup.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("base", [1 << 43, (1 << 62) + 5, -(1 << 63)])
def test_components_of_large_ids(spark, base):
    pairs = [(4, 3), (3, 9), (9, 12), (20, 21), (21, 25), (25, 22), (30, 31)]
    edges = [(base + a, base + b) for a, b in pairs]
    got = {r["node"] - base: r["root"] - base for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == {4: 3, 9: 3, 12: 3, 21: 20, 25: 20, 22: 20, 31: 30}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 4999), (7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1400)} | {5000: 4999}


def test_plan_keeps_recall():
    for n in (10, 10**5, 10**9):
        bits, tables = embedding_dedup.plan(n)
        same_bucket = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - same_bucket) ** tables <= 1e-5
