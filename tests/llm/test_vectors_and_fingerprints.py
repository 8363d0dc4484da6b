import collections
import functools
import hashlib
import math
import re
import struct

import numpy as np
import pytest
import xxhash

from llm_cases import DOCS, SF0001, no_docs, odd_docs  # noqa: F401
from ledgerloom.llm import centroid_clustering, fingerprints, vector_codes
from ledgerloom.llm.queries import QUERIES


def whole(vectors, scale):
    return np.array([[math.floor(scale * float(x)) for x in v] for v in vectors], object)


def apart(x, c):
    return ((x[:, None, :] - c[None]) ** 2).sum(axis=2)


def brute_clusters(rows, k=40, rounds=5, scale=256):
    ids, x = [r[0] for r in rows], whole([r[1] for r in rows], scale)
    mark = [("~", "") if i is None else (hashlib.sha256(f"2:{i}".encode()).hexdigest(), "") for i in ids]
    c = x[sorted(range(len(ids)), key=lambda i: mark[i])[:k]].copy()
    for done in range(rounds + 1):
        d = apart(x, c)
        to = [int(np.argmin(row)) for row in d]
        if done < rounds:
            for j in set(to):
                own = [i for i, t in enumerate(to) if t == j]
                c[j] = [int(s) // len(own) for s in x[own].sum(axis=0)]
    far = [int(d[i, t]) for i, t in enumerate(to)]
    sha = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c]
    return [(ids[i], t, far[i], sum(f for f, o in zip(far, to) if o == t), sum(far), sha[t]) for i, t in enumerate(to)]


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    ids, x = [r[0] for r in rows], whole([r[1] for r in rows], scale)
    width = x.shape[1] // parts
    first = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, list(x[i])))[:entries]
    cut = [x[:, p * width : (p + 1) * width] for p in range(parts)]
    books = [c[first].copy() for c in cut]
    for done in range(rounds + 1):
        d = [apart(c, b) for c, b in zip(cut, books)]
        to = [[int(np.argmin(row)) for row in one] for one in d]
        if done < rounds:
            for p in range(parts):
                for j in set(to[p]):
                    own = [i for i, t in enumerate(to[p]) if t == j]
                    books[p][j] = [int(s) // len(own) for s in cut[p][own].sum(axis=0)]
    sha = hashlib.sha256(",".join(str(v) for b in books for row in b for v in row).encode()).hexdigest()
    error = [int(sum(d[p][i, to[p][i]] for p in range(parts))) for i in range(len(ids))]
    return [(ids[i], "".join(f"{t[i]:02x}" for t in to), error[i], sum(e for e, r in zip(error, rows) if r[2] == rows[i][2]), sha) for i in range(len(ids))]


def same(got, want):
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_op12_and_op13_queries(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same(QUERIES["op12_centroid_clustering"](spark, SF0001).collect(), brute_clusters(rows))
    same(QUERIES["op13_vector_codes"](spark, SF0001).collect(), brute_codes(rows))


ODD = [
    (0, [0.5] * 8, 1), (1, [0.5] * 8, 1), (1, [0.5] * 8, 1), (2, [-0.001] * 8, None), (3, [0.25, -0.75] * 4, None), (None, [0.1] * 8, 2), (4, [0.0, -0.0] * 4, 1),
    (5, [float(i) for i in range(8)], 2), (6, [1e4] * 8, 2), (7, [-1e4] * 8, 3), (8, [0.5] * 7 + [0.5001], 1), (9, [0.1] * 8, 3),
]
LEFT_OUT = [(20, None, 1), (21, [None] + [1.0] * 7, 1), (22, [float("nan")] * 8, 1), (23, [float("inf")] + [0.0] * 7, 1), (24, [float("-inf")] * 8, None)]
KIND = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("k", [3, 40])
def test_clusters_of_odd_vectors(spark, k):
    df = spark.createDataFrame(ODD + LEFT_OUT + [(30, [1.0] * 7, 1), (31, [], 1)], KIND).selectExpr("*", "1 AS x", "2 AS coefs", "3 AS cluster").repartition(3)
    got = centroid_clustering.cluster_vectors(df, k=k, rounds=3, dim=8)
    same(got.collect(), brute_clusters(ODD, k=k, rounds=3))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroid_clustering.cluster_vectors(df.limit(0), dim=8).collect() == []
    with pytest.raises(Exception, match="do not fit a long"):
        centroid_clustering.cluster_vectors(spark.createDataFrame([(0, [1e30] * 8, 1)], KIND), dim=8).collect()


@pytest.mark.parametrize("entries", [3, 256])
def test_codes_of_odd_vectors(spark, entries):
    df = spark.createDataFrame(ODD + LEFT_OUT, KIND).selectExpr("*", "1 AS x", "2 AS code", "3 AS salt").repartition(3)
    same(vector_codes.encode_vectors(df, entries=entries, rounds=3).collect(), brute_codes(ODD, entries=entries, rounds=3))
    assert vector_codes.encode_vectors(df.limit(0)).collect() == []
    other = vector_codes.encode_vectors(spark.createDataFrame(ODD + [(40, [1.0] * 4, 1), (41, [], 9)], KIND), entries=entries, rounds=3).collect()
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in other if r["vec_id"] in (40, 41)} == {40: (None, None, next(r["label_error"] for r in other if r["vec_id"] == 0)), 41: (None, None, None)}
    with pytest.raises(ValueError):
        vector_codes.encode_vectors(spark.createDataFrame([(0, [1.0] * 6, 1)], KIND))


def test_codes_with_many_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 0)
    same(vector_codes.encode_vectors(spark.createDataFrame(ODD, KIND), entries=5).collect(), brute_codes(ODD, entries=5))


def test_progressive_search_and_balls_agree_with_whole_search():
    rng = np.random.default_rng(1)
    for spread in (3, 300, 2**26):
        x, c = rng.integers(-spread, spread, (700, 16)), rng.integers(-spread, spread, (30, 16))
        c[7] = c[3]  # a tie
        d = apart(x.astype(object), c.astype(object))
        h = centroid_clustering.walsh(16)
        to, far = centroid_clustering.nearest(x @ h.T, c @ h.T)
        assert to.tolist() == [int(np.argmin(r)) for r in d] and [int(f) // 16 for f in far] == [int(r.min()) for r in d]
        own = rng.integers(0, 30, 700)
        radii = [max([math.isqrt(int(d[i, j])) + 1 for i in range(700) if own[i] == j], default=0) for j in range(30)]
        assert vector_codes.Balls(c, radii).search(x, own).tolist() == [int(np.argmin(r)) for r in d]
    # well-separated balls: stable cores are not compared with anything
    c = np.arange(10)[:, None] * np.full((1, 4), 1000)
    assert all(not len(n) for n in vector_codes.Balls(c, [100] * 10).neighbours)


def xx(value, seed=42):
    data = value if isinstance(value, bytes) else struct.pack("<q" if isinstance(value, np.int64) else "<i", int(value))
    return xxhash.xxh64_intdigest(data, seed & (2**64 - 1))


@functools.cache
def brute_print(text, samples=64):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    pairs = [xx(b.encode(), xx(a.encode())) for a, b in zip(words, words[1:])] or [xx(w.encode()) for w in words]
    weights = collections.Counter(h >> 24 for h in pairs)
    out = []
    for k in range(samples if weights else 0):
        best = None
        for term, w in weights.items():
            seed = xx(np.int64(term))
            level, step = xx(k, seed) >> 20, 0
            if w > 1:
                h = xx(~k, seed)
                f1, e1 = -math.log1p(-(level + 0.5) / 2**44), -math.log(((h >> 32) + 0.5) / 2**32)
                r = e1 + math.log1p(-math.log(((h & 0xFFFFFFFF) + 0.5) / 2**32) / f1)
                step = math.floor((math.log(w) + e1) / r)
                if step:
                    level = min(math.floor(-math.expm1(-f1 * math.exp(-r * step)) * 2.0**44), 2**44 - 1)
            one = (level, (term + step * 40503) & 0xFFFF)
            best = one if best is None else min(best, one)
        out.append(best[1])
    return "".join(f"{b:04x}" for b in out), out, weights


def like(a, b):
    return float(len(a) == len(b)) if not a or not b else sum(x == y for x, y in zip(a, b)) / len(a)


def brute_fingerprints(rows):
    sign = lambda h: h - 2**64 if h >= 2**63 else h
    mark = lambda i, t: sign(xx(t.encode(), xx(int(i is None))))
    texts = [(i, t or "") for i, t in rows]
    order = sorted(set(texts), key=lambda r: (r[0] is None, -(r[0] or 0), mark(*r)))
    result = {}
    for n, (i, t) in enumerate(order):
        nxt = order[(n + 1) % len(order)][1]
        m = len(t) // 3
        edited = t[: len(t) - m] + nxt[:m]
        (a, x, _), (b, y, _), (_, z, _) = brute_print(t), brute_print(edited), brute_print(nxt)
        result[i, t] = (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, like(x, y), like(x, z))
    return [result[r] for r in texts]


def test_op11_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    same(QUERIES["op11_fingerprints"](spark, SF0001).collect(), brute_fingerprints(rows))


def test_fingerprints_of_odd_texts(spark, odd_docs, no_docs):  # noqa: F811
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = fingerprints.fingerprint_documents(odd_docs.selectExpr("*", "1 AS id", "2 AS mark", "3 AS term").repartition(5))
    same(got.collect(), brute_fingerprints(rows))
    assert fingerprints.fingerprint_documents(no_docs).collect() == []
    alone = fingerprints.fingerprint_documents(spark.createDataFrame([(7, "one two three", "", "", 0)], DOCS)).collect()
    same(alone, brute_fingerprints([(7, "one two three")]))


def test_fingerprints_run_without_python(spark):
    texts = spark.createDataFrame([(1, "a b c", "a b d")], "id long, one string, two string")
    plan = fingerprints.pair_fingerprints(texts, ["id"], "one", "two")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_collision_rate_is_generalised_jaccard(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):  # bags of single-word-pair terms with many weights above 1
        a, b = ("".join(f"w{i}-{j} x{i}-{j} .{i} " * int(n) for j, n in enumerate(rng.integers(0, 6, 12)) if n) for _ in range(2))
        rows.append((i, a, b))
    got = fingerprints.pair_fingerprints(spark.createDataFrame(rows, "id long, one string, two string"), ["id"], "one", "two", samples=256).collect()
    gap = []
    for r in got:
        x, y = brute_print(rows[r["id"]][1], 0)[2], brute_print(rows[r["id"]][2], 0)[2]
        truth = sum((x & y).values()) / sum((x | y).values())
        gap.append(like(r["fp_one"], r["fp_two"]) - truth)
    assert max(map(abs, gap)) < 0.15 and abs(np.mean(gap)) < 0.015
