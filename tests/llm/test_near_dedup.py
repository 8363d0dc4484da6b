import itertools
import random
import re

import numpy as np
import pytest

from llm_cases import SF0001, no_docs, odd_docs  # noqa: F401
from ledgerloom.llm import near_dedup
from ledgerloom.llm.queries import QUERIES


def shingles(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, percent):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    tried = set()
    for own in holders.values():
        for i, j in itertools.combinations(own, 2):
            if (i, j) not in tried and rows[i][0] is not None and rows[j][0] is not None:
                tried.add((i, j))
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        c = None if doc_id is None else least[root(i)]
        out.append((doc_id, len(sets[i]), c, c is None or c == doc_id))
    return out


def same(got, rows, percent):
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute(rows, percent)))


def test_op7_query(spark):
    sf = SF0001.replace("0.001", "0.01")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op7_near_dedup"](spark, sf).collect()
    same(got, rows, 85)
    assert sum(not r["kept"] for r in got) > 50


@pytest.mark.parametrize("block, percent", [(512, 85), (9, 80)])
def test_groups_of_near_copies_with_a_chain(spark, monkeypatch, block, percent):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(9)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(300)]
    rows, text = [], list(base)
    for i in range(150):  # drifts away from the first text: links only to its neighbours
        text = list(text)
        for _ in range(2):
            text[rng.randrange(300)] = f"x{rng.random()}"
        rows.append((1000 - i, " ".join(text)))
    for i in range(200):  # near copies of one text around the threshold
        t = list(base)
        for _ in range(rng.randint(1, 9)):
            t[rng.randrange(300)] = f"y{rng.random()}"
        rows.append((2000 + i, " ".join(t).upper() if i % 2 else "\t".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(near_dedup.near_groups(df, percent).collect(), rows, percent)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    same(near_dedup.near_groups(odd_docs).collect(), rows, 80)
    assert near_dedup.near_groups(no_docs).collect() == []
    out = near_dedup.drop_near_duplicates(odd_docs)
    assert out.columns == odd_docs.columns
    want = [r for r, j in zip(rows, brute(rows, 80)) if j[3]]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in out.collect()))) == sorted(map(str, want))


def test_index_guarantees_the_distance():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 65536, (300, near_dedup.SLOTS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(near_dedup.SLOTS, near_dedup.MAX_ERRORS, replace=False)
        row[at] ^= 1
    ka, kb = near_dedup.index_keys(a), near_dedup.index_keys(b)
    assert all(set(x) & set(y) for x, y in zip(ka.tolist(), kb.tolist()))


def test_words_split_at_six_characters_only():
    assert near_dedup.words_of("A\x0bÄB \x1cc\x1d d e f\x85g") == [w.encode() for w in ("a", "Äb", "\x1cc\x1d", "d e f\x85g")]


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6])
def test_shingle_counts(n):
    assert len(near_dedup.shingle_sets([" ".join(f"a{i}" for i in range(n))])[0]) == len(shingles(" ".join(f"a{i}" for i in range(n))))


def test_shared_counts_either_way():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    i, j = map(np.ravel, np.meshgrid(np.arange(40), np.arange(40)))
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert near_dedup._shared_counts(sets, sets, i, j).tolist() == want  # by products
    assert near_dedup._shared_counts(sets, sets, i[5:6], j[5:6]).tolist() == want[5:6]  # one by one
