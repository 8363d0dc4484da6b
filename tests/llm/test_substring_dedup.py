import collections
import hashlib
import random
import re

import pytest

from llm_cases import SF0001, no_docs, odd_docs  # noqa: F401
from ledgerloom.llm import substring_dedup
from ledgerloom.llm.queries import QUERIES


def brute(rows, window=35):
    """(doc_id, words, removed, hash of the kept ones) and the kept words of (doc_id, text) rows."""
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    times = collections.Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append(((doc_id, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()), kept))
    return out


def same(got, rows):
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(r) for r, _ in brute(rows))


def test_op9_query(spark):
    sf = SF0001.replace("0.001", "0.01")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op9_substring_dedup"](spark, sf).collect()
    same(got, rows)
    assert sum(r["n_removed"] > 0 for r in got) > 50


def planted():
    rng = random.Random(2)
    fresh = lambda n: [f"v{rng.random()}" for _ in range(n)]
    passage, line = fresh(60), fresh(36)
    rows = [(i, " ".join([*fresh(rng.randint(0, 50)), *passage[rng.randint(0, 5) : 60 - rng.randint(0, 5)], *fresh(rng.randint(0, 50))])) for i in range(60)]
    rows += [(100 + i, "\n".join([*fresh(10), *line[i % 2 :], *fresh(30), *line[: 36 - i % 3]])) for i in range(20)]
    rows += [(200, " ".join(["same"] * 36)), (201, " ".join(["same"] * 35)), (202, " ".join(["other"] * 35)), (203, " ".join(["a", "b"] * 40))]
    rows += [(300 + i, " ".join([*passage[:34], *fresh(40), *passage[30:64]])) for i in range(3)]
    rows += [(400, " ".join(base := fresh(500))), (401, " ".join(base)), (402, " ".join(base[:200] + fresh(1) + base[201:])), (402, "x")]
    return rows


@pytest.mark.parametrize("bits", [1 << 28, 1 << 16])
def test_planted_passages(spark, monkeypatch, bits):
    monkeypatch.setattr(substring_dedup, "MAX_FILTER_BITS", bits)
    monkeypatch.setattr(substring_dedup, "TEXT_RUN", 4000)
    same(substring_dedup.repeat_report(spark.createDataFrame(planted(), "doc_id long, text string").repartition(4)).collect(), planted())


def test_texts_with_whole_paths_and_bit_sets(spark):
    """Spans without bits and bit sets without a length in one batch, over the 53 bits of a double."""
    rows = [(i, t) for i, (_, t) in enumerate(planted())]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    got = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", r["text"]) for r in out}
    assert got == {r[0]: kept for r, kept in brute(rows)}


@pytest.mark.parametrize("window", [3, 11, 73, 74, 200])
def test_any_window(spark, window):
    rng = random.Random(window)
    fresh = lambda n: [f"v{rng.random()}" for _ in range(n)]
    long, short = fresh(3 * window), fresh(window)
    rows = [(i, " ".join([*fresh(20), *long[i:], *fresh(20)])) for i in range(4)] + [(10 + i, " ".join([*fresh(9), *short])) for i in range(2)]
    rows += [(20, " ".join(long[: window - 1])), (21, " ".join(fresh(5 * window))), (22, " ".join(["same"] * (window + 1))), (23, None)]
    got = substring_dedup.repeat_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), window).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(r) for r, _ in brute(rows, window))


def test_window_without_words_is_an_error(spark, no_docs):
    with pytest.raises(ValueError, match="at least one word"):
        substring_dedup.repeat_report(no_docs, 0)


def test_filter_that_passes_everything(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(substring_dedup, "_holds", lambda bitmap, values: np.ones(len(values), bool))
    same(substring_dedup.repeat_report(spark.createDataFrame(planted(), "doc_id long, text string")).collect(), planted())


def test_odd_rows_and_text_output(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    same(substring_dedup.repeat_report(odd_docs).collect(), rows)
    assert substring_dedup.repeat_report(no_docs).collect() == []
    out = substring_dedup.remove_repeats(odd_docs)
    assert out.columns == odd_docs.columns
    want = collections.Counter(t if not r[2] else " ".join(k) for (_, t), (r, k) in zip(rows, brute(rows)))
    assert collections.Counter(r["text"].strip() if r["text"] and len(r["text"]) > 500 else r["text"] for r in out.collect()) == collections.Counter(
        {(t.strip() if t and len(t) > 500 else t): n for t, n in want.items()}
    )
    assert substring_dedup.remove_repeats(no_docs).collect() == []


def test_white_space_of_kept_words_stays(spark):
    twice = " ".join(f"r{i}" for i in range(35))
    df = spark.createDataFrame([(1, f"\n a\tb \n{twice}  c\n\nd"), (2, twice)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(df).collect()} == {1: "\n a\tb \nc\n\nd", 2: ""}


def test_word_hashes_are_of_the_word_alone(monkeypatch):
    rng = random.Random(8)
    words = [bytes(rng.choices(b"ab\x00\xc3\xa9~", k=rng.randint(1, 9))) for _ in range(3000)] + [b"a" * 500, b"a" * 501, b"a", b"a\0"]
    whole = substring_dedup.WordHashes().of([words[:10], [], words[10:]])
    monkeypatch.setattr(substring_dedup, "HASH_RUN", 64)
    parts = substring_dedup.WordHashes().of([words])
    assert parts.tolist() == whole.tolist() and len({*zip(words, whole.tolist())}) == len(set(words)) == len(set(whole.tolist()))
    assert substring_dedup.WordHashes().of([[], []]).tolist() == []


def _colliding(all_equal):
    """Word hashes that do not see what follows a tilde; with ``all_equal``, hashes that see nothing."""

    class Hashes:
        def of(self, texts):
            from ledgerloom.llm.near_dedup import word_hashes

            return word_hashes().of([[b"x" if all_equal else w.split(b"~")[0] for w in t] for t in texts])

    return Hashes


@pytest.mark.parametrize("all_equal", [False, True])
def test_colliding_hashes_remove_nothing_unique(spark, monkeypatch, all_equal):
    monkeypatch.setattr(substring_dedup, "word_hashes", _colliding(all_equal))
    rng = random.Random(5)
    fresh = lambda n: [f"v{rng.random()}" for _ in range(n)]
    disguised = lambda words, k, every=1: [w if i % every else f"{w}~{k}" for i, w in enumerate(words)]
    a, b, c, d = fresh(120), fresh(90), fresh(80), fresh(70)
    rows = [(1, a), (2, disguised(a, 1)), (3, disguised(a, 2)), (4, a[:60] + disguised(a, 3)[60:])]
    rows += [(10, fresh(9) + b + fresh(4)), (11, fresh(3) + disguised(b, 1, 50) + fresh(8)), (12, b[10:60])]
    rows += [(20 + i, fresh(5) + c) for i in range(3)] + [(23, disguised(c, 1)), (24, disguised(c, 1)[20:70] + fresh(3)), (25, c[30:70])]
    rows += [(30, d), (31, disguised(d, 1)), (32, fresh(5) + disguised(d, 1)[5:60] + fresh(5)), (33, d), (33, d), (34, fresh(50))]
    rows = [(i, " ".join(w)) for i, w in rows]
    same(substring_dedup.repeat_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect(), rows)


def test_long_chain_with_branches(spark, monkeypatch):
    """Whole copies of a long text are one chain; a copy with an insertion cuts it in two; repeated rows count."""
    rng = random.Random(6)
    fresh = lambda n: [f"v{rng.random()}" for _ in range(n)]
    long, round_ = fresh(4000), fresh(50)
    rows = [(1, long), (2, fresh(7) + long), (3, long[:1500] + fresh(2) + long[1500:]), (4, long[100:3000]), (5, round_ * 6), (6, fresh(3) + round_ * 2), (7, fresh(100))]
    rows = [(i, " ".join(w)) for i, w in rows] + [(8, " ".join(long))] * 3
    seen = []
    spans = substring_dedup._chain_spans
    monkeypatch.setattr(substring_dedup, "_chain_spans", lambda *a: seen.append(spans(*a)) or seen[-1])
    same(substring_dedup.repeat_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect(), rows)
    assert max(r["n"] for r in seen[0].collect()) > 900
