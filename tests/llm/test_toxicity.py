import math
import random
import zlib

import pytest

from llm_cases import no_docs, odd_docs  # noqa: F401
from ledgerloom.llm import toxicity
from ledgerloom.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.1"


def brute_segments(scores):
    """By definition: best segment, then the same left and right of it."""

    def split(a, b):
        best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return [*split(a, i), (i, j, best[0]), *split(j, b)]

    return split(0, len(scores))


def test_scan_finds_all_maximal_segments():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.choice([-3.1, -1.7, -0.53, 0.9, 2.3]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got = toxicity.maximal_segments([(i, i + 1, s) for i, s in enumerate(scores)])
        assert [(a, b, round(s, 6)) for a, b, s in got] == [(a, b, round(s, 6)) for a, b, s in brute_segments(scores)]


def test_held_out_rule(spark):
    rows = spark.range(200).select("id", toxicity.held_out(toxicity.F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_op5_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](spark, SF01).collect()}
    labels = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect() if r["doc_id"] in got]
    assert len(got) == 10000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    bad = [got[i]["score"] for i, t in labels if t and got[i]["held_out"]]
    good = [got[i]["score"] for i, t in labels if not t and got[i]["held_out"]]
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.93 and sum(s >= 0.3 for s in good) <= 0.02 * len(good)


def test_finds_the_passage(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu") for b in ("lor", "nes", "tid", "vak", "rop")]
    rows = []
    for i in range(400):
        text = [rng.choice(words) for _ in range(80)]
        if i % 5 == 0:
            text[30:30] = rng.choices(["vile", "scummy", "rotten"], k=6)
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.drop("toxic"), df.drop("text"))
    for _, text, toxic in rows:
        found = model.passages(text)
        assert [(a, b) for a, b, _ in found] == ([(30, 36)] if toxic else [])


def test_curve_converges_on_heavy_bins():
    # condensed from the bins of 0.51 GB of documents: steps clipped to 2 ran away from the optimum and gave no score above 0.3
    bins = [(0.0, 0, 28822), (1.0, 0, 2400), (1.4, 0, 5200), (1.8, 0, 6800), (2.2, 0, 9100), (2.5, 30, 9800), (2.8, 1100, 4300),
            (3.0, 1150, 700), (3.3, 1600, 100), (3.6, 1200, 60), (4.0, 900, 20), (5.0, 500, 10), (6.3, 60, 1)]
    bias, slope = toxicity._fit_curve(bins)
    assert slope > 3 and 2.5 < (math.log(0.3 / 0.7) - bias) / slope < 3.0
    p = [1 / (1 + math.exp(-bias - slope * x)) for x, _, _ in bins]
    assert abs(sum((b + g) * q for q, (_, b, g) in zip(p, bins)) - sum(b for _, b, _ in bins)) < 5


@pytest.mark.parametrize("bins", [[(0.0, 50, 10), (3.0, 5, 400)], [(0.0, 10, 90)]])
def test_curve_that_does_not_rise_is_an_error(bins):
    with pytest.raises(ValueError, match="does not rise"):
        toxicity._fit_curve(bins)


def test_weak_words_are_no_evidence():
    model = toxicity.Model({"vile": 4.0, "weak": 0.2}, other=-0.05, scale=1.5, log_k=-7.0)
    clean = " ".join((["weak"] + ["plain"] * 9) * 50)
    assert model.evidence(clean) == 0
    assert [(a, b) for a, b, _ in model.passages(clean + " vile")] == [(500, 501)]


def test_op5_counts_agree_with_labels(spark):
    got = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](spark, SF01).collect()}
    labels = [(got[r["doc_id"]], r["toxic"]) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect() if r["doc_id"] in got]
    for held_out in (False, True):
        bad, good = ([r["predicted"] for r, t in labels if r["held_out"] == held_out and bool(t) == toxic] for toxic in (True, False))
        assert sum(bad) >= 0.95 * len(bad) > 0 and sum(good) <= 0.02 * len(good)


def test_odd_rows_and_no_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 1), (3, 0, 0), (None, 1, 1), (5, 1, None), (0, 0, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert [r["score"] for r in toxicity.score_documents(odd_docs, labels.limit(0)).collect()] == [0.0] * len(got)
    assert toxicity.score_documents(no_docs, labels).collect() == []
    out = toxicity.drop_toxic(odd_docs, labels.limit(0))
    assert out.columns == odd_docs.columns and out.count() == len(got)
