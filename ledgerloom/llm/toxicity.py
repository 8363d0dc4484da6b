"""Toxicity (operator 5): maximum-scoring segments over token log-odds.

Training.  Tokens are lower-cased words cut to their first STEM letters.  The
numbers of toxic and of other labelled texts that hold them (so that a token
repeated within a text counts once) give log-odds with an informative
Dirichlet prior (the pooled counts, scaled to PRIOR of their sum) and a
z-score each.
Tokens with \\|z\\| >= Z form the lexicon; all others are pooled as one token.

Scoring.  A linear-time scan finds all maximal scoring segments of a text
(none can be extended or cut without losing score).  For a clean text of n
tokens the expected number of segments that reach a score S is about
K n exp(-lambda S): lambda solves sum p_i exp(lambda s_i) = 1 over the clean
token frequencies p_i, K is counted on the clean training texts, at the scaled score
lambda S = COUNTED_AT.  The segments that reach it and are expected less than
once are the significant passages: below it the formula promises far fewer
segments than clean texts have, and evidence would grow with their length.  Their -ln(expected
number), summed, is the evidence of a text, and a logistic curve fitted on the
training texts turns log(1 + evidence) into a score from 0 to 1.

Bound: about TRAIN_ROWS labelled rows at most (those whose doc_id's hash lies
below a cut-off that follows from their number) are read for training, a
parameter of the model; their texts are written once.  The lexicon comes from
them, so it is bounded with them.  Every text is scored, whole.

Defined results: a null or empty text has no evidence and gets the curve's
value at 0.  Labels that are null or belong to no row are ignored; of several
labels of a doc_id the largest counts.  Without any training row of either
class, or with no token that speaks for toxic, every score is 0.  A curve that
does not rise with the evidence, or was not fitted to the end, is an error: it
would give every text the same score.  Repeated rows and null doc_ids are scored like any
other; an empty table gives an empty result.  The score sees nothing but the
text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged, text_or_empty, unused

STEM = 5
PRIOR, Z = 0.1, 3.0
TRAIN_ROWS = 200_000
REJECT = 0.3
#: Scaled score at which the segments of clean texts are counted.
COUNTED_AT = 1.0
#: Bins of log(1 + evidence), each BIN wide, on which the curve is fitted.
BIN, BINS = 0.05, 400
_WORD = re.compile(r"[^\W\d_]+")
_stem = itemgetter(slice(0, STEM))


def tokens(text: str) -> list[str]:
    return list(map(_stem, _WORD.findall(text.lower())))


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    other: float = -1.0
    scale: float = 1.0  # lambda
    log_k: float = 0.0
    bias: float = -math.inf
    slope: float = 0.0

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """(tokens, [(first token, end, score)]) of all maximal scoring segments."""
        words = tokens(text)
        get, other = self.weights.get, self.other
        s = np.array([get(w, other) for w in words])
        if not len(s) or s.max() <= 0:
            return len(words), []
        up = s > 0
        starts = np.concatenate([[0], np.flatnonzero(up[1:] != up[:-1]) + 1])
        sums, ends = np.add.reduceat(s, starts), np.append(starts[1:], len(s))
        return len(words), maximal_segments(list(zip(starts.tolist(), ends.tolist(), sums.tolist())))

    def passages(self, text: str) -> list[tuple[int, int, float]]:
        """(first token, end, -ln expected number) of the significant segments."""
        n, found = self.segments(text)
        most = self.log_k + math.log(max(1, n))
        return [(a, b, self.scale * s - most) for a, b, s in found if self.scale * s > max(most, COUNTED_AT)]

    def evidence(self, text: str) -> float:
        return sum(x for _, _, x in self.passages(text))

    def score(self, evidence: float) -> float:
        x = self.bias + self.slope * math.log1p(evidence)
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def maximal_segments(runs: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring subsequences of (start, end, score) runs, in linear time.

    Candidates hold the cumulative score before (``low``) and after (``high``)
    them.  A new candidate looks for the last one that begins lower; if that
    one also ends lower, the two and what lies between merge."""
    found: list[tuple[int, int, float, float, int]] = []  # start, end, low, high, index of the last candidate with a smaller low
    total = 0.0
    for a, b, s in runs:
        if s <= 0:
            total += s
            continue
        low, high = total, total + s
        total = high
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                break
            a, low, nxt = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = nxt
        found.append((a, b, low, high, j))
    return [(a, b, high - low) for a, b, low, high, _ in found]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never read: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    known = staged(known, "labels")
    n = known.count()
    cut = (1 << 31) if n <= TRAIN_ROWS else (1 << 31) * TRAIN_ROWS // n
    bounded = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < cut).withColumnRenamed("doc_id", "id")
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    # about TRAIN_ROWS pairs of a number and a flag are broadcast; the training reads the texts three times
    return staged(texts.join(F.broadcast(bounded), "id").select("text", "toxic"), "training-texts")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a batch that hold each token, by class."""
    for batch in batches:
        by_class = {True: Counter(), False: Counter()}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            by_class[toxic].update(set(tokens(text)))
        words = list(by_class[True].keys() | by_class[False].keys())
        counts = [[by_class[c][w] for w in words] for c in (True, False)]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array(c, pa.int64()) for c in counts)], names=["token", "bad", "good"])


def _tail_rate(steps: list[tuple[float, float]]) -> float:
    """lambda > 0 with sum p exp(lambda s) = 1, for (p, s) of negative mean with some s > 0."""
    excess = lambda rate: sum(p * math.exp(min(700.0, rate * s)) for p, s in steps) - 1
    high = 1e-3
    while excess(high) < 0 and high < 1e3:
        high *= 2
    low = 0.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _fit_curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic regression on (x, toxic, other) counts, lightly regularised: Newton steps.
    Raises if they do not arrive, or at a curve that does not rise."""
    x, bad, good = (np.array(c, float) for c in zip(*bins))
    design, n = np.stack([np.ones_like(x), x], axis=1), bad + good
    w = np.zeros(2)

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float((n * np.logaddexp(0, z)).sum() - bad @ z + 0.05 * w @ w)

    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        gradient = design.T @ (bad - n * p) - 0.1 * w
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2), gradient)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:  # the loss is convex: a shorter step lowers it
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    gradient = design.T @ (bad - n / (1 + np.exp(-np.clip(design @ w, -500, 500)))) - 0.1 * w
    if not np.abs(gradient).max() <= 1e-6 * n.sum():
        raise ValueError(f"the toxicity curve was not fitted to the end: bias {w[0]:g}, slope {w[1]:g}, gradient {gradient.tolist()}")
    if not w[1] > 0:
        raise ValueError(f"the toxicity curve does not rise with the evidence (slope {w[1]:g} on {bad.sum():.0f} toxic and {good.sum():.0f} other texts): the labels do not tell toxic texts apart")
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    texts = _training_texts(docs, labels, id_col, text_col)
    counts = texts.mapInArrow(_count, "token string, bad long, good long").groupBy("token").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    counts = counts.persist()
    n_bad, n_good = (x or 0 for x in counts.agg(F.sum("bad"), F.sum("good")).first())
    if not n_bad or not n_good:
        counts.unpersist()
        return Model()
    strength = PRIOR * (n_bad + n_good)
    a, b = (F.col(c) + PRIOR * (F.col("bad") + F.col("good")) for c in ("bad", "good"))
    odds = F.log(a / (n_bad + strength - a)) - F.log(b / (n_good + strength - b))
    ranked = counts.select("*", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
    lexicon = ranked.where(F.abs("z") >= Z).collect()  # tokens of the bounded training texts
    counts.unpersist()
    if not any(r["odds"] > 0 for r in lexicon):
        return Model()
    weights = {r["token"]: r["odds"] for r in lexicon}
    share = {r["token"]: (r["good"] + PRIOR * (r["bad"] + r["good"])) / (n_good + strength) for r in lexicon}  # among clean tokens
    bad_share = sum((r["bad"] + PRIOR * (r["bad"] + r["good"])) / (n_bad + strength) for r in lexicon)
    rest = max(1e-9, 1 - sum(share.values()))
    # all other tokens as one; it must cost enough that a clean text loses score on the way, or segments would never end
    drift = sum(p * weights[w] for w, p in share.items())
    other = min(math.log(max(1e-9, 1 - bad_share) / rest), -0.05, -(drift + 0.01) / rest)
    steps = [(p, weights[w]) for w, p in share.items()] + [(rest, other)]
    rate = _tail_rate(steps)

    first = Model(weights, other, rate)

    def clean_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the clean texts: tokens, and segments whose scaled score is at least COUNTED_AT."""
        for batch in batches:
            got = [first.segments(t) for t, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()) if not toxic]
            n = sum(sum(rate * s >= COUNTED_AT for _, _, s in found) for _, found in got)
            yield pa.RecordBatch.from_arrays([pa.array([sum(k for k, _ in got)], pa.int64()), pa.array([n], pa.int64())], names=["tokens", "segments"])

    n_tokens, n_segments = texts.mapInArrow(clean_segments, "tokens long, segments long").agg(F.sum("tokens"), F.sum("segments")).first()
    second = Model(weights, other, rate, math.log((n_segments + 1) / max(1, n_tokens)) + COUNTED_AT)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [min(BINS - 1, int(math.log1p(second.evidence(t)) / BIN)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column("toxic")], names=["bin", "toxic"])

    bins = texts.mapInArrow(binned, "bin int, toxic boolean").groupBy("bin").agg(F.sum(F.col("toxic").cast("long")), F.sum((~F.col("toxic")).cast("long"))).collect()
    bias, slope = _fit_curve([(r[0] * BIN, r[1], r[2]) for r in bins])
    return Model(weights, other, rate, second.log_k, bias, slope)


def toxicity_score(model: Model, spark) -> Column:
    """A column function: text -> score."""
    # Plain values: a broadcast object of this package could only be read where the package is installed.
    shared = spark.sparkContext.broadcast(astuple(model))

    @F.pandas_udf("double")
    def score(texts):
        model = Model(*shared.value)
        return texts.map(lambda t: model.score(model.evidence(t)))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    score = toxicity_score(train(docs, labels, id_col, text_col), docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), score(text_or_empty(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose score reaches REJECT, all columns kept."""
    mark = unused(docs, "toxicity")
    score = toxicity_score(train(docs, labels, id_col, text_col), docs.sparkSession)
    return docs.withColumn(mark, score(text_or_empty(text_col))).where(F.col(mark) < REJECT).drop(mark)
