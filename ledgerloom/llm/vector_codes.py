"""Vector code compression (operator 13): product codes learned by ball k-means.

A vector of integers is cut into equal consecutive parts, and each part
position has a codebook.  The parts of an entry lie in a ball around it.  An
entry j can only be as near to a part as the part's own entry i if
``|i - j| <= 2 * |part - i|``.  So the ball's radius gives the entry's
neighbours (those within two radii); parts nearer to i than half the way to
its nearest neighbour are its stable core and keep their code unseen; all
others lie in rings between half the distances to successive neighbours, and a
ring's parts are compared exactly with the neighbours up to that ring only.
All of it is integer arithmetic, so ties (lower index) come out right.

The radius is not measured again after a codebook has moved: the farthest part
of the last round plus the entry's own move bounds it.  The first round, which
has no balls yet, compares with the whole codebook.  A round writes the codes
beside the vectors, and one aggregation sums parts per entry inside tasks; only
codebooks (parts x entries rows) reach the driver.

Defined results: vectors that are null or hold a null or non-finite component
are left out.  The length is that of the smallest kept id's vector; it must be
a multiple of ``parts``, else that is an error.  Vectors of another length
cannot be coded: code and error null, and no part in sums.  Repeated rows count
each; start entries of equal ids come in the order of their components, null
ids last.  With fewer vectors than entries the codebook is as short.  An empty
table gives an empty result.  Scaled components beyond +-LARGEST are an error,
as their distances need not fit a long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.centroid_clustering import LARGEST, matrix_of, usable_vector, whole_numbers
from ledgerloom.llm.common import staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rings are compared in runs that end at these numbers of neighbours.
RING_ENDS = (4, 16, 64)
#: Parts compared at once.
ROWS = 65_536
#: Labels whose error sums are broadcast (two columns each); more are joined by shuffle.
FEW_LABELS = 10_000
LABEL_SALTS = 16


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of two integer matrices, as 64-bit integers."""
    largest = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if 4 * x.shape[1] * int(largest) ** 2 < 2**53:  # every term and sum is exact in a double
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)).astype(np.int64)
    out = np.zeros((len(x), len(c)), np.int64)
    for i in range(x.shape[1]):
        d = x[:, i, None] - c[:, i]
        out += d * d
    return out


def whole_search(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Nearest entry of every row, by comparing with all."""
    return np.concatenate([np.argmin(squared(x[i : i + ROWS], entries), axis=1) for i in range(0, len(x), ROWS)] or [np.zeros(0, np.int64)])


class Balls:
    """A codebook with the neighbours of every entry: those that its ball's radius lets compete, nearest first."""

    def __init__(self, entries: np.ndarray, radii: list[int]):
        self.entries = entries
        between = squared(entries, entries)
        self.neighbours, self.between = [], []
        for i, radius in enumerate(radii):
            rival = np.flatnonzero(between[i] <= 4 * radius * radius)
            rival = rival[rival != i]
            rival = rival[np.argsort(between[i, rival], kind="stable")]
            self.neighbours.append(rival)
            self.between.append(between[i, rival])

    def search(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Nearest entry of every row, ``own`` being the entry whose ball it lies in."""
        code = own.copy()
        d = x - self.entries[own]
        far = (d * d).sum(axis=1)
        by_ball = np.argsort(own, kind="stable")
        ends = np.searchsorted(own[by_ball], np.arange(len(self.entries) + 1))
        for i, rivals in enumerate(self.neighbours):
            ball = by_ball[ends[i] : ends[i + 1]]
            if not len(ball) or not len(rivals):
                continue
            ring = np.searchsorted(self.between[i], 4 * far[ball], side="right")  # rivals that may be as near
            lower = 0  # ring 0 is the stable core
            for upper in (*RING_ENDS, len(rivals)):
                rows = ball[(ring > lower) & (ring <= upper)]
                lower = max(lower, upper)
                if len(rows):
                    rival = np.sort(np.append(rivals[:upper], i))
                    for a in range(0, len(rows), ROWS):
                        at = rows[a : a + ROWS]
                        code[at] = rival[np.argmin(squared(x[at], self.entries[rival]), axis=1)]
        return code


def _codes(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    return batch.column("code").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, parts).astype(np.int64)


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel(), kind))


def _assign(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], balls: list[Balls] | None) -> Iterator[pa.RecordBatch]:
    """Sets the column ``code``: by balls where there are some, else by whole search."""
    parts, width = len(books), books[0].shape[1]
    for batch in batches:
        x = matrix_of(batch.column("x"), parts * width)
        cut = [x[:, p * width : (p + 1) * width] for p in range(parts)]
        if balls is None:
            code = [whole_search(c, book) for c, book in zip(cut, books)]
        else:
            old = _codes(batch, parts)
            code = [ball.search(c, old[:, p]) for p, (c, ball) in enumerate(zip(cut, balls))]
        columns = [*(batch.column(c) for c in ("vec_id", "label", "x")), _lists(np.stack(code, axis=1), pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "x", "code"])


def _sums(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Per part position and entry: parts, their componentwise sums and the largest squared distance, one row per task."""
    parts, (entries, width) = len(books), books[0].shape
    n, total, far = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    for batch in batches:
        x, code = matrix_of(batch.column("x"), parts * width), _codes(batch, parts)
        for p in range(parts):
            cut, own = x[:, p * width : (p + 1) * width], code[:, p]
            n[p] += np.bincount(own, minlength=entries)
            np.add.at(total[p], own, cut)
            d = cut - books[p][own]
            np.maximum.at(far[p], own, (d * d).sum(axis=1))
    part, entry = np.nonzero(n)
    columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n[part, entry]), pa.array(far[part, entry]), _lists(total[part, entry], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "far", "sums"])


def _result(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    parts, width = len(books), books[0].shape[1]
    digits = max(2, len(f"{max(1, len(books[0]) - 1):x}"))
    for batch in batches:
        x, code = matrix_of(batch.column("x"), parts * width), _codes(batch, parts)
        error = np.zeros(len(x), np.int64)
        for p in range(parts):
            d = x[:, p * width : (p + 1) * width] - books[p][code[:, p]]
            error += (d * d).sum(axis=1)
        text = ["".join(f"{c:0{digits}x}" for c in row) for row in code.tolist()]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])


def _root_above(n: int) -> int:
    r = math.isqrt(n)
    return r if r * r == n else r + 1


def learn_codes(table: DataFrame, dim: int, parts: int, entries: int, rounds: int) -> tuple[DataFrame, list[np.ndarray]]:
    """``table`` (vec_id, label, x) -> the same rows with their final codes, and the codebooks."""
    width = dim // parts
    start = table.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()  # as many rows as a codebook has entries
    first = np.array([r["x"] for r in start], np.int64).reshape(len(start), dim)
    books = [np.ascontiguousarray(first[:, p * width : (p + 1) * width]) for p in range(parts)]
    kind = f"vec_id long, label {table.schema['label'].dataType.simpleString()}, x array<long>, code array<int>"
    balls = None
    for done in range(rounds + 1):
        now, around = books, balls
        table = staged(table.mapInArrow(lambda it: _assign(it, now, around), kind), f"codes-{done}")
        if done == rounds:
            return table, books
        sums = table.mapInArrow(lambda it: _sums(it, now), "part int, entry int, n long, far long, sums array<long>")
        sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.max("far").alias("far"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
        books, radii = [b.copy() for b in now], [[0] * len(b) for b in now]
        for r in sums.collect():  # parts x entries rows
            p, e = r["part"], r["entry"]
            books[p][e] = [s // r["n"] for s in r["sums"]]
            move = sum((int(a) - int(b)) ** 2 for a, b in zip(books[p][e], now[p][e]))
            radii[p][e] = _root_above(r["far"]) + _root_above(move)
        balls = [Balls(b, r) for b, r in zip(books, radii)]
    raise AssertionError("unreachable")


def encode_vectors(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    if entries < 1 or parts < 1:
        raise ValueError("parts and entries are at least 1")
    kept = vectors.where(usable_vector(vector_col)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    least = kept.orderBy(F.col("vec_id").asc_nulls_last(), F.size("vector")).select(F.size("vector").alias("dim")).first()
    dim = least["dim"] if least else parts
    if dim % parts or not dim:
        raise ValueError(f"vectors of length {dim} cannot be cut into {parts} equal parts")
    kept = kept.select("vec_id", "label", whole_numbers("vector", scale).alias("x"))
    fits = F.size("x") == dim
    result = "vec_id long, label {0}, code string, error long".format(kept.schema["label"].dataType.simpleString())
    sha = hashlib.sha256(b"").hexdigest()
    coded = kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")).where(F.lit(False))
    if least:
        table, books = learn_codes(kept.where(fits), dim, parts, entries, rounds)
        sha = hashlib.sha256(",".join(str(c) for book in books for row in book.tolist() for c in row).encode()).hexdigest()
        coded = table.mapInArrow(lambda it: _result(it, books), result)
    other = kept.where(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = staged(coded.unionByName(other), "coded")

    sums = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    salted = coded.withColumn("salt", F.lit(0))
    if sums.count() <= FEW_LABELS:
        joined = salted.join(F.broadcast(sums.withColumnRenamed("label", "of")), F.col("label").eqNullSafe(F.col("of")))
    else:  # a label may hold a third of all rows: its rows are dealt to LABEL_SALTS keys
        salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(LABEL_SALTS)).cast("int"))
        copies = sums.withColumnRenamed("label", "of").withColumn("dealt", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
        joined = salted.join(copies, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("dealt")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
