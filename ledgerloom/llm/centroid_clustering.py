"""Centroid clustering (operator 12): Walsh-Hadamard progressive search.

Vectors become integers, and integers their Walsh-Hadamard coefficients in
order of sequency, coarse to fine.  The transform is exact (additions only)
and keeps squared distances up to the factor ``dim``.  To find the nearest
centroid, squared differences are accumulated over 1, 2, 4, ... ``dim``
coefficients.  The sum so far never exceeds the whole, so a centroid whose
sum so far is strictly above the whole distance of a well-placed rival is out;
what is left at the end has been compared on all coefficients, and ties go to
the smaller number.

The coefficients are written once.  A round is one pass that assigns and sums
coefficients per centroid inside each task; the transform being linear, the
sums of coefficients give the sums of components exactly.  Only ``k`` rows
reach the driver, whatever the table or the size of a cluster.

Defined results: vectors that are null, of another length than ``dim`` or hold
a null or non-finite component are left out; null ids are kept; repeated rows
count each.  Start centroids of one hash (repeated ids) come in the order of
their coefficients, null ids last.  With fewer vectors than ``k`` each is a
centroid; an empty table gives an empty result.  Scaled components beyond
+-LARGEST are an error, as their distances need not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged

#: Largest scaled component for which all squared distances fit a long.
LARGEST = 2**27
#: Up to here coefficients, differences and their sums stay exact in 64-bit integers.
SMALL = 2**21
#: Pairs of vector and centroid that one step holds.
PAIRS = 1_000_000


def usable_vector(vector: str) -> Column:
    """Not null, and no component null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))


def whole_numbers(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def matrix_of(column: pa.ListArray, width: int) -> np.ndarray:
    """A list column, all of one length, as a matrix of 64-bit integers."""
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)
    if m.size and max(-int(m.min()), int(m.max())) > LARGEST:
        raise ValueError(f"scaled components beyond +-{LARGEST} have distances that do not fit a long")
    return m


def walsh(dim: int) -> np.ndarray:
    """Walsh-Hadamard matrix, rows by their number of sign changes."""
    if dim < 1 or dim & (dim - 1):
        raise ValueError("the transform needs a power of two as length")
    h = np.ones((1, 1), np.int64)
    while len(h) < dim:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, dim x squared distance) per row; both arguments are coefficients."""
    step = max(1, PAIRS // len(centroids))
    found = [_nearest(x[i : i + step], centroids) for i in range(0, max(1, len(x)), step)]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    (n, dim), k = x.shape, len(centroids)
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) > SMALL * dim:
        x, centroids = x.astype(object), centroids.astype(object)  # Python's integers: exact at any size
    row, number = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)  # pairs still in the race, row by row
    part = np.zeros(n * k, x.dtype)
    bound = None
    done = 0
    while done < dim:
        upto = max(1, 2 * done)
        for a in range(done, upto):  # one coefficient at a time: memory stays at a few numbers per pair
            d = x[row, a] - centroids[number, a]
            part += d * d
        done = upto
        if bound is None and done >= min(4, dim):  # a rival for each row: the best so far, on all coefficients
            d = x - centroids[np.argmin(part.reshape(n, k), axis=1)] if n else x
            bound = (d * d).sum(axis=1)
        if bound is not None:
            left = (part <= bound[row]).astype(bool)
            row, number, part = row[left], number[left], part[left]
    if not n:
        return row, part
    best = np.minimum.reduceat(part, np.searchsorted(row, np.arange(n)))
    at = np.flatnonzero((part == best[row]).astype(bool))
    first = at[np.searchsorted(row[at], np.arange(n))]
    return number[first], best


def _transform(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    h = walsh(dim)
    for batch in batches:
        coefs = matrix_of(batch.column("x"), dim) @ h.T
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(coefs) + 1) * dim, pa.int32()), pa.array(coefs.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], names=["vec_id", "coefs"])


def _coefs(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("coefs").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per centroid: vectors assigned and the sums of their coefficients, one row per task and centroid."""
    k, dim = centroids.shape
    count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    for batch in batches:
        x = _coefs(batch, dim)
        to, _ = nearest(x, centroids)
        count += np.bincount(to, minlength=k)
        np.add.at(total, to, x)
    at = np.flatnonzero(count)
    sums = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * dim, pa.int32()), pa.array(total[at].ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at]), sums], names=["cluster", "n", "sums"])


def _assign(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    dim = centroids.shape[1]
    for batch in batches:
        to, far = nearest(_coefs(batch, dim), centroids)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(to, pa.int32()), pa.array((far // dim).tolist(), pa.int64())], names=["vec_id", "cluster", "distance"])


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    kept = vectors.where(usable_vector(vector_col) & (F.size(vector_col) == dim))
    kept = kept.select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(vector_col, scale).alias("x"))
    table = staged(kept.mapInArrow(lambda it: _transform(it, dim), "vec_id long, coefs array<long>"), "coefficients")

    h = walsh(dim)
    mark = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    start = table.orderBy(mark.asc_nulls_last(), "coefs").limit(k).select("coefs").collect()  # k rows
    centroids = np.array([r["coefs"] for r in start], np.int64).reshape(len(start), dim)

    for _ in range(rounds if len(start) else 0):
        now = centroids
        sums = table.mapInArrow(lambda it: _sums(it, now), "cluster int, n long, sums array<long>")
        rows = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dim)]).alias("sums")).collect()  # k rows
        centroids = now.copy()
        for r in rows:
            components = [int(s) // dim for s in h.T.astype(object) @ np.array(r["sums"], object)]  # H'H = dim: an exact division
            centroids[r["cluster"]] = h @ np.array([s // r["n"] for s in components], np.int64)

    final = centroids
    assigned = table.mapInArrow(lambda it: _assign(it, final), "vec_id long, cluster int, distance long")
    assigned = staged(assigned, "clusters")
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    names = [hashlib.sha256(",".join(str(int(c) // dim) for c in h.T @ row).encode()).hexdigest() for row in final]
    facts = [(i, inertia[i], sum(inertia.values()), name) for i, name in enumerate(names) if i in inertia]
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row per centroid: k rows
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
