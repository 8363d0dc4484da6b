"""Embedding near-dedup (operator 2): random-hyperplane sign hashing.

Equal vectors of a label form one class, so copies are never paired.  Each
class is hashed into several tables by the signs of its products with seeded
random hyperplanes; classes that share a bucket of some table are compared by
exact cosine in double precision.  A pair is counted only in the first table
in which it shares a bucket.  Buckets are compared block by block, and what
leaves a block is at most two rows per class: how many vectors it links to and
one edge towards the block's spanning forest.  Connected components of those
edges (``components``) give the groups.

Bits and tables follow from the number of vectors: about log2(n) - 4 bits keep
buckets small, and as many tables as make a pair at the threshold share a
bucket with probability 1 - MISS.  Buckets over BLOCK classes are cut into
blocks and every pair of blocks is a task of its own.

Defined results: a null, zero, non-finite or null-holding vector, and a vector
without a label or id, links with nothing: n_links 0, component_id its own id,
kept true.  Only vectors of equal length are compared.  Equal rows are
vectors of their own and link with each other.  Empty table, empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged
from ledgerloom.llm.components import connected_components, star_forest

THRESHOLD = 0.98
MISS = 1e-5
MIN_BITS, MAX_BITS = 8, 30
BLOCK = 1024
SEED = 20_031


def plan(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors."""
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(2, n))) - 4))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - same))


def hyperplanes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, count))


def _signatures(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(vectors, tables) bucket numbers."""
    signs = (vectors @ hyperplanes(vectors.shape[1], bits * tables)) >= 0
    return (signs.reshape(len(vectors), tables, bits) << np.arange(bits, dtype=np.int64)).sum(axis=2)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the vector as doubles (null where it can link with nothing) and its digest."""
    for batch in batches:
        vectors, digests = [], []
        usable = batch.column("usable").to_pylist()
        for ok, values in zip(usable, batch.column("vector").to_pylist()):
            v = np.array(values, np.float64) + 0.0 if ok else None  # + 0.0 turns -0.0 into 0.0
            if v is not None and np.isfinite(v).all() and v.any():
                v = v / np.abs(v).max() if not 1e-100 < np.abs(v).max() < 1e100 else v
                vectors.append(v.tobytes())
                digests.append(hashlib.blake2b(vectors[-1], digest_size=16).digest())
            else:
                vectors.append(None)
                digests.append(None)
        columns = [*(batch.column(c) for c in ("vec_id", "label", "row")), pa.array(vectors, pa.binary()), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "row", "vector", "digest"])


def _entries(batches: Iterator[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """One row per class and table: the bucket it falls into."""
    names = ["label", "dim", "tab", "bucket", "cls", "n", "vector"]
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("label", "cls", "n", "vector")]
        by_dim: dict[int, list[int]] = {}
        for i, v in enumerate(columns[3]):
            by_dim.setdefault(len(v) // 8, []).append(i)
        for dim, at in by_dim.items():
            label, cls, n, vector = ([c[i] for i in at] for c in columns)
            found = _signatures(np.frombuffer(b"".join(vector), np.float64).reshape(len(at), dim), bits, tables)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label, pa.int64()), pa.array([dim] * len(at), pa.int32()), pa.array([t] * len(at), pa.int32()), pa.array(found[:, t], pa.int64()), pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.array(vector, pa.binary())],
                    names=names,
                )


def _compare(table: pa.Table, bits: int, tables: int, threshold: float) -> pa.RecordBatch:
    """Links within one block, or between the two sides of a pair of blocks."""
    tab = table.column("tab")[0].as_py()
    side = table.column("side").to_numpy()
    cls, n = table.column("cls").to_numpy(), table.column("n").to_numpy()
    vectors = table.column("vector").to_pylist()
    m = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    norms = np.sqrt((m * m).sum(axis=1))
    inner = table.column("one")[0] == table.column("two")[0]
    x = np.flatnonzero(side == 0)
    y = x if inner else np.flatnonzero(side == 1)
    cosine = (m[x] @ m[y].T) / np.outer(norms[x], norms[y])
    i, j = np.nonzero(np.triu(cosine >= threshold, 1) if inner else cosine >= threshold)
    if len(i) and tab:  # a pair that an earlier table has brought together was counted there
        own = _signatures(m, bits, tables)[:, :tab]
        new = np.concatenate([~(own[x[i[k : k + 65536]]] == own[y[j[k : k + 65536]]]).any(axis=1) for k in range(0, len(i), 65536)])
        i, j = i[new], j[new]
    i, j = x[i], y[j]
    links = np.bincount(i, weights=n[j], minlength=len(cls)) + np.bincount(j, weights=n[i], minlength=len(cls))
    at = np.flatnonzero(links)
    node, root = star_forest(cls[i], cls[j])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([cls[at], node]), pa.int64()), pa.array(np.concatenate([links[at], np.zeros(len(node))]).astype(np.int64)), pa.array([None] * len(at) + root.tolist(), pa.int64())],
        names=["cls", "links", "root"],
    )


def _blocks(batches: Iterator[pa.RecordBatch], bits: int, tables: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Walks a partition sorted by block; holds one block (or pair of blocks) at a time."""
    held: list[pa.Table] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "tab", "bucket", "one", "two"))))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if keys[a] != key:
                if sum(t.num_rows for t in held) > 1:
                    yield _compare(pa.concat_tables(held), bits, tables, threshold)
                held, key = [], keys[a]
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if sum(t.num_rows for t in held) > 1:
        yield _compare(pa.concat_tables(held), bits, tables, threshold)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
    usable &= F.coalesce(~F.exists(vector_col, lambda x: x.isNull()), F.lit(False))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.monotonically_increasing_id().alias("row"),
        F.col(vector_col).alias("vector"),
        usable.alias("usable"),
    )
    rows = staged(rows.mapInArrow(_prepare, "vec_id long, label long, row long, vector binary, digest binary"), "vectors")
    alone = rows.where("digest IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    # A class is named by its first row; a hot vector is one row per task after the partial aggregate.
    classes = rows.where("digest IS NOT NULL").groupBy("label", "digest").agg(
        F.min("row").alias("cls"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")
    )
    classes = staged(classes, "classes")
    bits, tables = plan(classes.count(), threshold)
    entry = "label long, dim int, tab int, bucket long, cls long, n long, vector binary"
    entries = classes.select("label", "cls", "n", "vector").mapInArrow(lambda it: _entries(it, bits, tables), entry)
    key = ["label", "dim", "tab", "bucket"]
    sizes = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK)
    cut = entries.join(sizes, key, "left").withColumn("blocks", F.ceil(F.coalesce("size", F.lit(1)) / BLOCK).cast("int"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select(*key, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), (F.col("own") > F.col("other")).cast("int").alias("side"), "cls", "n", "vector")
    dealt = cut.repartition(*key, "one", "two").sortWithinPartitions(*key, "one", "two")
    found = staged(dealt.mapInArrow(lambda it: _blocks(it, bits, tables, threshold), "cls long, links long, root long"), "links")

    links = found.where("root IS NULL").groupBy("cls").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("root IS NOT NULL").select(F.col("cls").alias("a"), F.col("root").alias("b")))
    named = classes.drop("vector").join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    named = staged(named.withColumn("root", F.coalesce("root", "cls")), "class-links")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    result = named.join(least, "root").select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = rows.where("digest IS NOT NULL").select("vec_id", "label", "digest").join(result, ["label", "digest"])
    return alone.unionByName(linked.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")))
