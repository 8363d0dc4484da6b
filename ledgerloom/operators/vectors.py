"""N4 vector nearest neighbour: cosine top-1 against a reference set, exactly.

References lie in cells around pivots (references themselves); a cell's radius
is its greatest angle to the pivot.  A query at angle ``a`` of a pivot has no
reference in that cell closer than ``a - radius``, so a cell whose bound loses
against the best cosine found is skipped; the others are scored by one matrix
product for all queries that need them.  Pairs that may be best within rounding
are scored again term by term in order, so results do not depend on batches.

Up to SLICE references (counted first) go to the tasks as one broadcast.  More
stay in Spark: every query goes to the cell of its nearest pivot, and then only
to cells that its bound leaves open.  A (cell, part, block) is one group of
about SLICE references and BLOCK queries, whatever the size of a cell; only the
pivots and a count and radius per cell (at most PIVOTS rows) reach the driver.

Defined results: a vector that is null, zero or holds null or non-finite values
is near nothing, and its query has no row; neither has one for which no
reference has as many components.  Nor do vectors count whose length is too
small or too large for a double.  Keys of queries are distinct.  Ties go to the lowest ``ref_id``; equal
vectors count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: References in one search, queries in one group of a larger search, pivots of a larger search.
SLICE, BLOCK, PIVOTS = 20_000, 20_000, 512
#: Queries that are scored at once.
BATCH = 2_048
#: Rounding of a cosine by matrix product, and of an angle, with room.
COS_ERROR, ANGLE_ERROR = 1e-9, 1e-6


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def _usable(df: DataFrame) -> DataFrame:
    """Rows whose vector (made double) has a direction."""
    df = df.withColumn("vec", F.transform("vec", lambda x: x.cast("double")))
    norm = F.sqrt(_dot(F.col("vec"), F.col("vec")))  # NULL or not finite if any component is
    return df.where((norm > 0) & (norm < float("inf")))


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


class _Cells:
    """References of one length in cells around pivots."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vecs = ids[order], vecs[order]
        self.norms = _norms(self.vecs)
        unit = self.vecs / self.norms[:, None]
        self.pivots = unit[:: max(1, int(np.sqrt(len(unit))))]
        cell = np.concatenate([np.argmax(unit[i : i + BATCH] @ self.pivots.T, axis=1) for i in range(0, len(unit), BATCH)])
        self.members = [np.flatnonzero(cell == j) for j in range(len(self.pivots))]
        self.units = [unit[m] for m in self.members]
        self.radius = np.array([_angles(u, p[None]).max(initial=0.0) for u, p in zip(self.units, self.pivots)]) + ANGLE_ERROR

    def best(self, vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ref_id, cosine) of the best reference of each query."""
        norms = _norms(vecs)
        unit = vecs / norms[:, None]
        bound = np.cos(np.maximum(0.0, _angles(unit, self.pivots) - self.radius - ANGLE_ERROR)) + COS_ERROR
        best, found = np.full(len(vecs), -2.0), []
        nearest, done = np.argmax(bound, axis=1), np.zeros(bound.shape, bool)
        for first in (True, False):  # the likeliest cell of each query, then all that its best leaves open
            for j, members in enumerate(self.members):
                rows = np.flatnonzero(nearest == j if first else (bound[:, j] >= best) & ~done[:, j])
                if not len(rows) or not len(members):
                    continue
                done[rows, j] = True
                cos = unit[rows] @ self.units[j].T
                best[rows] = np.maximum(best[rows], cos.max(axis=1))
                q, r = np.nonzero(cos >= best[rows, None] - COS_ERROR)
                found.append((rows[q], members[r], cos[q, r]))
        q, r, cos = map(np.concatenate, zip(*found))
        near = cos >= best[q] - COS_ERROR
        q, r = q[near], r[near]
        cos = np.cumsum(vecs[q] * self.vecs[r], axis=1)[:, -1] / (norms[q] * self.norms[r])
        order = np.lexsort((r, -cos, q))  # references are in id order
        first = order[np.unique(q[order], return_index=True)[1]]
        return self.ids[r[first]], cos[first]


def _norms(vecs: np.ndarray) -> np.ndarray:
    return np.sqrt(np.cumsum(vecs * vecs, axis=1)[:, -1])


def _matrix(vecs: pd.Series) -> np.ndarray:
    return np.array(vecs.tolist(), np.float64)


def _search(refs: dict[int, _Cells], keys: pd.Series, vecs: pd.Series, key_col: str) -> pd.DataFrame:
    """Best reference per query, among those of its length."""
    out = [pd.DataFrame({key_col: keys[:0], "ref_id": pd.Series(dtype="int64"), "cos": pd.Series(dtype="float64")})]
    for length, rows in vecs.groupby(vecs.map(len).to_numpy()):
        for i in range(0, len(rows) if length in refs else 0, BATCH):
            part = rows.iloc[i : i + BATCH]
            ids, cos = refs[length].best(_matrix(part))
            out.append(pd.DataFrame({key_col: keys[part.index].to_numpy(), "ref_id": ids, "cos": cos}))
    return pd.concat(out[1:] or out)


def _cells(ids: pd.Series, vecs: pd.Series) -> dict[int, _Cells]:
    return {n: _Cells(ids[own.index].to_numpy(), _matrix(own)) for n, own in vecs.groupby(vecs.map(len).to_numpy())}


def nearest(queries: DataFrame, refs: DataFrame, key_col: str, slice_size: int = SLICE) -> DataFrame:
    """``queries(key_col, vec)``, ``refs(ref_id, vec)`` -> ``(key_col, ref_id,
    cos)`` with the best reference per query (cos in double; ties go to the
    lowest ``ref_id``)."""
    spark = queries.sparkSession
    queries = _usable(queries.select(key_col, "vec"))
    refs = _usable(refs.select(F.col("ref_id").cast("long"), "vec")).groupBy("vec").agg(F.min("ref_id").alias("ref_id"))
    schema = f"`{key_col}` {queries.schema[key_col].dataType.simpleString()}, ref_id long, cos double"
    rows = refs.select("ref_id", "vec").limit(slice_size + 1).collect()
    if len(rows) > slice_size:
        return _nearest_in_cells(queries, refs, key_col, slice_size, schema)
    shared = spark.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vecs = shared.value
        cells = _cells(pd.Series(ids, dtype="int64"), pd.Series(vecs, dtype=object))
        for batch in batches:
            yield _search(cells, batch[key_col], batch["vec"], key_col)

    return queries.mapInPandas(search, schema)


def _nearest_in_cells(queries: DataFrame, refs: DataFrame, key_col: str, slice_size: int, schema: str) -> DataFrame:
    from ledgerloom.session import materialize

    spark = queries.sparkSession
    pivots = [r[0] for r in refs.orderBy(F.xxhash64("ref_id"), "ref_id").limit(PIVOTS).select("vec").collect()]
    by_length = {n: [(j, v) for j, v in enumerate(pivots) if len(v) == n] for n in {len(v) for v in pivots}}
    shared = spark.sparkContext.broadcast(by_length)

    def angles_to(vecs: pd.Series) -> Iterator[tuple[pd.Series, list[int], np.ndarray]]:
        for n, own in vecs.groupby(vecs.map(len).to_numpy()):
            at = shared.value.get(n)
            if at:
                a, b = _matrix(own), np.array([v for _, v in at])
                yield own, [j for j, _ in at], _angles(a / _norms(a)[:, None], b / _norms(b)[:, None])

    @F.pandas_udf("struct<cell int, angle double>")
    def own_cell(vecs: pd.Series) -> pd.DataFrame:
        # lengths that no pivot has share a cell whose radius covers everything
        out = pd.DataFrame({"cell": -1, "angle": np.pi}, index=vecs.index)
        for own, numbers, angle in angles_to(vecs):
            near = angle.argmin(axis=1)
            out.loc[own.index, "cell"] = np.array(numbers)[near]
            out.loc[own.index, "angle"] = angle[np.arange(len(own)), near]
        return out

    refs = materialize(refs.withColumn("_at", own_cell("vec")).select("ref_id", "vec", F.col("_at.cell").alias("cell"), F.col("_at.angle").alias("angle")))
    sizes = refs.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect()  # at most PIVOTS + 1 rows
    radius = spark.sparkContext.broadcast({r.cell: r.radius + ANGLE_ERROR for r in sizes})
    parts = F.create_map(*[F.lit(x) for r in sizes for x in (r.cell, -(-r.n // slice_size))])

    @F.pandas_udf("array<struct<cell int, bound double>>")
    def open_cells(vecs: pd.Series, best: pd.Series) -> pd.Series:
        out = pd.Series([[{"cell": -1, "bound": 1.0}] if -1 in radius.value else []] * len(vecs), index=vecs.index)
        for own, numbers, angle in angles_to(vecs):
            held = [k for k, j in enumerate(numbers) if j in radius.value]
            reach = np.array([radius.value[numbers[k]] for k in held])
            bound = np.cos(np.maximum(0.0, angle[:, held] - reach - ANGLE_ERROR)) + COS_ERROR
            for i, row, least in zip(own.index, bound, best[own.index].fillna(-2.0)):
                out[i] = [{"cell": numbers[held[k]], "bound": row[k]} for k in np.flatnonzero(row >= least)]
        return out

    def searched(asked: DataFrame) -> DataFrame:
        """``asked(key, vec, cell)``: the best reference of each asked cell, best of all per key."""
        asked = materialize(asked)
        counts = asked.groupBy("cell").count().collect()  # at most PIVOTS + 1 rows
        if not counts:
            return spark.createDataFrame([], schema)
        blocks = F.create_map(*[F.lit(x) for r in counts for x in (r["cell"], -(-r["count"] // BLOCK))])
        n_parts, n_blocks = F.element_at(parts, F.col("cell")), F.element_at(blocks, F.col("cell"))
        left = asked.select(key_col, "vec", "cell", F.pmod(F.xxhash64(key_col), n_blocks).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), n_parts.cast("long") - 1)).alias("part"))
        right = refs.where(n_blocks.isNotNull()).select("ref_id", "vec", "cell", F.pmod(F.xxhash64("ref_id"), n_parts).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), n_blocks.cast("long") - 1)).alias("block"))

        def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            return _search(_cells(b["ref_id"], b["vec"]) if len(b) else {}, a[key_col], a["vec"], key_col)

        keys = ["cell", "part", "block"]
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, schema)
        best = F.max(F.struct("cos", (-F.col("ref_id")).alias("neg"))).alias("b")
        return found.groupBy(key_col).agg(best).select(key_col, (-F.col("b.neg")).alias("ref_id"), F.col("b.cos").alias("cos"))

    held = [r.cell for r in sizes]
    home = queries.withColumn("cell", own_cell("vec")["cell"]).where(F.col("cell").isin(held))
    one = materialize(searched(home))
    known = queries.join(one.select(F.col(key_col).alias("_key"), F.col("cos").alias("_best")), F.col(key_col).eqNullSafe(F.col("_key")), "left")
    asked = known.withColumn("_own", own_cell("vec")["cell"]).withColumn("_open", F.explode(open_cells("vec", "_best")))
    asked = asked.where(F.col("_open.cell") != F.col("_own")).select(key_col, "vec", F.col("_open.cell").alias("cell"))
    best = F.max(F.struct("cos", (-F.col("ref_id")).alias("neg"))).alias("b")
    both = one.unionByName(searched(asked)).groupBy(key_col).agg(best)
    return both.select(key_col, (-F.col("b.neg")).alias("ref_id"), F.col("b.cos").alias("cos"))
