"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the session's shared checkpoint
    folder and return a DataFrame that reads it: lineage is cut, the data is
    computed once and a lost executor costs nothing but a re-read.  The folder
    belongs to the caller, who clears it after the job as with checkpoints."""
    path = f"{checkpoint_dir(df.sparkSession)}/ledgerloom-llm/{uuid.uuid4().hex}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """A column name close to ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def worker_object(key: tuple, make: Callable[[], object], large: bool = False) -> object:
    """One object per Python worker process, made at first use.  The library
    is pickled by value, so its module globals do not outlive a task; this
    registry lives in ``sys.modules`` and does.  Of the ``large`` objects
    (caches that fill up) only the latest is kept: a worker serves one stage
    after another and must not hold the caches of all of them."""
    registry = sys.modules.setdefault("_ledgerloom_worker_objects", types.ModuleType("_ledgerloom_worker_objects"))
    objects = registry.__dict__.setdefault("objects", {})
    if key not in objects:
        if large:
            for other in [k for k, (_, is_large) in objects.items() if is_large]:
                del objects[other]
        objects[key] = make(), large
    return objects[key][0]


def by_size(rows: list, weight: Callable[[object], int], limit: int) -> Iterator[list]:
    """Cut a list into runs of at least one row whose weights sum to about ``limit``."""
    part, total = [], 0
    for row in rows:
        part.append(row)
        total += weight(row)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part


def text_runs(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of at least one row whose texts sum to about ``limit`` bytes: only the texts of
    one run become Python objects at a time.  At the end Arrow's unused memory goes back, as an idle worker
    would keep it for the stages that follow."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = min(batch.num_rows, int(np.searchsorted(ends, before + limit)) + 1)
            yield batch.slice(at, upto - at)
            at = upto
    pa.default_memory_pool().release_unused()


def batch_of(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
