"""Exact dedup (operator 3): two-pass Bloom filtering of text hashes.

Pass 1 hashes every text (SHA-256, in the JVM) and drops each hash into
``k`` slots of a saturating Bloom filter: a slot knows whether it was hit
never, once, or more than once.  Tasks do not ship bitmaps (their total would
grow with tasks x size) but the slots they hit, cut into slices; each slice is
merged on its own and gives the bitmap of slots hit more than once.  Pass 2
looks up every row: a hash with any slot hit at most once is certainly
unique, so its row passes straight through.  Only rows whose hash may repeat
shuffle, and the shuffled groups decide exactly.

The filter that is broadcast has a fixed upper size (``MAX_FILTER_BITS``, 32
MB).  Up to about 16 slots per row it lets through under 1 % of unique rows;
with more rows than that its false-positive share grows and more unique rows
take the shuffle, but no result changes.

Defined results: a null text counts as empty; empty texts equal each other.
Of equal texts the largest doc_id stays; null doc_ids rank below every number
(an all-null group keeps one row with a null doc_id); rows equal in doc_id and
text are copies of one another and exactly one of them stays.  An empty table
gives an empty result.  Extra columns pass through ``drop_exact_duplicates``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged, text_or_empty, unused

SLOTS_PER_ROW = 16
HASHES = 3
MIN_FILTER_BITS = 1 << 16
MAX_FILTER_BITS = 1 << 28
#: Slots of one slice: 128 KB as a bitmap, the unit that one merge group holds.
SLICE_BITS = 1 << 16
#: Salts over which the rows of one repeated hash spread when they meet their group's decision.
SALTS = 16


def filter_bits(n_rows: int) -> int:
    bits = MIN_FILTER_BITS
    while bits < SLOTS_PER_ROW * n_rows and bits < MAX_FILTER_BITS:
        bits *= 2
    return bits


def _slots(hashes: list[bytes], bits: int) -> np.ndarray:
    """(rows, HASHES) slots of 32-byte hashes: four independent 64-bit words each."""
    words = np.frombuffer(b"".join(hashes), dtype="<u8").reshape(-1, 4)
    return words[:, :HASHES] % np.uint64(bits)


def _hit_slots(batches: Iterator[pa.RecordBatch], bits: int, hash_col: str) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
    for batch in batches:
        hashes = batch.column(hash_col).to_pylist()
        if not hashes:
            continue
        s = _slots(hashes, bits)
        s = np.concatenate([s[:, 0]] + [np.where((s[:, j, None] == s[:, :j]).any(axis=1), np.uint64(bits), s[:, j]) for j in range(1, HASHES)])
        slot, count = np.unique(s[s < bits], return_counts=True)  # a row hits a slot once, however often it names it
        owner, local = (slot // SLICE_BITS).astype(np.int32), (slot % SLICE_BITS).astype("<u2")
        ids, starts = np.unique(owner, return_index=True)
        ends = np.append(starts[1:], len(owner))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int32()),
                pa.array([local[a:b][count[a:b] == 1].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                pa.array([local[a:b][count[a:b] > 1].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            ],
            schema=schema,
        )


def _merge_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the slices that a partition holds: at most (filter bits / partitions) of bitmap each."""
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, once, twice in zip(*(batch.column(c).to_pylist() for c in ("slice", "once", "twice"))):
            hits = seen.setdefault(i, np.zeros(SLICE_BITS, np.uint8))
            a, b = np.frombuffer(once, "<u2"), np.frombuffer(twice, "<u2")
            hits[a] = np.minimum(hits[a] + 1, 2)
            hits[b] = 2
    schema = pa.schema([("slice", pa.int32()), ("repeated", pa.binary())])
    ids = sorted(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int32()), pa.array([np.packbits(seen[i] > 1).tobytes() for i in ids], pa.binary())], schema=schema
    )


def repeated_slots(hashed: DataFrame, hash_col: str, bits: int) -> bytes:
    """Pass 1: the bitmap (``bits`` / 8 bytes, at most 32 MB) of slots hit by more than one row."""
    hits = hashed.select(hash_col).mapInArrow(lambda it: _hit_slots(it, bits, hash_col), "slice int, once binary, twice binary")
    merged = hits.repartition("slice").mapInArrow(_merge_slices, "slice int, repeated binary")
    bitmap = bytearray(bits // 8)
    for row in merged.toLocalIterator():
        bitmap[row["slice"] * SLICE_BITS // 8 : (row["slice"] + 1) * SLICE_BITS // 8] = row["repeated"]
    return bytes(bitmap)


def may_repeat(spark, bitmap: bytes) -> Callable[[Column], Column]:
    """Pass 2: a column function over hashes, false only for those that certainly occur once."""
    shared, bits = spark.sparkContext.broadcast(bitmap), len(bitmap) * 8

    @F.pandas_udf("boolean")
    def look_up(hashes: pd.Series) -> pd.Series:
        if not len(hashes):
            return pd.Series([], dtype=bool)
        table, s = np.frombuffer(shared.value, np.uint8), _slots(list(hashes), bits)
        hit = (table[s >> np.uint64(3)] >> (7 - (s & np.uint64(7))).astype(np.uint8)) & 1
        return pd.Series(hit.all(axis=1))

    return look_up


def _sha(text_col: str) -> Column:
    return F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    hashed = staged(
        docs.select(F.col(id_col).alias("doc_id"), _sha(text_col).alias("sha"), F.monotonically_increasing_id().alias("row")),
        "text-hashes",
    )
    check = may_repeat(spark, repeated_slots(hashed, "sha", filter_bits(hashed.count())))
    flagged = staged(hashed.withColumn("maybe", check("sha")), "flagged-hashes")

    alone = flagged.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    # The rows of a hot hash meet their decision under SALTS keys; the decision, one row per hash, goes to each.
    shuffled = flagged.where("maybe").withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)).cast("int"))
    best = F.max(F.struct("doc_id", "row")).alias("best")
    groups = (
        shuffled.groupBy("sha", "salt").agg(best, F.count(F.lit(1)).alias("n"))
        .groupBy("sha").agg(F.max("best").alias("best"), F.sum("n").alias("n"))
        .where("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    met, repeated = shuffled.join(groups, ["sha", "salt"], "left"), F.col("n").isNotNull()
    decided = met.select(
        "doc_id",
        F.when(repeated, F.col("best.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.when(repeated, F.col("row") == F.col("best.row")).otherwise(True).alias("kept"),
        "sha",
    )
    return alone.unionByName(decided).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without repeated texts, all columns kept.  Rows that the filter
    proves unique stay where they are; only possible repeats shuffle."""
    spark = docs.sparkSession
    sha, keep, copies = unused(docs, "sha"), unused(docs, "keep"), unused(docs, "copies")
    hashed = docs.withColumn(sha, _sha(text_col))
    digests = staged(hashed.select(F.col(id_col).alias("doc_id"), F.col(sha).alias("sha")), "text-hashes")
    check = may_repeat(spark, repeated_slots(digests, "sha", filter_bits(digests.count())))
    repeats = staged(
        digests.where(check("sha")).groupBy("sha").agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "repeated-hashes",
    ).select(F.col("sha").alias(sha), F.col("keep").alias(keep), F.col("n").alias(copies))
    met = hashed.where(check(sha)).join(repeats, sha, "left")
    falsely, winner = F.col(copies).isNull(), F.col(id_col).eqNullSafe(F.col(keep))
    winners = met.where(~falsely & winner).dropDuplicates([sha])  # repeated rows of the winning doc_id
    parts = (hashed.where(~check(sha)), met.where(falsely), winners)
    return parts[0].select(*docs.columns).unionByName(parts[1].select(*docs.columns)).unionByName(parts[2].select(*docs.columns))
