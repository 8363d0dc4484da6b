"""Sharding (operator 10, native): permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table,
``(offset + k * skip) mod size`` with offset and skip hashed from its name.
The shards take turns; on its turn a shard claims the first slot of its order
that is still free.  The filled table has ``size`` rows whatever the data, so
it is broadcast, and a row is placed by one hash and one lookup.  Every shard
gets ``size / shards`` slots, give or take one, and adding or removing a shard
moves little beyond its own share of the rows.

The table is a pure function of the shard names; the placing of rows uses
DataFrame functions only.

Defined results: a null key is placed like the empty string; equal keys always
land on one shard (that is the point of a key: use a finer key to spread a hot
one); an empty table gives an empty result.  ``place`` keeps every column of
its input and names its own columns as asked.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS_PER_SHARD = 100
#: Files that the rows of one shard are written to by ``write_shards``.
FILES_PER_SHARD = 4


def next_prime(n: int) -> int:
    while n < 2 or any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def preference(name: str, size: int) -> tuple[int, int]:
    digest = hashlib.md5(name.encode()).hexdigest()
    return int(digest[:15], 16) % size, int(digest[15:30], 16) % (size - 1) + 1


def lookup_table(shards: list[str], size: int) -> list[int]:
    """Slot -> index of its shard."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    orders = [preference(s, size) for s in shards]
    owner, steps, free = [-1] * size, [0] * len(shards), size
    while True:
        for i, (offset, skip) in enumerate(orders):
            if not free:
                return owner
            while owner[slot := (offset + steps[i] * skip) % size] >= 0:
                steps[i] += 1
            owner[slot] = i
            free -= 1


def slot_of(key: Column, size: int) -> Column:
    """Slot of a key: the first 15 hex digits of its MD5, modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key: Column, shards: list[str], size: int | None = None, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``df`` with its slot and shard."""
    size = size or next_prime(SLOTS_PER_SHARD * len(shards))
    if {slot_col.lower(), shard_col.lower()} & {c.lower() for c in df.columns}:
        raise ValueError("slot_col and shard_col must be new columns")
    rows = ", ".join(f"({slot}, {i})" for slot, i in enumerate(lookup_table(shards, size)))
    names = F.array(*[F.lit(s) for s in shards])
    table = df.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t({slot_col}, {shard_col})")
    # the table has ``size`` rows of two integers, set by the number of shards alone
    joined = df.withColumn(slot_col, slot_of(key, size)).join(F.broadcast(table), slot_col)
    return joined.select(*df.columns, slot_col, names[F.col(shard_col)].alias(shard_col))


def write_shards(df: DataFrame, path: str, key: Column, shards: list[str], size: int | None = None) -> None:
    """Writes one folder ``shard=<name>`` per shard.  Rows of a shard are dealt
    to FILES_PER_SHARD tasks by a hash of the whole row, so a shard's size is
    shared between several tasks."""
    placed = place(df, key, shards, size)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(FILES_PER_SHARD))
    dealt = placed.drop("slot").repartition(FILES_PER_SHARD * len(shards), "shard", salt)
    dealt.write.partitionBy("shard").parquet(path)


def oracle(table: str, key_sql: str, shards: int, prefix: str, size: int) -> str:
    """DuckDB SQL that fills the table turn by turn and places ``table``."""
    return f"""
        WITH RECURSIVE names AS (SELECT i, md5('{prefix}' || i) AS h FROM range({shards}) r(i)),
        orders AS (
            SELECT list(o ORDER BY i) AS o FROM (
                SELECT i, [((('0x' || substr(h, 1, 15))::BIGINT % {size})
                            + k * (('0x' || substr(h, 16, 15))::BIGINT % {size - 1} + 1)) % {size} FOR k IN range({size})] AS o
                FROM names)),
        turns(t, owner) AS (
            SELECT 0, [-1 FOR k IN range({size})]
            UNION ALL
            SELECT t + 1, list_transform(owner, lambda x, j: CASE WHEN j = claimed + 1 THEN t % {shards} ELSE x END)
            FROM (SELECT t, owner, list_filter(o[t % {shards} + 1], lambda k: owner[k + 1] = -1)[1] AS claimed
                  FROM turns, orders WHERE t < {size})),
        filled AS (SELECT owner FROM turns WHERE t = {size})
        SELECT {key_sql} AS doc_id, slot::INTEGER AS slot, '{prefix}' || owner[slot + 1] AS shard
        FROM (SELECT *, ('0x' || substr(md5(coalesce({key_sql}::VARCHAR, '')), 1, 15))::BIGINT % {size} AS slot FROM {table}), filled"""
