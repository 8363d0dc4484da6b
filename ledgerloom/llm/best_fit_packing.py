"""Best-fit packing (operator 4): best-two-fit over document lengths.

Every document becomes its ids and an end id; documents longer than a
sequence are cut into pieces of exactly the sequence length, the first piece
taking what is left over.  Full pieces are sequences of their own.  The other
pieces are dealt evenly to packing groups of a bounded number of pieces
(``GROUP_PIECES``, whatever their doc_ids or lengths) and each group is packed
on its own: a bin is filled greedily, largest fitting piece first, then its
smallest piece is taken out again if two unpacked pieces fit the widened gap
more tightly.  A group leaves at most a few bins partly filled, so the waste
does not grow with the input.

Defined results: a null text is empty and becomes the end id alone; repeated
rows and doc_ids are packed like any others, null doc_ids too; an empty table
gives an empty result.  Only (doc_id, length) rows shuffle, never texts.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_or_empty, text_runs
from ledgerloom.llm.tokens import default_tokenizer, encoder

SEQUENCE = 2048
END_ID = 0
#: Bytes of texts that are encoded at once.
TEXT_RUN = 2_000_000
#: Documents for one packing group on average.
GROUP_PIECES = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cuts(n: int, room: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    if n <= room:
        return [(0, n)]
    head = n % room
    return [(0, head)] * bool(head) + [(a, room) for a in range(head, n, room)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end: bytes, room: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    encode = encoder(path).encode
    for run in text_runs(batches, TEXT_RUN):
        out = []
        for doc_id, ids in zip(run.column("doc_id").to_pylist(), encode(run.column("text").to_pylist())):
            ids += end
            for k, (a, n) in enumerate(_cuts(len(ids) // 4, room)):
                out.append((doc_id, k, a, n, zlib.crc32(ids[4 * a : 4 * (a + n)])))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def token_pieces(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, room: int = SEQUENCE) -> DataFrame:
    """Per piece of each document: doc_id, piece, start, length, ids_crc32."""
    tokenizer, end = tokenizer or default_tokenizer(), struct.pack("<I", end_id)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _pieces(it, tokenizer, end, room), PIECES)


def best_two_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length (1 to ``room``).

    Pieces of one length are interchangeable, so the unpacked ones are kept as
    a count per length, with a bit set of the lengths still in stock."""
    count = np.bincount(lengths, minlength=room + 1).tolist()
    order = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[order], np.arange(room + 1)).tolist()  # next place in ``order`` of each length
    stock = sum(1 << n for n in range(1, room + 1) if count[n])
    upto = [(1 << (n + 1)) - 1 for n in range(room + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    next_bin, left = 0, len(lengths)

    def largest(n: int) -> int:
        return max(0, (stock & upto[n]).bit_length() - 1)

    while left:
        taken, gap = [], room
        while gap and (n := largest(gap)):
            count[n] -= 1
            if not count[n]:
                stock ^= 1 << n
            taken.append(n)
            gap -= n
        if gap and len(taken) > 1:
            smallest = taken[-1]
            wide, best, pair = gap + smallest, smallest, ()
            a = largest(wide)
            while a and 2 * a > best and best < wide:
                b = largest(min(a, wide - a))
                if b == a and count[a] < 2:
                    b = largest(a - 1)
                if b and a + b > best:
                    best, pair = a + b, (a, b)
                a = largest(a - 1)
            if pair:
                taken[-1:] = pair
                count[smallest] += 1
                stock |= 1 << smallest
                for n in pair:
                    count[n] -= 1
                    if not count[n]:
                        stock ^= 1 << n
        at = 0
        for n in taken:
            i = order[first[n]]
            first[n] += 1
            bins[i], offsets[i] = next_bin, at
            at += n
        next_bin, left = next_bin + 1, left - len(taken)
    return bins, offsets


def _pack(batches: Iterator[pa.RecordBatch], room: int) -> Iterator[pa.RecordBatch]:
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows).combine_chunks()
    bins, offsets = best_two_fit(table.column("length").to_numpy(), room)
    table = table.append_column("sequence_id", pa.array(bins + (TaskContext.get().partitionId() << 40)))
    yield from table.append_column("offset", pa.array(offsets)).to_batches()


def pack_documents(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, room: int = SEQUENCE) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    groups = max(1, -(-docs.count() // GROUP_PIECES))
    pieces = token_pieces(docs, tokenizer, id_col, text_col, end_id, room)
    return pieces.repartition(groups).mapInArrow(lambda it: _pack(it, room), PIECES + ", sequence_id long, offset long")
