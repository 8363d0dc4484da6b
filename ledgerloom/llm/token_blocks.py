"""Token-id output (operator 1): patched frame-of-reference blocks.

``write_token_blocks`` encodes every document, appends an end id and writes
the ids in ascending document order; ``read_token_blocks`` reads them back.

File format.  The output folder is a Parquet table (written by Spark, so task
retries and lost executors cannot leave half a file) of *segments*; a segment
holds whole documents.  Columns: ``part`` and ``seg`` (order of the segments),
``part_start`` (ids before the segment in its part), ``n_ids``, ``doc_ids``
and ``payload``, which is little endian and reads

    magic 'PFR1' | u32 documents | u32 ids | u32 blocks
    u32 x documents   ids of each document
    u32 x (blocks+1)  byte at which each block starts, after this header
    blocks of 1,024 ids (the last may be shorter):
      u32 minimum | u8 width | u8 0 | u16 exceptions
      ids - minimum, low ``width`` bits each, packed, filled up to a byte
      u16 x exceptions  places of the outliers
      u32 x exceptions  their bits above ``width``

``width`` is the smallest that holds at least PERCENTILE of the block's
values; the others keep their low bits in place and their high bits in the
exception list.  The block starts let a reader open one document by decoding
only the blocks that it touches (``document_ids``).

Defined results: a null text is encoded as empty, so an empty document is just
the end id.  Documents are ordered by doc_id, null doc_ids first; rows with
the same doc_id are ordered by a hash of their text.  An empty table writes no
segment.  Other columns are not read.  A range of doc_ids goes to one task and
rows of one doc_id may be cut between tasks, so a repeated doc_id cannot fill
one task; memory holds one segment and one batch of texts at a time.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_size, text_or_empty
from ledgerloom.llm.tokens import default_tokenizer, encoder

MAGIC = b"PFR1"
BLOCK = 1024
PERCENTILE = 0.9
END_ID = 0
#: Characters of text encoded at once, and ids after which a segment ends.
TEXT_RUN, SEGMENT_IDS = 4_000_000, 1 << 18
SEGMENTS = "part int, seg int, part_start long, n_ids long, doc_ids array<bigint>, payload binary"


def _pack_bits(low: np.ndarray, width: int) -> list[bytes]:
    """Rows of ``low`` at ``width`` bits a value, least significant bit first."""
    if width == 0:
        return [b""] * len(low)
    held = low.astype("<u4").view(np.uint8).reshape(*low.shape, 4)[:, :, : (width + 7) // 8]
    bits = np.unpackbits(np.ascontiguousarray(held), axis=2, bitorder="little")[:, :, :width]
    packed = np.packbits(bits.reshape(len(low), -1), axis=1, bitorder="little")
    return [row.tobytes() for row in packed]


def _unpack_bits(packed: np.ndarray, n: int, width: int) -> np.ndarray:
    """The ``n`` values of each row of bytes."""
    if width > 25:  # a value and its shift do not fit 32 bits
        bits = np.unpackbits(packed, axis=1, bitorder="little", count=n * width).reshape(len(packed), n, width)
        full = np.zeros((len(packed), n, 32), np.uint8)
        full[:, :, :width] = bits
        return np.packbits(full, axis=2, bitorder="little").view("<u4")[:, :, 0]
    at = np.arange(n) * width
    room = np.zeros((len(packed), packed.shape[1] + 4), np.uint8)
    room[:, : packed.shape[1]] = packed
    values = np.zeros((len(packed), n), np.uint32)
    for i in range((width + 14) // 8):  # the bytes that a value touches
        values |= room[:, (at >> 3) + i].astype(np.uint32) << np.uint32(8 * i)
    return (values >> (at & 7).astype(np.uint32)) & np.uint32((1 << width) - 1)


def _encode_rows(rows: np.ndarray) -> list[bytes]:
    """Encodes equally long blocks, given as the rows of a matrix."""
    n = rows.shape[1]
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    need = np.frexp(rest.astype(np.float64))[1]  # bits of each value
    holds = np.bincount((np.arange(len(rows))[:, None] * 33 + need).ravel(), minlength=33 * len(rows)).reshape(-1, 33).cumsum(axis=1)
    width = (holds >= np.ceil(PERCENTILE * n)).argmax(axis=1)
    out: list[bytes] = [b""] * len(rows)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        mask = np.uint32((1 << w) - 1)
        for i, packed in zip(at.tolist(), _pack_bits(rest[at] & mask, w)):
            odd = np.flatnonzero(need[i] > w)
            high = (rest[i][odd] >> np.uint32(w)).astype("<u4")
            out[i] = struct.pack("<IBBH", int(least[i]), w, 0, len(odd)) + packed + odd.astype("<u2").tobytes() + high.tobytes()
    return out


def encode_segment(docs: list[bytes]) -> bytes:
    """``docs``: ids of each document as little-endian 32-bit bytes."""
    ids = np.frombuffer(b"".join(docs), "<u4").astype(np.uint32)
    whole = len(ids) // BLOCK
    blocks = _encode_rows(ids[: whole * BLOCK].reshape(whole, BLOCK)) if whole else []
    if len(ids) % BLOCK:
        blocks += _encode_rows(ids[None, whole * BLOCK :])
    starts = np.cumsum([0, *map(len, blocks)]).astype("<u4")
    lengths = np.array([len(d) // 4 for d in docs], "<u4")
    return b"".join([MAGIC, struct.pack("<III", len(docs), len(ids), len(blocks)), lengths.tobytes(), starts.tobytes(), *blocks])


class Segment:
    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a token segment")
        self.payload = payload
        n_docs, self.n_ids, n_blocks = struct.unpack_from("<III", payload, 4)
        self.lengths = np.frombuffer(payload, "<u4", n_docs, 16).astype(np.int64)
        self.starts = np.frombuffer(payload, "<u4", n_blocks + 1, 16 + 4 * n_docs)
        self.body = 16 + 4 * n_docs + 4 * (n_blocks + 1)

    def blocks(self, first: int, last: int) -> list[np.ndarray]:
        """Values of the blocks ``first`` to ``last``; equally long and wide ones are unpacked together."""
        alike: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        for i, start in enumerate(self.starts[first : last + 1].tolist(), first):
            at, n = self.body + start, min(BLOCK, self.n_ids - i * BLOCK)
            least, width, _, odd = struct.unpack_from("<IBBH", self.payload, at)
            alike.setdefault((n, width), []).append((i - first, at + 8, least, odd))
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * (last + 1 - first)
        for (n, width), own in alike.items():
            size = (n * width + 7) // 8
            packed = np.stack([np.frombuffer(self.payload, np.uint8, size, at) for _, at, _, _ in own])
            for (i, at, least, odd), values in zip(own, _unpack_bits(packed, n, width)):
                if odd:
                    places = np.frombuffer(self.payload, "<u2", odd, at + size)
                    values[places] |= np.frombuffer(self.payload, "<u4", odd, at + size + 2 * odd) << np.uint32(width)
                out[i] = values + np.uint32(least)
        return out

    def ids(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *self.blocks(0, len(self.starts) - 2)])

    def document_ids(self, k: int) -> np.ndarray:
        """Ids of the ``k``-th document, from the blocks that it touches only."""
        a = int(self.lengths[:k].sum())
        b = a + int(self.lengths[k])
        if a == b:
            return np.zeros(0, np.uint32)
        first, last = a // BLOCK, (b - 1) // BLOCK
        return np.concatenate(self.blocks(first, last))[a - first * BLOCK : b - first * BLOCK]


def _segments(batches: Iterator[pa.RecordBatch], path: str, end: bytes) -> Iterator[pa.RecordBatch]:
    part, seg, start = TaskContext.get().partitionId(), 0, 0
    ids: list[int | None] = []
    docs: list[bytes] = []
    held = 0

    def flush() -> pa.RecordBatch:
        columns = ([part], [seg], [start], [held], [ids], [encode_segment(docs)])
        types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        names = ["part", "seg", "part_start", "n_ids", "doc_ids", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    encode = encoder(path).encode
    for batch in batches:
        rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
        for run in by_size(rows, lambda r: len(r[1]), TEXT_RUN):
            for (doc_id, _), own in zip(run, encode([text for _, text in run])):
                ids.append(doc_id)
                docs.append(own + end)
                held += len(own) // 4 + 1
                if held >= SEGMENT_IDS:
                    yield flush()
                    seg, start = seg + 1, start + held
                    ids, docs, held = [], [], 0
    if docs:
        yield flush()


def write_token_blocks(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encodes every row of ``docs`` and writes its ids under ``path`` (new folder)."""
    tokenizer, end = tokenizer or default_tokenizer(), struct.pack("<I", end_id)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    out = ordered.mapInArrow(lambda it: _segments(it, tokenizer, end), SEGMENTS)
    # the payload is packed already; small row groups keep a reader's batch small
    out.write.option("compression", "none").option("parquet.block.size", 8 << 20).parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.large_binary())])
    for batch in batches:
        for part, part_start, doc_ids, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "part_start", "doc_ids", "payload"))):
            segment = Segment(payload)
            ids, ends = segment.ids().astype("<u4").tobytes(), np.cumsum(segment.lengths)
            starts = ends - segment.lengths
            columns = (doc_ids, [part] * len(doc_ids), part_start + starts, segment.lengths, [ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "part", "start", "n_tokens", "ids_crc32"]
    for b in _documents(batches):
        crc = pa.array([zlib.crc32(x) for x in b.column("ids").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*b.columns[:4], crc], names=names)


def _with_starts(segments: DataFrame, rows: DataFrame) -> DataFrame:
    """Turns starts within parts into starts over all parts.  There is one row
    per written part (a Spark partition), so the running sum is short."""
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(base, "part").withColumn("start", F.col("base") + F.col("start")).drop("base", "part")


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian 32-bit) from written files."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    rows = segments.mapInArrow(_documents, "doc_id long, part int, start long, n_tokens long, ids binary")
    return _with_starts(segments, rows).select("doc_id", "start", "n_tokens", "ids")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids, from written files."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    rows = segments.mapInArrow(_checksums, "doc_id long, part int, start long, n_tokens long, ids_crc32 long")
    return _with_starts(segments, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
