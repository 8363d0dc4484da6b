"""Byte-level BPE encoding and decoding (operator 6): global distinct-word shuffle.

Documents are read in blocks of a bounded text size.  A block explodes its
texts into pieces (cut before a space that a non-space follows, which always
begins a pre-token) with positions, and each distinct piece into pre-tokens
("words"), which get local numbers.  Two kinds of data leave it: the words,
dealt to partitions by a hash of the word (a pass of its own, which builds no
positions), and the positions (piece numbers in text order and the word numbers
of each distinct piece, compressed).
Each partition of words encodes every distinct word once, whichever blocks
ask for it, and answers each block with the ids.  Positions and ids meet again
by block, where texts are reassembled by position; decoding looks every id up
in the token-byte table (as large as the vocabulary, whatever the data).

A word that a third of all rows hold crosses the shuffle once per block, and a
block is never larger than BLOCK_TEXT plus one document.

The two passes over the input must see the same blocks: the input has to be a
table scan (or another plan with stable partitions).  Blocks carry a checksum
of their texts, and reassembly raises an error if the passes disagree.

Defined results: a null text is encoded as empty (no ids); null and repeated
doc_ids are carried along; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import by_size, text_or_empty, worker_object
from ledgerloom.llm.tokens import numbered_pieces

RANKS = "byte_bpe_50k.tiktoken"
#: Characters of text in a block.
BLOCK_TEXT = 12_000_000
#: Distinct words that a partition of words keeps; beyond that it starts anew (a word may then be encoded again).
KEPT_WORDS = 2_000_000


def default_ranks() -> str:
    return public_tokenizers.path(RANKS)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class _Block:
    """A run of documents: its distinct words in order of first appearance, the
    words of each distinct piece, and the piece numbers of each text."""

    def __init__(self, block: int, rows: list[tuple[int, str]], pattern: str):
        self.block, self.crc, self.doc_ids = block, 0, [i for i, _ in rows]
        texts = [text for _, text in rows]
        for text in texts:
            self.crc = zlib.crc32(text.encode(), self.crc)
        pieces, self.positions = numbered_pieces(texts)
        find, spaced = regex.compile(pattern).findall, len(pieces) - len(texts)
        self.piece_words = [find(" " + p) for p in pieces[:spaced]] + [find(p) for p in pieces[spaced:]]
        self.words = list(dict.fromkeys(chain.from_iterable(self.piece_words)))


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[_Block]:
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        rows = list(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
        for run in by_size(rows, lambda r: len(r[1]), BLOCK_TEXT):
            yield _Block((part << 32) + seq, run, pattern)
            seq += 1


def _word_rows(batches: Iterator[pa.RecordBatch], pattern: str, parts: int) -> Iterator[pa.RecordBatch]:
    """Distinct words of each block: one row per part that has any."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for b in _blocks(batches, pattern):
        own: list[list[int]] = [[] for _ in range(parts)]
        words = [w.encode() for w in b.words]
        for i, k in enumerate(map(zlib.crc32, words)):
            own[k % parts].append(i)
        rows = [(b.block, b.crc, k, squeeze(np.array(at, "<u4").tobytes()), squeeze(_join([words[i] for i in at]))) for k, at in enumerate(own) if at]
        if rows:
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["block", "crc", "word_part", "numbers", "words"])


def _join(items: list[bytes]) -> bytes:
    """Byte strings with their lengths in front."""
    return np.array([len(items), *map(len, items)], "<u4").tobytes() + b"".join(items)


def _cut(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = (4 * (n + 1) + np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)).tolist()
    return [data[a:b] for a, b in zip([4 * (n + 1), *ends], ends)]


def _encode_words(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Each distinct word of the partition is encoded once."""
    squeeze, spread = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress
    coder = worker_object(("tiktoken", path), lambda: tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}))
    ids: dict[bytes, bytes] = {}
    for batch in batches:
        out = []
        for words in batch.column("words").to_pylist():
            answer = []
            for w in _cut(spread(words)):
                if w not in ids:
                    if len(ids) >= KEPT_WORDS:
                        ids.clear()
                    ids[w] = np.array(coder.encode_ordinary(w.decode()), "<u4").tobytes()
                answer.append(ids[w])
            out.append(squeeze(_join(answer)))
        columns = [*(batch.column(c) for c in ("block", "crc", "numbers")), pa.array(out, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "crc", "numbers", "ids"])


def _packed(numbers: np.ndarray) -> bytes:
    """Bytes of equal weight together compress best."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=6).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


POSITIONS = "block long, crc long, doc_ids array<bigint>, counts array<bigint>, n_words long, piece_sizes binary, piece_words binary, positions binary"


def _position_rows(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    types = (pa.int64(), pa.int64(), longs, longs, pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = [field.split()[0] for field in POSITIONS.split(", ")]
    for b in _blocks(batches, pattern):
        number = {w: i for i, w in enumerate(b.words)}
        sizes = np.fromiter(map(len, b.piece_words), np.uint32, len(b.piece_words))
        words = np.fromiter(map(number.__getitem__, chain.from_iterable(b.piece_words)), np.uint32)
        own = [p[sizes[p] > 0] for p in b.positions]  # the first piece of a text may be empty
        row = (b.block, b.crc, b.doc_ids, list(map(len, own)), len(b.words), _packed(sizes), _packed(words), _packed(np.concatenate(own)))
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)


def _reassemble(key: tuple, docs: pa.Table, answers: pa.Table, table: list[bytes]) -> pa.Table:
    spread = zstandard.ZstdDecompressor().decompress
    crcs = {*docs.column("crc").to_pylist(), *answers.column("crc").to_pylist()}
    if docs.num_rows != 1 or len(crcs) != 1:
        raise ValueError("the input changed between two passes over it: stage it as a table first")
    row = docs.to_pylist()[0]
    ids: list[bytes] = [b""] * row["n_words"]
    for numbers, found in zip(answers.column("numbers").to_pylist(), answers.column("ids").to_pylist()):
        for i, x in zip(np.frombuffer(spread(numbers), "<u4").tolist(), _cut(spread(found))):
            ids[i] = x
    words, ends = _unpacked(row["piece_words"]).tolist(), np.cumsum(_unpacked(row["piece_sizes"]), dtype=np.int64).tolist()
    decimal, decoded, counts = [], [], np.empty(len(ends), np.int64)
    for k, (a, b) in enumerate(zip([0, *ends], ends)):
        own = np.frombuffer(b"".join([ids[w] for w in words[a:b]]), "<u4").tolist()
        counts[k] = len(own)
        decimal.append(" ".join(map(str, own)))
        decoded.append(b"".join([table[i] for i in own]))
    flat, rows, at = _unpacked(row["positions"]), [], 0
    for doc_id, n in zip(row["doc_ids"], row["counts"]):
        places = flat[at : at + n]
        at += n
        own = places.tolist()
        text_ids = " ".join([decimal[i] for i in own]).encode()
        text = b"".join([decoded[i] for i in own])
        rows.append((doc_id, int(counts[places].sum()), hashlib.sha256(text_ids).hexdigest(), hashlib.sha256(text).hexdigest()))
    types = (pa.int64(), pa.int64(), pa.string(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode_and_decode(docs: DataFrame, ranks: str | None = None, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, SHA-256 of its ids (decimal, joined by a
    space) and SHA-256 of the bytes that the ids decode to."""
    path, spark = ranks or default_ranks(), docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # as for any shuffle, set with the size of the data
    words = rows.mapInArrow(lambda it: _word_rows(it, pattern, parts), "block long, crc long, word_part int, numbers binary, words binary")
    # the word decides the part, the part the partition: all blocks' copies of a word meet in one task
    answers = words.repartition("word_part").mapInArrow(lambda it: _encode_words(it, path, pattern), "block long, crc long, numbers binary, ids binary")
    positions = rows.mapInArrow(lambda it: _position_rows(it, pattern), POSITIONS)

    def reassemble(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _reassemble(key, left, right, _token_bytes(path))

    pairs = positions.groupBy("block").cogroup(answers.groupBy("block"))
    return pairs.applyInArrow(reassemble, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _token_bytes(path: str) -> list[bytes]:
    """The token-byte table: id -> bytes."""

    def make() -> list[bytes]:
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token
        return table

    return worker_object(("token bytes", path), make)
