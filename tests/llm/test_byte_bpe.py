import hashlib

import public_tokenizers
import pytest
import tiktoken

from llm_cases import SF0001, no_docs, odd_docs  # noqa: F401
from ledgerloom.llm import byte_bpe
from ledgerloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def expected():
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.default_ranks()), special_tokens={})

    def row(doc_id, text):
        ids = e.encode_ordinary(text or "")
        return doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    return row


def same(got, rows, expected):
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(expected(r["doc_id"], r["text"])) for r in rows)


@pytest.mark.parametrize("size", [50_000, 12_000_000])
def test_op6_query(spark, monkeypatch, expected, size):
    monkeypatch.setattr(byte_bpe, "BLOCK_TEXT", size)
    monkeypatch.setattr(byte_bpe, "KEPT_WORDS", size // 20)
    same(QUERIES["op6_byte_bpe"](spark, SF0001).collect(), spark.read.parquet(f"{SF0001}/documents.parquet").collect(), expected)


def test_odd_rows(spark, odd_docs, no_docs, expected):
    same(byte_bpe.encode_and_decode(odd_docs).collect(), odd_docs.collect(), expected)
    assert byte_bpe.encode_and_decode(no_docs).collect() == []
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    same(byte_bpe.encode_and_decode(blank).collect(), blank.collect(), expected)


def test_changed_input_is_noticed():
    import pyarrow as pa

    docs = pa.table({"crc": [1], "doc_ids": [[1]], "counts": [[0]], "n_words": [0], "positions": [b""]})
    with pytest.raises(ValueError, match="changed"):
        byte_bpe._reassemble((0,), docs, pa.table({"crc": [2], "numbers": [b""], "ids": [b""]}), [])
