import collections
import random
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_cases import SF0001, no_docs, odd_docs  # noqa: F401
from ledgerloom.llm import best_fit_packing, token_blocks
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.tokens import PieceEncoder, default_tokenizer, pre_tokens

ODD = ["", " ", "  ", "a  b", " a", "a ", "a\n b", "a\n\n  b\t c  \n", "it's 'so' 12 a<|endoftext|>b", "x\x1c y \x1cz", "é ü  b 　c", "日本 語", "  a \u0085 b"]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]


def test_pieces_encode_like_whole_texts(plain, docs, monkeypatch):
    monkeypatch.setattr("ledgerloom.llm.tokens.CACHED_PIECES", 500)
    e = PieceEncoder(default_tokenizer())
    texts = ODD + [t for _, t in docs[:60]]
    for run in (texts[:20], texts[20:], texts):
        assert [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in e.encode(run)] == [plain(t) for t in run]


PIECES = [
    "word", "word,", "wörd...", "end.\nNext", "a1b22", "$5.00", "a\n", "a\n\n", "a\n\n\nb", "x\r\n\ty!?", "###", "ÉVIAUX!!", "ƻɏɿ", "_a_",
    "it's", "", "\na", "a b", "×", "3÷4", "ʀ", "µ", "a\u0300", "я", "日本", "a\x00b", "a\x0bb", "x\x1cy", "a\u0085", "a\xa0b", "\x7f",
]


def test_plain_pieces_are_cut_like_the_pattern():
    t = Tokenizer.from_file(default_tokenizer())
    for pieces in (PIECES, PIECES[:14], PIECES[14:], [], ["a"] * 250):
        plain, texts, ends = pre_tokens(pieces)
        some = [p for p, is_plain in zip(pieces, plain) if is_plain]
        assert some == [p for p in pieces if p in (*PIECES[:14], "a")]
        assert "\n".join(texts) == "\n".join(w for p in some for w, _ in t.pre_tokenizer.pre_tokenize_str(" " + p))
        assert ends.tolist() == np.cumsum([1 + len(p.encode()) for p in some]).tolist()


def test_plain_pieces_pass_the_pattern_by(plain, monkeypatch):
    e, sent = PieceEncoder(default_tokenizer()), []
    before = e._plain
    monkeypatch.setattr(e, "_plain", lambda texts, t: sent.extend(texts if t is e.tokenizer else []) or before(texts, t))
    text = "the first of many, wörds.\nNext 12 it's 日本"
    assert list(np.frombuffer(e.encode([text])[0], "<u4")) == plain(text)
    assert sorted(sent) == [" it's 日本", "the"]


def test_other_tokenizers_take_whole_texts():
    path = default_tokenizer().replace("byte_bpe_50k", "word_bpe_49k")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    got = PieceEncoder(path).encode(["Hello  there", ""])
    assert [list(np.frombuffer(b, "<u4")) for b in got] == [t.encode(x, add_special_tokens=False).ids for x in ("Hello  there", "")]


@pytest.mark.parametrize("values", [[], [0], [7] * 3000, list(range(5000)), [0] * 1000 + [2**32 - 1] * 30, [50000, 3] * 700])
def test_segment_round_trip(values):
    cuts = [0, len(values) // 3, len(values) // 3, len(values)]
    parts = [np.array(values[a:b], "<u4") for a, b in zip(cuts, cuts[1:])]
    s = token_blocks.Segment(token_blocks.encode_segment([p.tobytes() for p in parts]))
    assert s.ids().tolist() == values
    for k, p in enumerate(parts):
        assert s.document_ids(k).tolist() == p.tolist()


def test_outliers_go_to_the_exception_list():
    ids = np.array([5] * 1000 + [1 << 20] * 24, "<u4")
    assert len(token_blocks.encode_segment([ids.tobytes()])) < 300


def _expected(docs, plain):
    start, out = 0, {}
    for doc_id, text in sorted(docs):
        ids = plain(text) + [0]
        out[doc_id] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return out


def test_op1_query(spark, plain, docs):
    got = QUERIES["op1_token_blocks"](spark, SF0001).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == _expected(docs, plain) and len(got) == len(docs)


def test_op1_odd_rows(spark, tmp_path, odd_docs, no_docs, plain):
    token_blocks.write_token_blocks(odd_docs, f"{tmp_path}/a")
    got = token_blocks.read_token_blocks(spark, f"{tmp_path}/a").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in odd_docs.collect()), key=lambda x: (x is not None, x))
    want = collections.Counter(tuple(plain(r["text"]) + [0]) for r in odd_docs.collect())
    assert collections.Counter(tuple(np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
    token_blocks.write_token_blocks(no_docs, f"{tmp_path}/b")
    assert token_blocks.token_digests(spark, f"{tmp_path}/b").collect() == []


def test_best_two_fit_bins():
    rng = random.Random(5)
    lengths = np.array([rng.choice([1, 2, 3, 700, 1025, 2048, rng.randint(1, 2048)]) for _ in range(4000)])
    bins, offsets = best_fit_packing.best_two_fit(lengths, 2048)
    full = np.bincount(bins, weights=lengths)
    assert full.max() <= 2048 and len(full) <= 1.01 * max(lengths.sum() / 2048, (lengths > 1024).sum()) + 1
    for b in range(len(full)):
        own = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]]


def test_swap_takes_two_that_fit_better():
    # greedy would hold 60 + 30 (90 of 100); 60 with 21 + 19 is full
    bins, _ = best_fit_packing.best_two_fit(np.array([60, 30, 21, 19]), 100)
    assert bins[0] == bins[2] == bins[3] != bins[1]


def _check_packing(rows, docs, plain):
    places, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        places[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 2048
    for doc_id, text in docs:
        ids, own = plain(text) + [0], sorted(places[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert len(own) == 1 if len(ids) <= 2048 else all(r["length"] == 2048 for r in own[1:])
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r["ids_crc32"]


def test_op4_query(spark, plain, docs):
    rows = QUERIES["op4_best_fit_packing"](spark, SF0001).collect()
    _check_packing(rows, docs, plain)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * total / 2048 + 1


def test_op4_odd_rows(odd_docs, no_docs, plain):
    rows = best_fit_packing.pack_documents(odd_docs).collect()
    assert sum(r["length"] for r in rows) == sum(len(plain(r["text"])) + 1 for r in odd_docs.collect())
    assert best_fit_packing.pack_documents(no_docs).collect() == []
