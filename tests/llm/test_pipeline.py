import collections
import struct
import zlib

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from llm_cases import SF0001, no_docs, odd_docs  # noqa: F401
from ledgerloom.llm.tokens import default_tokenizer
from test_near_dedup import brute as near
from test_substring_dedup import brute as repeats


def test_stages_like_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    scores = {}
    kept = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = [tuple(r) for r in kept.select("doc_id", "text", "lang", "source", "n_chars").collect()]
        stage(spark, kept, SF0001).write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        after = [tuple(r) for r in kept.collect()]
        pairs = [r[:2] for r in before]
        if name == "toxicity":
            assert set(after) <= set(before) and len(after) > 0.85 * len(before)
            want = after
        elif name == "exact_dedup":
            last = {}
            for i, t in pairs:
                last[t] = max(i, last.get(t, i))
            want = [r for r in before if last[r[1]] == r[0]]
        elif name == "near_dedup":
            want = [r for r, j in zip(before, near(pairs, 80)) if j[3]]
        else:
            judged = repeats(pairs)
            assert [r[0] for r in sorted(after)] == [r[0] for r in sorted(before)]
            got = {r[0]: r for r in after}
            for r, (summary, words) in zip(before, judged):
                new = got[r[0]]
                assert new[1].encode().split() == [w.encode() for w in words] and new[4] == len(new[1])
                assert summary[2] or new == r
            continue
        assert collections.Counter(after) == collections.Counter(want)
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF0001).collect()
    length = collections.Counter()
    for r in packed:
        length[r["doc_id"]] += r["length"]
    assert length == {r["doc_id"]: len(t.encode(r["text"], add_special_tokens=False).ids) + 1 for r in kept.collect()}


def test_run_and_odd_rows(spark, odd_docs, no_docs):
    assert corpus_pipeline.run(spark, SF0001).count() > 100
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF0001)
            assert out.columns == docs.columns
            out.count()


def test_toxicity_stage_against_labels(spark):
    """A stage that rejects nothing, or clean documents, fails here."""
    sf = SF0001.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.reject_toxic(spark, docs, sf).select("doc_id").collect()}
    here = {r["doc_id"] for r in docs.select("doc_id").collect()}
    labels = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["doc_id"] in here]
    toxic, clean = ([i for i, t in labels if t == k] for k in (1, 0))
    assert sum(i not in kept for i in toxic) >= 0.95 * len(toxic) > 0
    assert sum(i not in kept for i in clean) <= 0.02 * len(clean)


def test_packing_rows(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    ids = {r["doc_id"]: [*t.encode(r["text"], add_special_tokens=False).ids, 0] for r in docs.collect()}
    rows = corpus_pipeline.pack(spark, docs, SF0001).collect()
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    for spans, total in [*((s, None) for s in sequences.values()), *((p, len(ids[i])) for i, p in pieces.items())]:
        end = 0
        for start, length in sorted(spans):
            assert start == end and length > 0
            end += length
        assert end == total if total is not None else end <= 2048
    assert pieces.keys() == ids.keys()
    assert len(sequences) <= 1.05 * sum(map(len, ids.values())) / 2048 + 1
