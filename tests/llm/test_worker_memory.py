import random
import tracemalloc

import pyarrow as pa
import pytest

from ledgerloom.llm import best_fit_packing, near_dedup, substring_dedup
from ledgerloom.llm.common import text_runs
from ledgerloom.llm.tokens import default_tokenizer

#: Steps of the pipeline, and the MB that one may hold of a batch of 12 MB.
STEPS = {
    "features": (lambda it: near_dedup._features(it, 5), 20),
    "sets": (lambda it: near_dedup._sets(it, 5), 20),
    "anchors": (lambda it: substring_dedup._anchors(it, 35, 11), 30),
    "paths": (lambda it: substring_dedup._path_rows(it, b"\xff" * 8192, 35, 11), 35),
    "pieces": (lambda it: best_fit_packing._pieces(it, default_tokenizer(), bytes(4), 2048), 12),
}


def batch(characters):
    draw, words = random.Random(3), [f"word{i}" for i in range(2000)]
    texts = ["", *(" ".join(draw.choices(words, k=300)) for _ in range(characters // 2300))]
    ids = pa.array(range(len(texts)), pa.int64())
    digests = pa.array([b"%016d" % i for i in range(len(texts))])
    return pa.RecordBatch.from_arrays([ids, ids, ids, ids, digests, pa.array(texts)], names=["doc_id", "row", "tie", "cls", "digest", "text"])


@pytest.mark.parametrize("name", STEPS)
def test_a_large_batch_is_held_run_by_run(name):
    step, most = STEPS[name]
    small, large = batch(100_000), batch(12_000_000)
    for _ in step(iter([small])):  # what a worker keeps is made here
        pass
    tracemalloc.start()
    for _ in step(iter([large])):
        pass
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert peak < most


def test_runs_hold_every_row_once():
    texts = ["a" * 5, None, "", "é" * 4, "b" * 30, None, "c"]
    table = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["i", "text"])
    for limit in (1, 6, 13, 100):
        runs = list(text_runs(iter([table, table.slice(0, 0), table.slice(2)]), limit))
        assert [x for r in runs for x in r.column("text").to_pylist()] == texts + texts[2:]
        assert all(r.num_rows for r in runs)
        held = [sum(len((x or "").encode()) for x in r.column("text").to_pylist()[:-1]) for r in runs]
        assert max(held) < limit
