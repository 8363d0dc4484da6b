import numpy as np
import pytest

from ledgerloom.operators import vectors
from ledgerloom.operators.merchants import resolve_distinct
from ledgerloom.operators.vectors import nearest

SCHEMA = "array<double>"


def brute(queries, refs):
    out = {}
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    for key, q in queries:
        scored = [(sum(x * y for x, y in zip(q, r)) / (sum(x * x for x in q) ** 0.5 * sum(y * y for y in r) ** 0.5), -i) for i, r in refs if ok(q) and ok(r) and len(r) == len(q)]
        if scored:
            out[key] = -max(scored)[1], max(scored)[0]
    return out


def tables():
    """A cell that holds a third of all references, scaled and equal copies, odd vectors, two lengths."""
    rng = np.random.default_rng(5)
    refs = [list(map(float, v)) for v in rng.normal(size=(200, 6))]
    refs += [[float(x) for x in np.eye(6)[0] + 0.02 * rng.normal(size=6)] for _ in range(150)]
    refs += [refs[3], refs[7], [2 * x for x in refs[9]], [0.0] * 6, [float("nan")] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], None, [], [1.0, 2.0], [2.0, 1.0]]
    queries = [list(map(float, v)) for v in rng.normal(size=(120, 6))] + refs[::5] + refs[-8:] + [[1.0, 1.0], [1.0, 2.0, 3.0]]
    return list(enumerate(queries)), [(10_000 - i, v) for i, v in enumerate(refs)]


@pytest.mark.parametrize("slice_size, pivots", [(20_000, 512), (40, 12), (9, 1)])
def test_nearest_against_brute_force(spark, monkeypatch, slice_size, pivots):
    monkeypatch.setattr(vectors, "PIVOTS", pivots)
    monkeypatch.setattr(vectors, "BLOCK", 30 if pivots < 512 else 20_000)
    queries, refs = tables()
    q = spark.createDataFrame(queries, f"k int, vec {SCHEMA}")
    r = spark.createDataFrame(refs, f"ref_id long, vec {SCHEMA}")
    got = {x.k: (x.ref_id, x.cos) for x in nearest(q, r, "k", slice_size).collect()}
    want = brute(queries, refs)
    assert got.keys() == want.keys()
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 1e-12 for k in want)


def test_empty_tables(spark):
    q = spark.createDataFrame([(1, [1.0])], f"k int, vec {SCHEMA}")
    r = spark.createDataFrame([(1, [1.0]), (2, [-1.0])], f"ref_id long, vec {SCHEMA}")
    for size in (20_000, 1):
        assert nearest(q.limit(0), r, "k", size).collect() == []
    assert nearest(q, r.limit(0), "k").collect() == []


def test_cells_skip_what_cannot_win():
    """Clustered references: a query scores few cells."""
    rng = np.random.default_rng(1)
    centres = np.eye(64)
    refs = np.repeat(centres, 64, axis=0) + 0.01 * rng.normal(size=(4096, 64))
    cells = vectors._Cells(np.arange(4096), refs)
    scored = []
    cells.units = [_Counted(u, scored) for u in cells.units]
    ids, _ = cells.best(refs[:256] * 2)
    assert ids.tolist() == list(range(256)) and sum(scored) < 0.2 * 256 * 4096


class _Counted:
    """Stands for a cell's vectors and counts the pairs that are scored."""

    __array_ufunc__ = None  # numpy leaves the product to __rmatmul__

    def __init__(self, units, scored):
        self.T, self.units, self.scored = self, units, scored

    def __rmatmul__(self, rows):
        self.scored.append(len(rows) * len(self.units))
        return rows @ self.units.T


def test_both_sides_of_the_cutoff(spark):
    names = ["qqq zzz", "www vvv"]
    df = spark.createDataFrame([(n,) for n in names], "merchant string")
    angle = np.arccos([0.7201, 0.7199])
    tv = spark.createDataFrame([(n, [float(np.cos(a)), float(np.sin(a))]) for n, a in zip(names, angle)], f"text string, vec {SCHEMA}")
    cv = spark.createDataFrame([(0, [1.0, 0.0])], f"choice_idx long, vec {SCHEMA}")
    got = {r.merchant: (r.merchant_canonical, r.merchant_issues) for r in resolve_distinct(df, "merchant", vectors=(tv, cv)).collect()}
    assert got == {names[0]: ("Uber", ["embedding_matched"]), names[1]: (None, ["low_confidence"])}
