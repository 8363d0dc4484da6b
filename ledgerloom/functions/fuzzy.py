"""String similarity on the Indel (LCS) distance, 0-100 floats, pair by pair;
``batch_fuzzy`` computes the same for many pairs at once.

Published definitions of the scores:

* ``ratio(a, b)``       = 100 * (1 - (|a| + |b| - 2 LCS) / (|a| + |b|))
* ``token_sort_ratio``  = ratio of the whitespace tokens sorted and re-joined
* ``token_set_ratio``   = with s, x, y the sorted-joined intersection and the
  two differences of the token sets: 0 if a side has no tokens; 100 if s is
  non-empty and x or y is empty; else the best of ratio("s x", "s y"),
  ratio(s, "s x") and ratio(s, "s y") (ratio(x, y) when s is empty)
* ``partial_ratio``     = best ratio of the shorter string against every
  window of that length that overlaps the longer one, both ways round when
  the lengths are equal
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def lcs_len(a: str, b: str) -> int:
    """Bit-parallel: one machine word step per character of ``b``."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_ = full
    for hit in map(masks.get, b):
        if hit:
            both = open_ & hit
            open_ = ((open_ + both) | (open_ - both)) & full
    return len(a) - open_.bit_count()


def _share(distance: int, total: int) -> float:
    return 100.0 - 100.0 * distance / total if total else 100.0


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return (1.0 - (total - 2 * lcs_len(a, b)) / total) * 100 if total else 100.0


def sorted_text(tokens) -> str:
    return " ".join(sorted(tokens))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(sorted_text(a.split()), sorted_text(b.split()))


def token_set_scores(pairs: list[tuple[frozenset[str], frozenset[str]]], lcs_lengths: Callable[[list[str], list[str]], np.ndarray]) -> list[float]:
    """Token-set score of every pair of token sets; ``lcs_lengths`` compares lists of strings."""
    shared = [len(sorted_text(p & q)) for p, q in pairs]
    xs, ys = [sorted_text(p - q) for p, q in pairs], [sorted_text(q - p) for p, q in pairs]
    out = []
    for (p, q), s, x, y, lcs in zip(pairs, shared, xs, ys, lcs_lengths(xs, ys)):
        if not p or not q:
            out.append(0.0)
        elif s and not (x and y):
            out.append(100.0)
        else:
            gap = 1 if s else 0  # the space between s and what follows it
            sx, sy = s + gap + len(x), s + gap + len(y)
            scores = [_share(len(x) + len(y) - 2 * int(lcs), sx + sy)]
            if s:
                scores += [_share(gap + len(x), s + sx), _share(gap + len(y), s + sy)]
            out.append(max(scores))
    return out


def token_set_ratio(a: str, b: str) -> float:
    pair = frozenset(a.split()), frozenset(b.split())
    return token_set_scores([pair], lambda xs, ys: np.array([lcs_len(x, y) for x, y in zip(xs, ys)]))[0]


def _best_window(inner: str, outer: str) -> float:
    m = len(inner)
    windows = {outer[max(0, at) : at + m] for at in range(1 - m, len(outer))}
    return max(ratio(inner, w) for w in windows)


def partial_ratio(a: str, b: str) -> float:
    if not (a and b):
        return 0.0 if a or b else 100.0
    inner, outer = sorted((a, b), key=len)
    best = _best_window(inner, outer)
    return max(best, _best_window(outer, inner)) if len(a) == len(b) else best


def combined_score(query: str, choice: str, set_score: float) -> int:
    """Integer score of the chosen alias: the best of token-set, partial and
    token-sort, rounded half to even (before any threshold test)."""
    if set_score == 100.0:
        return 100
    return int(round(max(set_score, partial_ratio(query, choice), token_sort_ratio(query, choice))))
