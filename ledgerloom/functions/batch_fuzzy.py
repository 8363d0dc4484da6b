"""Similarity of many string pairs at once: one machine word per pair.

The longest common subsequence of a pair needs one word step per character of
one side.  Here a step is done for all pairs together: a pair is a lane of a
64-bit NumPy array, and a string's letter masks come from one table.  Strings
over 64 characters go pair by pair (``fuzzy.lcs_len``); the results are equal.

``Choices`` finds, for a batch of texts, each one's best choice by token-set
score, the first on ties.  Choices that share a token come from a token index,
and of those only the ones whose rests could still be alike enough are
compared; the score of any other is a single ratio, bounded by the letters in
common, and only choices whose bound can still win are compared.
"""

from __future__ import annotations

from collections import Counter

import numpy as np

from ledgerloom.functions import fuzzy

WORD = 64
#: Pairs whose letters are held at once.
PAIRS = 200_000


class Texts:
    """Strings as rows of letter numbers; the code points in ``alphabet`` (sorted) are numbered from 1, others are 0.
    Strings over WORD characters have empty rows."""

    def __init__(self, texts: list[str], alphabet: np.ndarray):
        self.texts, self.alphabet = texts, alphabet
        self.lengths = np.array([len(t) for t in texts], np.int64)
        fitting = [t if len(t) <= WORD else "" for t in texts]
        width = max(1, int(min(WORD, self.lengths.max(initial=1))))
        points = np.array(fitting, f"<U{width}").view(np.uint32).reshape(len(texts), width)
        self.codes = np.zeros(points.shape, np.int32)
        if len(alphabet):
            at = np.searchsorted(alphabet, points)
            known = alphabet[np.minimum(at, len(alphabet) - 1)] == points
            self.codes[known] = at[known] + 1

    def masks(self) -> np.ndarray:
        """(text, letter) -> the places of the letter, as bits; nothing for letter 0."""
        out = np.zeros((len(self.texts), len(self.alphabet) + 1), np.uint64)
        rows = np.arange(len(self.texts))
        for j in range(self.codes.shape[1]):
            out[rows, self.codes[:, j]] |= np.uint64(1 << j)
        out[:, 0] = 0
        return out

    def counts(self) -> np.ndarray:
        """(letter, text) -> how often, at most 255."""
        out = np.zeros((len(self.alphabet) + 1, len(self.texts)), np.uint8)
        rows = np.arange(len(self.texts))
        for j in range(self.codes.shape[1]):
            out[self.codes[:, j], rows] += 1
        numbers = {chr(c): i + 1 for i, c in enumerate(self.alphabet.tolist())}
        for i in np.flatnonzero(self.lengths > WORD).tolist():
            out[:, i] = 0
            for ch, n in Counter(self.texts[i]).items():
                out[numbers.get(ch, 0), i] = min(n, 255)
        out[0] = 0
        return out


def alphabet_of(texts: list[str]) -> np.ndarray:
    letters = set().union(*map(set, texts)) if texts else set()
    return np.array(sorted(map(ord, letters - {"\0"})), np.uint32)


def _numbered(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Distinct texts, and the number of each text among them."""
    numbers: dict[str, int] = {}
    at = np.array([numbers.setdefault(t, len(numbers)) for t in texts], np.int64)
    return list(numbers), at


def _lanes(masks: np.ndarray, lengths: np.ndarray, i: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """LCS length of text i[k] (at most WORD letters) with the letters of the k-th row of ``codes``."""
    open_ = np.full(len(i), np.uint64(2**WORD - 1))
    offset, flat = i * masks.shape[1], masks.ravel()
    for column in np.ascontiguousarray(codes.T):
        hit = flat[offset + column]
        both = open_ & hit
        open_ = (open_ + both) | (open_ - both)
    own = lengths[i]
    used = np.where(own >= WORD, np.uint64(2**WORD - 1), (np.uint64(1) << (own % WORD).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~open_ & used).astype(np.int64)


def lcs_of_pairs(a: Texts, masks: np.ndarray, b: Texts, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """LCS lengths of the pairs (a[i], b[j]); ``masks`` are those of ``a``."""
    out = np.zeros(len(i), np.int64)
    for at in range(0, len(i), PAIRS):
        ii, jj = i[at : at + PAIRS], j[at : at + PAIRS]
        long = (a.lengths[ii] > WORD) | (b.lengths[jj] > WORD)
        width = int(b.lengths[jj][~long].max(initial=0))
        found = _lanes(masks, a.lengths, ii, b.codes[jj, :width])
        for k in np.flatnonzero(long).tolist():
            found[k] = fuzzy.lcs_len(a.texts[ii[k]], b.texts[jj[k]])
        out[at : at + PAIRS] = found
    return out


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """LCS length of every pair (left[k], right[k]); equal strings are prepared once."""
    if not left:
        return np.zeros(0, np.int64)
    (ones, i), (twos, j) = _numbered(left), _numbered(right)
    alphabet = alphabet_of(ones)
    a = Texts(ones, alphabet)
    return lcs_of_pairs(a, a.masks(), Texts(twos, alphabet), i, j)


def ratios(left: list[str], right: list[str]) -> np.ndarray:
    """``fuzzy.ratio`` of every pair."""
    total = np.array([len(a) + len(b) for a, b in zip(left, right)], np.float64)
    lcs = lcs_lengths(left, right)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(total > 0, (1.0 - (total - 2 * lcs) / total) * 100, 100.0)


def partial_ratios(left: list[str], right: list[str]) -> np.ndarray:
    """``fuzzy.partial_ratio`` of every pair: a lane for every window of every pair."""
    out = np.zeros(len(left))
    inner, outer, pair = [], [], []
    for k, (a, b) in enumerate(zip(left, right)):
        if not (a and b) or max(len(a), len(b)) > WORD:
            out[k] = fuzzy.partial_ratio(a, b)
            continue
        short, long = sorted((a, b), key=len)
        for x, y in ((short, long), (long, short)) if len(a) == len(b) else ((short, long),):
            inner.append(x)
            outer.append(y)
            pair.append(k)
    if not pair:
        return out
    alphabet = alphabet_of(inner)
    x, y = Texts(inner, alphabet), Texts(outer, alphabet)
    masks, pair = x.masks(), np.array(pair)
    windows = x.lengths + y.lengths - 1
    step = max(1, PAIRS // int(windows.max()))
    for at in range(0, len(pair), step):
        own = np.arange(at, min(at + step, len(pair)))
        k = np.repeat(own, windows[own])
        first = np.arange(len(k)) - np.repeat(np.cumsum(windows[own]) - windows[own], windows[own]) + 1 - x.lengths[k]  # where the window starts
        place = first[:, None] + np.arange(int(x.lengths[own].max()))
        inside = (place >= 0) & (place < y.lengths[k][:, None]) & (place < (first + x.lengths[k])[:, None])
        codes = np.where(inside, y.codes[k[:, None], np.clip(place, 0, y.codes.shape[1] - 1)], 0)
        total = x.lengths[k] + np.minimum(first + x.lengths[k], y.lengths[k]) - np.maximum(first, 0)
        score = (1.0 - (total - 2 * _lanes(masks, x.lengths, k, codes)) / total) * 100
        np.maximum.at(out, pair[k], score)
    return out


def combined_scores(queries: list[str], choices: list[str], set_scores: np.ndarray) -> list[int]:
    """``fuzzy.combined_score`` of every pair."""
    out = [100] * len(queries)
    at = [k for k, s in enumerate(set_scores) if s != 100.0]
    q, c = [queries[k] for k in at], [choices[k] for k in at]
    sort = ratios([fuzzy.sorted_text(x.split()) for x in q], [fuzzy.sorted_text(x.split()) for x in c])
    for k, s, p, t in zip(at, np.asarray(set_scores)[at].tolist(), partial_ratios(q, c).tolist(), sort.tolist()):
        out[k] = int(round(max(s, p, t)))
    return out


class Choices:
    """Choices in list order, prepared for batches of best-choice searches."""

    #: (text, choice) pairs whose bounds are held at once.
    BOUNDS = 4_000_000
    #: Choices of a text that are compared first, best bound first.
    FIRST = 8

    def __init__(self, choices: list[str]):
        self.choices = choices
        self.tokens = [frozenset(c.split()) for c in choices]
        texts = [fuzzy.sorted_text(t) for t in self.tokens]
        self.texts = Texts(texts, alphabet_of(texts))
        self.counts = self.texts.counts()
        self.n_tokens = np.array([len(t) for t in self.tokens], np.int64)
        holders: dict[str, list[int]] = {}
        for i, own in enumerate(self.tokens):
            for token in own:
                holders.setdefault(token, []).append(i)
        self.holders = {token: np.array(found, np.int64) for token, found in holders.items()}

    def best(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Position and token-set score of every query's best choice."""
        place, top = np.zeros(len(queries), np.int64), np.zeros(len(queries))
        step = max(1, self.BOUNDS // max(1, len(self.choices)))
        for at in range(0, len(queries), step):
            place[at : at + step], top[at : at + step] = self._best(queries[at : at + step])
        return place, top

    def _best(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.choices)
        owns = [frozenset(q.split()) for q in queries]
        texts = [fuzzy.sorted_text(o) for o in owns]
        place, top = np.full(len(queries), n, np.int64), np.full(len(queries), -1.0)
        q_s, i_s = self._sharing(owns, texts, place, top)
        # all others: bounded by common letters
        mine = Texts(texts, self.texts.alphabet)
        masks, own_letters = mine.masks(), mine.counts()
        short = max(mine.lengths.max(initial=0), self.texts.lengths.max(initial=0)) <= 255
        common = np.zeros((len(queries), n), np.uint8 if short else np.int32)
        for letter in np.flatnonzero(own_letters.any(axis=1)).tolist():
            has = np.flatnonzero(own_letters[letter])
            common[has] += np.minimum(own_letters[letter, has][:, None], self.counts[letter][None, :])
        total = mine.lengths[:, None].astype(np.float32) + self.texts.lengths[None, :].astype(np.float32)
        if not short:  # counts were cut at 255: there, length bounds them
            over = (mine.lengths > 255)[:, None] & (self.texts.lengths > 255)[None, :]
            common[over] = np.minimum(mine.lengths[:, None], self.texts.lengths[None, :])[over]
        bounds = common * np.float32(200) / np.maximum(total, 1) + np.float32(1e-3)  # rounding stays below the margin
        bounds[q_s, i_s] = -1.0
        bounds[top == 100.0] = -1.0
        none = mine.lengths == 0
        bounds[none] = -1.0

        def compare(q: np.ndarray, i: np.ndarray) -> None:
            whole = (mine.lengths[q] + self.texts.lengths[i]).astype(np.float64)
            lcs = lcs_of_pairs(mine, masks, self.texts, q, i)
            self._keep(place, top, q, i, 100.0 - 100.0 * (whole - 2 * lcs) / whole)
            bounds[q, i] = -1.0

        if n > 4 * self.FIRST:
            first = np.argpartition(-bounds, self.FIRST, axis=1)[:, : self.FIRST]
            q, k = np.nonzero(np.take_along_axis(bounds, first, axis=1) >= top[:, None])
            compare(q, first[q, k])
        q, i = np.nonzero(bounds >= np.maximum(top, 0.0)[:, None])
        compare(q, i)
        place[none], top[none] = 0, 0.0
        return place, top

    def _sharing(self, owns: list[frozenset[str]], texts: list[str], place: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores the choices that share a token with a query, and returns all those pairs.  With s, x, y the
        lengths of the shared tokens and of the two rests, only the ratio of the rests needs a comparison,
        and only where it could be the best; a query or choice without rest makes 100."""
        n = len(self.choices)
        found = [(q, self.holders[t], len(t) + 1) for q, own in enumerate(owns) for t in own if t in self.holders]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        times = [len(h) for _, h, _ in found]
        every = np.repeat([q * n for q, *_ in found], times) + np.concatenate([h for _, h, _ in found])
        pairs, at = np.unique(every, return_inverse=True)  # by query, then by choice
        q, i = pairs // n, pairs % n
        shared = np.bincount(at)
        s = np.bincount(at, weights=np.repeat([w for *_, w in found], times)) - 1
        own_size, own_length = np.array([len(o) for o in owns]), np.array([len(t) for t in texts], np.float64)
        sx, sy = own_length[q], self.texts.lengths[i].astype(np.float64)
        x, y = sx - s - 1, sy - s - 1
        lower = np.maximum(100.0 - 100.0 * (1 + x) / (s + sx), 100.0 - 100.0 * (1 + y) / (s + sy))
        upper = np.maximum(lower, 100.0 - 100.0 * np.abs(x - y) / (sx + sy))
        full = (shared == own_size[q]) | (shared == self.n_tokens[i])
        lower[full] = upper[full] = 100.0
        self._keep(place, top, q, i, lower)
        open_ = np.flatnonzero(~full & (upper >= top[q]) & (top[q] < 100.0))
        if len(open_):
            scores = fuzzy.token_set_scores([(owns[a], self.tokens[b]) for a, b in zip(q[open_].tolist(), i[open_].tolist())], lcs_lengths)
            self._keep(place, top, q[open_], i[open_], np.array(scores))
        return q, i

    @staticmethod
    def _keep(place: np.ndarray, top: np.ndarray, q: np.ndarray, i: np.ndarray, score: np.ndarray) -> None:
        """Takes over better scores, of equal ones the first choice."""
        if len(q):
            order = np.lexsort((i, -score, q))
            first = order[np.unique(q[order], return_index=True)[1]]
            q, i, score = q[first], i[first], score[first]
            better = (score > top[q]) | ((score == top[q]) & (i < place[q]))
            place[q[better]], top[q[better]] = i[better], score[better]
