"""First of many patterns, in list order, that contains a text or is contained in it.

Patterns inside the text come from one pass of an Aho-Corasick automaton over
it; patterns around the text from the posting list of its rarest letter triple
(the whole text, if shorter).  Nothing is compared with all patterns.
"""

from __future__ import annotations

import ahocorasick

GRAM = 3


class Patterns:
    def __init__(self, patterns: list[str]):
        self.patterns = patterns
        self.automaton = ahocorasick.Automaton()
        self.holders: dict[str, list[int]] = {}
        for i, pattern in enumerate(patterns):
            if pattern and not self.automaton.exists(pattern):
                self.automaton.add_word(pattern, i)
            grams = {pattern[k : k + n] for n in range(1, GRAM + 1) for k in range(len(pattern) - n + 1)}
            for gram in grams:
                self.holders.setdefault(gram, []).append(i)
        self.automaton.make_automaton()

    def first_within(self, text: str) -> int | None:
        """First pattern that the text contains."""
        return min((i for _, i in self.automaton.iter(text)), default=None) if len(self.automaton) else None

    def first(self, text: str) -> int | None:
        """First pattern that contains the text or is contained in it; none for an empty text."""
        if not text:
            return None
        best = self.first_within(text)
        grams = [text[k : k + GRAM] for k in range(len(text) - GRAM + 1)] or [text]
        for i in min((self.holders.get(g, ()) for g in grams), key=len):
            if best is not None and i >= best:
                break
            if text in self.patterns[i]:
                return i
        return best
