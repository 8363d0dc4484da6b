"""Literals that a regular expression cannot match without."""

from __future__ import annotations

#: Escapes that stand for a kind of character or a place: they end a literal and add none.
_KINDS = set("dDwWsSbBhHvVRAzZ")


class _Unknown(Exception):
    """Syntax that is not looked into."""


def required_literals(pattern: str) -> list[str] | None:
    """Texts of which every match of ``pattern`` contains at least one, or None if none are known.

    Known are characters, escaped signs, ``.``, classes without nesting, anchors, groups with and
    without a number, alternation and quantifiers.  Anything else (flags, look-around, ``\\Q``,
    back references, code points by number) gives None, which is always right."""
    try:
        found, end = _either(pattern, 0)
    except (_Unknown, IndexError):
        return None
    return found if end == len(pattern) else None


def _either(p: str, i: int) -> tuple[list[str] | None, int]:
    """Branches up to a closing bracket or the end: one literal set each, put together."""
    out: list[str] | None = []
    while True:
        one, i = _sequence(p, i)
        out = None if one is None or out is None else out + one
        if i == len(p) or p[i] == ")":
            return (None if out is None else sorted(set(out))), i
        i += 1  # the bar


def _quantifier(p: str, i: int) -> tuple[bool, bool, int]:
    """(there is one, it allows none, place after it)."""
    if i == len(p) or p[i] not in "?*+{":
        return False, False, i
    sign, i = p[i], p.index("}", i) + 1 if p[i] == "{" and "}" in p[i:] else i + 1
    if i < len(p) and p[i] in "?+":  # lazy, possessive
        i += 1
    return True, sign != "+", i


def _sequence(p: str, i: int) -> tuple[list[str] | None, int]:
    sets: list[list[str]] = []
    run = ""
    while i < len(p) and p[i] not in "|)":
        c, inner, single = p[i], None, None
        if c == "(":
            if p[i + 1] == "?":
                if p[i + 2] != ":":
                    raise _Unknown
                i += 2
            inner, i = _either(p, i + 1)
            if p[i] != ")":
                raise _Unknown
        elif c == "[":
            i += 2 if p[i + 1] == "^" else 1
            first = i
            while p[i] != "]" or i == first:
                if p[i] == "[" or p[i : i + 2] == "&&":
                    raise _Unknown
                i += 2 if p[i] == "\\" else 1
        elif c == "\\":
            i += 1
            if p[i].isalnum() and p[i] not in _KINDS:
                raise _Unknown
            single = None if p[i].isalnum() else p[i]
        elif c not in ".^$":
            if c in "?*+{":
                raise _Unknown
            single = c
        i += 1
        repeated, optional, i = _quantifier(p, i)
        if single is not None and not optional:
            run += single
        if single is None or repeated:
            if run:
                sets.append([run])
            run = ""
        if inner is not None and not optional:
            sets.append(inner)
    if run:
        sets.append([run])
    return max(sets, key=lambda s: (min(map(len, s)), -len(s)), default=None), i
