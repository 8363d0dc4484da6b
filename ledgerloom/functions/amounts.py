"""J3 clean_amounts: raw amount text -> (amount_decimal, currency, issues).

One native expression, no Python in the plan.  The steps form a chain of
structs, each step's value bound once to a lambda variable (``_Chain``): the
expression stays linear in size however often a step reads the previous
ones, so the optimizer can push filters through it without blowing it up.

Steps, in order:
  A1  blank / NULL -> all NULL, no issues
  A2  four special spaces -> space, tag ``normalized_space`` per kind
  A3  Unicode digits -> ASCII, tag ``unicode_digits_converted``
  A4  fullwidth / Arabic separators, tag ``normalized_decimal_separators``
  A5  sign: ``( ... )`` wrapper, then one leading minus / en dash / minus sign
  A6  currency code: trailing whole-word 3 letters, else 3 leading letters
  A7  currency symbol (longest first), removed everywhere
  A8  spaces removed; apostrophe grouping removed, tagged
  A9  both ``,`` and ``.``: the later one is the decimal separator
  A10 only ``,``: last group of <= 2 digits is decimals (``comma_as_decimal``)
  A11 minus signs of any kind become ``-``; keep digits, dot, minus; empty -> NULL
  A12 to decimal(38,18); several dots and no ``..`` -> keep the last dot,
      tagged.  More than 20 digits before the point: NULL amount, tagged
      ``amount_out_of_range`` (the currency stays); more than 18 after it:
      rounded HALF_UP, tagged ``amount_rounded``
  A13 apply the sign
  A14 currency: code, else symbol, else a currency word in the raw text

Symbols and words are tables (built in, or the caller's ``symbols`` and
``words``): one regular expression per table, made of all its entries, finds
the entries in a text, and one map look-up gives the place in the search order.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.common import WHITESPACE
from ledgerloom.sources.dims import CURRENCY_WORDS, SYMBOL_CURRENCY

# 20 digits before and 18 after the point (18 is the scale of the smallest
# common currency unit, the wei); what does not fit is tagged, never dropped.
AMOUNT_TYPE = T.DecimalType(38, 18)
AMOUNT_SQL_TYPE = "decimal(38,18)"

# FIXED VALUES — special spaces, in the order they are tested.
SPECIAL_SPACES = ["\u00a0", "\u2009", "\u202f", "\u200a"]  # no-break, thin, narrow no-break, hair
# FIXED VALUES — separator characters: fullwidth full stop and Arabic decimal
# separator become ".", Arabic thousands separator is removed.
DECIMAL_SEPARATORS_TO_DOT = "\uff0e\u066b"  # fullwidth full stop, Arabic decimal separator
THOUSANDS_SEPARATORS_DROPPED = "\u066c"  # Arabic thousands separator
SIGN_CHARS = ["-", "\u2013", "\u2212"]  # hyphen-minus, en dash, minus sign
APOSTROPHES = "'\u2019"  # apostrophe, right single quotation mark
# A plain number, and one with a digit other than 0 beyond the 18th decimal.
NUMBER = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"
TOO_FINE = r"^-?[0-9]*\.[0-9]{18}[0-9]*[1-9]"


@lru_cache(maxsize=1)
def unicode_digit_table() -> tuple[str, str]:
    """(chars, ascii digits) for every non-ASCII character with a Unicode
    digit value.  Built from the rule, not listed (about 800 characters)."""
    src, dst = [], []
    for cp in range(0x110000):
        ch = chr(cp)
        if "0" <= ch <= "9":
            continue
        d = unicodedata.digit(ch, None)
        if d is not None:
            src.append(ch)
            dst.append(str(d))
    return "".join(src), "".join(dst)


def sql_lit(s: str) -> str:
    """A Spark SQL string literal for ``s`` (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_REF = re.compile(r"(?<![\w\\])s\.([a-z_0-9]+)")


class _Chain:
    """The parse as ordered steps of SQL expressions over named values
    (written ``s.<name>``).  ``clean_amounts`` turns each step into one
    projection (whole-stage codegen, common subexpressions computed once)
    and ends the chain with a generator, ``inline(array(struct(...)))``:
    a filter on a parsed column cannot be pushed below a generator, so the
    optimizer never substitutes (and multiplies) the chain into it."""

    def __init__(self, first: dict[str, str]):
        self.steps: list[dict[str, str]] = [dict(first)]

    def step(self, **new: str) -> None:
        self.steps.append(dict(new))

    def finish(self, body: str) -> None:
        self.body = body

    def projections(self, prefix: str) -> tuple[list[list[str]], str]:
        sub = lambda e: _REF.sub(lambda m: prefix + m.group(1), e)
        steps = [[f"{sub(e)} AS {prefix}{k}" for k, e in st.items()] for st in self.steps]
        return steps, sub(self.body)


def _strip(x: str) -> str:
    return f"btrim({x}, {sql_lit(WHITESPACE)})"


def _instr(x: str, sub: str) -> str:
    return f"(instr({x}, {sql_lit(sub)}) > 0)"


def _last_index(x: str, ch: str) -> str:
    return f"(CASE WHEN instr({x}, {sql_lit(ch)}) > 0 THEN length({x}) - instr(reverse({x}), {sql_lit(ch)}) ELSE -1 END)"


def _case(pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + " END"


def _map(pairs: list[tuple[str, str]]) -> str:
    return "map(" + ", ".join(f"{sql_lit(a)}, {b}" for a, b in pairs) + ")"


def _least_rank(text: str, ranks: dict[str, int], word: bool = False) -> str:
    """Least rank of the entries that occur anywhere in ``text`` (as whole words
    if ``word``), NULL if none does.  The look-ahead tries every position, so
    entries may overlap; at one position the first alternative is the least."""
    if not ranks:
        return "CAST(NULL AS int)"
    entries = sorted(ranks, key=ranks.get)
    starts = "[" + "".join(sorted({re.escape(e[0]) if e[0].isascii() else e[0] for e in entries})) + "]"
    body = "|".join(map(re.escape, entries))
    pattern = rf"(?U)\b(?=({body})\b)" if word else f"(?={starts})(?=({body}))"
    ordered = _map([(e, str(ranks[e])) for e in entries])
    return f"array_min(transform(regexp_extract_all({text}, {sql_lit(pattern)}, 1), m -> element_at({ordered}, m)))"


def _ranks(entries: list[tuple[int, str]]) -> dict[str, int]:
    """Entry -> its first rank."""
    out: dict[str, int] = {}
    for rank, entry in entries:
        out.setdefault(entry, rank)
    return out


Table = dict[str, str] | list[tuple[str, str]]


def _pairs(table: Table | None, default: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(k, v) for k, v in dict(default if table is None else table).items() if k]


def parse_amount_chain(raw: str, symbols: Table | None = None, words: Table | None = None) -> _Chain:
    """The parse steps; the final body is
    struct<amount_decimal decimal(38,18), currency string, issues array<string>>."""
    codes = sorted(_pairs(symbols, SYMBOL_CURRENCY), key=lambda pair: -len(pair[0]))  # the search order: longest first
    named = _pairs(words, CURRENCY_WORDS)
    digits_src, digits_dst = unicode_digit_table()
    seps = DECIMAL_SEPARATORS_TO_DOT + THOUSANDS_SEPARATORS_DROPPED
    trail = sql_lit(r"(?U)\b([A-Za-z]{3})\b\s*$")
    ch = _Chain({"t1": _strip(raw)})
    # A1, A2
    ch.step(
        blank="(s.t1 IS NULL OR s.t1 = '')",
        sp="array(" + ", ".join(_instr("s.t1", sp) for sp in SPECIAL_SPACES) + ")",
        t2=f"translate(s.t1, {sql_lit(''.join(SPECIAL_SPACES))}, {sql_lit(' ' * len(SPECIAL_SPACES))})",
    )
    # A3
    ch.step(t3=f"translate(s.t2, {sql_lit(digits_src)}, {sql_lit(digits_dst)})")
    # A4
    ch.step(
        conv="(s.t3 != s.t2)",
        dec=f"(s.t3 RLIKE {sql_lit('[' + seps + ']')})",
        t4=f"translate(s.t3, {sql_lit(seps)}, {sql_lit('.' * len(DECIMAL_SEPARATORS_TO_DOT))})",
    )
    # A5: ( ... ) wrapper, then one leading minus sign
    ch.step(paren="(startswith(s.t4, '(') AND endswith(s.t4, ')'))")
    ch.step(t5a=f"CASE WHEN s.paren THEN {_strip('substring(s.t4, 2, greatest(length(s.t4) - 2, 0))')} ELSE s.t4 END")
    ch.step(lead="(substring(s.t5a, 1, 1) IN (" + ", ".join(sql_lit(c) for c in SIGN_CHARS) + "))")
    ch.step(neg="(s.paren OR s.lead)", t5=f"CASE WHEN s.lead THEN {_strip('substring(s.t5a, 2)')} ELSE s.t5a END")
    # A6: currency code, trailing whole word, else three leading letters
    ch.step(has_trail=f"(s.t5 RLIKE {trail})", lead_code=f"regexp_extract(s.t5, {sql_lit('^([A-Za-z]{3})')}, 1)")
    trail_removed = f"regexp_replace(s.t5, {trail}, '')"
    ch.step(
        code=f"CASE WHEN s.has_trail THEN upper(regexp_extract(s.t5, {trail}, 1)) "
        "WHEN s.lead_code != '' THEN upper(s.lead_code) END",
        t6=f"CASE WHEN s.has_trail THEN {_strip(trail_removed)} "
        f"WHEN s.lead_code != '' THEN {_strip('substring(s.t5, 4)')} ELSE s.t5 END",
    )
    # A7: currency symbol, longest first; ASCII symbols case-insensitive
    folded = [(i, sym.lower()) for i, (sym, _) in enumerate(codes) if any(c.isascii() for c in sym)]
    exact = [(i, sym) for i, (sym, _) in enumerate(codes) if not any(c.isascii() for c in sym)]
    ch.step(sym_at=f"least({_least_rank('lower(s.t6)', _ranks(folded))}, {_least_rank('s.t6', _ranks(exact))})")
    ch.step(sym=f"get(array({', '.join(sql_lit(sym) for sym, _ in codes)}), s.sym_at)" if codes else "CAST(NULL AS string)")
    ch.step(t7=f"CASE WHEN s.sym IS NOT NULL THEN {_strip('replace(s.t6, s.sym, ' + sql_lit('') + ')')} ELSE s.t6 END")
    # A8
    ch.step(n1="replace(s.t7, ' ', '')")
    ch.step(apos=f"(s.n1 RLIKE {sql_lit('[' + APOSTROPHES + ']')})", n2=f"translate(s.n1, {sql_lit(APOSTROPHES)}, '')")
    # A9, A10
    ch.step(has_c=_instr("s.n2", ","), has_d=_instr("s.n2", "."), parts="split(s.n2, ',')")
    ch.step(comma_dec="(s.has_c AND NOT s.has_d AND length(element_at(s.parts, -1)) <= 2)")
    ch.step(
        n3="CASE WHEN s.has_c AND s.has_d THEN "
        f"(CASE WHEN {_last_index('s.n2', ',')} > {_last_index('s.n2', '.')} "
        "THEN replace(replace(s.n2, '.', ''), ',', '.') ELSE replace(s.n2, ',', '') END) "
        "WHEN s.comma_dec THEN concat(array_join(slice(s.parts, 1, size(s.parts) - 1), ''), '.', element_at(s.parts, -1)) "
        "WHEN s.has_c THEN replace(s.n2, ',', '') ELSE s.n2 END"
    )
    # A11, A12
    minus = f"translate(s.n3, {sql_lit(''.join(SIGN_CHARS))}, {sql_lit('-' * len(SIGN_CHARS))})"
    ch.step(n4=f"regexp_replace({minus}, {sql_lit(r'[^0-9.\-]')}, '')")
    ch.step(v1=f"try_cast(s.n4 AS {AMOUNT_SQL_TYPE})", ld=_last_index("s.n4", "."))
    ch.step(
        fix="CASE WHEN s.v1 IS NULL AND length(s.n4) - length(replace(s.n4, '.', '')) > 1 AND instr(s.n4, '..') = 0 "
        "THEN concat(replace(substring(s.n4, 1, s.ld), '.', ''), substring(s.n4, s.ld + 1)) END"
    )
    ch.step(v2=f"try_cast(s.fix AS {AMOUNT_SQL_TYPE})", num="coalesce(s.fix, s.n4)")
    ch.step(
        big=f"(s.v1 IS NULL AND s.v2 IS NULL AND s.num RLIKE {sql_lit(NUMBER)})",
        fine=f"(s.num RLIKE {sql_lit(TOO_FINE)})",
    )
    # A13, A14
    tag_pairs = [(f"s.sp[{i}]", "normalized_space") for i in range(len(SPECIAL_SPACES))] + [
        ("s.conv", "unicode_digits_converted"),
        ("s.dec", "normalized_decimal_separators"),
        ("s.apos", "removed_apostrophe_grouping"),
        ("s.comma_dec", "comma_as_decimal"),
        ("(s.fix IS NOT NULL)", "repaired_multiple_dots"),
        ("s.big", "amount_out_of_range"),
        ("(s.fine AND NOT s.big)", "amount_rounded"),
    ]
    issues = "filter(array(" + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in tag_pairs) + "), x -> x IS NOT NULL)"
    sym_code = f"element_at({_map([(sym, sql_lit(cur)) for sym, cur in codes])}, s.sym)" if codes else "CAST(NULL AS string)"
    word_at = _least_rank(f"lower({raw})", _ranks([(i, w.lower()) for i, (w, _) in enumerate(named)]), word=True)
    word_code = f"get(array({', '.join(sql_lit(cur) for _, cur in named)}), {word_at})" if named else "CAST(NULL AS string)"
    ok = "(NOT s.blank AND s.n4 != '' AND (s.v1 IS NOT NULL OR s.v2 IS NOT NULL OR s.big))"
    body = (
        "named_struct("
        f"'amount_decimal', CAST(CASE WHEN {ok} THEN (CASE WHEN s.neg THEN -coalesce(s.v1, s.v2) ELSE coalesce(s.v1, s.v2) END) END AS {AMOUNT_SQL_TYPE}), "
        f"'currency', CASE WHEN {ok} THEN coalesce(s.code, {sym_code}, {word_code}) END, "
        f"'issues', CASE WHEN {ok} THEN {issues} ELSE CAST(array() AS array<string>) END)"
    )
    ch.finish(body)
    return ch


OUTPUTS = ["amount_decimal", "currency", "issues"]


def clean_amounts(
    df: DataFrame, amount_col: str = "amount", *, symbols: Table | None = None, words: Table | None = None, prefix: str = "_amt_"
) -> DataFrame:
    """Add ``amount_decimal decimal(38,18)``, ``currency string`` and
    ``issues array<string>`` computed from ``amount_col`` (existing columns
    of those names are replaced).

    ``symbols`` (symbol -> code) and ``words`` (word -> code) replace the
    built-in tables.  The longest symbol in a text wins, then the first in the
    table; symbols with an ASCII character are found in any case (but removed
    only as spelled in the table).  The first word in the table wins.  An empty
    table finds nothing; blank entries are ignored."""
    keep = [c for c in df.columns if c not in OUTPUTS]
    steps, body = parse_amount_chain(f"`{amount_col}`", symbols, words).projections(prefix)
    for exprs in steps:
        df = df.selectExpr("*", *exprs)
    df = df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(F.expr(body))))
    return df
