"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Each oracle re-derives its result from the driver tables with plain SQL: the
same ``tx`` derivation, and every cleaning rule re-written with DuckDB
functions (RE2 regexes, ``try_strptime``, list lambdas).  The fuzzy scores
are computed by brute force over every (string, choice) pair with a
bit-parallel LCS in SQL, so they check the staged Spark plan (exact join,
token-subset join, Arrow scorer) rather than repeat it.

Limits of the oracle dialect, all outside the driver data: RE2 ``\\b``, ``\\w``
and ``\\s`` are ASCII-only; no NFKC (the literal alias table is normalised when
the SQL is generated; ``tx`` merchants are ASCII); the SQL LCS handles strings
of up to 126 characters.
"""

from __future__ import annotations

import re
import unicodedata

from ledgerloom.functions.amounts import (
    APOSTROPHES,
    DECIMAL_SEPARATORS_TO_DOT,
    SIGN_CHARS,
    SPECIAL_SPACES,
    THOUSANDS_SEPARATORS_DROPPED,
    unicode_digit_table,
)
from ledgerloom.functions.common import WHITESPACE
from ledgerloom.functions.dates import DEFAULT_PIVOT, TIME_OF_DAY, WEEKDAY
from ledgerloom.operators.categorize import _dedup_map
from ledgerloom.operators.merchants import DEFAULT_THRESHOLD, SUBSTRING_SCORE
from ledgerloom.plans.queries import CALLER_SYMBOLS, CALLER_WORDS, CARRIED, CUSTOM_RATES, DEFAULT_CURRENCY, LARGE_RATES, SAMPLE_ROWS, SHARED_ALIASES, TABLE_CODES, TWO_DIGIT, UNFIT_RATES
from ledgerloom.sources import dims
from ledgerloom.sources.driver_tables import TX_MERCHANTS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {lit(WHITESPACE)})"


def _years(lo: int, hi: int) -> str:
    return "|".join(f"{y:02d}" for y in range(lo, hi + 1))


# ------------------------------------------------------------------ the tx view
def tx_cte() -> str:
    merchants = "[" + ", ".join(lit(m) for m in TX_MERCHANTS) + "]"
    return f"""tx AS (
  SELECT o_orderkey AS tx_id, o_custkey AS account_id,
    CASE o_orderkey % 8
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o_orderdate, '%m/%d/%y')
      WHEN 2 THEN strftime(o_orderdate, '%b %-d, %Y')
      WHEN 3 THEN strftime(o_orderdate, '%Y.%m.%d')
      WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T23:30:00-05:00'
      WHEN 5 THEN strftime(o_orderdate, '%-d %b %Y')
      WHEN 6 THEN strftime(o_orderdate, '%Y/%m/%d')
      ELSE 'not a date' END AS date,
    CASE o_orderkey % 10
      WHEN 0 THEN '$' || t
      WHEN 1 THEN '(' || t || ')'
      WHEN 2 THEN t || ' USD'
      WHEN 3 THEN 'EUR' || t
      WHEN 4 THEN '€' || replace(t, '.', ',')
      WHEN 5 THEN '-£' || t
      WHEN 6 THEN t || ' JPY'
      WHEN 7 THEN '12..00'
      WHEN 8 THEN ''
      ELSE 'ZZZ ' || t END AS amount,
    CASE WHEN o_orderkey % 3 = 0 AND m0 <> '' THEN m0 || ' #' || CAST(o_custkey % 50 AS VARCHAR) ELSE m0 END AS merchant
  FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS t,
               {merchants}[o_custkey % 12 + 1] AS m0 FROM orders) o)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------------ dates
def dates_ctes(src: str = "tx") -> list[str]:
    lo, hi = _years(0, DEFAULT_PIVOT), _years(DEFAULT_PIVOT + 1, 99)
    head = r"\b(\d{1,2})[/-](\d{1,2})[/-]"
    iso = r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"
    ymd = r"^\d{4}[./-]\d{1,2}[./-]\d{1,2}$"
    mdy = r"^\d{1,2}[./-]\d{1,2}[./-]\d{4}$"
    return [
        f"d1 AS (SELECT *, nullif({strip('date')}, '') AS s1 FROM {src})",
        rf"d2a AS (SELECT *, regexp_replace(s1, '(?i)(\d)(st|nd|rd|th)', '\1', 'g') AS s2a FROM d1)",
        f"d2 AS (SELECT *, regexp_replace(regexp_replace(s2a, {lit(WEEKDAY)}, ''), {lit(TIME_OF_DAY)}, '') AS s2 FROM d2a)",
        f"d3 AS (SELECT *, regexp_replace(regexp_replace(s2, {lit(head + '(' + lo + r')\b')}, '\\1/\\2/20\\3', 'g'), "
        f"{lit(head + '(' + hi + r')\b')}, '\\1/\\2/19\\3', 'g') AS s3 FROM d2)",
        f"d4 AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(s3, {lit('[,.’‘' + chr(39) + '/-]')}, ' ', 'g'), "
        r"'(?i)\bsept\b', 'Sep', 'g'), '\s+', ' ', 'g')) AS w0 FROM d3)",
        f"d5 AS (SELECT *, CASE WHEN regexp_matches(w0, '^[0-9]{{4}} ') THEN w0 ELSE regexp_replace(regexp_replace(w0, "
        f"{lit(r'(\s)(' + lo + ')$')}, '\\120\\2'), {lit(r'(\s)(' + hi + ')$')}, '\\119\\2') END AS words FROM d4)",
        f"""dated AS (SELECT *, CAST(coalesce(
      CASE WHEN regexp_matches(s3, {lit(iso)}) THEN try_strptime(regexp_extract(s3, {lit(iso)}, 1), '%Y-%m-%d') END,
      CASE WHEN regexp_matches(s3, '^[0-9]{{8}}$') THEN try_strptime(s3, '%Y%m%d') END,
      CASE WHEN regexp_matches(s3, {lit(ymd)}) THEN try_strptime(translate(s3, '/.', '--'), '%Y-%m-%d') END,
      CASE WHEN regexp_matches(s3, {lit(mdy)}) THEN coalesce(try_strptime(translate(s3, '.-', '//'), '%m/%d/%Y'),
                                                          try_strptime(translate(s3, '.-', '//'), '%d/%m/%Y')) END,
      CASE WHEN regexp_matches(s3, '[A-Za-z]') THEN try_strptime(words, ['%b %d %Y', '%B %d %Y', '%d %b %Y', '%d %B %Y', '%Y %b %d', '%Y %B %d']) END
    ) AS DATE) AS date_iso FROM d5)""",
    ]


# ---------------------------------------------------------------------- amounts
def _last_index(x: str, ch: str) -> str:
    return f"(CASE WHEN instr({x}, {lit(ch)}) > 0 THEN length({x}) - instr(reverse({x}), {lit(ch)}) ELSE -1 END)"


def amounts_ctes(src: str = "tx", symbols: list | None = None, words: list | None = None) -> list[str]:
    symbols = dims.SYMBOL_CURRENCY if symbols is None else symbols
    dsrc, ddst = unicode_digit_table()
    seps = DECIMAL_SEPARATORS_TO_DOT + THOUSANDS_SEPARATORS_DROPPED
    trail = lit(r"\b([A-Za-z]{3})\b\s*$")
    sp_flags = ", ".join(f"instr(t1, {lit(c)}) > 0" for c in SPECIAL_SPACES)
    sym_case = "CASE " + " ".join(
        f"WHEN instr({'lower(t6)' if any(c.isascii() for c in s) else 't6'}, {lit(s.lower() if any(c.isascii() for c in s) else s)}) > 0 THEN {lit(s)}"
        for s in sorted([s for s, _ in symbols], key=len, reverse=True)
    ) + " END"
    sym_map = "CASE sym " + " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in symbols) + " END"
    words = "CASE " + " ".join(
        f"WHEN regexp_matches(lower(amount), {lit(r'\b' + re.escape(w) + r'\b')}) THEN {lit(c)}" for w, c in (dims.CURRENCY_WORDS if words is None else words)
    ) + " END"
    tags = [(f"sp[{i + 1}]", "normalized_space") for i in range(len(SPECIAL_SPACES))] + [
        ("conv", "unicode_digits_converted"),
        ("dec", "normalized_decimal_separators"),
        ("apos", "removed_apostrophe_grouping"),
        ("comma_dec", "comma_as_decimal"),
        ("fix IS NOT NULL", "repaired_multiple_dots"),
        ("big", "amount_out_of_range"),
        ("fine AND NOT big", "amount_rounded"),
    ]
    issues = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {lit(t)} END" for c, t in tags) + "], lambda x: x IS NOT NULL)"
    ok = "(NOT blank AND n4 <> '' AND (v1 IS NOT NULL OR v2 IS NOT NULL OR big))"
    trail_removed = f"regexp_replace(t5, {trail}, '')"
    return [
        f"a1 AS (SELECT *, {strip('amount')} AS t1 FROM {src})",
        f"a2 AS (SELECT *, (t1 IS NULL OR t1 = '') AS blank, [{sp_flags}] AS sp, "
        f"translate(t1, {lit(''.join(SPECIAL_SPACES))}, {lit(' ' * len(SPECIAL_SPACES))}) AS t2 FROM a1)",
        f"a3 AS (SELECT *, translate(t2, {lit(dsrc)}, {lit(ddst)}) AS t3 FROM a2)",
        f"a4 AS (SELECT *, t3 <> t2 AS conv, regexp_matches(t3, {lit('[' + seps + ']')}) AS dec, "
        f"translate(t3, {lit(seps)}, {lit('.' * len(DECIMAL_SEPARATORS_TO_DOT))}) AS t4 FROM a3)",
        "a5 AS (SELECT *, (starts_with(t4, '(') AND ends_with(t4, ')')) AS paren FROM a4)",
        f"a6 AS (SELECT *, CASE WHEN paren THEN {strip('substring(t4, 2, greatest(length(t4) - 2, 0))')} ELSE t4 END AS t5a FROM a5)",
        f"a7 AS (SELECT *, substring(t5a, 1, 1) IN ({', '.join(lit(c) for c in SIGN_CHARS)}) AS lead FROM a6)",
        f"a8 AS (SELECT *, (paren OR lead) AS neg, CASE WHEN lead THEN {strip('substring(t5a, 2)')} ELSE t5a END AS t5 FROM a7)",
        f"a9 AS (SELECT *, regexp_matches(t5, {trail}) AS has_trail, regexp_extract(t5, '^([A-Za-z]{{3}})', 1) AS lead_code FROM a8)",
        f"a10 AS (SELECT *, CASE WHEN has_trail THEN upper(regexp_extract(t5, {trail}, 1)) WHEN lead_code <> '' THEN upper(lead_code) END AS code, "
        f"CASE WHEN has_trail THEN {strip(trail_removed)} "
        f"WHEN lead_code <> '' THEN {strip('substring(t5, 4)')} ELSE t5 END AS t6 FROM a9)",
        f"a11 AS (SELECT *, {sym_case} AS sym FROM a10)",
        f"a12 AS (SELECT *, CASE WHEN sym IS NOT NULL THEN {strip('replace(t6, sym, ' + lit('') + ')')} ELSE t6 END AS t7 FROM a11)",
        "a13 AS (SELECT *, replace(t7, ' ', '') AS n1 FROM a12)",
        f"a14 AS (SELECT *, regexp_matches(n1, {lit('[' + APOSTROPHES + ']')}) AS apos, translate(n1, {lit(APOSTROPHES)}, '') AS n2 FROM a13)",
        "a15 AS (SELECT *, instr(n2, ',') > 0 AS has_c, instr(n2, '.') > 0 AS has_d, string_split(n2, ',') AS parts FROM a14)",
        "a16 AS (SELECT *, (has_c AND NOT has_d AND length(parts[-1]) <= 2) AS comma_dec FROM a15)",
        f"""a17 AS (SELECT *, CASE
      WHEN has_c AND has_d THEN (CASE WHEN {_last_index('n2', ',')} > {_last_index('n2', '.')}
                                      THEN replace(replace(n2, '.', ''), ',', '.') ELSE replace(n2, ',', '') END)
      WHEN comma_dec THEN array_to_string(parts[1:len(parts) - 1], '') || '.' || parts[-1]
      WHEN has_c THEN replace(n2, ',', '')
      ELSE n2 END AS n3 FROM a16)""",
        r"a18 AS (SELECT *, regexp_replace(replace(replace(n3, '–', '-'), '−', '-'), '[^0-9.\-]', '', 'g') AS n4 FROM a17)",
        f"a19 AS (SELECT *, TRY_CAST(n4 AS DECIMAL(38,18)) AS v1, {_last_index('n4', '.')} AS ld FROM a18)",
        """a19b AS (SELECT *, CASE WHEN v1 IS NULL AND length(n4) - length(replace(n4, '.', '')) > 1 AND instr(n4, '..') = 0
      THEN replace(substring(n4, 1, ld), '.', '') || substring(n4, ld + 1) END AS fix FROM a19)""",
        r"""a20 AS (SELECT *, TRY_CAST(fix AS DECIMAL(38,18)) AS v2,
      v1 IS NULL AND TRY_CAST(fix AS DECIMAL(38,18)) IS NULL AND regexp_matches(coalesce(fix, n4), '^-?([0-9]+\.?[0-9]*|\.[0-9]+)$') AS big,
      regexp_matches(coalesce(fix, n4), '^-?[0-9]*\.[0-9]{18}[0-9]*[1-9]') AS fine FROM a19b)""",
        f"""amt AS (SELECT *,
      CASE WHEN {ok} THEN CAST(CASE WHEN neg THEN -coalesce(v1, v2) ELSE coalesce(v1, v2) END AS DECIMAL(38,18)) END AS amount_decimal,
      CASE WHEN {ok} THEN coalesce(code, {sym_map}, {words}) END AS currency,
      CASE WHEN {ok} THEN {issues} ELSE []::VARCHAR[] END AS issues
    FROM a20)""",
    ]


# --------------------------------------------------------------------------- FX
def rates_values(rates: dict | None = None) -> str:
    table = {c: r for c, r in dims.DEFAULT_RATES}
    if rates:
        from decimal import Decimal, InvalidOperation

        for k, v in rates.items():
            try:
                Decimal(str(v))
            except InvalidOperation:
                continue
            table[k.upper()] = str(v)
    rows = ", ".join(f"({lit(c)}, CAST({lit(r)} AS DECIMAL(17,10)))" for c, r in table.items())
    return f"(VALUES {rows})"


def usd_sql(amount: str, rate: str) -> str:
    """Whole and fractional part times the rate: each product fits a decimal."""
    whole = f"CAST(trunc({amount}) AS DECIMAL(20,0))"
    part = f"CAST({amount} - trunc({amount}) AS DECIMAL(18,18))"
    return f"TRY_CAST({whole} * {rate} AS DECIMAL(38,16)) + CAST({part} * {rate} AS DECIMAL(38,16))"


def fx_ctes(src: str = "amt", rates: dict | None = None, name: str = "fx") -> list[str]:
    code_map = "CASE upper(currency) " + " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in dims.CODE_ALIASES) + " END"
    return [
        f"rates_{name}(currency, rate) AS {rates_values(rates)}",
        f"""{name} AS (SELECT a.*, CASE
        WHEN a.amount_decimal IS NULL THEN NULL
        WHEN a.currency IS NULL OR a.currency = '' THEN CAST(a.amount_decimal AS DECIMAL(38,16))
        ELSE CAST({usd_sql('a.amount_decimal', 'r.rate')} AS DECIMAL(38,16)) END AS amount_usd
      FROM {src} a LEFT JOIN rates_{name} r ON r.currency = coalesce({code_map.replace('currency', 'a.currency')}, upper(a.currency)))""",
    ]


# -------------------------------------------------------------------- merchants
PUNCT_RE2 = r"[\x{2000}-\x{206F}\x{2E00}-\x{2E7F}'" + '"' + r"·•*/\\(),@!?:;_\[\]#$%^&=+<>`~]+"


def clean_sql(x: str) -> str:
    """M2-M8 in DuckDB; M7 (spaced single letters) on whitespace tokens."""
    s = f"lower(coalesce({x}, ''))"
    s = f"regexp_replace({s}, {lit(PUNCT_RE2)}, ' ', 'g')"
    s = f"regexp_replace({s}, {lit(r'\b(store|store\s*#|atm|pos|terminal)\b')}, ' ', 'g')"
    s = f"regexp_replace({s}, {lit(r'\b\d{4,}\b')}, ' ', 'g')"
    toks = f"string_split({strip(f'regexp_replace({s}, {lit(chr(92) + "s+")}, {lit(" ")}, {lit("g")})')}, ' ')"
    glue = (
        f"list_transform(range(1, len(tk) + 1), lambda i: tk[i] || CASE WHEN i < len(tk) "
        f"AND regexp_matches(tk[i], {lit(r'(^|\W)[a-zA-Z]$')}) AND regexp_matches(tk[i + 1], {lit(r'^[a-zA-Z](\W|$)')}) "
        f"THEN '' ELSE ' ' END)"
    )
    return f"rtrim(list_reduce([{toks}], lambda acc, tk: array_to_string({glue}, ''), ''))"


def aggressive_sql(x: str) -> str:
    s = f"regexp_replace({x}, {lit(r'\b(supercenter|super ctr|super ctr\.|super ctr|store|store\b|branch|branch\b|center|ctr|centre)\b')}, ' ', 'g')"
    s = f"regexp_replace({s}, {lit(r'\b\d{2,}\b')}, ' ', 'g')"
    return strip(f"regexp_replace({s}, '\\s+', ' ', 'g')")


def alias_values(aliases: dict | None = None) -> str:
    rows = ", ".join(
        f"({idx}, {lit(canon)}, {lit(unicodedata.normalize('NFKC', alias))})" for idx, canon, alias in dims.alias_rows(aliases)
    )
    return f"(VALUES {rows})"


def choices_ctes(aliases: dict | None = None) -> list[str]:
    return [
        f"alias_raw(choice_idx, canonical, alias) AS {alias_values(aliases)}",
        f"written AS (SELECT choice_idx, canonical, alias_clean FROM (SELECT *, {clean_sql('alias')} AS alias_clean FROM alias_raw) WHERE alias_clean <> '')",
        "exact_map AS (SELECT alias_clean, arg_max(canonical, choice_idx) AS canonical FROM written GROUP BY alias_clean)",
        # a matched text means the canonical that wrote it last
        "choices AS (SELECT w.choice_idx, e.canonical, w.alias_clean FROM written w JOIN exact_map e USING (alias_clean))",
    ]


def merchant_keys_ctes(src: str = "tx") -> list[str]:
    return [
        f"mraw AS (SELECT DISTINCT merchant FROM {src})",
        f"mclean AS (SELECT merchant, {clean_sql('merchant')} AS merchant_cleaned FROM mraw)",
        f"mkeys AS (SELECT DISTINCT merchant_cleaned AS key FROM mclean WHERE merchant IS NOT NULL AND {strip('merchant')} <> '')",
        "mrest AS (SELECT key FROM mkeys WHERE key NOT IN (SELECT alias_clean FROM exact_map))",
    ]


def lcs_sql(a: str, b: str) -> str:
    full = f"((1::HUGEINT << length({a})) - 1)"
    mask = f"list_sum(list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN substring({a}, i, 1) = c THEN (1::HUGEINT << (i - 1)) ELSE 0::HUGEINT END))"
    step = f"lambda v, c: ((v + (v & {mask})) | (v - (v & {mask}))) & {full}"
    return f"(length({a}) - bit_count(list_reduce(string_split({b}, ''), {step}, {full})))"


def ratio_sql(a: str, b: str) -> str:
    lensum = f"(length({a}) + length({b}))"
    return f"(CASE WHEN {lensum} = 0 THEN 100.0::DOUBLE ELSE (1.0::DOUBLE - ({lensum} - 2 * {lcs_sql(a, b)})::DOUBLE / {lensum}) * 100 END)"


def _norm_dist(d: str, lensum: str) -> str:
    return f"(CASE WHEN ({lensum}) > 0 THEN 100.0::DOUBLE - 100.0::DOUBLE * ({d}) / ({lensum}) ELSE 100.0::DOUBLE END)"


def _toks(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def fuzzy_ctes(keys: str, out: str) -> list[str]:
    """``out(key, best_idx, best_choice, canonical, score)``: best choice by
    token-set ratio (first in list order on ties) and the rounded best of
    token-set / partial / token-sort for it; brute force over all pairs."""
    p = out + "_"
    x, y = "x", "y"
    sx = f"(s_len + (s_len > 0)::INT + length({x}))"
    sy = f"(s_len + (s_len > 0)::INT + length({y}))"
    indel_xy = f"(length({x}) + length({y}) - 2 * {lcs_sql(x, y)})"
    ts = f"""CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0::DOUBLE
        WHEN len(inter) > 0 AND (len(dab) = 0 OR len(dba) = 0) THEN 100.0::DOUBLE
        ELSE greatest({_norm_dist(indel_xy, sx + ' + ' + sy)},
                      CASE WHEN s_len > 0 THEN {_norm_dist('1 + length(x)', 's_len + ' + sx)} END,
                      CASE WHEN s_len > 0 THEN {_norm_dist('1 + length(y)', 's_len + ' + sy)} END) END"""
    win = lambda sh, lo: (
        f"list_concat(list_transform(range(1, length({sh})), lambda i: substring({lo}, 1, i)), "
        f"list_transform(range(1, length({lo}) - length({sh}) + 2), lambda i: substring({lo}, i, length({sh}))), "
        f"list_transform(range(length({lo}) - length({sh}) + 2, length({lo}) + 1), lambda i: substring({lo}, i)))"
    )
    return [
        f"""{p}pairs AS (SELECT k.key, c.choice_idx, c.alias_clean AS choice, c.canonical,
          list_distinct({_toks('k.key')}) AS ta, list_distinct({_toks('c.alias_clean')}) AS tb
        FROM {keys} k CROSS JOIN choices c)""",
        f"""{p}sets AS (SELECT *, list_intersect(ta, tb) AS inter,
          list_filter(ta, lambda t: NOT list_contains(tb, t)) AS dab,
          list_filter(tb, lambda t: NOT list_contains(ta, t)) AS dba FROM {p}pairs)""",
        f"""{p}joined AS (SELECT *, array_to_string(list_sort(dab), ' ') AS x, array_to_string(list_sort(dba), ' ') AS y,
          length(array_to_string(list_sort(inter), ' ')) AS s_len FROM {p}sets)""",
        f"{p}ts AS (SELECT key, choice_idx, choice, canonical, {ts} AS ts FROM {p}joined)",
        f"""{p}best AS (SELECT key, choice_idx, choice, canonical, ts FROM (
          SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, choice_idx ASC) AS rn FROM {p}ts) WHERE rn = 1)""",
        f"""{p}pw AS (SELECT key, choice,
          CASE WHEN length(key) <= length(choice) THEN key ELSE choice END AS sh,
          CASE WHEN length(key) <= length(choice) THEN choice ELSE key END AS lo FROM {p}best)""",
        f"""{p}win AS (SELECT key, choice, sh, unnest({win('sh', 'lo')}) AS w FROM {p}pw
          UNION ALL SELECT key, choice, lo AS sh, unnest({win('lo', 'sh')}) AS w FROM {p}pw WHERE length(sh) = length(lo))""",
        f"{p}partial AS (SELECT key, max({ratio_sql('sh', 'w')}) AS pr FROM {p}win GROUP BY key)",
        f"""{p}sorted AS (SELECT key, choice_idx, choice, canonical, ts,
          array_to_string(list_sort({_toks('key')}), ' ') AS ks, array_to_string(list_sort({_toks('choice')}), ' ') AS cs FROM {p}best)""",
        f"""{out} AS (SELECT s.key, s.choice_idx AS best_idx, s.choice AS best_choice, s.canonical,
          CAST(round_even(greatest(s.ts, coalesce(pa.pr, 0.0), {ratio_sql('s.ks', 's.cs')}), 0) AS INTEGER) AS score
        FROM {p}sorted s LEFT JOIN {p}partial pa ON pa.key = s.key)""",
    ]


def resolve_ctes() -> list[str]:
    """Full resolution of ``mkeys``: exact, scored, aggressive retry."""
    thr = DEFAULT_THRESHOLD
    return [
        *fuzzy_ctes("mrest", "fz1"),
        f"retry AS (SELECT DISTINCT {aggressive_sql('key')} AS key FROM fz1 WHERE score < {thr})",
        f"retry_keys AS (SELECT key FROM retry WHERE key <> '')",
        *fuzzy_ctes("retry_keys", "fz2"),
        f"""scored AS (SELECT f.key, f.canonical AS can1, f.score AS score1, {aggressive_sql('f.key')} AS aggr FROM fz1 f)""",
        f"""scored2 AS (SELECT s.*, CASE WHEN s.aggr <> '' AND s.aggr <> s.key THEN z.score END AS score2,
                              CASE WHEN s.aggr <> '' AND s.aggr <> s.key THEN z.canonical END AS can2
          FROM scored s LEFT JOIN fz2 z ON z.key = s.aggr)""",
        f"""resolved AS (
          SELECT key, canonical AS merchant_canonical, 100 AS merchant_score, '' AS issue, 'exact' AS match_stage
          FROM mkeys JOIN exact_map ON exact_map.alias_clean = mkeys.key
          UNION ALL
          SELECT key,
            CASE WHEN score1 >= {thr} THEN can1 WHEN score2 >= {thr} THEN can2 END,
            CASE WHEN score1 >= {thr} THEN score1 WHEN score2 >= {thr} THEN score2 ELSE greatest(score1, coalesce(score2, score1)) END,
            CASE WHEN score1 >= {thr} THEN 'fuzzy_matched' WHEN score2 >= {thr} THEN 'aggressive_fuzzy_matched' ELSE 'low_confidence' END,
            CASE WHEN score1 >= {thr} THEN 'fuzzy' WHEN score2 >= {thr} THEN 'aggressive' ELSE 'unresolved' END
          FROM scored2)""",
        f"""merchant_resolved AS (
          SELECT m.merchant, m.merchant_cleaned, r.merchant_canonical, r.merchant_score, r.issue, r.match_stage
          FROM mclean m JOIN resolved r ON r.key = m.merchant_cleaned
          WHERE m.merchant IS NOT NULL AND {strip('m.merchant')} <> ''
          UNION ALL
          SELECT merchant, merchant_cleaned, NULL, 0, 'empty_merchant', 'empty'
          FROM mclean WHERE merchant IS NULL OR {strip('merchant')} = '')""",
    ]


# ------------------------------------------------------------------- categories
def rules_case(raw: str) -> str:
    low = f"lower({raw})"
    parts = [f"WHEN regexp_matches({low}, {lit(r'\b(' + body + r')\b')}) THEN {lit(cat)}" for body, cat in dims.CATEGORY_RULES]
    parts += [f"WHEN instr({low}, {lit(k.lower())}) > 0 THEN {lit(c)}" for k, c in _dedup_map(dims.CATEGORY_MAP)]
    return f"CASE WHEN {raw} IS NOT NULL AND {raw} <> '' THEN (CASE {' '.join(parts)} END) END"


def category_map_values() -> str:
    rows = ", ".join(f"({lit(k)}, {lit(c)})" for k, c in _dedup_map(dims.CATEGORY_MAP))
    return f"(VALUES {rows})"


# ---------------------------------------------------------------------- queries
MONEY = "DECIMAL(38,2)"


def _q(ctes: list[str], body: str) -> str:
    return with_ctes(tx_cte(), *ctes) + body


def _report_ctes(resolve: bool, digits: int = 2) -> list[str]:
    """Per-merchant USD totals with their category, as the report uses."""
    ctes = amounts_ctes() + fx_ctes()
    ctes.append("pm AS (SELECT merchant, sum(amount_usd) AS amount_usd, count(*) AS n_tx FROM fx GROUP BY merchant)")
    if resolve:
        ctes += choices_ctes() + merchant_keys_ctes("pm") + resolve_ctes()
        ctes.append(f"catmap(merchant_canonical, map_category) AS {category_map_values()}")
        ctes.append(
            "pmc AS (SELECT pm.*, r.merchant_canonical FROM pm LEFT JOIN merchant_resolved r ON r.merchant IS NOT DISTINCT FROM pm.merchant)"
        )
        ctes.append(
            f"pmcat AS (SELECT pmc.*, coalesce(c.map_category, {rules_case('pmc.merchant')}) AS category "
            "FROM pmc LEFT JOIN catmap c ON c.merchant_canonical = pmc.merchant_canonical)"
        )
    else:
        ctes.append(f"pmcat AS (SELECT pm.*, {rules_case('merchant')} AS category FROM pm)")
    ctes.append(
        "bycat AS (SELECT category, coalesce(sum(amount_usd), 0) AS amount_raw, CAST(sum(n_tx) AS BIGINT) AS n_tx, "
        f"round(coalesce(sum(amount_usd), 0), {digits}) AS amount FROM pmcat GROUP BY category)"
    )
    return ctes


def oracle_sql() -> dict[str, str]:
    two_digit = lit(TWO_DIGIT)
    q: dict[str, str] = {}
    q["dates_clean"] = _q(dates_ctes(), "SELECT tx_id, date, strftime(date_iso, '%Y-%m-%d') AS date_iso FROM dated")
    q["dates_quality"] = _q(
        dates_ctes(),
        "SELECT regexp_replace(regexp_replace(date, '[0-9]', '9', 'g'), '[A-Za-z]', 'a', 'g') AS shape, count(*) AS n_rows, "
        "count(date_iso) AS n_parsed, CAST(sum(CASE WHEN date_iso IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unparsed, "
        "strftime(min(date_iso), '%Y-%m-%d') AS min_date, strftime(max(date_iso), '%Y-%m-%d') AS max_date FROM dated GROUP BY 1",
    )
    q["dates_two_digit_pivot"] = _q(
        dates_ctes(),
        f"SELECT tx_id, date, s3 AS expanded, strftime(date_iso, '%Y-%m-%d') AS date_iso FROM dated WHERE regexp_matches(date, {two_digit})",
    )
    q["amounts_clean"] = _q(
        amounts_ctes(),
        "SELECT tx_id, amount, amount_decimal, currency, array_to_string(issues, ',') AS issues FROM amt",
    )
    q["amount_issue_counts"] = _q(
        amounts_ctes(), "SELECT issue, count(*) AS n_rows FROM (SELECT unnest(issues) AS issue FROM amt) GROUP BY issue"
    )
    q["amount_parse_status"] = _q(
        amounts_ctes(),
        "SELECT CASE WHEN amount IS NULL OR trim(amount) = '' THEN 'blank' WHEN amount_decimal IS NULL THEN 'unparseable' "
        "WHEN currency IS NULL THEN 'no_currency' ELSE 'parsed' END AS status, count(*) AS n_rows, "
        f"CAST(sum(amount_decimal) AS {MONEY}) AS amount_sum FROM amt GROUP BY 1",
    )
    q["amounts_default_currency"] = _q(
        amounts_ctes(), f"SELECT tx_id, amount_decimal, coalesce(currency, {lit(DEFAULT_CURRENCY)}) AS currency FROM amt"
    )
    q["fx_convert"] = _q(amounts_ctes() + fx_ctes(), "SELECT tx_id, amount_decimal, currency, amount_usd FROM fx")
    q["fx_custom_rates"] = _q(
        amounts_ctes() + fx_ctes(rates=CUSTOM_RATES),
        "SELECT coalesce(currency, '(none)') AS currency, count(*) AS n_rows, count(amount_usd) AS n_converted, "
        f"CAST(round(sum(amount_usd), 2) AS {MONEY}) AS amount_usd FROM fx WHERE amount_decimal IS NOT NULL GROUP BY 1",
    )
    q["fx_missing_currency_policy"] = _q(
        amounts_ctes(),
        "SELECT tx_id, amount_decimal, CAST(amount_decimal AS DECIMAL(38,16)) AS usd_assume_missing, "
        "CAST(NULL AS DECIMAL(38,16)) AS usd_strict FROM amt WHERE amount_decimal IS NOT NULL AND currency IS NULL",
    )
    q["fx_unconvertible"] = _q(
        amounts_ctes() + fx_ctes(),
        f"SELECT currency, count(*) AS n_rows, CAST(sum(amount_decimal) AS {MONEY}) AS amount_sum FROM fx "
        "WHERE amount_decimal IS NOT NULL AND currency IS NOT NULL AND amount_usd IS NULL GROUP BY currency",
    )
    q["merchants_clean"] = _q(
        merchant_keys_ctes()[:2],
        f"SELECT merchant, merchant_cleaned, {aggressive_sql('merchant_cleaned')} AS merchant_aggressive FROM mclean",
    )
    spaced = "trim(regexp_replace(merchant, '(.)', '\\1 ', 'g'))"
    q["merchants_clean_spaced"] = _q(
        [f"sp AS (SELECT DISTINCT {spaced} AS merchant_spaced FROM tx)"],
        f"SELECT merchant_spaced, {clean_sql('merchant_spaced')} AS merchant_cleaned FROM sp",
    )
    mk = choices_ctes() + merchant_keys_ctes()
    q["merchants_exact"] = _q(
        mk,
        "SELECT m.merchant, m.merchant_cleaned, e.canonical AS merchant_canonical FROM mclean m "
        "LEFT JOIN exact_map e ON e.alias_clean = m.merchant_cleaned",
    )
    subset = [
        f"kt AS (SELECT key, unnest(t) AS tok, len(t) AS nk FROM (SELECT key, list_distinct({_toks('key')}) AS t FROM mrest))",
        f"ct AS (SELECT choice_idx, unnest(t) AS tok, len(t) AS nc FROM (SELECT choice_idx, list_distinct({_toks('alias_clean')}) AS t FROM choices))",
        "tpairs AS (SELECT key, choice_idx, count(*) AS shared, any_value(nk) AS nk, any_value(nc) AS nc FROM kt JOIN ct USING (tok) GROUP BY key, choice_idx)",
        "hits AS (SELECT key, min(choice_idx) AS best_idx FROM tpairs WHERE shared = nk OR shared = nc GROUP BY key)",
    ]
    q["merchants_token_subset"] = _q(
        mk + subset,
        "SELECT h.key AS merchant_cleaned, c.alias_clean AS best_choice, c.canonical AS merchant_canonical "
        "FROM hits h JOIN choices c ON c.choice_idx = h.best_idx",
    )
    q["merchants_fuzzy"] = _q(
        mk + fuzzy_ctes("mrest", "fz1"),
        f"SELECT key AS merchant_cleaned, best_choice, canonical AS merchant_canonical, score AS merchant_score, "
        f"score >= {DEFAULT_THRESHOLD} AS accepted FROM fz1",
    )
    q["merchants_aggressive"] = _q(
        mk
        + fuzzy_ctes("mrest", "fz1")
        + [
            f"low AS (SELECT key AS merchant_cleaned, {aggressive_sql('key')} AS aggr FROM fz1 WHERE score < {DEFAULT_THRESHOLD})",
            "low2 AS (SELECT * FROM low WHERE aggr <> '' AND aggr <> merchant_cleaned)",
            "retry_keys AS (SELECT DISTINCT aggr AS key FROM low2)",
        ]
        + fuzzy_ctes("retry_keys", "fz2"),
        "SELECT l.merchant_cleaned, l.aggr AS merchant_aggressive, z.best_choice, z.canonical AS merchant_canonical, "
        f"z.score AS merchant_score, z.score >= {DEFAULT_THRESHOLD} AS accepted FROM low2 l LEFT JOIN fz2 z ON z.key = l.aggr",
    )
    q["merchants_substring"] = _q(
        mk
        + [
            "sub AS (SELECT r.key, min(c.choice_idx) AS best_idx FROM mrest r JOIN choices c "
            "ON r.key <> '' AND (instr(r.key, c.alias_clean) > 0 OR instr(c.alias_clean, r.key) > 0) GROUP BY r.key)"
        ],
        "SELECT r.key AS merchant_cleaned, c.canonical AS merchant_canonical, "
        f"CASE WHEN s.best_idx IS NOT NULL THEN {SUBSTRING_SCORE} ELSE 0 END AS merchant_score, "
        "CASE WHEN s.best_idx IS NOT NULL THEN 'substring_matched' ELSE 'no_match' END AS issue "
        "FROM mrest r LEFT JOIN sub s ON s.key = r.key LEFT JOIN choices c ON c.choice_idx = s.best_idx",
    )
    q["merchants_vector"] = with_ctes(
        "refs AS (SELECT label, min(vec_id) AS ref_id FROM embeddings GROUP BY label)",
        "rv AS (SELECT r.ref_id, r.label AS match_label, CAST(e.embedding AS DOUBLE[]) AS v FROM refs r JOIN embeddings e ON e.vec_id = r.ref_id)",
        "qv AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id NOT IN (SELECT ref_id FROM refs))",
        "sims AS (SELECT q.vec_id, q.label, rv.ref_id, rv.match_label, "
        "list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * rv.v[i])) / "
        "(sqrt(list_sum(list_transform(q.v, lambda a: a * a))) * sqrt(list_sum(list_transform(rv.v, lambda a: a * a)))) AS cos "
        "FROM qv q CROSS JOIN rv)",
        "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cos DESC, ref_id ASC) AS rn FROM sims) WHERE rn = 1)",
    ) + (
        "SELECT vec_id, label, ref_id AS match_vec_id, match_label, round(cos, 6) AS cos, "
        "CAST(round_even(cos * 100, 0) AS INTEGER) AS score, cos >= 0.72 AS matched FROM best"
    )
    full = mk + resolve_ctes()
    q["merchants_resolve"] = _q(
        full, "SELECT merchant, merchant_cleaned, merchant_canonical, merchant_score, issue, match_stage FROM merchant_resolved"
    )
    q["merchants_resolve_spaced"] = _q(
        [f"sptx AS (SELECT {spaced} AS merchant FROM tx)"]
        + choices_ctes() + merchant_keys_ctes("sptx") + resolve_ctes(),
        "SELECT merchant, merchant_cleaned, merchant_canonical, merchant_score, match_stage FROM merchant_resolved",
    )
    q["merchants_review_queue"] = _q(
        full,
        "SELECT r.merchant_cleaned, max(r.merchant_score) AS merchant_score, CAST(sum(n) AS BIGINT) AS n_tx, count(*) AS n_variants "
        "FROM merchant_resolved r JOIN (SELECT merchant, count(*) AS n FROM tx GROUP BY merchant) t ON t.merchant = r.merchant "
        "WHERE r.match_stage = 'unresolved' GROUP BY r.merchant_cleaned",
    )
    q["categories_lookup"] = _q(
        mk + [f"catmap(merchant_canonical, map_category) AS {category_map_values()}"],
        "SELECT m.merchant, e.canonical AS merchant_canonical, c.map_category AS category FROM mclean m "
        "LEFT JOIN exact_map e ON e.alias_clean = m.merchant_cleaned LEFT JOIN catmap c ON c.merchant_canonical = e.canonical",
    )
    q["categories_rules"] = _q([], f"SELECT merchant, {rules_case('merchant')} AS category FROM (SELECT DISTINCT merchant FROM tx)")
    q["categories_full"] = _q(
        full + [f"catmap(merchant_canonical, map_category) AS {category_map_values()}"],
        f"SELECT r.merchant, r.merchant_canonical, coalesce(c.map_category, {rules_case('r.merchant')}) AS category "
        "FROM merchant_resolved r LEFT JOIN catmap c ON c.merchant_canonical = r.merchant_canonical",
    )
    q["merchant_totals_by_category"] = _q(
        amounts_ctes() + fx_ctes(),
        f"SELECT merchant, {rules_case('merchant')} AS category, CAST(round(coalesce(sum(amount_usd), 0), 2) AS {MONEY}) AS total_usd, "
        "count(*) AS n_tx FROM fx GROUP BY merchant",
    )
    q["spend_by_category"] = _q(
        _report_ctes(False), f"SELECT category, CAST(amount AS {MONEY}) AS total_usd, n_tx FROM bycat"
    )
    q["spend_by_category_resolved"] = _q(
        _report_ctes(True), f"SELECT category, CAST(amount AS {MONEY}) AS total_usd, n_tx FROM bycat"
    )
    q["spend_by_canonical"] = _q(
        _report_ctes(True),
        f"SELECT merchant_canonical, CAST(round(coalesce(sum(amount_usd), 0), 2) AS {MONEY}) AS total_usd, CAST(sum(n_tx) AS BIGINT) AS n_tx "
        "FROM pmcat GROUP BY merchant_canonical",
    )
    q["spend_by_column"] = _q(
        amounts_ctes() + fx_ctes(),
        f"SELECT n.n_name, CAST(round(coalesce(sum(fx.amount_usd), 0), 2) AS {MONEY}) AS total_usd, count(*) AS n_tx "
        "FROM fx LEFT JOIN customer c ON c.c_custkey = fx.account_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey "
        "GROUP BY n.n_name",
    )
    q["spend_share"] = _q(
        _report_ctes(False),
        f"SELECT category, CAST(amount AS {MONEY}) AS amount, round(CASE WHEN (SELECT sum(amount) FROM bycat) <> 0 "
        "THEN CAST(amount AS DOUBLE) / CAST((SELECT sum(amount) FROM bycat) AS DOUBLE) ELSE 0.0 END, 6) AS pct FROM bycat",
    )
    q["top_category"] = _q(
        _report_ctes(False),
        f"SELECT category AS top_category, CAST(amount AS {MONEY}) AS top_amount FROM bycat "
        "ORDER BY amount DESC, coalesce(category, '') ASC LIMIT 1",
    )
    q["transactions_cleaned"] = _q(
        dates_ctes() + amounts_ctes("dated"),
        "SELECT tx_id, date, amount, merchant, strftime(date_iso, '%Y-%m-%d') AS date_iso, amount_decimal, currency, "
        "array_to_string(issues, ',') AS issues FROM amt",
    )
    q["merchant_issue_counts"] = _q(
        [
            "cnt AS (SELECT merchant, count(*) AS n FROM tx GROUP BY merchant)",
            *choices_ctes(),
            *merchant_keys_ctes("cnt"),
            *resolve_ctes(),
        ],
        "SELECT r.issue, r.match_stage, CAST(sum(c.n) AS BIGINT) AS n_tx, count(*) AS n_merchants FROM cnt c "
        "JOIN merchant_resolved r ON r.merchant IS NOT DISTINCT FROM c.merchant GROUP BY r.issue, r.match_stage",
    )
    money_text = lambda x: f"'$' || format('{{:,.2f}}', CAST({x} AS {MONEY}))"
    q["spend_report_rows"] = _q(
        _report_ctes(True)
        + [
            "tot AS (SELECT coalesce(sum(amount), 0) AS total FROM bycat)",
            "top AS (SELECT category AS top_category, amount AS top_amount FROM bycat "
            "ORDER BY amount DESC, coalesce(category, '') ASC LIMIT 1)",
            "ranked AS (SELECT *, row_number() OVER (ORDER BY amount_raw DESC, category ASC NULLS LAST) AS rank FROM bycat)",
        ],
        f"SELECT CAST(r.rank AS INTEGER) AS rank, r.category, {money_text('r.amount')} AS amount, "
        "round(CASE WHEN t.total <> 0 THEN CAST(r.amount AS DOUBLE) / CAST(t.total AS DOUBLE) ELSE 0.0 END, 6) AS pct, "
        f"p.top_category, CAST(p.top_amount AS {MONEY}) AS top_amount, {money_text('t.total')} AS total_usd "
        "FROM ranked r CROSS JOIN tot t CROSS JOIN top p",
    )
    totals = "(SELECT coalesce(sum(amount), 0) FROM bycat)"
    top = "(SELECT {} FROM bycat ORDER BY amount DESC, coalesce(category, '') ASC LIMIT 1)"
    q["report_round_digits"] = _q(
        _report_ctes(False, 0),
        f"SELECT {top.format('category')} AS top_category, {money_text(top.format('amount'))} AS amount, {money_text(totals)} AS total_usd, "
        "CAST(count(*) AS INTEGER) AS n_groups FROM bycat",
    )
    share = f"format('{{:.6f}}', round(CASE WHEN {totals} <> 0 THEN CAST(amount AS DOUBLE) / CAST({totals} AS DOUBLE) ELSE 0 END, 6))"
    text_of = lambda x: f"coalesce(CAST(to_json({x}) AS VARCHAR), 'null')"
    item = f"""'{{"category":' || {text_of('category')} || ',"amount":"' || {money_text('amount')} || '","pct":' || {share} || '}}'"""
    q["spend_report_json"] = _q(
        _report_ctes(True),
        f"""SELECT '{{"top_category":' || {text_of(top.format('category'))} || ',"amount":"' || {money_text(top.format('amount'))}
          || '","top_amount":' || CAST(CAST({top.format('amount')} AS {MONEY}) AS VARCHAR)
          || ',"by_category":[' || string_agg({item}, ',' ORDER BY amount_raw DESC, category ASC NULLS LAST)
          || '],"total_usd":"' || {money_text(totals)} || '"}}' AS report FROM bycat""",
    )
    text = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
    worded_dates = """wd AS (SELECT o_orderkey AS tx_id, CASE o_orderkey % 6
      WHEN 0 THEN strftime(o_orderdate, '%B ') || nth || strftime(o_orderdate, ', %Y')
      WHEN 1 THEN nth || strftime(o_orderdate, ' %b %Y')
      WHEN 2 THEN strftime(o_orderdate, '%A, %-d %B %Y')
      WHEN 3 THEN strftime(o_orderdate, '%-d.%-m.%Y')
      WHEN 4 THEN strftime(o_orderdate, '%Y%m%d')
      ELSE strftime(o_orderdate, '%b ') || nth || strftime(o_orderdate, ' %y') END AS date
    FROM (SELECT *, CAST(day(o_orderdate) AS VARCHAR) || CASE WHEN day(o_orderdate) IN (11, 12, 13) THEN 'th'
            WHEN day(o_orderdate) % 10 = 1 THEN 'st' WHEN day(o_orderdate) % 10 = 2 THEN 'nd'
            WHEN day(o_orderdate) % 10 = 3 THEN 'rd' ELSE 'th' END AS nth FROM orders))"""
    q["dates_worded"] = with_ctes(worded_dates, *dates_ctes("wd")) + " SELECT tx_id, date, strftime(date_iso, '%Y-%m-%d') AS date_iso FROM dated"
    worded = """wa AS (SELECT o_orderkey AS tx_id, CASE o_orderkey % 12
      WHEN 0 THEN '€1.' || three || ',25' WHEN 1 THEN '1,' || three || '.25 dollars' WHEN 2 THEN '(2 ' || three || ' Euros)'
      WHEN 3 THEN t || ' pounds sterling' WHEN 4 THEN t || ' yen' WHEN 5 THEN 'kr ' || t WHEN 6 THEN 'CA$' || t
      WHEN 7 THEN t || ' zł' WHEN 8 THEN 'us$ ' || t || ' $' WHEN 9 THEN '₿' || t WHEN 10 THEN t || ' star credits'
      ELSE 'poundstore ' || t END AS amount
    FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS t, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS three FROM orders))"""
    amount_columns = " SELECT tx_id, amount, amount_decimal, currency, array_to_string(issues, ',') AS issues FROM amt"
    own_tables = list(CALLER_SYMBOLS.items()), CALLER_WORDS
    q["amounts_worded"] = with_ctes(worded, *amounts_ctes("wa")) + amount_columns
    q["amounts_caller_tables"] = with_ctes(worded, *amounts_ctes("wa", *own_tables)) + amount_columns
    q["fx_worded"] = with_ctes(worded, *amounts_ctes("wa"), *fx_ctes()) + " SELECT tx_id, currency, amount_usd FROM fx"
    q["amounts_precision"] = with_ctes(
        f"""tx AS (SELECT o_orderkey AS tx_id, CASE o_orderkey % 9
          WHEN 0 THEN 'Ξ0.' || lpad(o_orderkey::VARCHAR, 18, '0')
          WHEN 1 THEN '£−' || t
          WHEN 2 THEN '€–' || replace(t, '.', ',')
          WHEN 3 THEN lpad(o_orderkey::VARCHAR, 17, '9') || '.25 JPY'
          WHEN 4 THEN lpad(o_orderkey::VARCHAR, 21, '9') || ' JPY'
          WHEN 5 THEN '0.' || lpad(o_orderkey::VARCHAR, 19, '0') || '5 ETH'
          WHEN 6 THEN translate(t, '0123456789.', '٠١٢٣٤٥٦٧٨٩٫')
          WHEN 7 THEN '7’000' || chr(8201) || t || ' CHF'
          ELSE '1.' || t || ' INR' END AS amount FROM (SELECT *, {text} AS t FROM orders))""",
        *amounts_ctes(),
    ) + "SELECT tx_id, amount, amount_decimal, currency, array_to_string(issues, ',') AS issues FROM amt"
    codes = {"BTC": "105000", "SHB": "0.0000123456"}
    assert {k.upper(): v for k, v in LARGE_RATES.items()} == codes
    q["fx_large_rates"] = (
        "WITH big AS (SELECT o_orderkey AS tx_id, "
        "CAST(CAST(o_orderkey AS HUGEINT) AS DECIMAL(18,0)) AS k, "
        "CASE o_orderkey % 3 WHEN 0 THEN 'BTC' WHEN 1 THEN 'SHB' END AS currency FROM orders) "
        "SELECT tx_id, currency, CAST(CAST(k AS DECIMAL(22,0)) * CAST(CASE currency WHEN 'BTC' THEN '105' WHEN 'SHB' THEN '0.0000000123456' ELSE '0.001' END "
        "AS DECIMAL(16,13)) AS DECIMAL(38,16)) AS amount_usd FROM big"
    )
    rates = ", ".join(lit(c) for c in TABLE_CODES)
    q["fx_rates_table"] = _q(
        amounts_ctes(),
        f"""SELECT coalesce(currency, '(none)') AS currency, count(*) AS n_rows, CAST(round(sum(usd), 2) AS {MONEY}) AS amount_usd FROM (
          SELECT a.currency, {usd_sql('a.amount_decimal', 'r.rate')} AS usd FROM amt a LEFT JOIN (
            SELECT code, arg_max(rate, pos) AS rate FROM (
              SELECT upper([{rates}][n_nationkey % {len(TABLE_CODES)} + 1]) AS code,
                     CAST((n_nationkey + 5) / 10.0 AS DECIMAL(17,10)) AS rate, n_nationkey AS pos FROM nation
              UNION ALL SELECT currency, rate, -1 FROM {rates_values()} AS d(currency, rate)) GROUP BY code) r
          ON r.code = coalesce(a.currency, 'USD')) GROUP BY 1""",
    )
    unfit = ", ".join(lit(x) for x in UNFIT_RATES)
    q["fx_unfit_rates"] = _q(
        amounts_ctes(),
        f"""SELECT coalesce(currency, '(none)') AS currency, rate_issue, count(*) AS n_rows, CAST(round(sum(usd), 2) AS {MONEY}) AS amount_usd FROM (
          SELECT a.currency, CASE WHEN a.currency IS NOT NULL THEN CASE WHEN r.code IS NULL THEN 'no_rate' ELSE r.one.issue END END AS rate_issue,
                 {usd_sql('a.amount_decimal', 'r.one.rate')} AS usd FROM amt a LEFT JOIN (
            SELECT code, arg_max({{'rate': CASE WHEN issue IS NULL THEN CAST(x AS DECIMAL(17,10)) END, 'issue': issue}}, pos) AS one FROM (
              SELECT *, CASE WHEN abs(x) >= 10000000 THEN 'rate_out_of_range' WHEN round(x, 10) <> x THEN 'rate_too_fine' END AS issue FROM (
                SELECT upper([{rates}][n_nationkey % {len(TABLE_CODES)} + 1]) AS code,
                       CAST([{unfit}][n_nationkey % {len(UNFIT_RATES)} + 1] AS DECIMAL(38,20)) AS x, n_nationkey AS pos FROM nation
                UNION ALL SELECT currency, CAST(rate AS DECIMAL(38,20)), -1 FROM {rates_values()} AS d(currency, rate))) GROUP BY code) r
          ON r.code = coalesce(a.currency, 'USD')) GROUP BY 1, 2""",
    )
    q["report_ranked_accounts"] = _q(
        amounts_ctes() + fx_ctes(),
        f"""SELECT row_number() OVER (ORDER BY raw DESC, account_id ASC NULLS LAST) AS rank, account_id,
                 {money_text('round(raw, 2)')} AS amount
            FROM (SELECT account_id, coalesce(sum(amount_usd), 0) AS raw FROM fx GROUP BY account_id)""",
    )
    shared = choices_ctes(SHARED_ALIASES) + merchant_keys_ctes() + resolve_ctes()
    q["merchants_alias_collision"] = _q(
        shared, "SELECT merchant, merchant_canonical, merchant_score, match_stage FROM merchant_resolved"
    )
    q["merchants_no_map"] = _q(
        [],
        "SELECT tx_id, merchant, CAST(NULL AS VARCHAR) AS merchant_canonical, "
        f"CASE WHEN merchant IS NULL OR {strip('merchant')} = '' THEN 'empty_merchant' ELSE 'no_merchant_map' END AS issue FROM tx",
    )
    bases = "[" + ", ".join(lit(m) for m in TX_MERCHANTS) + "]"
    varied = (
        f"vtx AS (SELECT trim({bases}[account_id % 12 + 1] || ' ' || translate(account_id::VARCHAR, '0123456789', 'bdfglmnprt') "
        "|| CASE WHEN account_id % 3 = 0 THEN 'é' ELSE '' END) AS merchant FROM tx)"
    )
    q["merchants_varied"] = _q(
        [varied, *choices_ctes(), *merchant_keys_ctes("vtx"), *resolve_ctes()],
        "SELECT merchant, merchant_cleaned, merchant_canonical, merchant_score, match_stage FROM merchant_resolved",
    )
    q["categories_rule_table"] = _q(
        [
            varied,
            """own AS (SELECT v.merchant, arg_min(c.c_mktsegment, c.c_custkey) AS category
          FROM (SELECT DISTINCT merchant FROM vtx) v
          JOIN (SELECT *, translate(c_custkey::VARCHAR, '0123456789', 'bdfglmnprt') AS word FROM customer WHERE c_nationkey % 2 = 0) c
            ON contains(lower(v.merchant), c.word) AND regexp_matches(lower(v.merchant), '(^|[^a-z0-9_é])' || c.word || 'é?($|[^a-z0-9_é])')
          GROUP BY v.merchant)""",
        ],
        f"""SELECT v.merchant, CASE WHEN own.merchant IS NOT NULL THEN own.category ELSE {rules_case('v.merchant')} END AS category
            FROM (SELECT DISTINCT merchant FROM vtx) v LEFT JOIN own ON own.merchant = v.merchant""",
    )
    carried = "[" + ", ".join("NULL" if c is None else lit(c) for c in CARRIED) + f"][account_id % {len(CARRIED)} + 1]"
    q["report_existing_canonical"] = _q(
        amounts_ctes() + fx_ctes() + [f"catmap(canonical, map_category) AS {category_map_values()}"],
        f"""SELECT category, CAST(round(coalesce(sum(amount_usd), 0), 2) AS {MONEY}) AS total_usd, count(*) AS n_tx FROM (
          SELECT coalesce(c.map_category, {rules_case('f.merchant')}) AS category, f.amount_usd
          FROM (SELECT *, {carried} AS own FROM fx) f LEFT JOIN catmap c ON c.canonical = f.own) GROUP BY category""",
    )
    q["spend_by_currency"] = _q(
        amounts_ctes() + fx_ctes(),
        f"SELECT currency, CAST(round(coalesce(sum(amount_usd), 0), 2) AS {MONEY}) AS total_usd, count(*) AS n_tx FROM fx GROUP BY currency",
    )
    q["spend_no_merchant"] = _q(
        amounts_ctes() + fx_ctes(),
        f"SELECT CAST(NULL AS VARCHAR) AS category, CAST(round(coalesce(sum(amount_usd), 0), 2) AS {MONEY}) AS total_usd, count(*) AS n_tx "
        "FROM fx HAVING count(*) > 0",
    )
    q["transactions_enriched"] = _q(
        dates_ctes() + amounts_ctes("dated") + fx_ctes() + full + [f"catmap(merchant_canonical, map_category) AS {category_map_values()}"],
        f"""SELECT f.tx_id, strftime(f.date_iso, '%Y-%m-%d') AS date_iso, f.amount_decimal, f.currency, f.amount_usd, r.merchant_canonical,
              coalesce(c.map_category, {rules_case('f.merchant')}) AS category
            FROM fx f LEFT JOIN merchant_resolved r ON r.merchant IS NOT DISTINCT FROM f.merchant
            LEFT JOIN catmap c ON c.merchant_canonical = r.merchant_canonical""",
    )
    q["sample_first_n"] = _q([], f"SELECT tx_id, date, amount, merchant FROM tx ORDER BY tx_id LIMIT {SAMPLE_ROWS}")
    q["row_count"] = _q([], "SELECT count(*) AS n_rows FROM tx")
    return q
