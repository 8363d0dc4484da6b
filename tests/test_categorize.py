import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.categorize import categorize


def _cat(spark, pairs):
    df = spark.createDataFrame([(i, c, m) for i, (c, m) in enumerate(pairs)], "i int, merchant_canonical string, merchant string")
    return [r.category for r in sorted(categorize(df).collect(), key=lambda r: r.i)]


def test_canonical_lookup(spark):
    assert _cat(spark, [("Uber", None), ("Starbucks", None)]) == ["Transport", "Food"]


def test_raw_rules(spark):
    got = _cat(spark, [(None, "UBER *TRIP"), (None, "Amazon.com Marketplace"), (None, "Starbucks #4421"),
                       (None, "ATM Withdrawal"), (None, "Monthly Rent - Landlord"), (None, "EXXONMOBIL 44543354")])
    assert got == ["Transport", "Shopping", "Food", "Cash", "Housing", "Fuel"]


def test_unknown(spark):
    assert _cat(spark, [(None, "Some Weird Unknown Merchant"), (None, "Unknown Co")]) == [None, None]


def test_priority_and_fallback(spark):
    assert _cat(spark, [("Uber", "Starbucks #1"), ("UnknownBrand", "Starbucks #1")]) == ["Transport", "Food"]


def test_case_and_punctuation(spark):
    got = _cat(spark, [(None, "  starBUCKS-COFFEE/STM  "), (None, "cVs/pharmacy #123"), (None, "Netflix.com subscription"),
                       (None, "Monthly subscription fee"), (None, "Staples - Office Supplies"), (None, "La Boulangerie Bakery")])
    assert got == ["Food", "Healthcare", "Entertainment", "Subscription", "Office", "Food"]


def test_case_sensitive_canonical(spark):
    assert _cat(spark, [("uber", None)]) == [None]


def test_dataframe_precedence(spark):
    got = _cat(spark, [("Whole Foods", "Starbucks Reserve"), (None, "WAL-MART SUPERCENTER 3301"), (None, "Rent - Landlord")])
    assert got == ["Groceries", "Groceries", "Housing"]


def test_without_canonical_column(spark):
    df = spark.createDataFrame([("UBER *TRIP",)], "merchant string")
    assert categorize(df).first().category == "Transport"


def test_overwrites_input_category(spark):
    df = spark.createDataFrame([("UBER *TRIP", "Travel")], "merchant string, category string")
    out = categorize(df)
    assert out.columns.count("category") == 1 and out.first().category == "Transport"


def test_long_rule_tables_give_the_same(spark, monkeypatch):
    from ledgerloom.operators import categorize as C

    df = spark.createDataFrame([("UBER *TRIP",), ("Some Market",), ("Netflix.com",), ("",), (None,), ("zzz",)], "merchant string")
    short = [r.category for r in C.categorize(df).collect()]
    monkeypatch.setattr(C, "CASE_RULES", 0)
    assert [r.category for r in C.categorize(df).collect()] == short


def test_one_regex_engine_at_every_size(spark):
    """A combining mark is a word character of Java's (?U) and none of Python's; Python has no \\p{L}; '' is a category."""
    from ledgerloom.operators import categorize as C

    texts = ["cafe\u0301 x", "cafe x", "straße 9", "blank market", "last one", "zzq1400 shop", "nothing"]
    df = spark.createDataFrame([(t,) for t in texts], "merchant string")
    rules = [("cafe", "Food"), (r"\p{L}+ße", "Street"), ("blank", "")]
    many = rules + [(f"zzq{i}", f"c{i}") for i in range(1500)] + [("last", "End")]
    category_map = [("market", "Market")]
    few = [r.category for r in C.categorize(df, rules=[*rules, ("last", "End"), ("zzq1400", "c1400")], category_map=category_map).collect()]
    assert few == [None, "Food", "Street", "", "End", "c1400", None]
    assert [r.category for r in C.categorize(df, rules=many, category_map=category_map).collect()] == few


def test_required_literals():
    from ledgerloom.functions.literals import required_literals as lits

    assert lits("rent|landlord") == ["landlord", "rent"]
    assert lits("whole ?foods|gr[ao]cer") == ["cer", "whole"] or lits("whole ?foods|gr[ao]cer") == ["cer", "foods"]
    assert lits(r"a(?:bcd|efg)+x*\.y?") == ["bcd", "efg"]
    assert lits(r"ab+c") == ["ab"] and lits(r"abc{0,2}d") == ["ab"] and lits("x{2}yz") == ["yz"]
    for none in ["", ".*", r"\d+", "(?i)abc", r"\Qabc\E", "abc|", "(abc)?", r"a(?=b)", "[[a]b]cde", r"\x41bc", "(abc", "abc|x?"]:
        assert lits(none) is None, none


def _rule_table(spark, rules):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], "position long, pattern string, category string")


def test_rule_tables_give_what_lists_give(spark):
    from ledgerloom.sources import dims

    texts = ["UBER *TRIP", "Some Market", "Netflix.com", "", None, "zzz", "cafe\u0301 x", "cafe x", "wal mart 12", "ATM 3", "a.b", "q7 shop", "Spotify", "prime"]
    pairs = [(i, None if i % 3 else "Uber", t) for i, t in enumerate(texts + texts)]
    df = spark.createDataFrame(pairs, "i int, merchant_canonical string, merchant string")
    own = [("prime|(x|yz)?", "P?"), (r"q\d", "Digit"), (r"a\.b", None), ("cafe", ""), *dims.CATEGORY_RULES, ("(?i)ZZZ", "Flag"), ("zzz", "Late")]
    keys = [("Spotify", "Old"), ("shop", "Shop"), ("Spotify", "Music"), ("Uber", "Ride")]
    want = {r.i: r.category for r in categorize(df, rules=own, category_map=keys).collect()}
    as_map = spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], "position long, merchant_canonical string, category string")
    for rules, category_map in [(_rule_table(spark, own), as_map), (own, as_map), (_rule_table(spark, own).repartition(5), keys)]:
        got = categorize(df.withColumn("category", F.lit("old")), rules=rules, category_map=category_map)
        assert got.columns == ["i", "merchant_canonical", "merchant", "category"]
        assert {r.i: r.category for r in got.collect()} == want


def test_rule_table_empty_and_repeated(spark):
    df = spark.createDataFrame([("one two",), ("two",), (None,)], "merchant string")
    none = _rule_table(spark, []), []
    assert [r.category for r in categorize(df, rules=none[0], category_map=none[1]).collect()] == [None] * 3
    assert categorize(df.where("false"), rules=_rule_table(spark, [("two", "T")])).collect() == []
    rules = spark.createDataFrame([(5, "two", "B"), (5, "one", "A"), (5, "one", "A"), (9, "two", "C"), (1, None, "N")], "position long, pattern string, category string")
    assert {r.merchant: r.category for r in categorize(df, rules=rules).collect()} == {"one two": "A", "two": "B", None: None}


@pytest.mark.parametrize("keys", [200_000, 10])
def test_many_rules_with_and_without_literals(spark, monkeypatch, keys):
    from ledgerloom.operators import rule_tables

    monkeypatch.setattr(rule_tables, "BROADCAST_KEYS", keys)
    monkeypatch.setattr(rule_tables, "SLICE", 7)
    rules = [(f"shop{i}|store{i}x", f"c{i}") for i in range(20_000)] + [(rf"[uv]\d{{2}}{'' if i else '0'}[{i}]", f"k{i}") for i in range(10)]
    texts = [f"The Shop{i} ltd" for i in range(0, 20_000, 501)] + [f"store{i}x" for i in range(0, 20_000, 997)] + [f"u12{i}" for i in range(10)] + ["v1200"]
    df = spark.createDataFrame([(t,) for t in texts], "merchant string")
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], "position long, pattern string, category string")
    got = {r.merchant: r.category for r in categorize(df, rules=table, category_map=[]).collect()}
    low = {t: t.lower() for t in texts}
    assert got == {t: next((c for p, c in rules if re.search(rf"\b({p})\b", low[t])), None) for t in texts if t[0] in "uv"} | {
        t: "c" + re.search(r"\d+", t)[0] for t in texts if t[0] not in "uv"
    }


@pytest.mark.parametrize("keys", [1_000_000, 0])
def test_each_text_tries_few_rules_of_many(spark, monkeypatch, keys):
    """Words of few letters share their letter triples with most rules."""
    from ledgerloom.operators import rule_tables

    monkeypatch.setattr(rule_tables, "GRAM_KEYS", keys)
    words = ["".join("bdfglmnprt"[int(c)] for c in str(n)) for n in range(10_000, 100_000, 37)]
    rules = spark.createDataFrame([(i, f"{w}é?", w.upper()) for i, w in enumerate(words)], "position long, pattern string, category string")
    texts = spark.createDataFrame([(f"shop {w}{'é' * (i % 2)}",) for i, w in enumerate(words)], "text string")
    none = spark.createDataFrame([], "merchant_canonical string, category string, position long")
    got = {r["text"]: r["category"] for r in rule_tables.first_rule(texts, rules, none).collect()}
    assert got == {f"shop {w}{'é' * (i % 2)}": w.upper() for i, w in enumerate(words)}
    table = rule_tables._rule_rows(rules, none)
    monkeypatch.setattr(rule_tables, "_matches", lambda *_: F.lit(True))
    assert rule_tables._by_literal(texts, table).count() <= 2 * len(words)


def test_literals_of_any_length_and_none(spark):
    from ledgerloom.operators import rule_tables

    long = "abcdefghijklmnopqrstuvwxyz"
    patterns = [long[:n] for n in range(26, 0, -1)] + ["\\d"]
    rules = spark.createDataFrame([(i, p, p) for i, p in enumerate(patterns)], "position long, pattern string, category string")
    texts = spark.createDataFrame([(f"x {p} y",) for p in patterns[:-1]] + [("7",), ("",), (None,)], "text string")
    none = spark.createDataFrame([], "merchant_canonical string, category string, position long")
    want = {f"x {p} y": p for p in patterns[:-1]}
    assert {r["text"]: r["category"] for r in rule_tables.first_rule(texts, rules, none).collect()} == want | {"7": "\\d"}
    assert {r["text"]: r["category"] for r in rule_tables.first_rule(texts, rules.where("position = 26"), none).collect()} == {"7": "\\d"}
