"""J5 categorize_transactions.

category = map[canonical]                          (case-sensitive lookup)
           else first matching rule on lower(raw)  (ordered regex rules)
           else first map key (map order) contained in lower(raw)
           else NULL

The map is a broadcast equi-join against a small table; the rules become
one generated ``CASE WHEN`` with literal patterns, so every regex is compiled
once per task and evaluated inside whole-stage codegen.  Longer rule tables
become several such expressions, each the ELSE of the one before, so the same
regex engine judges tables of any size.  Plans apply this to *distinct* merchants (or per-merchant aggregates),
not to every row.

Rules and map may also be DataFrames, ``rules(position, pattern, category)`` and
``category_map(position, merchant_canonical, category)``; if one of them is, both stay in Spark and rules are
found through an index of literals (``operators.rule_tables``), with the results of the list form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.rule_tables import first_rule, unique_keys
from ledgerloom.sources import dims

Entries = list[tuple[str, str]] | DataFrame | None

#: Rules and map keys that one CASE expression holds.
CASE_RULES = 1_000


def _dedup_map(entries: list[tuple[str, str]]) -> list[tuple[str, str]]:
    pos: dict[str, int] = {}
    val: dict[str, str] = {}
    for k, v in entries:
        pos.setdefault(k, len(pos))
        val[k] = v
    return sorted(((k, val[k]) for k in pos), key=lambda kv: pos[kv[0]])


def rules_expr(
    raw: Column,
    rules: list[tuple[str, str]] | None = None,
    category_map: list[tuple[str, str]] | None = None,
) -> Column:
    """Ordered rules on ``lower(raw)``: regex rules, then map keys contained
    in the text.  NULL or empty raw text -> NULL."""
    rules = dims.CATEGORY_RULES if rules is None else rules
    entries = _dedup_map(dims.CATEGORY_MAP if category_map is None else category_map)
    low = F.lower(raw)
    branches = [(low.rlike(r"(?U)\b(" + body + r")\b"), cat) for body, cat in rules]
    branches += [(F.instr(low, key.lower()) > 0, cat) for key, cat in entries]
    step = max(1, CASE_RULES)
    expr = None
    for start in reversed(range(0, len(branches), step)):
        case = F
        for cond, cat in branches[start : start + step]:
            case = case.when(cond, F.lit(cat))
        expr = case if expr is None else case.otherwise(expr)
    return F.when(raw.isNotNull() & (raw != ""), expr)


def category_map_table(spark, category_map: list[tuple[str, str]] | None = None) -> DataFrame:
    entries = _dedup_map(dims.CATEGORY_MAP if category_map is None else category_map)
    return spark.createDataFrame(entries, "merchant_canonical string, map_category string")


def _as_table(spark, entries: Entries, default: list[tuple[str, str]], name: str) -> DataFrame:
    if isinstance(entries, DataFrame):
        return entries.select(F.col("position").cast("long").alias("position"), name, "category")
    rows = [(i, *entry) for i, entry in enumerate(default if entries is None else entries)]
    return spark.createDataFrame(rows, f"position long, {name} string, category string")


def _categorize_by_tables(df: DataFrame, merchant_col: str, canonical_col: str, category_map: Entries, rules: Entries, out_col: str) -> DataFrame:
    spark = df.sparkSession
    rules = _as_table(spark, rules, dims.CATEGORY_RULES, "pattern")
    keys = unique_keys(_as_table(spark, category_map, dims.CATEGORY_MAP, "merchant_canonical"))
    found, looked_up = F.lit(None).cast("string"), F.lit(None).cast("string")
    names = [c for c in df.columns if c != out_col]
    if merchant_col in df.columns:
        low = F.lower(F.col(merchant_col))
        hits = first_rule(df.select(low.alias("text")).distinct(), rules, keys)
        df = df.join(hits.select(F.col("text").alias("_cat_text"), F.col("category").alias("_cat_rule")), low == F.col("_cat_text"), "left")
        found = F.col("_cat_rule")
    if canonical_col in df.columns:
        own = keys.select(F.col("merchant_canonical").alias("_cat_key"), F.col("category").alias("_cat_own"))
        df = df.join(own, F.col(canonical_col) == F.col("_cat_key"), "left")
        looked_up = F.col("_cat_own")
    return df.select(*[F.col(f"`{c}`") for c in names], F.coalesce(looked_up, found).cast("string").alias(out_col))


def categorize(
    df: DataFrame,
    merchant_col: str = "merchant",
    canonical_col: str = "merchant_canonical",
    *,
    category_map: Entries = None,
    rules: Entries = None,
    out_col: str = "category",
) -> DataFrame:
    """Add (or overwrite) ``category``."""
    if isinstance(rules, DataFrame) or isinstance(category_map, DataFrame):
        return _categorize_by_tables(df, merchant_col, canonical_col, category_map, rules, out_col)
    by_rules = rules_expr(F.col(merchant_col), rules, category_map) if merchant_col in df.columns else F.lit(None)
    if canonical_col in df.columns:
        table = category_map_table(df.sparkSession, category_map).withColumnRenamed(
            "merchant_canonical", "_cat_key"
        )
        # a literal of known length: a short one is broadcast
        if len(dims.CATEGORY_MAP if category_map is None else category_map) <= CASE_RULES:
            table = F.broadcast(table)
        df = df.join(table, df[canonical_col] == F.col("_cat_key"), "left").drop("_cat_key")
        cat = F.coalesce(F.col("map_category"), by_rules)
        return df.withColumn(out_col, cat.cast("string")).drop("map_category")
    return df.withColumn(out_col, by_rules.cast("string"))

