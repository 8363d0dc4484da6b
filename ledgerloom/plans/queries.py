"""Registered queries over the driver tables (see ``sources.driver_tables``).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; every computed
column is aliased to the name its SQL oracle (``plans.oracle``) uses.  Money
leaves as ``decimal(38,2)`` (or the exact ``decimal(38,16)``), shares as
``round(double, 6)``, dates as ``yyyy-MM-dd`` text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.amounts import clean_amounts
from ledgerloom.functions.dates import clean_dates, expand_two_digit_year_expr
from ledgerloom.functions.text import aggressive_clean_expr
from ledgerloom.operators import merchants as M
from ledgerloom.operators.categorize import categorize, category_map_table, rules_expr
from ledgerloom.operators.fx import convert_to_usd
from ledgerloom.operators.report import ranked_rows, report_json, report_row, top_group, with_share
from ledgerloom.operators.vectors import nearest
from ledgerloom.plans import pipeline
from ledgerloom.plans.pipeline import categorized_merchant_totals, clean_transactions, spend_report_plan, usd_rows
from ledgerloom.sources import dims
from ledgerloom.sources.driver_tables import messy_transactions, precise_amounts, table, varied_merchants, worded_amounts, worded_dates

MONEY = "decimal(38,2)"
USD_EXACT = "decimal(38,16)"
TWO_DIGIT = r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2}\b"

# FIXED VALUES — caller rates used by the custom-rates query (keys are
# upper-cased, values that do not parse are ignored).
CUSTOM_RATES = {"eur": "1.1", "GBP": "1.3", "jpy": "0.0065", "XXX": "n/a"}
# FIXED VALUES — rates far from 1, for the large-rates query.
LARGE_RATES = {"BTC": "105000", "shb": "0.0000123456"}
# FIXED VALUES — currency codes of the rates table made from ``nation``.
TABLE_CODES = ["eur", "EUR", "Gbp", "JPY", "zzz"]
# FIXED VALUES — alias map in which canonicals share texts.
SHARED_ALIASES = {
    "Rides": ["uber trip", "starbucks"], "Coffee": ["Starbucks"], "Rental": ["monthly rent landlord"],
    "Housing": ["Monthly Rent - Landlord"], "Films": ["netflix.com"], "Video": ["NETFLIX COM"],
}
# FIXED VALUES — canonicals that rows already carry, by account_id % 4.
CARRIED = ["Uber", "Walmart", None, "Nobody"]
DEFAULT_CURRENCY = "USD"
SAMPLE_ROWS = 100
#: Position of the first built-in rule in a table that begins with a rule per customer.
BUILT_IN_PLACE = 1 << 50


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    return messy_transactions(spark, sf)


def _date_text(c):
    return F.date_format(c, "yyyy-MM-dd")


def _issues_text(c):
    return F.array_join(c, ",")


# ----------------------------------------------------------------- dates (J2)
def dates_clean(spark, sf):
    return clean_dates(_tx(spark, sf)).select("tx_id", "date", _date_text("date_iso").alias("date_iso"))


def dates_quality(spark, sf):
    df = clean_dates(_tx(spark, sf))
    shape = F.regexp_replace(F.regexp_replace("date", "[0-9]", "9"), "[A-Za-z]", "a")
    return df.groupBy(shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("date_iso").alias("n_parsed"),
        F.sum(F.when(F.col("date_iso").isNull(), 1).otherwise(0)).alias("n_unparsed"),
        _date_text(F.min("date_iso")).alias("min_date"),
        _date_text(F.max("date_iso")).alias("max_date"),
    )


def dates_two_digit_pivot(spark, sf):
    df = clean_dates(_tx(spark, sf)).where(F.col("date").rlike(TWO_DIGIT))
    return df.select(
        "tx_id", "date", expand_two_digit_year_expr(F.col("date")).alias("expanded"), _date_text("date_iso").alias("date_iso")
    )


# --------------------------------------------------------------- amounts (J3)
def amounts_clean(spark, sf):
    df = clean_amounts(_tx(spark, sf))
    return df.select("tx_id", "amount", "amount_decimal", "currency", _issues_text("issues").alias("issues"))


def amount_issue_counts(spark, sf):
    df = clean_amounts(_tx(spark, sf))
    return df.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n_rows"))


def amount_parse_status(spark, sf):
    df = clean_amounts(_tx(spark, sf))
    blank = F.col("amount").isNull() | (F.trim("amount") == "")
    status = (
        F.when(blank, "blank")
        .when(F.col("amount_decimal").isNull(), "unparseable")
        .when(F.col("currency").isNull(), "no_currency")
        .otherwise("parsed")
    )
    return df.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("amount_decimal").cast(MONEY).alias("amount_sum"),
    )


def amounts_default_currency(spark, sf):
    df = clean_amounts(_tx(spark, sf))
    return df.select("tx_id", "amount_decimal", F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"))


# -------------------------------------------------------------------- FX (J6)
def fx_convert(spark, sf):
    df = usd_rows(_tx(spark, sf))
    return df.select("tx_id", "amount_decimal", "currency", F.col("amount_usd").cast(USD_EXACT).alias("amount_usd"))


def fx_custom_rates(spark, sf):
    df = usd_rows(_tx(spark, sf), rates=CUSTOM_RATES)
    df = df.where(F.col("amount_decimal").isNotNull())
    return df.groupBy(F.coalesce("currency", F.lit("(none)")).alias("currency")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("amount_usd").alias("n_converted"),
        F.round(F.sum("amount_usd"), 2).cast(MONEY).alias("amount_usd"),
    )


def fx_missing_currency_policy(spark, sf):
    df = clean_amounts(_tx(spark, sf)).where(F.col("amount_decimal").isNotNull() & F.col("currency").isNull())
    assume = convert_to_usd(df, assume_missing_usd=True, out_col="usd_assume_missing")
    both = convert_to_usd(assume, assume_missing_usd=False, out_col="usd_strict")
    return both.select(
        "tx_id",
        "amount_decimal",
        F.col("usd_assume_missing").cast(USD_EXACT).alias("usd_assume_missing"),
        F.col("usd_strict").cast(USD_EXACT).alias("usd_strict"),
    )


def fx_unconvertible(spark, sf):
    df = usd_rows(_tx(spark, sf))
    bad = df.where(F.col("amount_decimal").isNotNull() & F.col("currency").isNotNull() & F.col("amount_usd").isNull())
    return bad.groupBy("currency").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount_decimal").cast(MONEY).alias("amount_sum")
    )


# -------------------------------------------------------------- merchants (J4)
def _spaced(c):
    """Every character of the merchant separated by a space (derived input
    for the spaced-letters rule): ``Starbucks`` -> ``S t a r b u c k s``."""
    return F.trim(F.regexp_replace(c, "(.)", "$1 "))


def merchants_clean(spark, sf):
    return M.clean_distinct(_tx(spark, sf), "merchant", "merchant_cleaned").select(
        "merchant", "merchant_cleaned", aggressive_clean_expr(F.col("merchant_cleaned")).alias("merchant_aggressive")
    )


def merchants_clean_spaced(spark, sf):
    sp = _tx(spark, sf).select(_spaced(F.col("merchant")).alias("merchant_spaced"))
    return M.clean_distinct(sp, "merchant_spaced", "merchant_cleaned")


def _index(spark):
    return M.default_index(spark)


def merchants_exact(spark, sf):
    d = M.clean_distinct(_tx(spark, sf), "merchant", "merchant_cleaned")
    ex = _index(spark).exact.select(F.col("alias_clean").alias("merchant_cleaned"), F.col("canonical").alias("merchant_canonical"))
    return d.join(ex, "merchant_cleaned", "left").select("merchant", "merchant_cleaned", "merchant_canonical")


def _not_exact(spark, sf, idx):
    d = M.clean_distinct(_tx(spark, sf), "merchant", "merchant_cleaned").where(F.trim("merchant") != "")
    keys = d.select(F.col("merchant_cleaned").alias("key")).distinct()
    return keys.join(idx.exact.select(F.col("alias_clean").alias("key")), "key", "left_anti")


def _tokens(c):
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def merchants_token_subset(spark, sf):
    """The first choice whose token set contains or is contained in the
    string's (token-set score 100), by a token equi-join: a second way to the
    best choices of the fuzzy search."""
    idx = _index(spark)
    own = idx.choices.select("choice_idx", _tokens(F.col("alias_clean")).alias("t"))
    own = F.broadcast(own.select("choice_idx", F.explode("t").alias("tok"), F.size("t").alias("nc")))  # the built-in map
    keys = _not_exact(spark, sf, idx).select("key", _tokens(F.col("key")).alias("t"))
    keys = keys.select("key", F.explode("t").alias("tok"), F.size("t").alias("nk"))
    pairs = keys.join(own, "tok").groupBy("key", "choice_idx").agg(F.count(F.lit(1)).alias("shared"), F.first("nk").alias("nk"), F.first("nc").alias("nc"))
    hits = pairs.where((F.col("shared") == F.col("nk")) | (F.col("shared") == F.col("nc"))).groupBy("key").agg(F.min("choice_idx").alias("best_idx"))
    hits = hits.join(idx.choices, hits["best_idx"] == idx.choices["choice_idx"])
    return hits.select(
        F.col("key").alias("merchant_cleaned"), F.col("alias_clean").alias("best_choice"), F.col("canonical").alias("merchant_canonical")
    )


def _best_columns():
    return [
        F.col("best.choice").alias("best_choice"),
        F.col("best.canonical").alias("merchant_canonical"),
        F.col("best.score").alias("merchant_score"),
        (F.col("best.score") >= M.DEFAULT_THRESHOLD).alias("accepted"),
    ]


def merchants_fuzzy(spark, sf):
    idx = _index(spark)
    scored = idx.with_best(_not_exact(spark, sf, idx), F.col("key"), "best")
    return scored.select(F.col("key").alias("merchant_cleaned"), *_best_columns())


def merchants_aggressive(spark, sf):
    idx = _index(spark)
    low = idx.with_best(_not_exact(spark, sf, idx), F.col("key"), "first").where(F.col("first.score") < M.DEFAULT_THRESHOLD)
    low = low.select(F.col("key").alias("merchant_cleaned"), aggressive_clean_expr(F.col("key")).alias("merchant_aggressive"))
    low = low.where((F.col("merchant_aggressive") != "") & (F.col("merchant_aggressive") != F.col("merchant_cleaned")))
    return idx.with_best(low, F.col("merchant_aggressive"), "best").select("merchant_cleaned", "merchant_aggressive", *_best_columns())


def merchants_substring(spark, sf):
    idx = _index(spark)
    keys = _not_exact(spark, sf, idx)
    res = M.resolve_keys(keys, idx, fallback="substring")
    return res.select(
        F.col("key").alias("merchant_cleaned"), "merchant_canonical", "merchant_score", "issue"
    )


def merchants_resolve(spark, sf):
    res = M.resolve_distinct(_tx(spark, sf), "merchant")
    return res.select(
        "merchant",
        "merchant_cleaned",
        "merchant_canonical",
        "merchant_score",
        _issues_text("merchant_issues").alias("issue"),
        "match_stage",
    )


def merchants_resolve_spaced(spark, sf):
    sp = _tx(spark, sf).select(_spaced(F.col("merchant")).alias("merchant"))
    res = M.resolve_distinct(sp, "merchant")
    return res.select("merchant", "merchant_cleaned", "merchant_canonical", "merchant_score", "match_stage")


def merchants_review_queue(spark, sf):
    tx = _tx(spark, sf)
    res = M.resolve_distinct(tx, "merchant").where(F.col("match_stage") == "unresolved")
    counts = tx.groupBy("merchant").agg(F.count(F.lit(1)).alias("n"))
    q = res.join(counts, "merchant")
    return q.groupBy("merchant_cleaned").agg(
        F.max("merchant_score").alias("merchant_score"),
        F.sum("n").alias("n_tx"),
        F.count(F.lit(1)).alias("n_variants"),
    )


def merchants_vector(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    refs = emb.groupBy("label").agg(F.min("vec_id").alias("ref_id"))
    ref_vecs = refs.join(emb.select(F.col("vec_id").alias("ref_id"), F.col("embedding").alias("vec")), "ref_id")
    queries = emb.join(refs.select(F.col("ref_id").alias("vec_id")), "vec_id", "left_anti")
    best = nearest(queries.select("vec_id", F.col("embedding").alias("vec")), ref_vecs.select("ref_id", "vec"), "vec_id")
    best = best.join(refs.select("ref_id", F.col("label").alias("match_label")), "ref_id")
    out = queries.select("vec_id", "label").join(best, "vec_id")
    return out.select(
        "vec_id",
        "label",
        F.col("ref_id").alias("match_vec_id"),
        "match_label",
        F.round("cos", 6).alias("cos"),
        F.bround(F.col("cos") * 100, 0).cast("int").alias("score"),
        (F.col("cos") >= 0.72).alias("matched"),
    )


# ------------------------------------------------------------- categories (J5)
def categories_lookup(spark, sf):
    ex = merchants_exact(spark, sf)
    cats = F.broadcast(category_map_table(spark))
    return ex.join(cats, "merchant_canonical", "left").select(
        "merchant", "merchant_canonical", F.col("map_category").alias("category")
    )


def categories_rules(spark, sf):
    d = _tx(spark, sf).select("merchant").distinct()
    return d.select("merchant", rules_expr(F.col("merchant")).alias("category"))


def categories_full(spark, sf):
    res = M.resolve_distinct(_tx(spark, sf), "merchant")
    return categorize(res, "merchant", "merchant_canonical").select("merchant", "merchant_canonical", "category")


def categories_rule_table(spark, sf):
    """A rule per customer of every second nation (the word of ``varied_merchants``), then the built-in rules."""
    word = F.translate(F.col("c_custkey").cast("string"), "0123456789", "bdfglmnprt")
    own = table(spark, sf, "customer").where("c_nationkey % 2 = 0").select(
        F.col("c_custkey").alias("position"), F.concat(word, F.lit("é?")).alias("pattern"), F.col("c_mktsegment").alias("category")
    )
    rows = [(BUILT_IN_PLACE + i, *rule) for i, rule in enumerate(dims.CATEGORY_RULES)]
    rules = own.unionByName(spark.createDataFrame(rows, "position long, pattern string, category string"))
    texts = varied_merchants(spark, sf).select("merchant").distinct()
    return categorize(texts, rules=rules).select("merchant", "category")


# ----------------------------------------------------------------- report (J7)
def spend_by_category(spark, sf):
    g = spend_report_plan(_tx(spark, sf), resolve=False)
    return g.select("category", F.col("amount").cast(MONEY).alias("total_usd"), "n_tx")


def spend_by_category_resolved(spark, sf):
    g = spend_report_plan(_tx(spark, sf), resolve=True)
    return g.select("category", F.col("amount").cast(MONEY).alias("total_usd"), "n_tx")


def spend_by_canonical(spark, sf):
    g = spend_report_plan(_tx(spark, sf), group_by="merchant_canonical", resolve=True)
    return g.select("merchant_canonical", F.col("amount").cast(MONEY).alias("total_usd"), "n_tx")


def spend_by_column(spark, sf):
    """Group by a run-time column from joined dimensions (customer nation).
    USD is summed per account first, so the join sees one row per account."""
    per_account = usd_rows(_tx(spark, sf)).groupBy("account_id").agg(
        F.sum("amount_usd").alias("amount_usd"), F.count(F.lit(1)).alias("n_tx")
    )
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("account_id"), "c_nationkey")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = per_account.join(cust, "account_id", "left").join(nation, "c_nationkey", "left")
    g = j.groupBy("n_name").agg(F.coalesce(F.sum("amount_usd"), F.lit(0)).alias("amount_raw"), F.sum("n_tx").alias("n_tx"))
    return g.select("n_name", F.round("amount_raw", 2).cast(MONEY).alias("total_usd"), "n_tx")


def spend_share(spark, sf):
    g = with_share(spend_report_plan(_tx(spark, sf)))
    return g.select("category", F.col("amount").cast(MONEY).alias("amount"), F.round("pct", 6).alias("pct"))


def top_category(spark, sf):
    t = top_group(spend_report_plan(_tx(spark, sf)), "category")
    return t.select(F.col("category").alias("top_category"), F.col("amount").cast(MONEY).alias("top_amount"))


def spend_report_rows(spark, sf):
    """The report object (resolution on) one row per listed category, with
    the top category and total: the JSON report in a checkable shape."""
    rep = report_row(spend_report_plan(_tx(spark, sf), resolve=True), "category")
    items = rep.select(
        "top_category", "top_amount", "total_usd", F.posexplode("by_category").alias("pos", "item")
    )
    return items.select(
        (F.col("pos") + 1).alias("rank"),
        F.col("item.category").alias("category"),
        F.col("item.amount").alias("amount"),
        F.round("item.pct", 6).alias("pct"),
        "top_category",
        F.col("top_amount").cast(MONEY).alias("top_amount"),
        "total_usd",
    )


def spend_report_json(spark, sf):
    return report_json(report_row(spend_report_plan(_tx(spark, sf), resolve=True), "category"))


def transactions_cleaned(spark, sf):
    """Entry B rows: raw columns + date_iso, amount_decimal, currency, issues
    (what the cleaned-CSV sink writes)."""
    df = clean_transactions(_tx(spark, sf))
    return df.select(
        "tx_id", "date", "amount", "merchant", _date_text("date_iso").alias("date_iso"),
        "amount_decimal", "currency", _issues_text("issues").alias("issues"),
    )


def merchant_issue_counts(spark, sf):
    """Quality counts of the resolution: transactions per merchant tag and
    stage (per-merchant counts first, so the tags are joined to distinct
    merchants only)."""
    tx = _tx(spark, sf)
    counts = tx.groupBy("merchant").agg(F.count(F.lit(1)).alias("n"))
    res = M.resolve_distinct(counts, "merchant")
    j = counts.join(res, counts["merchant"].eqNullSafe(res["merchant"]))
    return j.groupBy(_issues_text("merchant_issues").alias("issue"), "match_stage").agg(
        F.sum("n").alias("n_tx"), F.count(F.lit(1)).alias("n_merchants")
    )


# --------------------------------------------------------------- ingest (J1)
def sample_first_n(spark, sf):
    return _tx(spark, sf).orderBy("tx_id").limit(SAMPLE_ROWS).select("tx_id", "date", "amount", "merchant")


def row_count(spark, sf):
    return _tx(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))


def merchant_totals_by_category(spark, sf):
    """Per distinct raw merchant: USD total, count and category (no resolution)."""
    m = categorized_merchant_totals(_tx(spark, sf))
    return m.select("merchant", "category", F.round("amount_usd", 2).cast(MONEY).alias("total_usd"), "n_tx")


# ------------------------------------------------- precision, rates, aliases
def amounts_precision(spark, sf):
    df = clean_amounts(precise_amounts(spark, sf))
    return df.select("tx_id", "amount", "amount_decimal", "currency", _issues_text("issues").alias("issues"))


#: A caller's tables: symbols and words that the built-in ones lack or read otherwise.
CALLER_SYMBOLS = {"₿": "BTC", "zł": "PLN", "kr": "DKK", "$": "USD", "US$": "USX", "A$": "AUD"}
CALLER_WORDS = [("credits", "CRD"), ("pounds sterling", "GBX"), ("pounds", "GBP"), ("pound", "LBS")]


def amounts_worded(spark, sf):
    df = clean_amounts(worded_amounts(spark, sf))
    return df.select("tx_id", "amount", "amount_decimal", "currency", _issues_text("issues").alias("issues"))


def amounts_caller_tables(spark, sf):
    df = clean_amounts(worded_amounts(spark, sf), symbols=CALLER_SYMBOLS, words=CALLER_WORDS)
    return df.select("tx_id", "amount", "amount_decimal", "currency", _issues_text("issues").alias("issues"))


def fx_worded(spark, sf):
    df = convert_to_usd(clean_amounts(worded_amounts(spark, sf)))
    return df.select("tx_id", "currency", F.col("amount_usd").cast(USD_EXACT).alias("amount_usd"))


def dates_worded(spark, sf):
    return clean_dates(worded_dates(spark, sf)).select("tx_id", "date", _date_text("date_iso").alias("date_iso"))


def fx_large_rates(spark, sf):
    code = F.element_at(F.array(F.lit(" BTC"), F.lit(" SHB"), F.lit("")), (F.col("tx_id") % 3 + 1).cast("int"))
    tx = _tx(spark, sf).select("tx_id", F.concat((F.col("tx_id") / 1000).cast("decimal(18,3)").cast("string"), code).alias("amount"))
    return usd_rows(tx, rates=LARGE_RATES).select("tx_id", "currency", F.col("amount_usd").cast(USD_EXACT).alias("amount_usd"))


def fx_rates_table(spark, sf):
    codes = F.array(*[F.lit(c) for c in TABLE_CODES])
    rates = table(spark, sf, "nation").select(
        F.element_at(codes, (F.col("n_nationkey") % len(TABLE_CODES) + 1).cast("int")).alias("currency"),
        ((F.col("n_nationkey") + 5) / 10).cast("decimal(9,1)").cast("string").alias("rate"),
        F.col("n_nationkey").alias("pos"),
    )
    df = usd_rows(_tx(spark, sf), rates=rates)
    return df.groupBy(F.coalesce("currency", F.lit("(none)")).alias("currency")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("amount_usd"), 2).cast(MONEY).alias("amount_usd")
    )


# FIXED VALUES — rates of the unfit-rates query: two that the rate type cannot hold, one that it can.
UNFIT_RATES = ["20000000", "0.00000000000123", "1.5"]


def fx_unfit_rates(spark, sf):
    """A rates table with rates beyond the rate type: they convert nothing, and the rows say why."""
    codes, texts = (F.array(*[F.lit(x) for x in values]) for values in (TABLE_CODES, UNFIT_RATES))
    rates = table(spark, sf, "nation").select(
        F.element_at(codes, (F.col("n_nationkey") % len(TABLE_CODES) + 1).cast("int")).alias("currency"),
        F.element_at(texts, (F.col("n_nationkey") % len(UNFIT_RATES) + 1).cast("int")).alias("rate"),
        F.col("n_nationkey").alias("pos"),
    )
    df = convert_to_usd(clean_amounts(_tx(spark, sf)), rates=rates, issue_col="rate_issue")
    return df.groupBy(F.coalesce("currency", F.lit("(none)")).alias("currency"), "rate_issue").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("amount_usd"), 2).cast(MONEY).alias("amount_usd")
    )


def report_ranked_accounts(spark, sf):
    """The report's listing, one ranked row per account."""
    return ranked_rows(spend_report_plan(_tx(spark, sf), group_by="account_id"), "account_id").select("rank", "account_id", "amount")


def merchants_alias_collision(spark, sf):
    res = M.resolve_distinct(_tx(spark, sf), "merchant", aliases=SHARED_ALIASES)
    return res.select("merchant", "merchant_canonical", "merchant_score", "match_stage")


def merchants_no_map(spark, sf):
    res = M.resolve_merchants(_tx(spark, sf), "merchant", aliases={})
    return res.select("tx_id", "merchant", "merchant_canonical", _issues_text("merchant_issues").alias("issue"))


def merchants_varied(spark, sf):
    res = M.resolve_distinct(varied_merchants(spark, sf), "merchant")
    return res.select("merchant", "merchant_cleaned", "merchant_canonical", "merchant_score", "match_stage")


# ------------------------------------------------------- report, other inputs
def report_existing_canonical(spark, sf):
    own = F.element_at(F.array(*[F.lit(c) for c in CARRIED]), (F.col("account_id") % len(CARRIED) + 1).cast("int"))
    g = spend_report_plan(_tx(spark, sf).withColumn("merchant_canonical", own))
    return g.select("category", F.col("amount").cast(MONEY).alias("total_usd"), "n_tx")


def spend_by_currency(spark, sf):
    g = spend_report_plan(_tx(spark, sf), group_by="currency")
    return g.select("currency", F.col("amount").cast(MONEY).alias("total_usd"), "n_tx")


def spend_no_merchant(spark, sf):
    g = spend_report_plan(_tx(spark, sf).drop("merchant"))
    return g.select("category", F.col("amount").cast(MONEY).alias("total_usd"), "n_tx")


def report_round_digits(spark, sf):
    rep = report_row(spend_report_plan(_tx(spark, sf), round_digits=0), "category")
    return rep.select("top_category", "amount", "total_usd", F.size("by_category").alias("n_groups"))


def transactions_enriched(spark, sf):
    """The row-level result: what a report is made of, one row per transaction."""
    df = pipeline.transactions_enriched(_tx(spark, sf))
    return df.select(
        "tx_id", _date_text("date_iso").alias("date_iso"), "amount_decimal", "currency",
        F.col("amount_usd").cast(USD_EXACT).alias("amount_usd"), "merchant_canonical", "category",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dates_clean": dates_clean,
    "dates_quality": dates_quality,
    "dates_two_digit_pivot": dates_two_digit_pivot,
    "amounts_clean": amounts_clean,
    "amount_issue_counts": amount_issue_counts,
    "amount_parse_status": amount_parse_status,
    "amounts_default_currency": amounts_default_currency,
    "fx_convert": fx_convert,
    "fx_custom_rates": fx_custom_rates,
    "fx_missing_currency_policy": fx_missing_currency_policy,
    "fx_unconvertible": fx_unconvertible,
    "merchants_clean": merchants_clean,
    "merchants_clean_spaced": merchants_clean_spaced,
    "merchants_exact": merchants_exact,
    "merchants_token_subset": merchants_token_subset,
    "merchants_fuzzy": merchants_fuzzy,
    "merchants_aggressive": merchants_aggressive,
    "merchants_substring": merchants_substring,
    "merchants_vector": merchants_vector,
    "merchants_resolve": merchants_resolve,
    "merchants_resolve_spaced": merchants_resolve_spaced,
    "merchants_review_queue": merchants_review_queue,
    "categories_lookup": categories_lookup,
    "categories_rules": categories_rules,
    "categories_full": categories_full,
    "categories_rule_table": categories_rule_table,
    "merchant_totals_by_category": merchant_totals_by_category,
    "spend_by_category": spend_by_category,
    "spend_by_category_resolved": spend_by_category_resolved,
    "spend_by_canonical": spend_by_canonical,
    "spend_by_column": spend_by_column,
    "spend_share": spend_share,
    "top_category": top_category,
    "spend_report_rows": spend_report_rows,
    "spend_report_json": spend_report_json,
    "transactions_cleaned": transactions_cleaned,
    "merchant_issue_counts": merchant_issue_counts,
    "amounts_precision": amounts_precision,
    "amounts_worded": amounts_worded,
    "amounts_caller_tables": amounts_caller_tables,
    "fx_worded": fx_worded,
    "dates_worded": dates_worded,
    "fx_large_rates": fx_large_rates,
    "fx_rates_table": fx_rates_table,
    "fx_unfit_rates": fx_unfit_rates,
    "report_ranked_accounts": report_ranked_accounts,
    "merchants_alias_collision": merchants_alias_collision,
    "merchants_no_map": merchants_no_map,
    "merchants_varied": merchants_varied,
    "report_existing_canonical": report_existing_canonical,
    "spend_by_currency": spend_by_currency,
    "spend_no_merchant": spend_no_merchant,
    "report_round_digits": report_round_digits,
    "transactions_enriched": transactions_enriched,
    "sample_first_n": sample_first_n,
    "row_count": row_count,
}
