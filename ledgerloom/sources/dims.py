"""Built-in dimension tables.

The values below are FIXED VALUES: they must equal the published defaults for
results to match (alias map, category map, category rules, FX rates, currency
symbols and words).  They are stated here as plain text, in their natural
order.  Every job also accepts a caller-supplied table in their place.
"""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — merchant alias map: canonical -> aliases, in file order.
# ---------------------------------------------------------------------------
MERCHANT_ALIASES: dict[str, list[str]] = {
    "Uber": ["UBER *TRIP", "Uber Technologies", "UBER EATS"],
    "Amazon": ["AMZN Mktp US", "AMAZON.COM", "AMAZON"],
    "Starbucks": ["Starbucks Store", "STARBUCKS", "STARBUCKS STORE 45"],
    "Walmart": ["WALMART #1234", "WALMART", "WALMART INC"],
    "Shell": ["SHELL OIL CO.", "SHELL", "SHELL OIL"],
    "Swiss Bakery": ["Swiss-Boulangerie", "Swiss Bakery", "Swiss Boulangerie"],
    "Neighborhood Grocery": ["Neighborhood Grocery #22", "Neighborhood Grocery", "Neighborhood Grocer"],
    "Corner Store": ["Corner.Store", "Corner Store", "CornerStore"],
    "RentCo": ["LANDLORD PAYMENT", "Rent - Apt 2B", "RENT PAYMENT"],
    "Health Clinic": ["HEALTH CLINIC", "HealthClinic", "Clinic #12"],
    "Pharmacy": ["PHARMACY INC", "Walgreens Pharmacy", "CVS PHARMACY"],
    "Cinema": ["CINEPLEX", "Cinema & Tickets", "MOVIE THEATRE"],
    "Netflix": ["NETFLIX.COM", "Netflix US", "Netflix"],
    "Credit Card": ["CC PAYMENT", "Credit Card Payment", "Card Payment"],
    "LoanService": ["LOAN PAYMENT", "LoanService", "Student Loan"],
    "International Market": ["YEN MART", "EURO SHOP", "Cairo Market"],
    "Office Supplies": ["Office Supplies Co.", "Office Supplies", "OfficeSupplies"],
    "Electro Depot": ["Electro.Depot#100", "Electro Depot", "ElectroDepot"],
    "Asia Imports": ["Asia-Imports Ltd.", "Asia Imports", "AsiaImports"],
    "Target": ["TARGET #112", "TGT 445", "Target Store #112"],
    "Chipotle": ["CHIPOTLE #221", "Chipotle Mexican Grill", "Chipotle"],
    "Whole Foods": ["WHOLEFDS MRKT 10203", "Whole Foods Market", "WHOLE FOODS"],
    "Spotify": ["SPOTIFY  USA", "Spotify", "SPOTIFY"],
    "ExxonMobil": ["EXXONMOBIL 44543354", "Exxon", "EXXON MOBIL"],
}

# ---------------------------------------------------------------------------
# FIXED VALUES — canonical merchant -> category, in source order.
# ("Chipotle" is listed twice in the source; the first position is kept,
# both entries say Food.)
# ---------------------------------------------------------------------------
CATEGORY_MAP: list[tuple[str, str]] = [
    ("Uber", "Transport"),
    ("Lyft", "Transport"),
    ("Starbucks", "Food"),
    ("Chipotle", "Food"),
    ("Swiss Bakery", "Food"),
    ("Whole Foods", "Groceries"),
    ("Walmart", "Groceries"),
    ("Neighborhood Grocery", "Groceries"),
    ("Corner Store", "Groceries"),
    ("Target", "Shopping"),
    ("Amazon", "Shopping"),
    ("Office Supplies", "Office"),
    ("Electro Depot", "Shopping"),
    ("Asia Imports", "Shopping"),
    ("Netflix", "Entertainment"),
    ("Spotify", "Entertainment"),
    ("Starz", "Entertainment"),
    ("Chipotle", "Food"),
    ("Shell", "Fuel"),
    ("ExxonMobil", "Fuel"),
    ("RentCo", "Housing"),
    ("Health Clinic", "Healthcare"),
    ("Pharmacy", "Healthcare"),
    ("Credit Card", "Debt"),
    ("LoanService", "Debt"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — ordered category rules on the lower-cased raw merchant.
# Each body is wrapped as \b( body )\b; the first rule that matches wins.
# ---------------------------------------------------------------------------
CATEGORY_RULES: list[tuple[str, str]] = [
    ("rent|landlord|lease", "Housing"),
    ("atm|withdrawal", "Cash"),
    ("uber|lyft|taxi|cab|ride", "Transport"),
    ("starbuck|coffee|cafe", "Food"),
    ("chipotl|chipotle", "Food"),
    ("whole ?foods|wholefoods|grocery|market|grocer", "Groceries"),
    ("wal-?mart|walmart|supercenter|super ctr|mart", "Groceries"),
    ("target|tgt", "Shopping"),
    ("amzn|amazon|mktp|marketplace", "Shopping"),
    ("shell|exxon|mobil|petrol|gasoline|gas", "Fuel"),
    ("pharmacy|cv s|walgreens|drug", "Healthcare"),
    ("clinic|hospital|health", "Healthcare"),
    ("netflix|spotify|hulu|prime video|itunes|amazon prime", "Entertainment"),
    ("subscription|subscr|membership|prime", "Subscription"),
    ("loan|payment to|loanservice|student loan|cc payment|credit card", "Debt"),
    ("office|supplies|stationery|staples", "Office"),
    ("bakery|boulangerie|bakery", "Food"),
    ("cinema|movie|cineplex|theatre|theater", "Entertainment"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — default FX rates, USD per unit.
# ---------------------------------------------------------------------------
DEFAULT_RATES: list[tuple[str, str]] = [
    ("USD", "1"),
    ("EUR", "1.08"),
    ("GBP", "1.25"),
    ("JPY", "0.007"),
    ("INR", "0.012"),
    ("CAD", "0.74"),
    ("AUD", "0.66"),
    ("ETH", "1800"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES — currency symbols and their codes.  Detection tries the
# symbols longest first, so "CA$" is seen before "A$" (the published list
# tests "A$" first, which reads "CA$5" as AUD; we follow the code map).
# ---------------------------------------------------------------------------
SYMBOL_CURRENCY: list[tuple[str, str]] = [
    ("$", "USD"),
    ("US$", "USD"),
    ("USD$", "USD"),
    ("£", "GBP"),
    ("€", "EUR"),
    ("¥", "JPY"),
    ("￥", "JPY"),
    ("₹", "INR"),
    ("C$", "CAD"),
    ("CA$", "CAD"),
    ("A$", "AUD"),
    ("AU$", "AUD"),
    ("Ξ", "ETH"),
    ("₽", "RUB"),
    ("₩", "KRW"),
    ("₺", "TRY"),
    ("฿", "THB"),
    ("₦", "NGN"),
    ("₫", "VND"),
    ("₴", "UAH"),
    ("₪", "ILS"),
]

# FIXED VALUES — symbol-like currency codes accepted by the FX stage.
CODE_ALIASES: list[tuple[str, str]] = [
    ("$", "USD"),
    ("US$", "USD"),
    ("USD$", "USD"),
    ("C$", "CAD"),
    ("CA$", "CAD"),
    ("A$", "AUD"),
    ("AU$", "AUD"),
    ("Ξ", "ETH"),
]

# FIXED VALUES — currency words searched (as whole words) in the raw text.
CURRENCY_WORDS: list[tuple[str, str]] = [
    ("usd", "USD"),
    ("dollar", "USD"),
    ("dollars", "USD"),
    ("eur", "EUR"),
    ("euro", "EUR"),
    ("euros", "EUR"),
    ("gbp", "GBP"),
    ("pound", "GBP"),
    ("pounds", "GBP"),
    ("inr", "INR"),
    ("rupee", "INR"),
    ("rupees", "INR"),
    ("jpy", "JPY"),
    ("yen", "JPY"),
    ("aud", "AUD"),
    ("cad", "CAD"),
    ("chf", "CHF"),
    ("cny", "CNY"),
    ("rmb", "CNY"),
    ("yuan", "CNY"),
]

# 7 digits before and 10 after the point: 20 + 7 integer digits of a product
# with an amount stay exact.
RATE_TYPE = T.DecimalType(17, 10)
RATE_SQL_TYPE = "decimal(17,10)"


def alias_rows(aliases: dict[str, list[str] | str] | None = None) -> list[tuple[int, str, str]]:
    """Alias dimension as rows ``(choice_idx, canonical, alias)`` in list
    order: each canonical name, then its aliases (a list or a single string)."""
    aliases = MERCHANT_ALIASES if aliases is None else aliases
    rows = []
    for canon, al in aliases.items():
        own = [al] if isinstance(al, str) else al if isinstance(al, (list, tuple)) else []
        rows += [(canon, a) for a in (canon, *own) if isinstance(a, str)]
    return [(i, canon, a) for i, (canon, a) in enumerate(rows)]



def default_rates(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(DEFAULT_RATES, "currency string, rate_text string")
    return rows.select("currency", F.col("rate_text").cast(RATE_TYPE).alias("rate"))


def rates_df(spark: SparkSession, rates: dict[str, object] | None = None) -> DataFrame:
    """Rates table: the caller's rates override the defaults, which fill the
    gaps.  Keys are upper-cased; of keys that then agree the last one counts;
    values that are no number are ignored.  A number that the rate type cannot
    hold raises ``ValueError``: it must not fall back to a default unseen."""
    if not rates:
        return default_rates(spark)
    user: dict[str, str] = {}
    for key, value in rates.items():
        try:
            number = Decimal(str(value))
        except InvalidOperation:
            continue
        if not number.is_finite():
            continue
        if abs(number) >= 10**7 or number != number.quantize(Decimal(1).scaleb(-10)):
            raise ValueError(f"rate {key}={value} does not fit {RATE_SQL_TYPE}")
        user[str(key).upper()] = str(number)
    table = [(c, r) for c, r in user.items()]
    return merge_rates(default_rates(spark), spark.createDataFrame(table, "currency string, rate string"))


def merge_rates(defaults: DataFrame, user: DataFrame) -> DataFrame:
    """``user(currency, rate)`` (rate a number or its text) over
    ``defaults(currency, rate)``: ``(currency, rate, rate_issue)``, one row per
    currency.  Codes are upper-cased and rates that are no number ignored.  A
    table has no last row, so of several rates of a currency the one of the
    greatest ``pos`` counts where the table has such a column, else the greatest
    rate.  A number that the rate type cannot hold makes the rate NULL (never
    the default), with ``rate_out_of_range`` or, beyond 10 decimals,
    ``rate_too_fine``."""
    order = F.col("pos") if "pos" in user.columns else F.lit(0)
    text = F.btrim(F.col("rate").cast("string"))
    read = user.select(
        F.upper("currency").alias("currency"), order.alias("pos"), text.try_cast("double").alias("number"),
        text.try_cast(RATE_SQL_TYPE).alias("held"), text.try_cast("decimal(38,28)").alias("exact"),
    )
    read = read.where(F.col("number").isNotNull() & (F.abs("number") < float("inf")) & F.col("currency").isNotNull())  # NaN is above every number
    held = F.col("held").cast("decimal(38,28)")
    issue = F.when((F.abs("number") >= 1e7) | F.col("held").isNull(), "rate_out_of_range").when((held != F.col("exact")) | ((held == 0) & (F.col("number") != 0)), "rate_too_fine")
    read = read.select("currency", "pos", "number", issue.alias("rate_issue"), F.when(issue.isNull(), F.col("held")).alias("rate"))
    one = read.groupBy("currency").agg(F.max_by(F.struct("rate", "rate_issue"), F.struct("pos", "number", "rate")).alias("one"))
    one = one.select("currency", "one.rate", "one.rate_issue")
    rest = defaults.join(one.select("currency"), "currency", "left_anti").select("currency", "rate", F.lit(None).cast("string").alias("rate_issue"))
    return one.unionByName(rest)
