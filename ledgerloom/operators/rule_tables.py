"""Ordered category rules and map keys held in tables of any size (J5).

``first_rule`` finds for every distinct text the first rule that matches it,
without trying all rules on all texts:

* A rule is entered under literals that its matches must contain (one for each
  branch of an alternation), a literal under one of its grams: of the largest of
  SIZES that fits it, the gram that the fewest texts hold.  So a gram fetches few
  rules however many there are.  Grams are kept as hashes; a text's grams fetch
  its candidate rules, and only those whose literal it contains run their regular
  expression (Java's, as in the list form).
* Rules without a known literal are dealt to slices of about SLICE rules; a
  text meets each slice once and keeps its first match there.
* The least (phase, position) per text wins by aggregation, so neither a list
  of rules nor one of candidates is ever built for a text.

Rules and texts stay in Spark.  An index of up to BROADCAST_KEYS entries (some
60 bytes each) is broadcast after it was counted; a larger one is joined, and
AQE splits a gram that many texts hold.  Grams that no rule asks for are dropped
before any join, where up to GRAM_KEYS (some 30 bytes each) are asked for without
a shuffle.

Defined results: NULL and empty texts have no category; an empty table has no
rules; of rules with one position the one with the smaller pattern is first;
a rule whose category is NULL or '' ends the search with that category; rules
with a NULL pattern, keys that are NULL, are left out.  Of a key that occurs
twice the category written last counts, at the first one's place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ledgerloom.functions.literals import required_literals
from ledgerloom.session import materialize

#: Letters of a gram.
SIZES = (1, 2, 3, 4, 6, 8, 12, 16)
#: Rules without a literal that a text meets at once.
SLICE = 1_000
BROADCAST_KEYS = 200_000
GRAM_KEYS = 1_000_000


@F.pandas_udf(ArrayType(StringType()))
def _literals(patterns: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in patterns:
        yield batch.map(required_literals)


def _grams(text: Column, sizes: Column) -> Column:
    """Hashes of the distinct grams of ``text`` of the sizes in an array column; none where the text is shorter."""
    starts = lambda n: F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.flatten(F.transform(sizes, lambda n: F.transform(starts(n), lambda i: F.xxhash64(F.substring(text, i, n))))))


def unique_keys(category_map: DataFrame) -> DataFrame:
    """``merchant_canonical, category, position`` with one row per key: the last category, the first position."""
    rows = category_map.where("merchant_canonical IS NOT NULL")
    last = F.max(F.struct("position", "category"))["category"]
    return rows.groupBy("merchant_canonical").agg(last.alias("category"), F.min("position").alias("position"))


def _rule_rows(rules: DataFrame, keys: DataFrame) -> DataFrame:
    """``place`` (what the least is taken of), ``category``, ``pattern`` or ``key``, ``literals``."""
    regex = rules.where("pattern IS NOT NULL").select(
        F.struct(F.lit(0).alias("phase"), F.col("position").cast("long").alias("position"), F.col("pattern").alias("text")).alias("place"),
        F.col("category").cast("string").alias("category"),
        F.concat(F.lit(r"(?U)\b("), "pattern", F.lit(r")\b")).alias("pattern"),
        F.lit(None).cast("string").alias("key"),
        _literals("pattern").alias("literals"),
    )
    low = F.lower("merchant_canonical")
    contained = keys.select(
        F.struct(F.lit(1).alias("phase"), F.col("position").cast("long").alias("position"), F.col("merchant_canonical").alias("text")).alias("place"),
        F.col("category").cast("string").alias("category"),
        F.lit(None).cast("string").alias("pattern"),
        low.alias("key"),
        F.when(low != "", F.array(low)).alias("literals"),
    )
    return regex.unionByName(contained).withColumn("rule", F.monotonically_increasing_id())


def _matches(text: Column, pattern: Column, key: Column) -> Column:
    return F.when(pattern.isNotNull(), F.rlike(text, pattern)).otherwise(F.instr(text, key) > 0)


def _sized(df: DataFrame, rows: int, limit: int | None = None) -> DataFrame:
    return F.broadcast(df) if rows <= (BROADCAST_KEYS if limit is None else limit) else df


def _by_literal(texts: DataFrame, rules: DataFrame) -> DataFrame:
    size = F.greatest(*[F.when(F.length("literal") >= n, n) for n in SIZES])
    literal = rules.select("rule", F.explode("literals").alias("literal")).withColumn("size", size)
    own = literal.withColumn("grams", _grams(F.col("literal"), F.array("size")))
    sizes = sorted(r["size"] for r in own.select("size").distinct().collect())
    if not sizes:
        return texts.where("false").select("text", F.lit(None).cast("struct<place:struct<phase:int,position:bigint,text:string>,category:string>").alias("hit"))
    asked = materialize(own.select("rule", "literal", F.size("grams").alias("choice"), F.explode("grams").alias("gram")))
    grams = asked.select("gram").distinct()
    held = texts.select("text", F.explode(_grams(F.col("text"), F.array(*map(F.lit, sizes)))).alias("gram"))
    held = held.join(_sized(grams, grams.count(), GRAM_KEYS), "gram", "left_semi")
    # a gram that no text holds is the rarest of all and fetches the rule for nobody
    several = asked.where("choice > 1")
    several_grams = several.select("gram").distinct()
    seen = held.join(_sized(several_grams, several_grams.count(), GRAM_KEYS), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))["gram"]
    chosen = several.join(seen, "gram", "left").groupBy("rule", "literal").agg(rarest.alias("gram"))
    index = materialize(asked.where("choice = 1").select("rule", "literal", "gram").unionByName(chosen))
    candidates = held.join(_sized(index, index.count()), "gram").where(F.instr("text", F.col("literal")) > 0).select("text", "rule").distinct()
    tried = candidates.join(rules.drop("literals"), "rule").where(_matches(F.col("text"), F.col("pattern"), F.col("key")))
    return tried.select("text", F.struct("place", "category").alias("hit"))


def _without_literal(texts: DataFrame, rules: DataFrame, n_rules: int) -> DataFrame:
    slices = -(-n_rules // SLICE)
    dealt = rules.withColumn("slice", F.pmod(F.xxhash64("rule"), F.lit(slices)).cast("int"))
    lists = dealt.groupBy("slice").agg(F.collect_list(F.struct("place", "category", "pattern", "key")).alias("own"))
    met = texts.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).join(_sized(lists, n_rules), "slice")
    fits = F.filter("own", lambda r: _matches(F.col("text"), r["pattern"], r["key"]))
    hit = F.array_min(F.transform(fits, lambda r: F.struct(r["place"].alias("place"), r["category"].alias("category"))))
    return met.select("text", hit.alias("hit")).where("hit IS NOT NULL")


def first_rule(texts: DataFrame, rules: DataFrame, keys: DataFrame) -> DataFrame:
    """``text, category`` of the texts that a rule or else a key applies to.

    ``texts(text)``: distinct lower-case texts; ``rules(position, pattern, category)``; ``keys`` as
    ``unique_keys`` returns them."""
    texts = materialize(texts.where("text <> ''"))
    table = materialize(_rule_rows(rules, keys))
    known = F.size(F.coalesce("literals", F.array().cast("array<string>"))) > 0
    hits = _by_literal(texts, table.where(known))
    n_rest = table.where(~known).count()
    if n_rest:
        hits = hits.unionByName(_without_literal(texts, table.where(~known), n_rest))
    return hits.groupBy("text").agg(F.min("hit").alias("hit")).select("text", F.col("hit.category").alias("category"))
