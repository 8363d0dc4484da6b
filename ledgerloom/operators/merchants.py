"""J4 resolve_merchants: raw merchant text -> canonical merchant.

One lazy plan over the *distinct* merchant strings, then one join back:

  clean      NFKC (Arrow, sees non-ASCII strings only) + native regex chain
  exact      equi-join with the alias table (last writer wins on duplicates)
  fuzzy      the rest against all choices in one Arrow function: best
             token-set score, first choice on ties, final score the best of
             token-set / partial / token-sort for that choice, rounded
  aggressive in the same function: a string below the threshold is searched
             again in its aggressively cleaned form
  vector     optional: caller-supplied vectors, cosine top-1 over a cutoff
  rest       ``low_confidence`` with the best score seen

``fallback="substring"`` replaces the scored stages by the first choice that
contains or is contained in the string (fixed score 75).

The alias table is counted first.  Up to SLICE choices (some hundred bytes
each) go to the Arrow functions as one broadcast, and the plan is lazy.  A
larger table never leaves Spark: choices are dealt to slices and strings to
blocks, every (slice, block) is one bounded group that is searched exactly, and
the greatest result per string is the answer.  Either way a search scores a
whole batch of strings at once (``functions.batch_fuzzy``,
``functions.containment``).  An empty alias table is "no map".

Result tags: ``empty_merchant``, ``no_merchant_map``, ``fuzzy_matched``,
``aggressive_fuzzy_matched``, ``embedding_matched``, ``low_confidence``,
``substring_matched``, ``no_match``; exact matches carry none.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.batch_fuzzy import Choices, combined_scores
from ledgerloom.functions.common import strip_ws
from ledgerloom.functions.containment import Patterns
from ledgerloom.functions.text import aggressive_clean_expr, clean_merchant_expr, is_ascii, nfkc
from ledgerloom.session import materialize
from ledgerloom.sources import dims

DEFAULT_THRESHOLD = 85
SUBSTRING_SCORE = 75
#: Choices that one search holds; an alias table of up to so many is broadcast.
SLICE = 20_000
#: Strings that one search of a larger table holds.
BLOCK = 20_000


# --------------------------------------------------------------------------- cleaning
def nfkc_normalize(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add ``out`` = NFKC(col).  ASCII is NFKC-normal, so the Arrow function
    sees only the other strings (NULL in place of ASCII ones)."""
    c = F.col(col)
    return df.withColumn(out, F.coalesce(nfkc(F.when(~is_ascii(c), c)), c))


def clean_distinct(df: DataFrame, col: str, out: str = "cleaned") -> DataFrame:
    """Distinct values of ``col`` with their cleaned form."""
    d = df.select(F.col(col).alias("_raw")).distinct()
    d = nfkc_normalize(d, "_raw", "_norm")
    return d.select(F.col("_raw").alias(col), clean_merchant_expr(F.col("_norm")).alias(out))


def prepare_choices(spark: SparkSession, aliases=None) -> DataFrame:
    """Alias dimension -> ``(choice_idx, alias_clean, canonical)``.

    ``aliases`` is a dict ``{canonical: [aliases]}`` (default: built-in map)
    or a DataFrame ``(choice_idx, canonical, alias)``; an empty one means "no
    map".  Choices whose cleaned form is empty are dropped.  A dict is a
    literal table built on the driver, so its NFKC step is applied to the
    literals themselves; a DataFrame goes through the Arrow function.

    ``canonical`` is the one that wrote the cleaned text last, in list order:
    a text that two canonicals share means the later one in every stage.
    """
    if aliases is None or isinstance(aliases, dict):
        rows = [(idx, canon, unicodedata.normalize("NFKC", alias)) for idx, canon, alias in dims.alias_rows(aliases)]
        raw = spark.createDataFrame(rows, "choice_idx long, canonical string, _norm string")
    else:
        raw = aliases.select(F.col("choice_idx").cast("long"), "canonical", "alias")
        raw = nfkc_normalize(raw, "alias", "_norm")
    out = raw.select("choice_idx", clean_merchant_expr(F.col("_norm")).alias("alias_clean"), "canonical")
    out = out.where(F.col("alias_clean") != "")
    last = out.groupBy("alias_clean").agg(F.max_by("canonical", "choice_idx").alias("canonical"))
    return out.drop("canonical").join(last, "alias_clean").select("choice_idx", "alias_clean", "canonical")


_DEFAULT_INDEX: dict[tuple, "ChoiceIndex"] = {}


def default_index(spark: SparkSession) -> "ChoiceIndex":
    """The built-in alias map, prepared once per session (96 rows)."""
    key = (id(spark), spark.sparkContext.applicationId)
    if key not in _DEFAULT_INDEX:
        _DEFAULT_INDEX[key] = ChoiceIndex(prepare_choices(spark))
    return _DEFAULT_INDEX[key]


# --------------------------------------------------------------------------- scoring
# ordered so that the greatest struct is the best: score, then the first in list order
_BEST = "set_score double, neg_idx long, choice string, canonical string, score int"
_FIRST = "neg_idx long, canonical string"
#: (choice_idx, alias_clean, canonical) in list order -> a function from texts to one result row each
Search = Callable[[list[str]], list[tuple]]


def _scoring(rows: list[tuple[int, str, str]]) -> Search:
    """Best choice by token-set score with its combined score (``_BEST``)."""
    table = Choices([choice for _, choice, _ in rows])

    def search(texts: list[str]) -> list[tuple]:
        place, set_scores = table.best(texts)
        found = [rows[i] for i in place.tolist()]
        scores = combined_scores(texts, [choice for _, choice, _ in found], set_scores)
        return [(s, -idx, choice, canonical, score) for s, (idx, choice, canonical), score in zip(set_scores.tolist(), found, scores)]

    return search


def _containing(rows: list[tuple[int, str, str]]) -> Search:
    """First choice that contains the text or is contained in it (``_FIRST``)."""
    table = Patterns([choice for _, choice, _ in rows])

    def search(texts: list[str]) -> list[tuple]:
        return [(None, None) if i is None else (-rows[i][0], rows[i][2]) for i in map(table.first, texts)]

    return search


def _column_search(spark: SparkSession, rows: list[tuple[int, str, str]], prepare: Callable[[list], Search], kind: str):
    """Arrow function: text -> result of a search of all choices; NULL fields for NULL.
    The choices are prepared once per task."""
    shared = spark.sparkContext.broadcast(rows)
    names = [field.split()[0] for field in kind.split(", ")]

    @F.pandas_udf(kind)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        search = prepare(shared.value)
        for texts in batches:
            given = texts.notna()
            found = pd.DataFrame([(None,) * len(names)] * len(texts), columns=names, index=texts.index, dtype=object)
            if given.any():
                found.loc[given] = pd.DataFrame(search(texts[given].tolist()), columns=names, index=texts.index[given], dtype=object)
            yield found

    return find.asNondeterministic()  # as ``nfkc``: stays above the distinct texts, once per text


class ChoiceIndex:
    """The alias choices, prepared once per job."""

    def __init__(self, choices: DataFrame, slice_size: int = SLICE):
        spark = choices.sparkSession
        rows = [tuple(r) for r in choices.select("choice_idx", "alias_clean", "canonical").limit(slice_size + 1).collect()]
        self.small, self.slice_size = len(rows) <= slice_size, slice_size
        if self.small:
            rows.sort()
            self.n = len(rows)
            self.choices = spark.createDataFrame(rows, "choice_idx long, alias_clean string, canonical string")
            self._scorer = _column_search(spark, rows, _scoring, _BEST)
            self._container = _column_search(spark, rows, _containing, _FIRST)
        else:
            self.choices = materialize(choices.select("choice_idx", "alias_clean", "canonical"))
            self.n = self.choices.count()
        self.exact = self._sized(self.choices.select("alias_clean", "canonical").distinct())

    def empty(self) -> bool:
        return self.n == 0

    def _sized(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    def with_best(self, df: DataFrame, text: Column, out: str) -> DataFrame:
        """``df`` with the struct ``out`` (``_BEST``): the best choice for ``text``; NULL for NULL."""
        return df.withColumn(out, self._scorer(text)) if self.small else self._joined(df, text, out, _scoring, _BEST)

    def with_first_containing(self, df: DataFrame, text: Column, out: str) -> DataFrame:
        return df.withColumn(out, self._container(text)) if self.small else self._joined(df, text, out, _containing, _FIRST)

    def _joined(self, df: DataFrame, text: Column, out: str, prepare: Callable[[list], Search], kind: str) -> DataFrame:
        df = df.withColumn("_text", text)
        texts = df.select("_text").where("_text IS NOT NULL").distinct()
        slices, blocks = -(-self.n // self.slice_size), max(1, -(-texts.count() // BLOCK))
        dealt = texts.select("_text", F.pmod(F.xxhash64("_text"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
        own_slice = F.pmod(F.xxhash64("choice_idx"), F.lit(slices)).cast("int").alias("slice")
        choices = self.choices.select("*", own_slice, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

        def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            names = ["_text", *(field.split()[0] for field in kind.split(", "))]
            if left.empty or right.empty:
                return pd.DataFrame(columns=names)
            rows = sorted(zip(right["choice_idx"].tolist(), right["alias_clean"], right["canonical"]))
            texts = left["_text"].tolist()
            found = [(t, *r) for t, r in zip(texts, prepare(rows)(texts)) if r[-1] is not None]
            return pd.DataFrame(found, columns=names)

        found = dealt.groupBy("slice", "block").cogroup(choices.groupBy("slice", "block")).applyInPandas(search, f"_text string, {kind}")
        fields = [field.split()[0] for field in kind.split(", ")]
        best = found.groupBy("_text").agg(F.max(F.struct(*fields)).alias(out))
        return df.join(best.withColumnRenamed("_text", "_found"), F.col("_text") == F.col("_found"), "left").drop("_text", "_found")


# --------------------------------------------------------------------------- stages
def _out(df: DataFrame, canonical, score, issue: str, stage: str) -> DataFrame:
    return df.select(
        "key",
        F.lit(canonical).cast("string").alias("merchant_canonical") if canonical is None else canonical.alias("merchant_canonical"),
        score.cast("int").alias("merchant_score"),
        F.lit(issue).cast("string").alias("issue"),
        F.lit(stage).alias("match_stage"),
    )


def resolve_keys(
    keys: DataFrame,
    index: ChoiceIndex,
    *,
    threshold: int = DEFAULT_THRESHOLD,
    fallback: str = "fuzzy",
    vectors: tuple[DataFrame, DataFrame] | None = None,
    vector_cutoff: float = 0.72,
) -> DataFrame:
    """Resolve distinct cleaned strings ``keys(key)``.  Returns one row per
    key: ``key, merchant_canonical, merchant_score, issue, match_stage``."""
    keys = keys.select("key").distinct()
    if index.empty():
        return _out(keys, None, F.lit(0), "no_merchant_map", "no_map")
    exact = index.exact.select(F.col("alias_clean").alias("_alias"), F.col("canonical").alias("can0"))
    r = keys.join(exact, F.col("key") == F.col("_alias"), "left").drop("_alias")
    is_exact = F.col("can0").isNotNull()
    rest = F.when(~is_exact, F.col("key"))

    if fallback == "substring":
        r = index.with_first_containing(r, rest, "hit")
        found = F.col("hit.canonical").isNotNull()
        return r.select(
            "key",
            F.coalesce("can0", "hit.canonical").alias("merchant_canonical"),
            F.when(is_exact, 100).when(found, SUBSTRING_SCORE).otherwise(0).alias("merchant_score"),
            F.when(is_exact, None).when(found, "substring_matched").otherwise("no_match").alias("issue"),
            F.when(is_exact, "exact").when(found, "substring").otherwise("none").alias("match_stage"),
        )

    r = index.with_best(r.withColumn("aggr", aggressive_clean_expr(F.col("key"))), rest, "one")
    weak = F.col("one.score") < threshold
    r = index.with_best(r, F.when(weak & (F.col("aggr") != "") & (F.col("aggr") != F.col("key")), F.col("aggr")), "two")
    ok1 = F.col("one.score") >= threshold
    ok2 = F.coalesce(F.col("two.score") >= threshold, F.lit(False))
    low_score = F.greatest("one.score", "two.score")
    r = r.select(
        "key",
        "aggr",
        F.when(is_exact, F.col("can0")).when(ok1, F.col("one.canonical")).when(ok2, F.col("two.canonical")).alias("merchant_canonical"),
        F.when(is_exact, 100).when(ok1, F.col("one.score")).when(ok2, F.col("two.score")).otherwise(low_score).alias("merchant_score"),
        F.when(is_exact, None).when(ok1, "fuzzy_matched").when(ok2, "aggressive_fuzzy_matched").otherwise("low_confidence").alias("issue"),
        F.when(is_exact, "exact").when(ok1, "fuzzy").when(ok2, "aggressive").otherwise("unresolved").alias("match_stage"),
    )
    if vectors is not None:
        r = _vector_stage(r, index, vectors, vector_cutoff)
    return r.drop("aggr")


def _vector_stage(r: DataFrame, index: ChoiceIndex, vectors, cutoff: float) -> DataFrame:
    """Cosine top-1 of caller-supplied vectors for still-unresolved strings:
    ``vectors = (text_vecs(text, vec), choice_vecs(choice_idx, vec))``.  The
    query is the aggressive form when it is non-empty, else the string."""
    from ledgerloom.operators.vectors import nearest

    text_vecs, choice_vecs = vectors
    un = r.where(F.col("match_stage") == "unresolved")
    q = un.select("key", F.when(F.col("aggr") != "", F.col("aggr")).otherwise(F.col("key")).alias("text"))
    q = q.join(text_vecs.select("text", "vec"), "text")
    best = nearest(q.select("key", "vec"), choice_vecs.select(F.col("choice_idx").alias("ref_id"), "vec"), "key")
    names = index._sized(index.choices.select(F.col("choice_idx").alias("ref_id"), "canonical"))
    best = best.join(names, "ref_id", "left")
    hit = best.where(F.col("cos") >= cutoff).select(
        "key", F.col("canonical").alias("vcan"), F.bround(F.col("cos") * 100, 0).cast("int").alias("vscore")
    )
    r = r.join(hit, "key", "left")
    v = (F.col("match_stage") == "unresolved") & F.col("vscore").isNotNull()
    return r.select(
        "key",
        "aggr",
        F.when(v, F.col("vcan")).otherwise(F.col("merchant_canonical")).alias("merchant_canonical"),
        F.when(v, F.col("vscore")).otherwise(F.col("merchant_score")).alias("merchant_score"),
        F.when(v, "embedding_matched").otherwise(F.col("issue")).alias("issue"),
        F.when(v, "vector").otherwise(F.col("match_stage")).alias("match_stage"),
    )


def resolve_distinct(
    df: DataFrame,
    merchant_col: str = "merchant",
    *,
    aliases=None,
    threshold: int = DEFAULT_THRESHOLD,
    fallback: str = "fuzzy",
    slice_size: int = SLICE,
    vectors=None,
) -> DataFrame:
    """One row per distinct raw merchant: ``merchant_col, merchant_cleaned,
    merchant_canonical, merchant_score, merchant_issues, match_stage``."""
    spark = df.sparkSession
    if aliases is None and slice_size == SLICE:
        index = default_index(spark)
    else:
        index = ChoiceIndex(prepare_choices(spark, aliases), slice_size)
    cleaned = clean_distinct(df, merchant_col, "merchant_cleaned")
    raw = F.col(merchant_col)
    is_empty = raw.isNull() | (strip_ws(raw) == "")
    nonempty = cleaned.where(~is_empty)
    resolved = resolve_keys(
        nonempty.select(F.col("merchant_cleaned").alias("key")), index, threshold=threshold, fallback=fallback, vectors=vectors
    )
    found = nonempty.join(resolved, nonempty.merchant_cleaned == resolved.key, "left").drop("key")
    empty = cleaned.where(is_empty).select(
        merchant_col,
        "merchant_cleaned",
        F.lit(None).cast("string").alias("merchant_canonical"),
        F.lit(0).alias("merchant_score"),
        F.lit("empty_merchant").alias("issue"),
        F.lit("empty").alias("match_stage"),
    )
    out = found.unionByName(empty)
    return out.select(
        merchant_col,
        "merchant_cleaned",
        "merchant_canonical",
        "merchant_score",
        F.when(F.col("issue").isNull(), F.array().cast("array<string>"))
        .otherwise(F.array(F.col("issue")))
        .alias("merchant_issues"),
        "match_stage",
    )


def resolve_merchants(df: DataFrame, merchant_col: str = "merchant", **kw) -> DataFrame:
    """Row-level: ``df`` plus the resolution columns, joined back on the raw
    string (NULL-safe).  AQE picks broadcast or sort-merge for the join back
    from the measured size of the distinct table, and splits skewed keys."""
    res = resolve_distinct(df, merchant_col, **kw).withColumnRenamed(merchant_col, "_m_raw")
    joined = df.join(res, df[merchant_col].eqNullSafe(res["_m_raw"]), "left")
    return joined.drop("_m_raw")
