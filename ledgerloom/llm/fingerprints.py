"""Document fingerprints (operator 11, native): consistent weighted sampling.

A text is a bag of weighted terms: its pairs of adjacent words (words are
``[^\\x20\\x09-\\x0D]+``; a text of one word has that word as its term), each
weighted by its number of occurrences.  For every sample, a term of weight w
draws from hashes of (term, sample) alone r and c from Gamma(2, 1) and b
uniform in [0, 1), and then

    step = floor(ln w / r + b)      a = c * exp(-r * (step - b) - r)

The term with the least a gives the sample (term, step).  Two texts agree on a
sample with probability sum(min(w1, w2)) / sum(max(w1, w2)), the generalised
Jaccard similarity.  A fingerprint keeps 16 bits of each of SAMPLES samples;
the likeness of two fingerprints is the share of equal samples.

The gamma variables are made of exponential ones so that the frequent case
costs one hash: with E1, E2, F1, F2 ~ Exp(1), r = E1 + E2, b = E1 / r and
c = F1 + F2, where exp(-E2) = F1 / c is uniform and independent of c.  Then
a = F1 * exp(-r * step), which is F1 itself for weight 1 (step 0).  Samples are
ordered by 1 - exp(-a), so F1 is needed as a uniform number only.

Everything is DataFrame functions.  Terms are counted inside the row (sorted
hashes), so no term is ever shuffled; a term with equal weight in a text and
its edited text is drawn once for both; the least a of a sample is a hash
aggregation over longs that hold (1 - exp(-a), sample).  Texts are shuffled
once, to meet their neighbour's first characters.

The order of documents is descending doc_id (null last; documents of one id by
a hash of the text), found on (id, hash, length) rows only: range partitions,
a window inside each, and the partitions' last rows, as many as there are
partitions, to link one with the next.

Defined results: a null text is empty.  Rows equal in doc_id and text are one
document in that order and share one result, given once per row.  A text
without words has the fingerprint "", which is like another such fingerprint
(1.0) and unlike all others (0.0).  A single document is its own next one.
Empty table, empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged

SAMPLES = 64
#: Samples that one row draws for a term of weight 1.
TOGETHER = 8
#: Bits of a code: a term's hash, then its weight less 1.
TERM_BITS, WEIGHT_BITS = 40, 23
#: Bits of 1 - exp(-a) in a sample, then of its name.
LEVEL_BITS, NAME_BITS = 44, 16
BLANKS = " \t\n\x0b\x0c\r"
NAME_MASK = (1 << NAME_BITS) - 1
WEIGHT_MASK = (1 << WEIGHT_BITS) - 1


def with_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replaces each text column by one code (hash, weight) per distinct term.
    Every step is a projection of its own: what a step uses often is computed once."""
    rest = [c for c in df.columns if c not in columns]

    def step(df: DataFrame, keep: str, made: Callable[[str], dict[str, Column]]) -> DataFrame:
        old = [f"{c}{suffix}" for c in columns for suffix in keep.split()]
        return df.select(*rest, *old, *(expr.alias(f"{c}{suffix}") for c in columns for suffix, expr in made(c).items()))

    least_one = lambda n: F.greatest(n, F.lit(1))
    term = lambda a, b: F.shiftleft(F.shiftrightunsigned(F.xxhash64(a, b), 64 - TERM_BITS), WEIGHT_BITS)
    words = lambda c: F.split(F.btrim(F.col(c), F.lit(BLANKS)), f"[{BLANKS}]+")
    pairs = lambda w: F.zip_with(F.slice(w, 1, least_one(F.size(w) - 1)), F.slice(w, 2, least_one(F.size(w) - 1)), term)
    no_codes = F.array().cast("array<long>")

    df = step(df, "", lambda c: {"_w": words(c)})
    df = step(df, "", lambda c: {"_t": F.when((F.size(f"{c}_w") == 1) & (F.get(f"{c}_w", F.lit(0)) == ""), no_codes).otherwise(F.sort_array(pairs(f"{c}_w")))})
    # repeats: every occurrence of a term but its first, sorted like the terms
    df = step(df, "_t", lambda c: {"_r": F.filter(f"{c}_t", lambda x, i: x == F.get(f"{c}_t", i - 1))})
    at = lambda r, i: F.get(f"{r}_r", i)
    df = step(df, "_t _r", lambda c: {"_s": F.filter(F.transform(f"{c}_r", lambda x, i: F.when((i == 0) | (x != at(c, i - 1)), i)), lambda i: i.isNotNull())})
    df = step(df, "_t _r _s", lambda c: {"_e": F.when(F.size(f"{c}_s") > 0, F.concat(F.slice(f"{c}_s", 2, least_one(F.size(f"{c}_s"))), F.array(F.size(f"{c}_r"))))})
    heavier = lambda c: F.zip_with(f"{c}_s", f"{c}_e", lambda s, e: at(c, s).bitwiseOR(F.least(e - s, F.lit(WEIGHT_MASK)).cast("long")))
    lighter = lambda c: F.array_except(F.array_distinct(f"{c}_t"), f"{c}_r")
    return step(df, "", lambda c: {"": F.when(F.size(f"{c}_r") > 0, F.concat(lighter(c), heavier(c))).otherwise(F.col(f"{c}_t"))})


def _open_unit(bits: Column, count: int) -> Column:
    """A number of ``count`` bits as one strictly between 0 and 1."""
    return (bits.cast("double") + 0.5) * F.lit(2.0**-count)


def _level(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - LEVEL_BITS)


def _packed(level: Column, name: Column) -> Column:
    return F.shiftleft(level, NAME_BITS).bitwiseOR(name)


def draws(dealt: DataFrame, rest: list[str], samples: int) -> DataFrame:
    """``rest`` and ``code`` -> ``rest``, ``run`` (of TOGETHER samples) and the draws d0, d1, ...
    A term of weight 1 gives a row per run, a heavier one a row per sample with one draw."""
    runs = samples // TOGETHER
    light = F.col("code").bitwiseAND(WEIGHT_MASK) == 0
    slots = F.when(F.col("code").isNull(), F.array(F.lit(0))).when(light, F.array(*map(F.lit, range(runs)))).otherwise(F.array(*map(F.lit, range(runs, runs + samples))))
    df = dealt.select(*rest, "code", F.explode(slots).alias("slot"))
    term, heavy = F.shiftright("code", WEIGHT_BITS), F.col("slot") >= runs
    sample = F.when(heavy, F.col("slot") - runs)
    df = df.select(
        *rest, term.alias("term"), term.bitwiseAND(NAME_MASK).alias("name"), sample.alias("sample"), F.when(heavy, F.floor(sample / TOGETHER).cast("int")).otherwise(F.col("slot")).alias("run"),
        F.when(heavy, F.ln(F.col("code").bitwiseAND(WEIGHT_MASK).cast("double") + 1.0)).alias("ln_w"),
    )
    df = df.select("*", F.when(F.col("sample").isNotNull(), _level(F.xxhash64("term", "sample"))).alias("level"), F.when(F.col("sample").isNotNull(), F.xxhash64("term", F.bitwise_not("sample"))).alias("h"))
    exponential = lambda bits: -F.ln(_open_unit(bits, 32))
    df = df.select("*", (-F.log1p(-_open_unit(F.col("level"), LEVEL_BITS))).alias("f1"), exponential(F.shiftrightunsigned("h", 32)).alias("e1"))
    df = df.select("*", (F.col("e1") + F.log1p(exponential(F.col("h").bitwiseAND(0xFFFFFFFF)) / F.col("f1"))).alias("r"))
    df = df.select("*", F.floor((F.col("ln_w") + F.col("e1")) / F.col("r")).alias("step"))
    nearer = F.least(F.floor(-F.expm1(-F.col("f1") * F.exp(-F.col("r") * F.col("step"))) * F.lit(float(1 << LEVEL_BITS))), F.lit((1 << LEVEL_BITS) - 1))
    stepped = (F.col("name") + F.col("step") * 40503).bitwiseAND(NAME_MASK)
    df = df.select(*rest, "term", "name", "sample", "run", _packed(F.when(F.col("step") == 0, F.col("level")).otherwise(nearer), stepped).alias("heavy"))
    one = lambda i: F.when(F.col("sample") == F.col("run") * TOGETHER + i, F.col("heavy")).when(
        F.col("sample").isNull() & F.col("term").isNotNull(), _packed(_level(F.xxhash64("term", F.col("run") * TOGETHER + i)), F.col("name"))
    )
    return df.select(*rest, "run", *(one(i).alias(f"d{i}") for i in range(TOGETHER)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; an empty fingerprint is like empty ones only."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(equal / F.size(a).cast("double"))


def hex_text(samples: Column) -> Column:
    return F.lower(F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(NAME_MASK)), NAME_BITS // 4, "0")), ""))


def pair_fingerprints(texts: DataFrame, keys: list[str], one: str, two: str, samples: int = SAMPLES) -> DataFrame:
    """``keys`` (their values tell rows apart), and the samples of both texts of a row as
    arrays of 16-bit numbers, ``fp_one`` and ``fp_two``."""
    if samples % TOGETHER or samples < TOGETHER:
        raise ValueError(f"samples is a multiple of {TOGETHER}")
    weighted = with_codes(texts.select(*keys, F.col(one).alias("one"), F.col(two).alias("two")), ["one", "two"])
    sides = F.array_intersect("one", "two"), F.array_except("one", "two"), F.array_except("two", "one")  # 0: in both, 1: in the first, 2: in the second
    dealt = weighted.select(*keys, F.inline(F.array(*(F.struct(F.lit(i).alias("side"), c.alias("codes")) for i, c in enumerate(sides)))))
    drawn = draws(dealt.select(*keys, "side", F.explode_outer("codes").alias("code")), [*keys, "side"], samples)
    least = drawn.groupBy(*keys, "side", "run").agg(*(F.min(f"d{i}").alias(f"d{i}") for i in range(TOGETHER)))
    run = F.struct("side", "run", F.array(*(f"d{i}" for i in range(TOGETHER))).alias("least")).alias("runs")
    per_row = least.select(*keys, run).groupBy(*keys).agg(F.sort_array(F.collect_list("runs")).alias("runs"))  # 3 sides x samples / TOGETHER runs at most

    def of_side(side: int) -> Column:
        own = F.flatten(F.transform(F.filter("runs", lambda x: x["side"] == side), lambda x: x["least"]))
        return F.when(F.size(own) == samples, own)  # else the side has no terms: one run of nulls

    per_row = per_row.select(*keys, *(of_side(i).alias(f"s{i}") for i in range(3)))

    def merged(side: str) -> Column:
        lesser = F.coalesce(F.zip_with("s0", side, lambda a, b: F.least(a, b)), F.col("s0"), F.col(side), F.array().cast("array<long>"))
        return F.transform(lesser, lambda x: F.shiftright(F.shiftleft(x, 64 - NAME_BITS), 64 - NAME_BITS).cast("short"))

    return per_row.select(*keys, merged("s1").alias("fp_one"), merged("s2").alias("fp_two"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(absent, id, mark, text): whether the id is null, the id or 0, a hash of text and absence."""
    text, absent = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).isNull()
    return docs.select(absent.alias("absent"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.xxhash64(absent, text).alias("mark"), text.alias("text"))


def document_order(docs: DataFrame) -> DataFrame:
    """Of every document (``keyed``): id, mark, copies, and ``before``, the document before it."""
    order = [F.col("absent"), F.col("id").desc(), F.col("mark")]
    slim = docs.groupBy("absent", "id", "mark").agg(F.count(F.lit(1)).alias("copies"), F.max(F.length("text")).alias("n_chars"))
    slim = staged(slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order")
    last = F.max(F.struct("absent", F.bitwise_not("id").alias("down"), "mark", "n_chars", "copies"))
    ends = sorted(slim.groupBy("part").agg(last.alias("last")).collect())  # one row per range partition
    kind = "struct<absent: boolean, id: long, mark: long, n_chars: int, copies: long>"
    ahead = [(e["part"], (lambda x: (x["absent"], ~x["down"], x["mark"], x["n_chars"], x["copies"]))(ends[i - 1]["last"])) for i, e in enumerate(ends)]
    ahead = docs.sparkSession.createDataFrame(ahead, f"part int, ahead {kind}")
    preceding = F.lag(F.struct("absent", "id", "mark", "n_chars", "copies")).over(Window.partitionBy("part").orderBy(*order))
    near = slim.withColumn("before", preceding).join(F.broadcast(ahead), "part")  # one row per range partition
    return near.select("id", "mark", F.coalesce("before", "ahead").alias("before"))


def edited_texts(docs: DataFrame) -> DataFrame:
    """``docs`` (``keyed``) -> one row per document: absent, id, mark, copies, n_chars, text,
    edited, next_id, next_mark."""
    own = Window.partitionBy("id", "mark").orderBy("mark")
    order, docs = document_order(docs), docs.select("id", "mark", "text")  # the same columns in both joins: one exchange serves both
    givers = docs.join(order.hint("merge"), ["id", "mark"]).withColumn("nth", F.row_number().over(own)).where("nth = 1")
    given = givers.select(
        F.col("before.id").alias("id"), F.col("before.mark").alias("mark"), F.col("before.copies").alias("copies"), F.col("before.n_chars").alias("n_chars"), F.col("before.absent").alias("absent"),
        F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.substring("text", F.lit(1), F.floor(F.col("before.n_chars") / 3).cast("int")).alias("given"),
    )
    takers = docs.join(given.hint("merge"), ["id", "mark"]).withColumn("nth", F.row_number().over(own)).where("nth = 1")
    left = F.col("n_chars") - F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), left), "given")
    return takers.select("absent", "id", "mark", "copies", "n_chars", "text", edited.alias("edited"), "next_id", "next_mark")


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    texts = edited_texts(keyed(docs, id_col, text_col)).withColumn("edited_sha256", F.unhex(F.sha2("edited", 256)))
    facts = ["id", "mark", "absent", "copies", "n_chars", "next_id", "next_mark", "edited_sha256"]
    prints = staged(pair_fingerprints(texts, facts, "text", "edited", samples), "fingerprints")
    following = prints.select(F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("fp_one").alias("fp_next"))
    rows = prints.join(following, ["next_id", "next_mark"])
    result = rows.select(
        F.when(~F.col("absent"), F.col("id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        hex_text(F.col("fp_one")).alias("fingerprint"), hex_text(F.col("fp_two")).alias("edited_fingerprint"),
        likeness(F.col("fp_one"), F.col("fp_two")).alias("near_edited"), likeness(F.col("fp_one"), F.col("fp_next")).alias("near_next"), "copies",
    )
    return result.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("nth")).drop("copies", "nth")
