"""URL filters (operator 8): rules indexed by their rarest literal token.

A rule names a host and a path (``*`` in a path stands for any characters) and
fits that host and its subdomains where the URL's path begins with the rule's.
Each rule is compiled to a regular expression over host and path.  The literal
tokens of a rule are the labels of its host and the path segments it holds
whole; the token that the fewest URLs have becomes its index key.  A URL's
tokens fetch candidate rules from that index and only those run their regular
expressions.  Rules without a literal token are candidates for every URL.

Defined results: a null url, or one without ``://``, has an empty host and
path and fits no rule that names a host.  The longest fitting rule wins; of
equally long ones a block wins, then the first in alphabetical order.  Without
a fitting rule the verdict is ``default``.  Repeated rows and ids are judged
row by row, null ids too; an empty table gives an empty result; columns other
than id and url are not read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rule indexes of up to so many rules (under 1 KB each) are broadcast; larger ones are joined by shuffle.
BROADCAST_RULES = 20_000
ANY_URL = ""


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        path = ".*".join("\\Q" + p.replace("\\E", "\\E\\\\E\\Q") + "\\E" if p else "" for p in self.path.split("*"))
        host = r"(?:[^/]*\.)?\Q" + self.host + r"\E" if self.host else "[^/]*"
        return rf"(?s)\A{host}{path}"

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that every URL fitting the rule has."""
        whole = [s for s in self.path.split("/")[1:-1] if s and "*" not in s] if self.path.startswith("/") else []
        return sorted({"." + label for label in self.host.split(".") if label} | {"/" + s for s in whole}) or [ANY_URL]


def parse_rule(text: str) -> Rule:
    """``block example.org/es/`` -> Rule."""
    verdict, _, where = text.strip().partition(" ")
    host, slash, path = where.strip().partition("/")
    if verdict not in ("allow", "block"):
        raise ValueError(f"a rule begins with allow or block: {text!r}")
    return Rule(verdict, re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path)


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.name, r.verdict, r.regex, r.tokens) for r in dict.fromkeys(rules)]
    return spark.createDataFrame(rows, "rule string, rule_verdict string, regex string, tokens array<string>")


def _host(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"\A[^/?#]*", 0), UPPER, LOWER)


def _path(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"\A[^/?#]*([^?#]*)", 1)


def _tokens(host: Column, path: Column) -> Column:
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("."), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("/"), x))
    return F.array_distinct(F.concat(labels, segments, F.array(F.lit(ANY_URL))))


def judge_urls(pages: DataFrame, rules: list[Rule] | DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict."""
    spark = pages.sparkSession
    rules = rules if isinstance(rules, DataFrame) else rules_table(spark, rules)
    few = rules.count() <= BROADCAST_RULES
    sized = F.broadcast if few else lambda df: df
    urls = pages.select(F.col(id_col).alias("id"), _host(F.col(url_col)).alias("host"), _path(F.col(url_col)).alias("path"))
    urls = urls.withColumn("row", F.monotonically_increasing_id())
    tokens = urls.select("*", F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))

    literal = rules.select("*", F.explode("tokens").alias("token")).drop("tokens")
    frequency = tokens.select("token").join(sized(literal.select("token").distinct()), "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    rarest = F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("token")
    index = literal.join(frequency, "token", "left").groupBy("rule", "rule_verdict", "regex").agg(rarest)

    candidates = tokens.join(sized(index), "token", "left")
    fits = F.coalesce(F.expr("concat(host, path) rlike regex"), F.lit(False))
    order = F.struct(-F.length("rule"), F.col("rule_verdict") == "allow", "rule")
    best = F.min_by(F.struct("rule", "rule_verdict"), F.when(fits, order)).alias("best")
    judged = candidates.groupBy("row", "id", "host", "path").agg(best)
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))
