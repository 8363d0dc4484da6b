"""S9 alias dimension source: JSON ``{canonical: [aliases] | alias}``.

Parsed on the cluster (``wholetext`` read + ``from_json``), not on the
driver.  A value may be a list or a single string; anything else (a number,
an object, null) adds no alias.  A missing file, or one that is no JSON
object, means "no map": an empty table, with which no merchant resolves.
Other failures (permissions, storage) are raised.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "choice_idx long, canonical string, alias string"


def read_alias_json(spark: SparkSession, path: str) -> DataFrame:
    """``(choice_idx, canonical, alias)`` in file order: each canonical name
    itself, then its aliases."""
    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    # variant values tell a string from a list, which text values would not
    parsed = raw.select(F.from_json("value", "map<string,variant>").alias("m")).where(F.col("m").isNotNull())
    entries = parsed.select(F.posexplode(F.map_entries("m")).alias("canon_pos", "e"))
    kind = F.coalesce(F.schema_of_variant("e.value"), F.lit(""))
    one = F.array(F.try_variant_get("e.value", "$", "string"))
    many = F.filter(F.try_variant_get("e.value", "$", "array<variant>"), lambda x: F.schema_of_variant(x) == "STRING")
    listed = F.transform(many, lambda x: F.try_variant_get(x, "$", "string"))
    own = F.when(kind == "STRING", one).when(kind.startswith("ARRAY"), listed).otherwise(F.array().cast("array<string>"))
    choices = entries.select(
        "canon_pos", F.col("e.key").alias("canonical"), F.posexplode(F.concat(F.array("e.key"), own)).alias("alias_pos", "alias")
    )
    # an array has fewer than 2^31 elements, so positions never run into each other
    idx = F.shiftleft(F.col("canon_pos").cast("long"), 31) + F.col("alias_pos")
    return choices.select(idx.alias("choice_idx"), "canonical", "alias")
