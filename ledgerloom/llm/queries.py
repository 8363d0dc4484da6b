"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    best_fit_packing, byte_bpe, centroid_clustering, embedding_dedup, exact_dedup, fingerprints, near_dedup, sharding, substring_dedup,
    token_blocks, toxicity, url_filters, vector_codes,
)
from ledgerloom.llm.common import read_table
from ledgerloom.session import checkpoint_dir


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/ledgerloom-llm/{uuid.uuid4().hex}-token-blocks"
    token_blocks.write_token_blocks(read_table(spark, sf_dir, "documents"), path)
    return token_blocks.token_digests(spark, path)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_and_decode(read_table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read_table(spark, sf_dir, "documents"), percent=85)


URL_RULES = [
    url_filters.parse_rule(rule)
    for rule in ("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")
]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_report(read_table(spark, sf_dir, "documents"))


SHARDS = 16


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, F.col("doc_id"), [f"shard-{i}" for i in range(SHARDS)])


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read_table(spark, sf_dir, "documents"))


CENTROIDS, CLUSTER_ROUNDS = 40, 5


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster_vectors(read_table(spark, sf_dir, "embeddings"), k=CENTROIDS, rounds=CLUSTER_ROUNDS)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_blocks": op1_token_blocks,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_toxicity": op5_toxicity,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_near_dedup": op7_near_dedup,
    "op8_url_filters": op8_url_filters,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_sharding": op10_sharding,
    "op11_fingerprints": op11_fingerprints,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_vector_codes": op13_vector_codes,
}


def _url_oracle() -> str:
    fits = "(host = {host!r} OR suffix(host, {dot!r})) AND prefix(path, {path!r})"
    rules = " UNION ALL ".join(
        f"SELECT page, {r.name!r} AS rule, {r.verdict!r} AS verdict FROM urls WHERE " + fits.format(host=r.host, dot="." + r.host, path=r.path) for r in URL_RULES
    )
    return f"""
        WITH rest AS (SELECT row_number() OVER () AS page, page_id,
                             CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        urls AS (SELECT page, page_id,
                        translate(regexp_extract(rest, '^[^/?#]*'), '{url_filters.UPPER}', '{url_filters.LOWER}') AS host,
                        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        fitting AS ({rules}),
        best AS (SELECT page, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fitting GROUP BY page)
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (page)"""


_USABLE = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"
_APART = "list_sum(list_transform(list_zip({0}, {1}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
_MEAN = "((s - ((s % n) + n) % n) // n)::BIGINT"  # floor, also of negative sums


def _clustering_oracle() -> str:
    steps = []
    for r in range(CLUSTER_ROUNDS + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (SELECT row, any_value(x.v) AS v, any_value(vec_id) AS vec_id, min(d) AS d, arg_min(cluster, (d, cluster)) AS cluster
              FROM (SELECT row, vec_id, x.v, cluster, {_APART.format("x.v", "c.v")} AS d FROM kept x, c{r} c) x GROUP BY row)""")
        if r < CLUSTER_ROUNDS:
            steps.append(f"""
        c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
              SELECT cluster, list({_MEAN} ORDER BY i) AS v FROM (
                SELECT cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, 65) r(i) GROUP BY cluster, i) GROUP BY cluster) m USING (cluster))""")
    last = CLUSTER_ROUNDS
    return f"""
        WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
              FROM embeddings WHERE len(embedding) = 64 AND {_USABLE}),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS cluster, v FROM kept QUALIFY cluster < {CENTROIDS}),
        {",".join(steps)}
        SELECT vec_id, cluster::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{last} JOIN c{last} c USING (cluster)"""


def _codes_oracle() -> str:
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (SELECT row, part, any_value(v) AS v, min(d) AS d, arg_min(entry, (d, entry)) AS entry
              FROM (SELECT row, part, x.v, entry, {_APART.format("x.v", "c.v")} AS d FROM cut x JOIN c{r} c USING (part)) GROUP BY row, part)""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
              SELECT part, entry, list({_MEAN} ORDER BY i) AS v FROM (
                SELECT part, entry, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, width, range(1, width + 1) r(i) GROUP BY part, entry, i)
              GROUP BY part, entry) m USING (part, entry))""")
    return f"""
        WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label,
                  list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND {_USABLE}),
        width AS (SELECT any_value(len(v)) // {parts} AS width FROM kept),
        cut AS MATERIALIZED (SELECT row, part, v[part * width + 1 : (part + 1) * width] AS v FROM kept, width, range({parts}) r(part)),
        c0 AS MATERIALIZED (SELECT part, row AS entry, v FROM cut WHERE row < {entries}),
        {",".join(steps)},
        coded AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY row)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
        FROM kept JOIN coded USING (row)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": """
            SELECT doc_id,
                   max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                   count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
                   doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents""",
        "op8_url_filters": _url_oracle(),
        "op10_sharding": sharding.oracle("documents", "doc_id", SHARDS, "shard-", sharding.next_prime(sharding.SLOTS_PER_SHARD * SHARDS)),
        "op12_centroid_clustering": _clustering_oracle(),
        "op13_vector_codes": _codes_oracle(),
    }
