"""The registered queries of the text operators, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.llm import bpe, centroids, chat, exact_dedup, language, licenses, line_dedup, packing, quality, simhash, tokenfile, topk, variants
from veil.llm.common import table
from veil.plans.tables import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


@_query(
    """WITH v AS (
           SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
       s AS (
           SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
           FROM v AS q JOIN v ON q.vec_id <> v.vec_id
           WHERE q.vec_id % 100 = 0)
       SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
       FROM s
       WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
       QUALIFY rank <= 10"""
)
def op1_topk_maxscore(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@_query()
def op2_license_scan(spark, sf):
    return licenses.license_scan(table(spark, sf, "documents"))


@_query()
def op3_best_fit_packing(spark, sf):
    return packing.best_fit_packing(table(spark, sf, "documents"))


@_query()
def op4_simhash_dedup(spark, sf):
    return simhash.simhash_dedup(table(spark, sf, "documents"))


@_query()
def op5_prefix_bpe(spark, sf):
    rows = bpe.bpe_round_trip(table(spark, sf, "documents"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query()
def op6_quality_cotraining(spark, sf):
    return quality.quality_classifier(table(spark, sf, "documents"), table(spark, sf, "labels"))


@_query()
def op7_line_dedup(spark, sf):
    cleaned = line_dedup.line_dedup(table(spark, sf, "documents"), min_words=1)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return cleaned.select("doc_id", "n_lines", "n_removed", digest.alias("text_sha256"))


@_query()
def op8_language_id(spark, sf):
    return language.identify_language(table(spark, sf, "documents"))


@_query(
    r"""WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t
        WINDOW w AS (PARTITION BY text_sha256)"""
)
def op9_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


@_query()
def op10_token_files(spark, sf):
    path = f"{scratch_folder(spark)}/veil-llm/token-files-{uuid.uuid4().hex}"
    tokenfile.write_token_files(table(spark, sf, "documents"), path)
    return tokenfile.read_token_files(spark, path)


_MARKED = "(?:[<\\[])(?:\\\\*)(?:" + chat.ESCAPED.rsplit("(", 1)[1]


@_query(
    f"""WITH t AS (
           SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
       SELECT conv_id, count(*) AS n_turns,
              sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
              CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
              sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
              CAST(sum(length(text) + len(regexp_extract_all(text, '{_MARKED}'))
                  + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 4 ELSE 24 + length(role) END)
                  AS BIGINT) AS formatted_chars
       FROM t GROUP BY conv_id"""
)
def op11_chat_format(spark, sf):
    conversations = table(spark, sf, "conversations")
    text = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return chat.format_chat(conversations.select(*added.columns).unionByName(added))


@_query()
def op12_spelling_variants(spark, sf):
    return variants.spelling_variants(table(spark, sf, "documents"))


def _clustering_sql(rounds: int) -> str:
    """Each round as two tables: the nearest centroid of each vector, and the centroids moved there."""
    parts = [
        """v AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        """c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS INTEGER) AS cluster, e
            FROM v QUALIFY cluster < 8)""",
    ]
    for r in range(rounds + 1):
        distance = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        parts.append(
            f"""a{r} AS MATERIALIZED (
                SELECT vec_id, v.e, cluster, CAST({distance} AS BIGINT) AS distance FROM v, c{r} AS c
                QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
                    SELECT cluster, coalesce(m.e, c.e) AS e
                    FROM c{r} AS c LEFT JOIN (
                        SELECT cluster, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY d) AS e
                        FROM (SELECT cluster, d, sum(x) AS s, count(*) AS n
                              FROM (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM a{r})
                              GROUP BY cluster, d)
                        GROUP BY cluster) AS m USING (cluster))"""
            )
    return (
        "WITH " + ", ".join(parts) + f"""
        SELECT vec_id, cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.e, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} AS c USING (cluster)"""
    )


@_query(_clustering_sql(10))
def op13_centroid_clustering(spark, sf):
    return centroids.cluster_vectors(table(spark, sf, "embeddings"))
