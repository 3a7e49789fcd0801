"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import (
    conversations,
    decontaminate,
    line_labels,
    mixing,
    ngram_join,
    packing,
    quality_trees,
    repeats,
    runs,
    secrets,
    sharding,
    token_files,
    warc,
)
from weftline.llm.common import table


def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(table(spark, sf_dir, "pages"))


def op2_align_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op3_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op4_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_digest(table(spark, sf_dir, "documents"), str(path))


def op5_crf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_labels.label_lines(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op6_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op9_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)


def op11_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_digest(table(spark, sf_dir, "documents"), str(path), end_id=1)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digest(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digest(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_archive": op1_warc_archive,
    "op2_align_leaks": op2_align_leaks,
    "op3_rendezvous_sharding": op3_rendezvous_sharding,
    "op4_range_coded_ids": op4_range_coded_ids,
    "op5_crf_lines": op5_crf_lines,
    "op6_boosted_quality": op6_boosted_quality,
    "op7_suffix_repeats": op7_suffix_repeats,
    "op8_pivotal_mix": op8_pivotal_mix,
    "op9_entropy_secrets": op9_entropy_secrets,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_tiered_packing": op11_tiered_packing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_repair": op13_conversation_repair,
}
SQL: dict[str, str] = {
    "op1_warc_archive": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                 sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
          SELECT payload_digest, min(page_id) AS first_id FROM p
          WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response'
                    ELSE 'revisit' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    # Slices of a blob are bytes. Runs of removed bytes are islands of window starts.
    "op7_suffix_repeats": """
        WITH d AS (
          SELECT doc_id, encode(coalesce(text, '')) AS bytes,
                 strlen(coalesce(text, '')) AS n_bytes FROM documents
        ), w AS (
          SELECT doc_id, place, md5(bytes[place + 1:place + 100]) AS k
          FROM (SELECT doc_id, bytes, unnest(range(n_bytes - 99)) AS place FROM d)
        ), r AS (
          SELECT doc_id, place, place - lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS gap
          FROM (SELECT doc_id, place, row_number() OVER (PARTITION BY k ORDER BY doc_id, place) AS nth
                FROM w) WHERE nth > 1
        ), s AS (
          SELECT doc_id, min(place) AS a, max(place) + 100 AS b
          FROM (SELECT doc_id, place, count(*) FILTER (gap IS NULL OR gap > 100)
                  OVER (PARTITION BY doc_id ORDER BY place) AS island FROM r)
          GROUP BY doc_id, island
        ), kept AS (
          SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM s
        ), spans AS (
          SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
                 string_agg(CASE WHEN a > since THEN hex(bytes[since + 1:a]) ELSE '' END, '' ORDER BY a)
                   AS left_over
          FROM kept JOIN d USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(left_over, '') || CASE WHEN n_bytes > coalesce(last, 0)
                 THEN hex(bytes[coalesce(last, 0) + 1:n_bytes]) ELSE '' END)) AS kept_sha256
        FROM d LEFT JOIN spans USING (doc_id)
    """,
    "op10_ngram_jaccard": """
        WITH RECURSIVE d AS (
          SELECT doc_id, [x FOR x IN regexp_split_to_array(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws
          FROM documents
        ), g AS MATERIALIZED (
          SELECT DISTINCT doc_id, md5_number(array_to_string(ws[place:place + 3], ' ')) AS k
          FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS place
                FROM d WHERE len(ws) > 0)
        ), n AS MATERIALIZED (
          SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
        ), links AS MATERIALIZED (
          SELECT a, b FROM (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
            FROM g x JOIN g y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY ALL
          ) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * common >= 85 * (p.n + q.n - common)
        ), reach(doc_id, other) AS (
          SELECT doc_id, doc_id FROM documents
          UNION
          SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
        ), least AS (
          SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
        FROM d LEFT JOIN n USING (doc_id) JOIN least USING (doc_id)
    """,
}
