"""The registered queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.llm import bpe, decontamination, exact_dedup, html_extraction, language_id, language_model, line_dedup, near_dedup, sharding, toxicity
from captionloom.llm.common import crc_of_id, read

RANK_FILE = "byte_bpe_50k.tiktoken"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extraction.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.pmod(crc_of_id(), F.lit(4)) == 2
    model = language_id.train(docs.select("doc_id", "text", "lang"), learn=~held_out)
    out = language_id.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(crc_of_id(), F.lit(7)) == 2
    out = language_model.score(read(spark, sf_dir, "documents"), learn=~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(read(spark, sf_dir, "documents"), exact_chars=1)
    return out.select("doc_id", "class_id", "n_links", "lines", "exact_dropped", "near_dropped", "line_kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    out = bpe.encode(docs, path, pattern, decoded_col="decoded", keep_text=False)
    return out.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.pmod(crc_of_id(), F.lit(5)) == 0
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=~held_out)
    out = toxicity.score(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=40)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four arrivals: three immutable snapshots and an incoming batch, told apart by crc32 of the id."""
    epoch = F.pmod(crc_of_id(), F.lit(4))
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"), epoch)


OP6_SQL = r"""
    WITH doc AS (
        SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), item AS (
        SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), win AS (
        SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i + 1:i + least(13, len(w))], ' ') AS g
        FROM (SELECT item, w, unnest(range(0, len(w) - least(13, len(w)) + 1)) AS i FROM item WHERE len(w) > 0)
    ), lengths AS (SELECT DISTINCT n FROM win),
    grams AS (
        SELECT rid, i, n, array_to_string(w[i + 1:i + n], ' ') AS g
        FROM (SELECT rid, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM doc, lengths WHERE len(w) >= n)
    ), found AS (SELECT rid, i, n, item FROM grams JOIN win USING (n, g)),
    hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid),
    items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)"""


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_extraction, op2_language_id, op3_language_model, op4_line_dedup, op5_byte_bpe, op6_decontamination, op7_toxicity, op8_sharding, op9_exact_dedup, op10_minhash_near_dedup)}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_decontamination": OP6_SQL,
        "op9_exact_dedup": """
            SELECT doc_id,
                   max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                   count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
                   doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents""",
    }
