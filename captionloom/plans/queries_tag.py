"""Queries: tag vectors, tag sets, token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.functions import tags, tokens
from captionloom.plans.registry import query, table

GENERAL = 48


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: tags.sigmoid(x.cast("double"))).alias("p"))


_P = "SELECT vec_id, i, 1 / (1 + exp(-CAST(embedding[i + 1] AS DOUBLE))) AS p FROM (SELECT vec_id, embedding, unnest(range(64)) AS i FROM embeddings)"


@query(f"""
    SELECT vec_id, coalesce(string_agg(CASE WHEN i < 48 AND p > 0.53 THEN CAST(i AS VARCHAR) END, ',' ORDER BY i), '') AS features, coalesce(string_agg(CASE WHEN i >= 48 AND p > 0.55 THEN CAST(i AS VARCHAR) END, ',' ORDER BY i), '') AS characters
    FROM ({_P}) GROUP BY 1""")
def tag_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.array_join(c.cast("array<string>"), ",")
    return _scores(spark, sf_dir).select("vec_id", text(tags.above(F.col("p"), 0.53, 0, GENERAL)).alias("features"), text(tags.above(F.col("p"), 0.55, GENERAL)).alias("characters"))


@query(f"""
    SELECT vec_id, coalesce(string_agg(DISTINCT ip, ',' ORDER BY ip), '') AS series FROM ({_P}) LEFT JOIN (SELECT 48 + n_nationkey % 16 AS k, n_name AS ip FROM nation) ON k = i AND p > 0.55 GROUP BY 1""")
def ip_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters found to the distinct, sorted series that they are from, through the vocabulary table."""
    vocabulary: dict[int, list[str]] = {}
    for row in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect():
        vocabulary.setdefault(GENERAL + row.n_nationkey % 16, []).append(row.n_name)
    found = tags.above(F.col("p"), 0.55, GENERAL)
    return _scores(spark, sf_dir).select("vec_id", F.array_join(tags.series_of(found, vocabulary), ",").alias("series"))


_THRESHOLD = "CASE WHEN i % 5 = 0 THEN 0.5 + i / 1000 WHEN i < 40 THEN 0.52 WHEN i < 56 THEN 0.54 ELSE 0.4 END"


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = lambda i: F.when(i % 5 == 0, 0.5 + i / 1000)
    kind = lambda i: F.when(i < 40, "general").when(i < 56, "character").otherwise("rating")
    limits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: tags.threshold_for(own(i), kind(i), {"general": 0.52, "character": 0.54}))
    df = _scores(spark, sf_dir).withColumn("limits", limits)
    scored = lambda lo, hi: F.transform(tags.ranked(F.col("p"), F.col("limits"), F.sequence(F.lit(lo), F.lit(hi))), lambda x: F.struct(F.concat(F.lit("t_"), x["i"].cast("string")).alias("tag"), x["score"].alias("score")))
    return df.select("vec_id", scored(0, 39).alias("general"), scored(40, 55).alias("character"), scored(56, 63).alias("rating"))


def _listed(lo: int, hi: int) -> str:
    return f"coalesce(string_agg(CASE WHEN i BETWEEN {lo} AND {hi} AND p >= {_THRESHOLD} THEN 't_' || CAST(i AS VARCHAR) END, ',' ORDER BY p DESC, i), '')"


@query(f"SELECT vec_id, {_listed(0, 39)} AS general, {_listed(40, 55)} AS character, {_listed(56, 63)} AS rating FROM ({_P}) GROUP BY 1")
def tag_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.array_join(tags.names(F.col(c)), ",").alias(c)
    return _ranked(spark, sf_dir).select("vec_id", text("general"), text("character"), text("rating"))


@query(f"SELECT vec_id, 't_' || CAST(i AS VARCHAR) AS rating, p AS score FROM ({_P}) WHERE i >= 56 AND p >= {_THRESHOLD} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) = 1")
def top_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _ranked(spark, sf_dir)
    return df.where(F.size("rating") > 0).select("vec_id", tags.best(F.col("rating")).alias("rating"), F.get("rating", F.lit(0))["score"].alias("score"))


@query(f"""
    SELECT vec_id, regexp_replace(concat_ws(chr(10), CASE WHEN g <> '' THEN 'Features: ' || replace(replace(g, ',', ', '), '_', ' ') END, CASE WHEN c <> '' THEN 'Characters: ' || replace(replace(c, ',', ', '), '_', ' ') END, CASE WHEN r <> '' THEN 'Rating: ' || split_part(r, ',', 1) END), '^$', '') AS lines,
           '# general' || CASE WHEN g = '' THEN chr(10) ELSE chr(10) || replace(g, ',', ', ') END || chr(10) || chr(10) || '# rating' || chr(10) || replace(r, ',', ', ') AS shown
    FROM (SELECT vec_id, {_listed(0, 39)} AS g, {_listed(40, 55)} AS c, {_listed(56, 63)} AS r FROM ({_P}) GROUP BY 1)""")
def tag_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _ranked(spark, sf_dir)
    return df.select("vec_id", tags.prompt_lines_best(F.col("general"), F.col("character"), F.col("rating")).alias("lines"), tags.show_sections(general=tags.names(F.col("general")), rating=tags.names(F.col("rating"))).alias("shown"))


@query(f"""
    SELECT vec_id, '# rating' || chr(10) || string_agg('  t_' || CAST(i AS VARCHAR) || ': ' || printf('%.3f', p), chr(10) ORDER BY p DESC, i) AS shown, round(sum(round(p, 4)), 4) AS total
    FROM ({_P}) WHERE i >= 56 AND p >= {_THRESHOLD} GROUP BY 1""")
def tag_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _ranked(spark, sf_dir)
    total = F.round(F.aggregate(tags.rounded(F.col("rating")), F.lit(0.0), lambda a, x: a + x["score"]), 4)
    return df.where(F.size("rating") > 0).select("vec_id", tags.show_scores(rating=F.col("rating")).alias("shown"), total.alias("total"))


@query(f"SELECT vec_id, count(*) AS tags, round(sum(p), 6) AS total FROM ({_P}) WHERE p >= {_THRESHOLD} GROUP BY 1")
def tag_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _ranked(spark, sf_dir).withColumn("every", tags.scores_map(F.col("general"), F.col("character"), F.col("rating")))
    return df.where(F.size("every") > 0).select("vec_id", F.size(tags.all_tags(F.col("general"), F.col("character"), F.col("rating"))).cast("long").alias("tags"), F.round(F.aggregate("every", F.lit(0.0), lambda a, x: a + x["score"]), 6).alias("total"))


@query("""
    SELECT p_partkey, CAST(floor(w * s) AS INTEGER) AS width, CAST(floor(h * s) AS INTEGER) AS height, CAST(floor((448 - floor(w * s)) / 2) AS INTEGER) AS "left", CAST(floor((448 - floor(h * s)) / 2) AS INTEGER) AS top
    FROM (SELECT p_partkey, w, h, least(448.0::DOUBLE / w, 448.0::DOUBLE / h) AS s FROM (SELECT p_partkey, 100 + 7 * p_size AS w, 90 + 11 * (p_partkey % 50) AS h FROM part))""")
def letterbox_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = 100 + 7 * F.col("p_size"), 90 + 11 * (F.col("p_partkey") % 50)
    return table(spark, sf_dir, "part").select("p_partkey", tags.letterbox(w, h, 448, 448).alias("b")).select("p_partkey", "b.width", "b.height", "b.left", "b.top")


@query("SELECT doc_id, len(regexp_extract_all(text, '[^ \\n\\t\\r]+')) AS tokens FROM documents")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tokens.word_tokens(F.col("text")).alias("tokens"))


@query("""
    SELECT p_partkey, len(string_split(p_name, ' ')) AS name_tokens, len(string_split(p_type, ' ')) + 1 AS tag_tokens, len(string_split(p_name, ' ')) + len(string_split(p_type, ' ')) + 1 AS total FROM part""")
def caption_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {"name": ("str", F.col("p_name")), "size": ("int", F.col("p_size")), "tags": ("list", F.array("p_type", "p_brand"))}
    got = table(spark, sf_dir, "part").select("p_partkey", tokens.field_tokens(fields).alias("n"), tokens.total_tokens(fields).alias("total"))
    return got.select("p_partkey", F.col("n.name").alias("name_tokens"), F.col("n.tags").alias("tag_tokens"), "total")
