"""Queries: audits, score repair, request statistics, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.functions.keys import iso_timestamp
from captionloom.functions.textops import fixed, percent
from captionloom.operators import audits, joins
from captionloom.plans.registry import query, table

_STATUS = "CASE WHEN length(text) < 100 THEN 'too_short' WHEN length(text) > 2000 THEN 'too_long' ELSE 'success' END"


@query(f"""
    SELECT lang, {_STATUS} AS status, count(*) AS "rows", min(length(text)) AS length_min, max(length(text)) AS length_max,
           avg(length(text)) AS length_mean, CAST(median(length(text)) AS DOUBLE) AS length_median
    FROM documents GROUP BY 1, 2""")
def audit_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", audits.caption_status(F.col("text")).alias("status"), F.length("text").alias("length"))
    return audits.spread_by(docs, "lang", "status", length=F.col("length")).withColumnRenamed("length_count", "rows")


@query(f"SELECT doc_id, {_STATUS} AS status, length(text) AS length FROM documents WHERE {_STATUS} <> 'success'")
def audit_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", audits.caption_status(F.col("text")).alias("status"), F.length("text").alias("length"))
    return docs.where("status <> 'success'")


@query("""
    SELECT CASE WHEN l.doc_id IS NULL THEN 'without_tags' WHEN quality + toxic < 1 THEN 'too_few' ELSE 'success' END AS status,
           count(*) AS images, CAST(coalesce(sum(quality + toxic), 0) AS BIGINT) AS tags
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def audit_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels")
    tagged = docs.join(labels.select("doc_id", (F.col("quality") + F.col("toxic")).alias("n"), F.lit(True).alias("tagged")), "doc_id", "left")
    status = audits.tag_status(F.coalesce("tagged", F.lit(False)), F.col("n"), least=1)
    return tagged.groupBy(status.alias("status")).agg(F.count("*").alias("images"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("tags"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.skip_existing(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN (SELECT * FROM labels WHERE toxic = 0) l USING (doc_id)")
def attach_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    sidecars = table(spark, sf_dir, "labels").select("doc_id", "quality", F.when(F.col("toxic") == 1, "unreadable").alias("error"))
    return joins.attach_tags(table(spark, sf_dir, "documents").select("doc_id", "lang"), sidecars, "doc_id")


@query("""
    SELECT doc_id, CASE WHEN a.k IS NOT NULL THEN a.text WHEN b.k IS NOT NULL THEN b.text END AS caption,
           CASE WHEN a.k IS NOT NULL THEN 0 WHEN b.k IS NOT NULL THEN 1 END AS source
    FROM (SELECT doc_id FROM documents) d
    LEFT JOIN (SELECT doc_id AS k, 'caption ' || lang AS text FROM documents WHERE doc_id % 3 = 0) a ON a.k = doc_id
    LEFT JOIN (SELECT doc_id AS k, 'cap ' || source AS text FROM documents WHERE doc_id % 2 = 0) b ON b.k = doc_id""")
def caption_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    first = docs.where("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("caption "), "lang").alias("caption"))
    second = docs.where("doc_id % 2 = 0").select("doc_id", F.concat(F.lit("cap "), "source").alias("caption"))
    return joins.first_present(docs.select("doc_id"), "doc_id", "caption", first, second)


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def class_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = joins.with_class(table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, sf_dir, "region"), "r_regionkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return joins.with_class(customers, nations, "n_nationkey").select("c_custkey", "n_name", "r_name")


@query("SELECT n_name, count(*) AS images, count(DISTINCT c_mktsegment) AS segments FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return joins.with_class(customers, table(spark, sf_dir, "nation"), "n_nationkey").groupBy("n_name").agg(F.count("*").alias("images"), F.count_distinct("c_mktsegment").alias("segments"))


@query("SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")
def class_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return joins.without_class(customers, table(spark, sf_dir, "nation").where("n_regionkey < 3"), "n_nationkey").select("c_custkey")


_SCORES = """SELECT event_id, value AS aesthetic_score, value / 10 AS nsfw_score, (value - 50) / 20 AS quality_score FROM events"""
_LONG = f"""SELECT event_id, 'aesthetic_score' AS field, aesthetic_score AS score FROM ({_SCORES}) UNION ALL SELECT event_id, 'nsfw_score', nsfw_score FROM ({_SCORES})
    UNION ALL SELECT event_id, 'quality_score', quality_score FROM ({_SCORES})"""
_ISSUE = "CASE WHEN score < 0 THEN 'below_0' WHEN score > 10 THEN 'above_10' WHEN score > 1 THEN 'above_1' ELSE 'ok' END"


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    return table(spark, sf_dir, "events").select("event_id", v.alias("aesthetic_score"), (v / 10).alias("nsfw_score"), ((v - 50) / 20).alias("quality_score"))


@query(f"SELECT field, {_ISSUE} AS issue, count(*) AS scores, count(DISTINCT event_id) AS items FROM ({_LONG}) WHERE score IS NOT NULL GROUP BY 1, 2")
def score_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.audit_scores(_scores(spark, sf_dir), "event_id")


@query("""
    SELECT event_id, {}, aesthetic_score > 1 AND aesthetic_score <= 10 OR nsfw_score > 1 AND nsfw_score <= 10 OR quality_score > 1 AND quality_score <= 10 AS changed
    FROM ({})""".format(", ".join(f"CASE WHEN {s} > 1 AND {s} <= 10 THEN {s} / 10 ELSE {s} END AS {s}" for s in audits.SCORES), _SCORES))
def score_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.fix_scores(_scores(spark, sf_dir))


_SPREAD = ", ".join(f"count({c}) AS {n}_count, min({c}) AS {n}_min, max({c}) AS {n}_max, avg({c}) AS {n}_mean, median({c}) AS {n}_median" for n, c in (("price", "l_extendedprice"), ("quantity", "l_quantity"), ("discount", "l_discount")))


@query(f"SELECT l_returnflag, {_SPREAD} FROM lineitem GROUP BY 1")
def score_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.spread_by(table(spark, sf_dir, "lineitem"), "l_returnflag", price=F.col("l_extendedprice"), quantity=F.col("l_quantity"), discount=F.col("l_discount"))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "ts", F.col("event_type").alias("model"), (F.col("event_type") != "error").alias("success"), F.col("value").alias("latency_ms"), (F.col("event_id") % 4).alias("retries"), F.when(F.col("event_type") == "error", F.col("props")).alias("error"))


_LOG = "SELECT event_id, user_id, ts, event_type AS model, event_type <> 'error' AS success, value AS latency_ms, event_id % 4 AS retries, CASE WHEN event_type = 'error' THEN props END AS error FROM events"


@query(f"""
    SELECT model, count(*) AS requests, count(*) FILTER (success) AS successes, count(*) FILTER (NOT success) AS failures, CAST(sum(retries) AS BIGINT) AS retries, sum(latency_ms) AS latency_ms,
           count(*) FILTER (success) / count(*) AS success_rate, count(*) FILTER (NOT success) / count(*) AS failure_rate,
           coalesce(sum(latency_ms) / nullif(count(*) FILTER (success), 0), 0) AS average_latency_ms, sum(latency_ms) / count(*) AS mean_latency_ms, sum(retries) / count(*) AS average_retries
    FROM ({_LOG}) GROUP BY 1""")
def request_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.request_stats(_requests(spark, sf_dir).groupBy("model"), F.col("success"), F.col("latency_ms"), F.col("retries"))


@query(f"SELECT model, substring(error, 1, 50) AS error, count(*) AS times FROM ({_LOG}) WHERE error IS NOT NULL AND error <> '' GROUP BY 1, 2")
def error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.error_counts(_requests(spark, sf_dir), F.col("error"), "model")


@query("""
    SELECT l_linenumber, printf('%.1f%%', round(100 * avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 4)) AS success_text,
           printf('%.1f', round(avg(l_quantity), 4)) AS latency_text FROM lineitem GROUP BY 1""")
def stats_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("rate"), F.avg("l_quantity").alias("quantity"))
    return items.select("l_linenumber", percent(F.round("rate", 6)).alias("success_text"), fixed(F.round("quantity", 4), 1).alias("latency_text"))


@query("""
    SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus <> 'F' OR o_totalprice > 200000) AS success, count(*) FILTER (NOT (o_orderstatus <> 'F' OR o_totalprice > 200000)) AS failed
    FROM orders GROUP BY 1""")
def download_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "orders").select("o_orderpriority", (F.col("o_orderstatus") != "F").alias("success"), (F.col("o_totalprice") > 200000).alias("existed"))
    return audits.download_totals(results, "o_orderpriority")


@query("SELECT DISTINCT text FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)")
def union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.distinct_union(table(spark, sf_dir, "documents").select("text"), table(spark, sf_dir, "benchmark").select("text"))


@query("""
    SELECT 'img' || CAST(l_orderkey AS VARCHAR) AS image_id, string_agg(f, ',' ORDER BY f) AS files
    FROM (SELECT l_orderkey, 'img' || CAST(l_orderkey AS VARCHAR) || CASE l_linenumber WHEN 1 THEN '.jpg' WHEN 2 THEN '.tag.json' WHEN 3 THEN '.caption.json' ELSE '.txt' END AS f FROM lineitem)
    WHERE NOT f LIKE '%.txt' GROUP BY 1""")
def files_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    suffix = F.when(line == 1, ".jpg").when(line == 2, ".tag.json").when(line == 3, ".caption.json").otherwise(".txt")
    files = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("img"), F.col("l_orderkey").cast("string"), suffix).alias("name"))
    return joins.files_by_item(files).select("image_id", F.array_join("files", ",").alias("files"))


@query("SELECT event_id, list_contains(json_keys(props), 'k') AS has_k, list_contains(json_keys(props), 'error') AS has_error FROM events")
def error_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", audits.has_key(F.col("props"), "k").alias("has_k"), audits.has_key(F.col("props"), "error").alias("has_error"))


@query(f"""
    WITH p AS (SELECT row_number() OVER (ORDER BY doc_id) AS i, 'item ' || CAST(doc_id AS VARCHAR) || ': ' || {_STATUS} AS line FROM documents WHERE {_STATUS} <> 'success')
    SELECT CAST(i AS INTEGER) AS position, line FROM p WHERE i <= 20 UNION ALL SELECT 21, '... and ' || CAST(count(*) - 20 AS VARCHAR) || ' more problems' FROM p HAVING count(*) > 20""")
def problem_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty problems and how many more there are: the limit is the feature."""
    rows = audit_problems(spark, sf_dir)
    return audits.preview(rows, "doc_id", line=F.concat(F.lit("item "), F.col("doc_id").cast("string"), F.lit(": "), "status"))


@query("""
    SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_part('microseconds', t) % 1000000 <> 0 THEN '.' || lpad(CAST(date_part('microseconds', t) % 1000000 AS VARCHAR), 6, '0') ELSE '' END AS timestamp
    FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE ts + INTERVAL 7 MICROSECONDS END AS t FROM events)""")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts") + F.expr("INTERVAL '0.000007' SECOND"))
    return table(spark, sf_dir, "events").select("event_id", iso_timestamp(moment).alias("timestamp"))
