"""Queries: moving rates, remaining time, running totals, throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.operators import audits, rates
from captionloom.plans.registry import query, table

_FRAME = "PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {} PRECEDING AND CURRENT ROW"


def _rate(n: int, done: str) -> str:
    w = _FRAME.format(n - 1)
    passed = f"((max(epoch_us(ts)) OVER ({w})) - (min(epoch_us(ts)) OVER ({w}))) / 1e6"
    return f"CASE WHEN (count(*) OVER ({w})) < 2 OR {passed} <= 0 THEN 0 ELSE ({done.format(w=w)}) / ({passed}) END"


@query(f"SELECT event_id, round({_rate(20, '(count(*) OVER ({w})) - 1')}, 9) AS rate FROM events")
def speed_monitor20(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return rates.speed(ticks, "ts", "event_id", by=("user_id",), last=20).select("event_id", F.round("rate", 9).alias("rate"))


@query(f"SELECT event_id, round({_rate(50, '(sum(event_id % 7) OVER ({w})) - (first_value(event_id % 7) OVER ({w}))')}, 9) AS rate FROM events")
def speed_monitor50(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", (F.col("event_id") % 7).alias("n"))
    return rates.speed(ticks, "ts", "event_id", by=("user_id",), last=50, weight="n").select("event_id", F.round("rate", 9).alias("rate"))


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN '?' WHEN s < 60 THEN printf('%.0f', s) || 's' WHEN s < 3600 THEN printf('%.1f', s / 60) || 'm' ELSE printf('%.1f', s / 3600) || 'h' END AS eta
    FROM (SELECT *, l_quantity * CASE WHEN l_suppkey % 2 = 0 THEN 400 ELSE 1 END * 16 / l_linenumber AS s FROM lineitem)""")
def remaining_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds, minutes and hours; lines of number 1 have no rate."""
    rate = F.when(F.col("l_linenumber") == 1, 0.0).otherwise(F.col("l_linenumber") / 16)
    left = F.col("l_quantity") * F.when(F.col("l_suppkey") % 2 == 0, 400).otherwise(1)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rates.eta(left, rate).alias("eta"))


@query("""
    SELECT event_id, count(*) OVER w AS requests_so_far, count(*) FILTER (event_type <> 'error') OVER w AS successes_so_far, round(sum(value) OVER w, 6) AS latency_so_far
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", (F.col("event_type") != "error").alias("success"), F.col("value").alias("latency_ms"))
    out = rates.running(log, "ts", "event_id", by=("user_id",))
    return out.select("event_id", "requests_so_far", "successes_so_far", F.round("latency_so_far", 6).alias("latency_so_far"))


@query("""
    SELECT o_custkey, count(*) AS items, CAST(sum(o_orderkey % 100) AS BIGINT) AS tokens, round(sum(o_orderkey % 100) / (max(o_totalprice) / 1000), 9) AS tokens_per_second, round(max(o_totalprice) / count(*), 6) AS ms_per_item
    FROM orders GROUP BY 1""")
def batch_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey")
    out = audits.throughput(orders, F.col("o_orderkey") % 100, F.col("o_totalprice"))
    return out.select("o_custkey", "items", "tokens", F.round("tokens_per_second", 9).alias("tokens_per_second"), F.round("ms_per_item", 6).alias("ms_per_item"))


@query("SELECT doc_id, row_number() OVER (ORDER BY lang, doc_id) AS position FROM documents")
def numbered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.positions(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id").select("doc_id", "position")
