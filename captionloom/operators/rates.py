"""Moving rates, remaining time, positions and shards: window operators over a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from captionloom.functions.textops import fixed
from captionloom.operators.lineage import settle


def _micros(ts: Column) -> Column:
    """Whole microseconds, so that differences are exact."""
    return F.unix_micros(ts.cast("timestamp"))


def _parted(by: tuple[str, ...]) -> WindowSpec:
    if not by:
        raise ValueError("name the columns that part the log")
    return Window.partitionBy(*by)


def speed(ticks: DataFrame, ts: str, *order: str, by: tuple[str, ...], last: int = 20, weight: str | None = None) -> DataFrame:
    """Adds `rate`: items a second over the last ticks; zero before the second tick and where no time has passed.

    `by` names the columns (a run, a worker) that part the log: without any, all of it would be one task's.
    Without weights n ticks are n - 1 items; with weights the first tick's items do not count.
    """
    frame = _parted(by).orderBy(ts, *order).rowsBetween(1 - last, 0)
    at = _micros(F.col(ts))
    done = F.count(F.lit(1)).over(frame) - 1 if weight is None else F.sum(weight).over(frame) - F.first_value(weight).over(frame)
    passed = (F.max(at).over(frame) - F.min(at).over(frame)) / 1e6
    rate = F.when((F.count(F.lit(1)).over(frame) < 2) | (passed <= 0), F.lit(0.0)).otherwise(F.try_divide(done.cast("double"), passed))
    return ticks.withColumn("rate", rate)


def eta(remaining: Column, rate: Column) -> Column:
    """Remaining time as text: ?, seconds, minutes or hours."""
    seconds = F.try_divide(remaining.cast("double"), rate)
    return F.when(rate <= 0, "?").when(seconds < 60, F.concat(fixed(seconds, 0), F.lit("s"))).when(seconds < 3600, F.concat(fixed(seconds / 60, 1), F.lit("m"))).otherwise(F.concat(fixed(seconds / 3600, 1), F.lit("h")))


def running(log: DataFrame, ts: str, *order: str, by: tuple[str, ...], success: str = "success", latency: str = "latency_ms") -> DataFrame:
    """The log with the totals up to each request."""
    frame = _parted(by).orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumns({"requests_so_far": F.count(F.lit(1)).over(frame), "successes_so_far": F.count_if(F.col(success)).over(frame), "latency_so_far": F.sum(latency).over(frame)})


def positions(items: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """1-based positions in a stated order without gathering all rows in one task: rows are range-partitioned, counted
    for each partition, and numbered inside it after the rows of the partitions before."""
    spark = items.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # Settled, since range boundaries come from a sample that a second run would draw anew.
    placed = settle(items.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition: small whatever the table's size.
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return placed.join(F.broadcast(starts), "__part").withColumn(name, (F.col("__start") + rank).cast("long")).drop("__part", "__start")
