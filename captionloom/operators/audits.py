"""Audits of captions, tags and scores; score repair; request statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from captionloom.operators.lineage import settle

# Bounds of a good description and of scores.
SHORTEST, LONGEST = 100, 2000
SCORES = ("aesthetic_score", "nsfw_score", "quality_score")


def caption_status(description: Column, error: Column | None = None, parse_error: Column | None = None) -> Column:
    """error, parse_error, too_short, too_long or success, judged in this order by code points."""
    size = F.length(description)
    out = F.when(F.lit(False) if error is None else error, "error").when(F.lit(False) if parse_error is None else parse_error, "parse_error")
    return out.when(size < SHORTEST, "too_short").when(size > LONGEST, "too_long").otherwise("success")


def has_key(json: Column, key: str) -> Column:
    """Whether a JSON object has the key, be its value null."""
    return F.array_contains(F.json_object_keys(json), key)


def tag_status(tags: Column, count: Column, least: int = 1, error: Column | None = None) -> Column:
    """without_tags, error, too_few or success; `tags` tells whether there are any, ratings do not count."""
    return F.when(~tags, "without_tags").when(F.lit(False) if error is None else error, "error").when(count < least, "too_few").otherwise("success")


def spread(groups: GroupedData | DataFrame, **columns: Column) -> DataFrame:
    """Rows, least, greatest, mean and exact median of each column."""
    made = []
    for name, c in columns.items():
        made += [F.count(c).alias(f"{name}_count"), F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max"), F.avg(c).alias(f"{name}_mean"), F.median(c).alias(f"{name}_median")]
    return groups.agg(*made)


def spread_by(df: DataFrame, *by: str, gathered: int = 1_000_000, **columns: Column) -> DataFrame:
    """`spread` for a few groups of any size. While a group holds more than `gathered` values between two bounds around its
    median, approximate percentiles move the bounds closer; the ranks are counted, so the median is exact. No task gathers
    more than the values between the bounds, each distinct one once. Groups of null keys are groups."""
    key, names = F.struct(*by), list(columns)
    whole = df.groupBy(*by).agg(*[f(c).alias(f"{n}_{a}") for n, c in columns.items() for a, f in (("count", F.count), ("min", F.min), ("max", F.max), ("mean", F.avg))])
    if not by or max(n or 0 for n in whole.agg(*[F.max(f"{n}_count") for n in names]).first()) <= gathered:
        return spread(df.groupBy(*by), **columns)
    long = df.select(F.to_json(key, {"ignoreNullFields": "false"}).alias("__key"), F.inline(F.array(*[F.struct(F.lit(n).alias("__name"), c.cast("double").alias("__v")) for n, c in columns.items()]))).where("__v IS NOT NULL")
    groups = ["__key", "__name"]
    # One row for each group and column: few by this function's contract.
    bounds = settle(long.groupBy(*groups).agg(F.count("*").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")).select(*groups, "__n", "__lo", "__hi", F.lit(0).cast("long").alias("__below"), F.col("__n").alias("__in")))
    low, high = F.floor((F.col("__n") - 1) / 2), F.floor(F.col("__n") / 2)
    inside = F.col("__v").between(F.col("__lo"), F.col("__hi"))
    while True:
        wide = bounds.where((F.col("__in") > gathered) & (F.col("__lo") < F.col("__hi")))
        if wide.isEmpty():
            break
        near = (low - F.col("__below")) / F.col("__in")
        cuts = long.join(wide, groups).where(inside).groupBy(*groups).agg(F.percentile_approx("__v", [i / 1000 for i in range(1001)], 10_000).alias("__cuts"))
        at = F.floor(near * 1000).cast("int")
        tried = wide.join(cuts, groups).withColumns({"__a": F.greatest("__lo", F.get("__cuts", F.greatest(at - 1, F.lit(0)))), "__b": F.least("__hi", F.get("__cuts", F.least(at + 3, F.lit(1000))))})
        ranks = long.join(tried.select(*groups, "__a", "__b"), groups).groupBy(*groups).agg(F.count_if(F.col("__v") < F.col("__a")).alias("__less"), F.count_if(F.col("__v").between(F.col("__a"), F.col("__b"))).alias("__got"))
        held = (F.col("__less") <= low) & (F.col("__less") + F.col("__got") > high)
        closer = tried.join(ranks, groups).select(*groups, "__n", F.col("__a").alias("__lo"), F.col("__b").alias("__hi"), F.col("__less").alias("__below"), F.col("__got").alias("__in"), held.alias("__held"), (F.col("__got") < F.col("__in")).alias("__less_in"))
        closer = settle(closer.where("__held AND __less_in").drop("__held", "__less_in"))
        if closer.isEmpty():
            break
        bounds = settle(bounds.join(closer.select(*groups), groups, "left_anti").unionByName(closer))
    counts = long.join(bounds, groups).where(inside).groupBy(*groups, "__v").agg(F.count("*").alias("__c"), F.first("__n").alias("__n"), F.first("__below").alias("__below"))
    upto = F.col("__below") + F.sum("__c").over(Window.partitionBy(*groups).orderBy("__v"))
    ranked = counts.withColumn("__upto", upto)
    hits = lambda rank: (F.col("__upto") - F.col("__c") <= rank) & (F.col("__upto") > rank)
    medians = ranked.groupBy(*groups).agg(((F.max(F.when(hits(low), F.col("__v"))) + F.max(F.when(hits(high), F.col("__v")))) / 2).alias("__median"))
    medians = medians.groupBy("__key").pivot("__name", names).agg(F.first("__median"))
    out = whole.withColumn("__key", F.to_json(key, {"ignoreNullFields": "false"})).join(medians, "__key", "left")
    return out.select(*by, *[c for n in names for c in (f"{n}_count", f"{n}_min", f"{n}_max", f"{n}_mean", F.col(n).alias(f"{n}_median"))])


def score_issue(score: Column) -> Column:
    """below_0 and above_10 cannot be fixed; above_1 is on a scale of ten."""
    return F.when(score < 0, "below_0").when(score > 10, "above_10").when(score > 1, "above_1").otherwise("ok")


def fixed_score(score: Column) -> Column:
    return F.when((score > 1) & (score <= 10), score / 10).otherwise(score)


def long_scores(captions: DataFrame, key: str = "image_id", scores: tuple[str, ...] = SCORES) -> DataFrame:
    """(key, field, score) of the numeric scores that are there."""
    return captions.unpivot([key], list(scores), "field", "score").where("score IS NOT NULL")


def audit_scores(captions: DataFrame, key: str = "image_id", scores: tuple[str, ...] = SCORES) -> DataFrame:
    """field, issue: scores and distinct items with it."""
    found = long_scores(captions, key, scores).withColumn("issue", score_issue(F.col("score")))
    return found.groupBy("field", "issue").agg(F.count("*").alias("scores"), F.count_distinct(F.col(key)).alias("items"))


def fix_scores(captions: DataFrame, scores: tuple[str, ...] = SCORES) -> DataFrame:
    """Scores on a scale of ten brought to one; `changed` tells which rows to write again."""
    changed = F.lit(False)
    for s in scores:
        changed = changed | F.coalesce(score_issue(F.col(s)) == "above_1", F.lit(False))
    return captions.withColumn("changed", changed).withColumns({s: fixed_score(F.col(s)) for s in scores})


def ratio(part: Column, whole: Column) -> Column:
    """Zero where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def request_stats(groups: GroupedData, success: Column, latency: Column, retries: Column) -> DataFrame:
    """Counts and ratios of a request log. average_latency_ms divides all latency by the successes; mean_latency_ms by
    all requests."""
    good = F.count_if(success)
    return groups.agg(
        F.count("*").alias("requests"),
        good.alias("successes"),
        F.count_if(~success).alias("failures"),
        F.sum(retries).cast("long").alias("retries"),
        F.sum(latency).alias("latency_ms"),
        ratio(good.cast("double"), F.count("*")).alias("success_rate"),
        ratio(F.count_if(~success).cast("double"), F.count("*")).alias("failure_rate"),
        ratio(F.sum(latency), good).alias("average_latency_ms"),
        ratio(F.sum(latency), F.count("*")).alias("mean_latency_ms"),
        ratio(F.sum(retries).cast("double"), F.count("*")).alias("average_retries"),
    )


def error_counts(requests: DataFrame, error: Column, *by: str) -> DataFrame:
    """How often each error came, by its first 50 characters."""
    short = F.substring(error, 1, 50)
    return requests.where(error.isNotNull() & (error != "")).groupBy(*by, short.alias("error")).agg(F.count("*").alias("times"))


def summary_line(stats: DataFrame) -> DataFrame:
    from captionloom.functions.textops import fixed, percent

    return stats.withColumns({"success_text": percent(F.col("success_rate")), "latency_text": fixed(F.col("average_latency_ms"), 1), "retries_text": fixed(F.col("average_retries"), 2)})


def download_totals(results: DataFrame, *by: str) -> DataFrame:
    """Totals of downloads; a file that was there already is a success."""
    ok = F.col("success") | F.col("existed")
    return results.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed"))


def throughput(batches: GroupedData, tokens: Column, millis: Column) -> DataFrame:
    """tokens a second and milliseconds an item of generated batches."""
    return batches.agg(F.count("*").alias("items"), F.sum(tokens).cast("long").alias("tokens"), ratio(F.sum(tokens).cast("double"), F.max(millis) / 1000).alias("tokens_per_second"), ratio(F.max(millis), F.count("*")).alias("ms_per_item"))


def preview(rows: DataFrame, *order: str, line: Column, n: int = 20, rest: str = "problems") -> DataFrame:
    """position and line: the first n rows in order, then how many more there are. One sort keeps n rows of each task."""
    first = rows.orderBy(*order).limit(n).select(*order, line.alias("line"))
    # n rows: what the window gathers is bounded.
    first = first.select(F.row_number().over(Window.orderBy(*order)).alias("position"), "line")
    more = rows.agg((F.count("*") - n).alias("more")).where("more > 0")
    return first.unionByName(more.select(F.lit(n + 1).alias("position"), F.format_string(f"... and %d more {rest}", "more").alias("line")))
