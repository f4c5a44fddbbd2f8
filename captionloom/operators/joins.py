"""Joins and set operations between items, finished work, sidecars and classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captionloom.functions import keys


def skip_existing(items: DataFrame, done: DataFrame, key: str = "image_id", failed: DataFrame | None = None) -> DataFrame:
    """Items without finished work (and, if given, without a recorded failure). Put it before any model call: an
    anti join is not moved below a function by the optimizer."""
    left = items.join(done.select(key), key, "left_anti")
    return left if failed is None else left.join(failed.select(key), key, "left_anti")


def one_each(source: DataFrame, key: str) -> DataFrame:
    """One row for each key, so that a join multiplies nothing: of several the first by its JSON text."""
    others = F.struct(*[c for c in source.columns if c != key])
    if source.columns == [key]:
        return source.distinct()
    return source.groupBy(key).agg(F.min_by(others, F.to_json(others, {"ignoreNullFields": "false"})).alias("one")).select(key, "one.*")


def attach_tags(items: DataFrame, sidecars: DataFrame, key: str = "image_id", error: str = "error") -> DataFrame:
    """Left join; sidecars with an error count as absent, and of several sidecars of an item one counts."""
    good = sidecars.where(F.col(error).isNull()).drop(error) if error in sidecars.columns else sidecars
    return items.join(one_each(good, key), key, "left")


def first_present(items: DataFrame, key: str, value: str, *sources: DataFrame) -> DataFrame:
    """Each item's value from the first of the sources that has the key; of several values in a source the least."""
    out = items
    for k, source in enumerate(sources):
        out = out.join(one_each(source.select(key, F.col(value).alias(f"__{k}")), key).withColumn(f"__has{k}", F.lit(True)), key, "left")
    picked = F.when(F.col("__has0"), F.col("__0"))
    source = F.when(F.col("__has0"), F.lit(0))
    for k in range(1, len(sources)):
        picked, source = picked.when(F.col(f"__has{k}"), F.col(f"__{k}")), source.when(F.col(f"__has{k}"), F.lit(k))
    return out.withColumn(value, picked).withColumn("source", source).drop(*[c for k in range(len(sources)) for c in (f"__{k}", f"__has{k}")])


def with_class(items: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """Items that have a class, with it; of several rows of a class one counts. Spark broadcasts the classes where
    statistics say that they are small."""
    return items.join(one_each(classes, key), key)


def without_class(items: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    return items.join(classes.select(key), key, "left_anti")


def files_by_item(files: DataFrame, name: str = "name") -> DataFrame:
    """The files that belong to each item, in order; other files are left out."""
    own = files.withColumn("image_id", keys.stem(F.col(name))).where("image_id IS NOT NULL")
    return own.groupBy("image_id").agg(F.array_sort(F.collect_list(name)).alias("files"))


def distinct_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()
