"""Where items come from: image folders, sidecar files, URL lists, dataset tables; and where results go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captionloom.functions.keys import IMAGE_SUFFIXES
from captionloom.functions.textops import ordered_path, strip


def _name_glob(suffixes: tuple[str, ...]) -> str:
    """A file-name pattern for the suffixes in any case."""
    either = lambda s: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s)
    return "*.{" + ",".join(either(s) for s in suffixes) + "}"


def scan_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES, recursive: bool = True) -> DataFrame:
    """path, size and modified of files under a folder; contents are not read. Case of suffixes does not count."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", _name_glob(suffixes)).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(root).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def scan_items(spark: SparkSession, root: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES, recursive: bool = True) -> DataFrame:
    """image_id (path below the root without its suffix), path and tag_path (the sidecar beside it) of each image."""
    files = scan_files(spark, root, suffixes, recursive).select("path").distinct()
    own = root.rstrip("/")
    below = F.regexp_replace("path", "^.*?" + _quoted(own.split(":", 1)[-1].lstrip("/")) + "/", "")
    stem = F.regexp_replace("path", r"\.[^./]*$", "")
    return files.select(F.regexp_replace(below, r"\.[^./]*$", "").alias("image_id"), "path", F.concat(stem, F.lit(".tag.json")).alias("tag_path"))


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "/" else c for c in text)


def in_path_order(items: DataFrame, path: str = "path") -> DataFrame:
    """Sorted part by part, as paths compare."""
    return items.orderBy(ordered_path(F.col(path)))


def first_items(items: DataFrame, n: int | None, key: str = "image_id") -> DataFrame:
    """The first n by key; all for None. Applied before finished work is skipped."""
    return items if n is None else items.orderBy(key).limit(n)


def quick_items(items: DataFrame, n: int | None) -> DataFrame:
    """Any n items, for a quick look: unlike `first_items` nothing is sorted, and tasks stop reading when there are enough."""
    return items if n is None else items.limit(n)


def has_any(items: DataFrame) -> bool:
    """Whether there is an item at all; the scan ends at the first one."""
    return not items.isEmpty()


def read_sidecars(spark: SparkSession, root: str, suffix: str = ".tag.json", schema: T.StructType | str | None = None) -> DataFrame:
    """One row for each readable sidecar: path, image_id and its JSON (columns under a schema, else the text); unreadable ones are left out."""
    if schema is None:
        files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}")
        files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json")).where(F.try_parse_json("json").isNotNull())
    else:
        own = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        full = T.StructType([*own.fields, T.StructField("_corrupt_record", T.StringType())])
        files = spark.read.schema(full).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").json(root)
        files = files.select(F.col("_metadata.file_path").alias("path"), "*").where("_corrupt_record IS NULL").drop("_corrupt_record")
    return files.withColumn("image_id", F.regexp_replace(F.element_at(F.split("path", "/"), -1), _quoted(suffix) + "$", ""))


def read_dataset(spark: SparkSession, path: str, image_col: str, id_col: str | None = None, label_col: str | None = None) -> DataFrame:
    """A dataset table under fixed names: own_id, label (-1 where there is none) and image; only those columns are read."""
    df = spark.read.parquet(path)
    own = F.col(id_col).cast("string") if id_col else F.lit(None).cast("string")
    label = F.coalesce(F.col(label_col).cast("int"), F.lit(-1)) if label_col else F.lit(-1)
    return df.select(own.alias("own_id"), label.alias("label"), F.col(image_col).alias("image"))


def read_dataset_rows(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The columns with `index`: each row's place in the dataset, files in the order of their paths."""
    rows = spark.read.parquet(path).select(*columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    # One row for each file: small beside the table, and broadcast by Spark's own estimate.
    counts = rows.groupBy("__file").agg((F.max("__row") + 1).alias("__n"))
    starts = counts.select("__file", (F.sum("__n").over(Window.orderBy("__file")) - F.col("__n")).alias("__start"))
    return rows.join(starts, "__file").select(*columns, (F.col("__start") + F.col("__row")).alias("index"))


def read_tag_map(spark: SparkSession, path: str) -> DataFrame:
    """index, tag and category of a JSON vocabulary: `tag_map` gives indices, and the first `gen_tag_count` are general tags."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", "tag_map map<string,int>, tag_split struct<gen_tag_count:int>").alias("v"))
    rows = text.select(F.col("v.tag_split.gen_tag_count").alias("general"), F.explode("v.tag_map").alias("tag", "index"))
    return rows.select("index", "tag", F.when(F.col("index") < F.col("general"), "general").otherwise("character").alias("category"))


def read_tag_table(spark: SparkSession, tags: str, categories: str) -> DataFrame:
    """index, tag and category of a CSV vocabulary (columns name and category) and its JSON list of categories; a tag
    such as `null` or `nan` is text, and an empty one stays empty. The file is small, so its order is one task's."""
    names = spark.read.schema("category int, name string").option("multiLine", True).json(categories)
    rows = spark.read.option("header", True).option("multiLine", True).csv(tags).coalesce(1)
    rows = rows.select(F.monotonically_increasing_id().cast("int").alias("index"), F.coalesce("name", F.lit("")).alias("tag"), F.col("category").cast("int").alias("category"))
    return rows.join(F.broadcast(names.withColumnRenamed("name", "kind")), "category", "left").select("index", "tag", F.col("kind").alias("category"))


def url_lines(text: Column) -> Column:
    """array<struct<position, url>> of a URL list: blank lines and comments do not count."""
    kept = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: (x != "") & ~x.startswith("#"))
    return F.transform(kept, lambda x, i: F.struct((i + 1).cast("long").alias("position"), x.alias("url")))


def read_url_lists(spark: SparkSession, path: str) -> DataFrame:
    """file, position (from 1, among kept lines) and url of a .txt file or of all in a folder."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    return files.select(F.col("_metadata.file_name").alias("file"), F.inline(url_lines(F.col("value"))))


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines request log; timestamps are naive."""
    return spark.read.schema("request_id string, model string, success boolean, latency_ms double, retries int, error string, timestamp timestamp_ntz").json(path)


# --- sinks ---------------------------------------------------------------------------------------------


def write_results(done: DataFrame, path: str, success: str = "success") -> None:
    """Accepted rows to `captions`, the others to `failed`, from one computation that is kept until both are written."""
    done = done.persist()
    try:
        done.where(F.col(success)).write.mode("append").parquet(f"{path}/captions")
        done.where(~F.coalesce(F.col(success), F.lit(False))).write.mode("append").parquet(f"{path}/failed")
    finally:
        done.unpersist()


def append_log(requests: DataFrame, path: str) -> None:
    requests.write.mode("append").json(path)


def write_routed(items: DataFrame, path: str, *by: str) -> None:
    """One folder for each class (or split and class), instead of moving files one by one. Rows are rebalanced by class as
    the job runs: a hot class is split over tasks, small ones share them."""
    items.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_item_files(items: DataFrame, path: str, id_col: str = "image_id", suffix: str = ".caption.json") -> None:
    """Compatibility sink: one JSON file for each row, named by its id, on a file system that all executors share."""
    columns = [c for c in items.columns if c != id_col]
    rows = items.select(F.col(id_col).alias("id"), F.to_json(F.struct(id_col, *columns), {"ignoreNullFields": "false"}).alias("json"))

    def put(part) -> None:
        import os

        for row in part:
            target = os.path.join(path, row.id + suffix)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            # Written beside and renamed, so that a task that runs again leaves whole files only.
            with open(f"{target}.{os.getpid()}", "w", encoding="utf-8") as f:
                f.write(row.json)
            os.replace(f"{target}.{os.getpid()}", target)

    rows.foreachPartition(put)


def repair_files(captions: DataFrame, path: str, id_col: str = "image_id", dry_run: bool = False) -> int:
    """Brings scores on a scale of ten to one and writes again only the files whose rows changed; gives their number. A dry
    run counts and writes nothing."""
    from captionloom.operators.audits import fix_scores

    changed = fix_scores(captions).where("changed").drop("changed").persist()
    try:
        n = changed.count()
        if n and not dry_run:
            write_item_files(changed, path, id_col)
        return n
    finally:
        changed.unpersist()
