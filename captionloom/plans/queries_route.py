"""Queries: ids, routes, URLs, sources in table form, shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.functions import keys
from captionloom.operators.rates import positions
from captionloom.plans.registry import query, table
from captionloom.sources.items import url_lines


@query("""
    SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'extra' END || '_' || lpad(CAST(doc_id AS VARCHAR), 8, '0')
           ELSE source || '_' || lang || '_x.' || CAST(doc_id AS VARCHAR) END AS image_id FROM documents""")
def image_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.col("doc_id") % 2 == 1, F.concat("source", F.lit("/"), "lang", F.lit(" x."), F.col("doc_id").cast("string"), F.lit(".png")))
    split = F.when(F.col("doc_id") % 3 == 0, "train").when(F.col("doc_id") % 3 == 1, "validation").otherwise("extra")
    return table(spark, sf_dir, "documents").select("doc_id", keys.image_id(split, F.col("doc_id"), own).alias("image_id"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source || '.x' WHEN 1 THEN source WHEN 2 THEN source END AS stem FROM documents")
def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    name = F.concat("source", F.when(k == 0, ".x.tag.json").when(k == 1, ".caption.json").when(k == 2, ".webp").otherwise(".JPG"))
    return table(spark, sf_dir, "documents").select("doc_id", keys.stem(name).alias("stem"))


_SPLIT = "CASE doc_id % 5 WHEN 0 THEN 'train' WHEN 1 THEN 'val' WHEN 2 THEN 'test' WHEN 3 THEN 'train' ELSE 'unknown' END"


@query(f"""
    SELECT doc_id, {_SPLIT} AS split, CASE WHEN {_SPLIT} = 'test' OR coalesce(quality, -1) = -1 THEN 'test' WHEN {_SPLIT} IN ('train', 'val') THEN {_SPLIT} || '/' || CAST(quality AS VARCHAR) END AS target
    FROM documents LEFT JOIN labels USING (doc_id)""")
def split_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    name = F.concat(F.when(k == 0, "train_").when(k == 1, "val_").when(k == 2, "test_").when(k == 3, "train_x").otherwise("foo_"), F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", keys.split_of(name).alias("split")).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return docs.select("doc_id", "split", keys.route(F.col("split"), F.coalesce("quality", F.lit(-1))).alias("target"))


@query(f"SELECT {_SPLIT} AS split, count(*) AS files FROM documents GROUP BY 1")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_routes(spark, sf_dir).groupBy("split").agg(F.count("*").alias("files"))


@query("SELECT s_suppkey, regexp_matches(CASE s_suppkey % 4 WHEN 0 THEN CAST(s_nationkey AS VARCHAR) WHEN 1 THEN '-' || CAST(s_nationkey AS VARCHAR) WHEN 2 THEN '1_' || CAST(s_nationkey AS VARCHAR) ELSE s_name END, '^[+-]?[0-9]+(_[0-9]+)*$') AS is_class FROM supplier")
def class_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("s_suppkey") % 4, F.col("s_nationkey").cast("string")
    name = F.when(k == 0, F.concat(F.lit(" "), n)).when(k == 1, F.concat(F.lit("-"), n)).when(k == 2, F.concat(F.lit("1_"), n)).otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", keys.is_number_name(name).alias("is_class"))


_PATH = "regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_LAST = f"regexp_extract({_PATH}, '([^/]*)$', 1)"
_SUFFIX = f"lower(regexp_extract({_LAST}, '\\.([^.]*)$', 1))"
_KIND = f"CASE WHEN {_SUFFIX} = 'jpeg' THEN 'jpg' WHEN {_SUFFIX} IN ('jpg', 'png', 'gif', 'webp', 'bmp', 'tiff', 'avif') THEN {_SUFFIX} ELSE 'jpg' END"
_URLS = "SELECT page_id, CASE page_id % 7 WHEN 0 THEN url WHEN 1 THEN split_part(url, '?', 1) || '/a+b.PNG?x=1' WHEN 2 THEN split_part(split_part(url, '?', 1), '#', 1) || '/p.JPEG' WHEN 3 THEN split_part(split_part(url, '?', 1), '#', 1) || '/r.AVIF' WHEN 4 THEN split_part(split_part(url, '?', 1), '#', 1) || '/s.svg' WHEN 5 THEN split_part(split_part(url, '?', 1), '#', 1) || '/100%zz%.webp' ELSE split_part(split_part(url, '?', 1), '#', 1) || '/q:1.tar.gz' END AS u FROM pages"


@query(f"SELECT page_id, {_KIND} AS suffix, CASE WHEN contains({_LAST}, '.') THEN regexp_replace({_LAST}, '[<>:\"/\\\\|?*]', '_', 'g') ELSE printf('%04d', page_id) || '.' || {_KIND} END AS name FROM ({_URLS})")
def url_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 7
    bare = F.element_at(F.split("url", r"\?"), 1)
    plain = F.element_at(F.split(bare, "#"), 1)
    url = F.when(k == 0, F.col("url")).when(k == 1, F.concat(bare, F.lit("/a+b.PNG?x=1"))).when(k == 2, F.concat(plain, F.lit("/p.JPEG")))
    url = url.when(k == 3, F.concat(plain, F.lit("/r.AVIF"))).when(k == 4, F.concat(plain, F.lit("/s.svg"))).when(k == 5, F.concat(plain, F.lit("/100%zz%.webp"))).otherwise(F.concat(plain, F.lit("/q%3A1.tar.gz")))
    return table(spark, sf_dir, "pages").select("page_id", keys.url_suffix(url).alias("suffix"), keys.url_file_name(url, F.col("page_id")).alias("name"))


@query("SELECT page_id, starts_with(url, 'http://') OR starts_with(url, 'https://') AS is_url, 'data:image/jpeg;base64,' || to_base64(encode(url)) AS data_url FROM pages")
def data_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat("url", F.lit("/i.JPG"))
    return table(spark, sf_dir, "pages").select("page_id", keys.is_url(F.col("url")).alias("is_url"), keys.data_url(path, F.col("url").cast("binary")).alias("data_url"))


@query("""
    WITH lists AS (SELECT n_regionkey, string_agg(' ' || line || ' ', chr(10) ORDER BY n_nationkey) AS lines FROM (SELECT *, CASE n_nationkey % 4 WHEN 0 THEN '# note' WHEN 1 THEN '' ELSE 'http://x/' || n_name END AS line FROM nation) GROUP BY 1),
    each AS (SELECT n_regionkey, unnest(range(len(string_split(lines, chr(10))))) AS i, unnest(string_split(lines, chr(10))) AS line FROM lists)
    SELECT n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY i) AS position, trim(line) AS url FROM each WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')""")
def url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey") % 4
    line = F.when(k == 0, "# note").when(k == 1, "").otherwise(F.concat(F.lit("http://x/"), "n_name"))
    nation = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("line")))), lambda x: F.concat(F.lit(" "), x["line"], F.lit(" "))), "\n").alias("lines"))
    return nation.select("n_regionkey", F.inline(url_lines(F.col("lines"))))


@query("SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 8 AS INTEGER) AS shard FROM documents")
def shard_stride(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", keys.shard_of(F.col("position"), 8).alias("shard"))


@query("SELECT n_nationkey, CAST(ceil(count(*) / 16) AS BIGINT) AS batches, CAST(count(*) // 7 + CASE WHEN n_nationkey % 7 < count(*) % 7 THEN 1 ELSE 0 END AS BIGINT) AS share FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def rank_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return counts.select("n_nationkey", keys.batches_of(F.col("n"), 16).alias("batches"), keys.share_of(F.col("n"), F.col("n_nationkey") % 7, 7).alias("share"))


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100) WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def max_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hundred items, then those that are left to do: the limit is the feature."""
    from captionloom.operators.joins import skip_existing
    from captionloom.sources.items import first_items

    return skip_existing(first_items(table(spark, sf_dir, "documents").select("doc_id"), 100, "doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT event_id, 'props of ' || CAST(event_id AS VARCHAR) AS error, CAST(-1 AS INTEGER) AS label FROM events WHERE event_type = 'error' UNION ALL SELECT event_id, NULL, CAST(event_id % 10 AS INTEGER) FROM events WHERE event_type <> 'error'")
def load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    error, label = keys.load_outcome(F.col("event_type") == "error", F.concat(F.lit("props of "), F.col("event_id").cast("string")), F.col("event_id") % 10)
    return table(spark, sf_dir, "events").select("event_id", error.alias("error"), label.alias("label"))
