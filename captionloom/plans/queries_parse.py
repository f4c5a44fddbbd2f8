"""Queries: section parsers, converters, formats and validators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.functions import parsing, validating
from captionloom.functions.parsing import Field
from captionloom.plans.registry import query, table

FIELDS = (Field("title"), Field("size", kind="int"), Field("score", kind="float"), Field("parts", kind="list"))


def _raw(open_line) -> Column:
    """Text in a section layout from a part's columns; every seventh part lacks its score, every fifth repeats the title."""
    line = lambda name, value: F.concat(F.lit(open_line(name)), F.lit("\n"), value, F.lit("\n\n"))
    key = F.col("p_partkey")
    return F.concat(
        F.lit("preamble that is dropped\n"),
        line("Title", F.col("p_name")),
        line("size", F.concat(F.lit("about "), F.col("p_size").cast("string"), F.lit(" cm"))),
        F.when(key % 7 != 0, line("score", F.concat(F.lit(" "), (F.col("p_size") / 8).cast("string"), F.lit(" ")))).otherwise(""),
        line("parts", F.concat_ws(", ", "p_brand", "p_type")),
        F.when(key % 5 == 0, line("title", F.lit("   "))).otherwise(""),
    )


_PARSED = """SELECT p_partkey, p_name AS title, CAST(p_size AS BIGINT) AS size, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) / 8 END AS score, p_brand || '|' || p_type AS parts,
    p_partkey % 7 <> 0 AS success, CASE WHEN p_partkey % 7 = 0 THEN 'Missing required fields: score' END AS error FROM part"""


def _parsed(spark: SparkSession, sf_dir: str, header: str, open_line) -> DataFrame:
    got = table(spark, sf_dir, "part").select("p_partkey", parsing.parse_key_values(_raw(open_line), FIELDS, header).alias("r"))
    return got.select("p_partkey", "r.data.title", "r.data.size", "r.data.score", F.array_join("r.data.parts", "|").alias("parts"), "r.success", "r.error")


@query(_PARSED)
def parse_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "hash", lambda n: f"# {n} and a tail")


@query(_PARSED)
def parse_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "bracket", lambda n: f" [ {n} ] ")


@query(_PARSED)
def parse_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir, "xml", lambda n: f"<{n}> more")


@query("""
    SELECT p_partkey, 1 AS start_line, CAST(4 AS INTEGER) AS end_line, 'title' AS name, p_name AS content FROM part
    UNION ALL SELECT p_partkey, 5, 7, 'brand', p_brand FROM part WHERE p_size % 2 = 0""")
def section_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("x\n#title\n"), F.col("p_name"), F.lit("\n\n\n# Brand\n"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(" "), F.lit("\n"))
    found = parsing.sections(text, ["title", "brand"])
    return table(spark, sf_dir, "part").select("p_partkey", F.inline(found)).select("p_partkey", "start_line", "end_line", "name", "content")


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE) WHEN p_partkey % 3 = 1 THEN p_retailprice ELSE 0 END AS number,
           CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS BIGINT) WHEN p_partkey % 3 = 1 THEN CAST(floor(p_retailprice) AS BIGINT) ELSE 0 END AS whole, string_agg(w, '|' ORDER BY i) AS items
    FROM (SELECT p_partkey, p_size, p_retailprice, unnest(w) AS w, unnest(range(len(w))) AS i FROM (SELECT *, string_split(p_type || ' ' || p_brand, ' ') AS w FROM part)) GROUP BY ALL""")
def convert_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    text = F.when(key % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit("/10"))).when(key % 3 == 1, F.concat(F.lit("$"), F.format_string("%.2f", "p_retailprice"))).otherwise("none")
    items = F.concat(F.replace(F.concat_ws(" ", "p_type", "p_brand"), F.lit(" "), F.lit(" ,\n")), F.lit(", "))
    return table(spark, sf_dir, "part").select("p_partkey", parsing.to_float(text).alias("number"), parsing.to_int(text).alias("whole"), F.array_join(parsing.to_list(items), "|").alias("items"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Parse error: could not convert string to float: ''1.2.3''' END AS error, p_size % 2 = 1 AS success FROM part")
def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("# score\n"), F.when(F.col("p_size") % 2 == 0, "v 1.2.3").otherwise("0.5f"))
    got = parsing.parse_key_values(text, (Field("score", kind="float"),))
    return table(spark, sf_dir, "part").select("p_partkey", got["error"].alias("error"), got["success"].alias("success"))


@query("SELECT p_partkey, '# title' || chr(10) || p_name || chr(10) || chr(10) || '# size' || chr(10) || CAST(p_size AS VARCHAR) || chr(10) || chr(10) || '# tags' || chr(10) || p_brand || ', ' || p_type AS text FROM part")
def format_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = parsing.format_key_values({"title": ("str", F.concat(F.lit(" "), "p_name")), "size": ("int", F.col("p_size")), "tags": ("list", F.array(F.concat("p_brand", F.lit(" ")), "p_type"))})
    return table(spark, sf_dir, "part").select("p_partkey", made.alias("text"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'Missing required fields: gone' AS error, false AS success FROM events")
def parse_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```"))).otherwise(F.concat(F.lit("here "), "props", F.lit(" and more }")))
    got = table(spark, sf_dir, "events").select("event_id", parsing.parse_json_fields(text, (Field("k", kind="int"), Field("gone"))).alias("r"))
    return got.select("event_id", "r.data.k", "r.error", "r.success")


@query("""
    SELECT p_partkey, CAST(p_size AS DOUBLE) AS f, CAST(floor(p_retailprice) AS BIGINT) AS i, CASE WHEN p_size % 2 = 0 THEN p_brand || '|x' ELSE p_brand END AS l, CASE WHEN p_size % 2 = 0 THEN 1.0 ELSE 0.0 END AS b FROM part""")
def parse_json_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("p_size") % 2 == 0
    text = F.concat(
        F.lit('{"f": "'), F.col("p_size").cast("string"), F.lit('", "i": '), F.format_string("%.2f", "p_retailprice"), F.lit(', "l": '),
        F.when(even, F.concat(F.lit('["'), "p_brand", F.lit('", "x"]'))).otherwise(F.concat(F.lit('"'), "p_brand", F.lit('"'))), F.lit(', "b": '), F.when(even, "true").otherwise("null"), F.lit("}"),
    )
    kinds = (Field("f", kind="float"), Field("i", kind="int"), Field("l", kind="list"), Field("b", kind="float"))
    got = table(spark, sf_dir, "part").select("p_partkey", parsing.parse_json_fields(text, kinds)["data"].alias("d"))
    return got.select("p_partkey", "d.f", "d.i", F.array_join("d.l", "|").alias("l"), "d.b")


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS value, regexp_matches(html, '<title>([^<]*)</title>') AS valid, CASE WHEN NOT regexp_matches(html, '<title>([^<]*)</title>') THEN 'no title' END AS error FROM pages")
def validate_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = table(spark, sf_dir, "pages").select("page_id", validating.regex("<title>([^<]*)</title>", 1, "no title")(F.col("html")).alias("r"))
    return got.select("page_id", "r.value", "r.valid", "r.error")


def _object(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    score = F.when(key % 4 == 0, '"high"').when(key % 4 == 1, '"0.25"').otherwise(F.format_string("%.2f", F.col("p_size") / 10))
    text = F.concat(F.lit('```json\n{"title": "'), "p_brand", F.lit('", "score": '), score, F.when(key % 5 == 0, "").otherwise(', "kind": "a"'), F.when(key % 11 == 0, "").otherwise("}"), F.lit("\n```"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", text.alias("text"))


_BASIC = (Field("title"), Field("score", kind="float"), Field("kind"))


@query("""
    SELECT p_partkey, p_partkey % 11 <> 0 AND p_partkey % 4 <> 0 AND p_partkey % 5 <> 0 AS valid,
           CASE WHEN p_partkey % 11 = 0 THEN 'Invalid JSON' WHEN p_partkey % 4 = 0 AND p_partkey % 5 = 0 THEN 'Validation error: score, kind'
                WHEN p_partkey % 4 = 0 THEN 'Validation error: score' WHEN p_partkey % 5 = 0 THEN 'Validation error: kind' END AS error,
           CASE WHEN p_partkey % 11 <> 0 AND p_partkey % 4 <> 0 AND p_partkey % 5 <> 0 THEN CASE WHEN p_partkey % 4 = 1 THEN 0.25 ELSE CAST(p_size AS DOUBLE) / 10 END END AS score
    FROM part""")
def validate_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _object(spark, sf_dir).select("p_partkey", validating.model(_BASIC)(F.col("text")).alias("r"))
    return got.select("p_partkey", "r.valid", "r.error", F.col("r.value.score").alias("score"))


@query("""
    SELECT p_partkey, p_partkey % 11 <> 0 AND p_partkey % 4 >= 2 AND p_partkey % 5 <> 0 AS valid,
           CASE WHEN p_partkey % 11 = 0 THEN 'Invalid JSON' WHEN p_partkey % 4 < 2 AND p_partkey % 5 = 0 THEN 'Validation error: score, kind'
                WHEN p_partkey % 4 < 2 THEN 'Validation error: score' WHEN p_partkey % 5 = 0 THEN 'Validation error: kind' END AS error
    FROM part""")
def validate_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number written as a string does not count."""
    got = _object(spark, sf_dir).select("p_partkey", validating.model(_BASIC, strict=True)(F.col("text")).alias("r"))
    return got.select("p_partkey", "r.valid", "r.error")


_RULES = {
    "type": "object",
    "required": ["title", "kind"],
    "properties": {"score": {"type": "number", "minimum": 0.2, "maximum": 3}, "title": {"type": "string", "pattern": "^Brand#[1-3]"}, "kind": {"enum": ["a", "b"]}, "tags": {"type": "array", "items": {"type": "string"}}},
}


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'Invalid JSON' ELSE nullif(concat_ws('; ', CASE WHEN p_partkey % 5 = 0 THEN 'kind is required' END,
           CASE WHEN p_partkey % 4 = 0 THEN 'score is not of type number' WHEN p_size < 2 THEN 'score is less than 0.2' WHEN p_size > 30 THEN 'score is greater than 3' END,
           CASE WHEN NOT regexp_matches(p_brand, '^Brand#[1-3]') THEN 'title does not match' END,
           CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 3 = 0 THEN 'kind is not one of the allowed values' END,
           CASE WHEN p_partkey % 6 = 0 THEN 'tags has items of another type' WHEN p_partkey % 6 = 1 THEN 'tags is not of type array' END), '') END AS error
    FROM part""")
def validate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    score = F.when(key % 4 == 0, '"high"').otherwise(F.format_string("%.2f", F.col("p_size") / 10))
    kind = F.when(key % 5 == 0, "").otherwise(F.concat(F.lit(', "kind": "'), F.when(key % 3 == 0, "z").otherwise("a"), F.lit('"')))
    own = F.when(key % 6 == 0, "[1, 2]").when(key % 6 == 1, '"x"').otherwise('["x"]')
    text = F.concat(F.lit('{"title": "'), "p_brand", F.lit('", "score": '), score, kind, F.lit(', "tags": '), own, F.when(key % 11 == 0, "").otherwise("}"))
    got = table(spark, sf_dir, "part").select("p_partkey", validating.schema(_RULES)(text).alias("r"))
    return got.select("p_partkey", "r.error")


@query("""
    SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 AND event_type = 'error' THEN 'error' END AS value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 AND event_type = 'error' AS valid,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 1 THEN 'odd' WHEN event_type <> 'error' THEN 'no error' END AS error
    FROM events""")
def validate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    text = F.concat(F.when(k % 2 == 0, "even").otherwise("none"), F.lit(" "), F.col("event_type"))
    got = validating.all_of(validating.regex("even", 0, "odd"), validating.regex("error", 0, "no error"))(text)
    return table(spark, sf_dir, "events").select("event_id", got["value"].alias("value"), got["valid"].alias("valid"), got["error"].alias("error"))


@query("""
    SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'even' WHEN event_type = 'error' THEN 'error' END AS value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 OR event_type = 'error' AS valid,
           CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 1 AND event_type <> 'error' THEN 'odd; no error' END AS error
    FROM events""")
def validate_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    text = F.concat(F.when(k % 2 == 0, "even").otherwise("none"), F.lit(" "), F.col("event_type"))
    got = validating.first_success(validating.regex("even", 0, "odd"), validating.regex("error", 0, "no error"))(text)
    return table(spark, sf_dir, "events").select("event_id", got["value"].alias("value"), got["valid"].alias("valid"), got["error"].alias("error"))


@query("SELECT event_id, event_id % 3 = 0 AS valid, CASE WHEN event_id % 3 = 0 THEN '{\"k\":' || json_extract_string(props, '$.k') || '}' END AS value FROM events")
def extract_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, "null").otherwise("{broken")
    got = validating.json_object()(text)
    return table(spark, sf_dir, "events").select("event_id", got["valid"].alias("valid"), got["value"].alias("value"))


@query("""
    SELECT doc_id, '{' || chr(10) || '  "title": ' || coalesce(CAST(to_json(source) AS VARCHAR), 'null') || ',' || chr(10) || '  "description": ' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',' || chr(10)
           || '  "length": ' || coalesce(CAST(n_chars AS VARCHAR), 'null') || ',' || chr(10) || '  "tags": ' || CASE WHEN doc_id % 3 = 0 THEN '[]' ELSE '[' || chr(10) || '    "' || lang || '",' || chr(10) || '    "b\\\\c"' || chr(10) || '  ]' END || chr(10) || '}' AS json
    FROM documents""")
def format_json_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = (parsing.Field("title"), parsing.Field("description"), parsing.Field("length", kind="int"), parsing.Field("tags", kind="list"))
    tags = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("lang", F.lit("b\\c")))
    data = F.struct(F.col("source").alias("title"), F.col("text").alias("description"), F.col("n_chars").alias("length"), tags.alias("tags"))
    return table(spark, sf_dir, "documents").select("doc_id", parsing.format_json(data, fields).alias("json"))
