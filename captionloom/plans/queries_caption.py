"""Queries: captioning plans from end to end, with the deterministic backend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.functions import tags, templates
from captionloom.functions.parsing import KeyValueFormat
from captionloom.plans.backends import EchoBackend, Retry
from captionloom.plans.captioning import build_prompt, caption
from captionloom.plans.registry import query, table


def _no_pause(seconds: float) -> None:
    """The echo backend needs no rest between attempts."""


@query("""
    SELECT p_partkey, p_partkey % 10 <> 0 AS success, CASE WHEN p_partkey % 10 <> 0 THEN length(p_name) || ' characters' END AS brief, CASE WHEN p_partkey % 10 <> 0 THEN p_name END AS description,
           CASE WHEN p_partkey % 10 = 0 THEN 'echo backend was told to fail' END AS error
    FROM part WHERE p_partkey % 4 <> 0""")
def echo_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip what is done, prompt, generate, parse, and keep failures as rows."""
    part = table(spark, sf_dir, "part")
    prompt = F.when(F.col("p_partkey") % 10 == 0, F.concat("p_name", F.lit("[fail]"))).otherwise(F.col("p_name"))
    items = part.select("p_partkey", prompt.alias("prompt"))
    done = part.where("p_partkey % 4 = 0").select("p_partkey")
    out = caption(items, EchoBackend, "echo", done=done, item_key="p_partkey", retry=Retry(attempts=1, sleep=_no_pause))
    return out.select("p_partkey", "success", F.col("data.brief").alias("brief"), F.col("data.description").alias("description"), "error")


@query("""
    SELECT p_partkey, 'Caption ' || p_name || '.' || chr(10) || chr(10) || 'Text detected in image:' || chr(10) || '  "' || p_brand || '"' || chr(10) || chr(10) || 'Existing tags:' || chr(10) || 'Features: ' || p_type AS prompt FROM part""")
def built_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.array(F.struct(F.lit("ocr").alias("context_type"), F.to_json(F.struct(F.col("p_brand").alias("text"))).alias("data"), F.lit(None).cast("string").alias("label")))
    own = templates.Prompt("own", "Caption {name}.\n\n{context}\n")
    made = build_prompt(own, KeyValueFormat(), items=items, tag_lines=F.concat(F.lit("Features: "), "p_type"), name=F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", made.alias("prompt"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS prompt_tags, lang AS saved_tags FROM documents")
def tag_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags go to the prompt in context mode alone; they are saved in both modes."""
    mode = F.when(F.col("doc_id") % 2 == 0, "context").otherwise("parallel")
    return table(spark, sf_dir, "documents").select("doc_id", tags.prompt_tags(mode, F.col("lang")).alias("prompt_tags"), F.col("lang").alias("saved_tags"))
