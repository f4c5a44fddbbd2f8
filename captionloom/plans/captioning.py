"""Whole captioning plans: prompt, model call, parse, validate, retry, and the split into captions and failures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionloom.functions import contexts, tags, templates
from captionloom.functions.parsing import KeyValueFormat
from captionloom.functions.validating import Validator
from captionloom.operators.joins import skip_existing
from captionloom.operators.lineage import settle
from captionloom.plans.backends import Backend, Retry, generate


def build_prompt(prompt: templates.Prompt, fmt: KeyValueFormat, engine: templates.Engine | None = None, items: Column | None = None, tag_lines: Column | None = None, **values: Column) -> Column:
    """The rendered prompt: context items and the format's instruction are variables; tags are appended."""
    context = {"context": F.lit("") if items is None else contexts.format_items(items), "instruction": F.lit(fmt.instruction()), **values}
    made = F.regexp_replace(prompt.render(engine or templates.Engine(), context), r"(?U)^\s+|\s+$", "")
    return made if tag_lines is None else tags.with_tags(made, tag_lines)


def caption(items: DataFrame, make: Callable[[], Backend], key: str, fmt: KeyValueFormat | None = None, done: DataFrame | None = None, item_key: str = "image_id", image: str | None = None, validation_retries: int = 2, validator: Validator | None = None, batch: int = 8, retry: Retry = Retry()) -> DataFrame:  # noqa: B008
    """items (with `prompt`) to success, data, error, raw, retries, latency_ms, passes.

    Finished items are left out first. What the model answers is parsed, and judged by the validator if there is one; rows
    whose answer does not parse or is not valid are asked again, in passes of their own over those rows alone, while rows whose call failed are final at once. Answers are
    settled after each pass, so nothing is generated twice.
    """
    fmt = fmt or KeyValueFormat()
    todo = items if done is None else skip_existing(items, done, item_key)
    base = todo.columns
    finished: list[DataFrame] = []
    for k in range(validation_retries + 1):
        answered = generate(todo, make, key, image=image, batch=batch, retry=retry)
        parsed = answered.withColumn("__parsed", fmt.parse(F.col("raw"))).withColumn("passes", F.lit(k + 1))
        judged = validator(F.col("raw")) if validator else F.struct(F.lit(True).alias("valid"), F.lit(None).cast("string").alias("error"))
        parsed = parsed.withColumn("__judged", judged)
        error = F.when(F.col("success"), F.coalesce("__parsed.error", "__judged.error")).otherwise(F.col("error"))
        rows = parsed.select(*base, (F.col("success") & F.col("__parsed.success") & F.col("__judged.valid")).alias("success"), F.col("success").alias("called"), F.when(F.col("success"), F.col("__parsed.data")).alias("data"), error.alias("error"), "raw", "retries", "latency_ms", "passes")
        rows = settle(rows)
        again = rows.where("called AND NOT success")
        if k == validation_retries or again.isEmpty():
            finished.append(rows)
            break
        finished.append(rows.where("success OR NOT called"))
        todo = again.select(*base)
    out = finished[0]
    for df in finished[1:]:
        out = out.unionByName(df)
    return out.drop("called")


def tag_vectors(items: DataFrame, make: Callable[[], object], vector_col: str, image_col: str) -> DataFrame:
    """Adds a tagger's scores: make() gives a function from a batch of images to a batch of vectors, built for each worker."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as T

    return items.withColumn(vector_col, predict_batch_udf(make, return_type=T.ArrayType(T.FloatType()), batch_size=64)(F.col(image_col)))
