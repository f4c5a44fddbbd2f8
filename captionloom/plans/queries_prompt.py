"""Queries: templates, context items, tags in prompts, chat layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.functions import contexts, tags, templates
from captionloom.plans.registry import query, table

_ENGINE = templates.Engine()


@query("""
    SELECT o_orderkey, 'Order ' || CAST(o_orderkey AS VARCHAR) || ' (' || lower(o_orderpriority) || ', ' || CASE WHEN o_orderstatus = 'F' THEN 'open' ELSE o_orderstatus END || ') for {nobody} [' || o_orderstatus || ', ' || o_orderpriority || '] {"a": 1}' AS prompt
    FROM orders""")
def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _ENGINE.render(
        'Order {o.key} ({priority!lower}, {status:open}) for {nobody} [{both!csv}] {"a": 1}',
        {"o": F.struct(F.col("o_orderkey").alias("key")), "priority": F.col("o_orderpriority"), "status": F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")), "both": F.array("o_orderstatus", "o_orderpriority")},
        lists=frozenset({"both"}),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", made.alias("prompt"))


@query("SELECT p_partkey, upper(p_name) || '|' || trim(p_brand) || '|- ' || p_type || chr(10) || '- x|[\"' || p_type || '\",\"x\"]' AS text FROM part")
def prompt_formatters(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _ENGINE.render("{a!upper}|{b!strip}|{c!list}|{c!json}", {"a": F.col("p_name"), "b": F.concat(F.lit(" "), "p_brand", F.lit("\t")), "c": F.array("p_type", F.lit("x"))}, lists=frozenset({"c"}))
    return table(spark, sf_dir, "part").select("p_partkey", made.alias("text"))


@query("SELECT p_partkey, '{' || lower(split_part(p_brand, '#', 1)) || '}|{b:x!upper}' AS variables FROM part")
def template_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = F.concat(F.lit("a {"), F.lower(F.element_at(F.split("p_brand", "#"), 1)), F.lit("} {1x} {b:x!upper} { c}"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(templates.variables_of(template), "|").alias("variables"))


@query("""
    SELECT l_orderkey, l_linenumber, 'Detected Objects:' || chr(10) || '  - ' || l_returnflag || ' (' || printf('%.1f', 100 * l_discount) || '%): x=' || printf('%.0f', l_quantity) || ', y=' || printf('%.0f', l_linenumber / 4) || ', w=' || printf('%.0f', l_quantity) || ', h=2'
           || chr(10) || '  - Object 2: x=0, y=0, w=2, h=4' AS text FROM lineitem""")
def context_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lambda x: F.lit(x).cast("double")
    box = lambda x, y, w, h, label, sure: F.struct(x.alias("x"), y.alias("y"), w.alias("width"), h.alias("height"), label.alias("label"), sure.alias("confidence"))
    first = box(F.col("l_quantity").cast("double"), F.col("l_linenumber") / 4, F.col("l_quantity").cast("double"), d(2.5), F.col("l_returnflag"), F.col("l_discount").cast("double"))
    second = box(d(0), d(0.5), d(1.5), d(3.5), F.lit(None).cast("string"), d(None))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", contexts.boxes(F.array(first, second)).alias("text"))


@query("""
    SELECT p_partkey, 'Depth Information:' || chr(10) || '  Overview: ' || p_name || chr(10) || '  Depth range: ' || CAST(p_size AS VARCHAR) || '.5 - N/A' || chr(10) || '  Mean depth: 0.25' || chr(10) || '  Regions:' || chr(10) || '    - ' || p_brand || ': depth=far' || chr(10) || '    - Unknown: depth=N/A' AS depth,
           'Segmentation:' || chr(10) || '  - ' || p_type || ' (' || printf('%.1f', p_size + 0.25) || '%)' || chr(10) || '  - Unknown' || chr(10) || '  Detected classes: ' || p_brand || ', x' AS segmentation,
           'Text detected in image:' || chr(10) || '  "' || p_name || '"' || chr(10) || '  - "' || p_brand || '" (confidence: ' || CASE WHEN p_size % 2 = 0 THEN '50.0' ELSE '37.5' END || '%)' || chr(10) || '  - ""' AS ocr
    FROM part""")
def context_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    stats = F.struct((F.col("p_size") + 0.5).cast("double").alias("min"), null("double").alias("max"), F.lit(0.25).alias("mean"))
    regions = F.array(F.struct(F.col("p_brand").alias("name"), F.lit("far").alias("depth")), F.struct(null("string").alias("name"), null("string").alias("depth")))
    segments = F.array(F.struct(F.col("p_type").alias("label"), (F.col("p_size") + 0.25).cast("double").alias("area_percent")), F.struct(null("string").alias("label"), null("double").alias("area_percent")))
    blocks = F.array(F.struct(F.col("p_brand").alias("text"), F.when(F.col("p_size") % 2 == 0, 0.5).otherwise(0.375).alias("confidence")), F.struct(null("string").alias("text"), null("double").alias("confidence")))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        contexts.depth(F.col("p_name"), stats, regions).alias("depth"),
        contexts.segmentation(segments, F.array("p_brand", F.lit("x"))).alias("segmentation"),
        contexts.ocr(F.col("p_name"), blocks).alias("ocr"),
    )


@query("""
    SELECT p_partkey, 'Image Metadata:' || chr(10) || '  brand: ' || p_brand || chr(10) || '  size:' || chr(10) || '    cm: ' || CAST(p_size AS VARCHAR) || chr(10) || '    unit: cm' || chr(10) || chr(10)
           || 'Existing tags: ' || p_brand || ', big box' || chr(10) || chr(10) || CASE WHEN p_size % 2 = 0 THEN 'Text detected in image:' || chr(10) || '  "' || p_type || '"' ELSE '[Unvalidated ocr]: {"words": 1}' END
           || chr(10) || chr(10) || 'Note:' || chr(10) || '{"a":1}' AS text
    FROM part""")
def context_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    json = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    items = F.array().cast("array<struct<context_type:string,data:string,label:string>>")
    items = contexts.add_item(items, "metadata", json('{"brand": "', F.col("p_brand"), '", "size": {"cm": ', F.col("p_size").cast("string"), ', "unit": "cm"}}'))
    items = contexts.add_item(items, "tags", json('{"tags": "', F.col("p_brand"), ' , big box"}'))
    items = contexts.add_item(items, "ocr", F.when(F.col("p_size") % 2 == 0, json('{"text": "', F.col("p_type"), '"}')).otherwise('{"words": 1}'))
    items = contexts.add_item(items, "custom", F.lit('{"a":1}'), F.lit("Note"))
    return table(spark, sf_dir, "part").select("p_partkey", contexts.format_items(items).alias("text"))


@query("SELECT p_partkey, 'Size ' || CAST(p_size AS VARCHAR) || ' of ' || p_brand || ' {gone}' AS text FROM part")
def context_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.to_json(F.struct(F.concat(F.lit("{size} of "), "p_brand").alias("what"), F.col("p_size").alias("size")))
    return table(spark, sf_dir, "part").select("p_partkey", contexts.custom(data, template="Size {what} {gone}", keys=("what", "size", "gone")).alias("text"))


@query("""
    SELECT doc_id, 'Describe.' || CASE WHEN quality IS NULL THEN '' ELSE chr(10) || chr(10) || 'Existing tags:' || chr(10) || 'Features: lang ' || lang || ', ' || source || CASE WHEN toxic = 1 THEN chr(10) || 'Rating: not safe' ELSE '' END END AS prompt
    FROM documents LEFT JOIN labels USING (doc_id)""")
def tags_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    none = F.array().cast("array<string>")
    general = F.when(F.col("quality").isNotNull(), F.array(F.concat(F.lit("lang_"), "lang"), "source")).otherwise(none)
    rating = F.when(F.col("toxic") == 1, F.array(F.lit("not_safe"))).otherwise(none)
    return docs.select("doc_id", tags.with_tags(F.lit("Describe."), tags.prompt_lines(general, none, rating)).alias("prompt"))


@query("""
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN lang || ',a' WHEN 1 THEN lang || ',b' ELSE lang END AS general, CASE doc_id % 3 WHEN 1 THEN source ELSE '' END AS character FROM documents""")
def canonical_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    nested = F.format_string('{"image_id": "x", "tags": {"general_tags": ["%s", "a"], "rating_tags": []}}', "lang")
    flat = F.format_string('{"general": ["%s", "b"], "character": ["%s"], "scores": {}}', "lang", "source")
    top = F.format_string('{"general_tags": ["%s"], "character_tags": []}', "lang")
    own = tags.canonical(F.when(k == 0, nested).when(k == 1, flat).otherwise(top))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(own["general"], ",").alias("general"), F.array_join(own["character"], ",").alias("character"))


@query("""
    SELECT conv_id, turn, '[' || CASE WHEN turn % 2 = 0 THEN '{"role":"system","content":"' || role || '"},' ELSE '' END || '{"role":"user","content":[{"type":"text","text":"turn ' || CAST(turn AS VARCHAR) || '"},{"type":"image_url","image_url":{"url":"http://x/' || CAST(conv_id AS VARCHAR) || '","detail":"auto"}}]}]' AS messages
    FROM conversations""")
def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, url = F.concat(F.lit("turn "), F.col("turn").cast("string")), F.concat(F.lit("http://x/"), F.col("conv_id").cast("string"))
    made = templates.chat_messages(text, url, F.when(F.col("turn") % 2 == 0, F.col("role")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", made.alias("messages"))


_MODELS = ("google/Gemma-3n-E4B", "google/gemma-3-27b", "llava-v1.6-7b", "llava-1.5-13b", "Qwen2.5-VL-7B", "OpenGVLab/InternVL2", "other")
_NAMES = ("gemma-3n", "gemma-3", "llava-next", "llava-1.5", "qwen2-vl", "internvl", "default")


_SYSTEM = "CASE WHEN turn % 2 = 0 THEN {} ELSE {} END"
_N = "' || chr(10) || '"


def _layout(before: str, after: str, system_before: str | None = None) -> str:
    """SQL of one family: the system text before the prompt, or in a turn of its own."""
    with_system = f"'{before}be brief{_N}{_N}' || role || '{after}'" if system_before is None else f"'{system_before}be brief<|im_end|>{_N}{before}' || role || '{after}'"
    return _SYSTEM.format(with_system, f"'{before}' || role || '{after}'")


_GEMMA, _QWEN = f"<end_of_turn>{_N}<start_of_turn>model{_N}", f"<|im_end|>{_N}<|im_start|>assistant{_N}"
_LAYOUTS = (
    _layout(f"<start_of_turn>user{_N}<image_soft_token>", _GEMMA),
    _layout(f"<bos><start_of_turn>user{_N}<start_of_image>", _GEMMA),
    _layout(f"[INST] <image>{_N}", " [/INST]"),
    _layout(f"USER: <image>{_N}", f"{_N}ASSISTANT:"),
    _layout(f"<|im_start|>user{_N}<|vision_start|><|image_pad|><|vision_end|>", _QWEN, f"<|im_start|>system{_N}"),
    _layout(f"<|im_start|>user{_N}<image>{_N}", _QWEN, f"<|im_start|>system{_N}"),
    _layout(f"<image>{_N}", ""),
)


@query(f"""
    SELECT conv_id, turn, list_extract({list(_NAMES)!r}, CAST((conv_id + turn) % 7 + 1 AS INTEGER)) AS family,
           CASE (conv_id + turn) % 7 {" ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(_LAYOUTS))} END AS prompt
    FROM conversations""")
def model_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven families, with a system text in even turns."""
    k = (F.col("conv_id") + F.col("turn")) % 7
    family = templates.model_family(F.get(F.array(*[F.lit(m) for m in _MODELS]), k.cast("int")))
    made = templates.chat_prompt(family, F.col("role"), F.when(F.col("turn") % 2 == 0, "be brief"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", family.alias("family"), made.alias("prompt"))
