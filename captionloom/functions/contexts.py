"""Context items (typed payloads about an image) to the text that a prompt carries.

Each formatter takes typed columns; `format_item` and `format_items` dispatch over items whose payload is JSON,
read into one schema that holds every kind's fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from captionloom.functions.textops import fixed, percent, python_list, python_number, strip

KINDS = ("metadata", "object_bbox", "depth_map", "segmentation", "ocr", "tags", "custom")
#: One schema for the payloads of all kinds but metadata and custom, which are taken as maps.
PAYLOAD = (
    "struct<boxes:array<struct<x:double,y:double,width:double,height:double,label:string,confidence:double>>,"
    "description:string,stats:struct<min:double,max:double,mean:double>,regions:array<struct<name:string,depth:string>>,"
    "segments:array<struct<label:string,area_percent:double>>,classes:array<string>,"
    "text:string,blocks:array<struct<text:string,confidence:double>>,tags:array<string>,categories:map<string,array<string>>>"
)


def _lines(*parts: Column) -> Column:
    return F.concat_ws("\n", *parts)


def _each(items: Column, show) -> Column:
    """One line for each item, null where there is no list."""
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, show), "\n"))


def metadata(entries: Column) -> Column:
    """entries: array<struct<key, value>>; a value that is a JSON object becomes a level of its own."""

    def show(e: Column) -> Column:
        nested = F.when(e["value"].rlike(r"^\s*\{"), F.map_entries(F.from_json(e["value"], "map<string,string>")))
        inner = F.array_join(F.transform(nested, lambda x: F.concat(F.lit("\n    "), x["key"], F.lit(": "), x["value"])), "")
        return F.concat(F.lit("  "), e["key"], F.when(nested.isNotNull(), F.concat(F.lit(":"), inner)).otherwise(F.concat(F.lit(": "), e["value"])))

    return F.concat_ws("\n", F.lit("Image Metadata:"), _each(entries, show))


def boxes(items: Column) -> Column:
    def show(b: Column, i: Column) -> Column:
        label = F.coalesce(b["label"], F.concat(F.lit("Object "), (i + 1).cast("string")))
        sure = F.when(b["confidence"].isNotNull(), F.concat(F.lit(" ("), percent(b["confidence"]), F.lit(")"))).otherwise("")
        return F.concat(F.lit("  - "), label, sure, F.lit(": x="), fixed(b["x"], 0), F.lit(", y="), fixed(b["y"], 0), F.lit(", w="), fixed(b["width"], 0), F.lit(", h="), fixed(b["height"], 0))

    return _lines(F.lit("Detected Objects:"), _each(items, show))


def depth(description: Column, stats: Column, regions: Column) -> Column:
    number = lambda c: F.coalesce(python_number(c), F.lit("N/A"))
    spread = F.when(stats.isNotNull(), F.concat(F.lit("  Depth range: "), number(stats["min"]), F.lit(" - "), number(stats["max"])))
    mean = F.when(stats["mean"].isNotNull(), F.concat(F.lit("  Mean depth: "), python_number(stats["mean"])))
    head = F.when(regions.isNotNull(), F.lit("  Regions:"))
    show = lambda r: F.concat(F.lit("    - "), F.coalesce(r["name"], F.lit("Unknown")), F.lit(": depth="), F.coalesce(r["depth"], F.lit("N/A")))
    return _lines(F.lit("Depth Information:"), F.concat(F.lit("  Overview: "), description), spread, mean, head, _each(regions, show))


def segmentation(segments: Column, classes: Column) -> Column:
    def show(s: Column) -> Column:
        area = F.when(s["area_percent"].isNotNull(), F.concat(F.lit(" ("), fixed(s["area_percent"], 1), F.lit("%)"))).otherwise("")
        return F.concat(F.lit("  - "), F.coalesce(s["label"], F.lit("Unknown")), area)

    return _lines(F.lit("Segmentation:"), _each(segments, show), F.when(classes.isNotNull(), F.concat(F.lit("  Detected classes: "), python_list(classes))))


def ocr(text: Column, blocks: Column) -> Column:
    def show(b: Column) -> Column:
        sure = F.when(b["confidence"].isNotNull(), F.concat(F.lit(" (confidence: "), percent(b["confidence"]), F.lit(")"))).otherwise("")
        return F.concat(F.lit('  - "'), F.coalesce(b["text"], F.lit("")), F.lit('"'), sure)

    return _lines(F.lit("Text detected in image:"), F.concat(F.lit('  "'), text, F.lit('"')), _each(blocks, show))


def split_tags(text: Column) -> Column:
    return F.transform(F.split(text, ","), strip)


def tags(items: Column, categories: Column | None = None) -> Column:
    plain = F.concat(F.lit("Existing tags: "), python_list(F.coalesce(items, F.array().cast("array<string>"))))
    if categories is None:
        return plain
    show = lambda e: F.concat(F.lit("  "), e["key"], F.lit(": "), python_list(e["value"]))
    return F.when(categories.isNotNull(), _lines(F.lit("Existing tags:"), _each(F.map_entries(categories), show))).otherwise(plain)


def custom(data: Column, label: Column | None = None, template: str | None = None, keys: tuple[str, ...] = ()) -> Column:
    """A template whose {key}s are replaced in order (a value may bring a later key's placeholder), else labelled JSON."""
    if template is None:
        return F.concat(F.coalesce(F.lit("Additional Context") if label is None else label, F.lit("Additional Context")), F.lit(":\n"), data)
    out = F.lit(template)
    for key in keys:
        value = F.get_json_object(data, f"$.{key}")
        out = F.when(value.isNull(), out).otherwise(F.replace(out, F.lit("{" + key + "}"), value))
    return out


def format_item(kind: Column, data: Column, label: Column | None = None) -> Column:
    """kind and JSON payload to text; a payload that lacks its kind's fields is shown as it is, marked as unvalidated."""
    p = F.from_json(data, PAYLOAD)
    flat = F.when(F.get_json_object(data, "$.tags").startswith("["), p["tags"]).otherwise(split_tags(F.get_json_object(data, "$.tags")))
    complete = F.forall(p["boxes"], lambda b: b["x"].isNotNull() & b["y"].isNotNull() & b["width"].isNotNull() & b["height"].isNotNull())
    entries = F.map_entries(F.from_json(data, "map<string,string>"))
    made = {
        "metadata": (entries.isNotNull(), metadata(entries)),
        "object_bbox": (F.coalesce(complete, F.lit(False)), boxes(p["boxes"])),
        "depth_map": (p["description"].isNotNull() | p["stats"].isNotNull() | p["regions"].isNotNull(), depth(p["description"], p["stats"], p["regions"])),
        "segmentation": (p["segments"].isNotNull() | p["classes"].isNotNull(), segmentation(p["segments"], p["classes"])),
        "ocr": (p["text"].isNotNull() | p["blocks"].isNotNull(), ocr(p["text"], p["blocks"])),
        "tags": (F.get_json_object(data, "$.tags").isNotNull(), tags(flat, p["categories"])),
        "custom": (entries.isNotNull(), custom(data, label)),
    }
    out = None
    for name, (valid, shown) in made.items():
        shown = F.when(F.coalesce(valid, F.lit(False)), shown).otherwise(F.concat(F.lit(f"[Unvalidated {name}]: "), data))
        out = F.when(kind == name, shown) if out is None else out.when(kind == name, shown)
    return out.otherwise(F.raise_error(F.concat(F.lit("no provider for context type: "), F.coalesce(kind, F.lit("null")))).cast("string"))


def format_items(items: Column) -> Column:
    """items: array<struct<context_type, data, label>>, in order, with a blank line between."""
    return F.array_join(F.transform(items, lambda x: format_item(x["context_type"], x["data"], x["label"])), "\n\n")


def add_item(items: Column, kind: str, data: Column, label: Column | None = None) -> Column:
    """The items with one more at the end."""
    if kind not in KINDS:
        raise ValueError(f"no provider for context type: {kind}")
    item = F.struct(F.lit(kind).alias("context_type"), data.alias("data"), (F.lit(None).cast("string") if label is None else label).alias("label"))
    return F.concat(F.coalesce(items, F.array().cast("array<struct<context_type:string,data:string,label:string>>")), F.array(item))
