"""Validators: text to struct<valid, value, error>, as Column expressions that can be combined."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from captionloom.functions.parsing import Field, data_type, fenced_json, parse_json_fields

Validator = Callable[[Column], Column]


def verdict(valid: Column, value: Column, error: Column) -> Column:
    valid = F.coalesce(valid, F.lit(False))
    return F.struct(valid.alias("valid"), F.when(valid, value).alias("value"), F.when(~valid, error).alias("error"))


def regex(pattern: str, group: int = 0, message: str = "No match") -> Validator:
    """Valid where the pattern is found; the value is the group, null where the group took no part."""
    return lambda c: verdict(c.rlike(pattern), F.nullif(F.regexp_extract(c, pattern, group), F.lit("")) if group else F.regexp_extract(c, pattern, 0), F.lit(message))


def json_object() -> Validator:
    """Valid where the text, or its code fence, is JSON other than null; the value is its text."""

    def run(c: Column) -> Column:
        v = F.try_parse_json(fenced_json(c))
        return verdict(v.isNotNull() & ~F.is_variant_null(v), v.cast("string"), F.lit("Invalid JSON"))

    return run


def model(fields: tuple[Field, ...], strict: bool = False) -> Validator:
    """A typed object: required fields present and of their kind. Lax mode takes numbers from strings."""

    def judge(s: Column) -> Column:
        text, v = s["text"], s["v"]
        problems = []
        for f in fields:
            own = F.try_variant_get(v, f"$.{f.name}", "variant")
            kind = F.schema_of_variant(own)
            number, whole = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), kind == "BIGINT"
            as_text = F.try_variant_get(v, f"$.{f.name}", "string")
            ok = {
                "str": kind == "STRING",
                "float": number if strict else number | (kind == "BOOLEAN") | ((kind == "STRING") & as_text.try_cast("double").isNotNull()),
                "int": whole if strict else whole | (kind == "BOOLEAN") | (as_text.try_cast("bigint").cast("double") == as_text.try_cast("double")),
                "list": kind.startswith("ARRAY"),
            }[f.kind]
            gone = own.isNull()
            bad = (gone & F.lit(f.required)) | (~gone & ~F.coalesce(ok, F.lit(False)))
            problems.append(F.when(bad, F.lit(f.name)))
        wrong = F.array_join(F.filter(F.array(*problems), lambda x: x.isNotNull()), ", ")
        error = F.when(v.isNull(), F.lit("Invalid JSON")).when(wrong != "", F.concat(F.lit("Validation error: "), wrong))
        value = parse_json_fields(text, fields)["data"]
        return verdict(error.isNull(), value, error)

    def run(c: Column) -> Column:
        # Parsed once, under a name, for all fields.
        own = F.struct(fenced_json(c).alias("text"), F.try_parse_json(fenced_json(c)).alias("v"))
        return F.get(F.transform(F.array(own), judge), F.lit(0))

    return run


def schema(rules: dict) -> Validator:
    """A part of JSON Schema: type, required, properties with type, minimum, maximum, enum, pattern and items' type.
    Up to five messages, in the order of the properties."""
    kinds = {"string": "^STRING", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", "integer": "^BIGINT", "boolean": "^BOOLEAN", "array": "^ARRAY", "object": "^OBJECT", "null": "^VOID"}

    def run(c: Column) -> Column:
        v = F.try_parse_json(fenced_json(c))
        found = [F.when(~F.schema_of_variant(v).rlike(kinds[rules["type"]]), F.lit(f"not of type {rules['type']}"))] if "type" in rules else []
        for name in rules.get("required", []):
            found.append(F.when(F.try_variant_get(v, f"$.{name}", "variant").isNull(), F.lit(f"{name} is required")))
        for name, rule in rules.get("properties", {}).items():
            own = F.try_variant_get(v, f"$.{name}", "variant")
            there, kind = own.isNotNull(), F.schema_of_variant(own)
            number, text = F.try_variant_get(v, f"$.{name}", "double"), F.try_variant_get(v, f"$.{name}", "string")
            if "type" in rule:
                found.append(F.when(there & ~kind.rlike(kinds[rule["type"]]), F.lit(f"{name} is not of type {rule['type']}")))
            if "minimum" in rule:
                found.append(F.when(there & kind.rlike(kinds["number"]) & (number < rule["minimum"]), F.lit(f"{name} is less than {rule['minimum']}")))
            if "maximum" in rule:
                found.append(F.when(there & kind.rlike(kinds["number"]) & (number > rule["maximum"]), F.lit(f"{name} is greater than {rule['maximum']}")))
            if "enum" in rule:
                found.append(F.when(there & ~text.isin([str(x) for x in rule["enum"]]), F.lit(f"{name} is not one of the allowed values")))
            if "pattern" in rule:
                found.append(F.when(there & (kind == "STRING") & ~text.rlike(rule["pattern"]), F.lit(f"{name} does not match")))
            if "items" in rule:
                found.append(F.when(there & kind.startswith("ARRAY") & ~kind.rlike(f"^ARRAY<{kinds[rule['items']['type']][1:]}"), F.lit(f"{name} has items of another type")))
        messages = F.slice(F.filter(F.array(*found), lambda x: x.isNotNull()), 1, 5)
        error = F.when(v.isNull(), F.lit("Invalid JSON")).when(F.size(messages) > 0, F.array_join(messages, "; "))
        return verdict(error.isNull(), v.cast("string"), error)

    return run


def function(check: Callable[[str], str | None], message: str = "Validation failed") -> Validator:
    """User code in Arrow batches: None is invalid, an exception is its row's error."""

    def one(text):
        try:
            value = check(text)
        except Exception as e:  # the user's code decides what it raises; the row carries it
            return {"valid": False, "value": None, "error": f"{message}: {e}"}
        return {"valid": value is not None, "value": None if value is None else str(value), "error": message if value is None else None}

    @pandas_udf("valid boolean, value string, error string")
    def run(texts):
        import pandas as pd

        return pd.DataFrame([one(t) for t in texts], columns=["valid", "value", "error"])

    return run


def first_success(*validators: Validator) -> Validator:
    """The first valid result, else all errors joined."""
    if not validators:
        raise ValueError("a composite needs validators")

    def run(c: Column) -> Column:
        made = [v(c) for v in validators]
        value = F.coalesce(*[F.when(m["valid"], m["value"]) for m in made])
        return verdict(reduce(lambda a, b: a | b, [m["valid"] for m in made]), value, F.concat_ws("; ", *[m["error"] for m in made]))

    return run


def all_of(*validators: Validator) -> Validator:
    """The last result if all are valid, else the first error."""
    if not validators:
        raise ValueError("a composite needs validators")

    def run(c: Column) -> Column:
        made = [v(c) for v in validators]
        return verdict(reduce(lambda a, b: a & b, [m["valid"] for m in made]), made[-1]["value"], F.coalesce(*[m["error"] for m in made]))

    return run


def describe(fields: tuple[Field, ...]) -> str:
    """What a prompt says of a model's schema."""
    kinds = {"str": "string", "float": "number", "int": "integer", "list": "array"}
    return json.dumps({"type": "object", "properties": {f.name: {"type": kinds[f.kind], "description": f.description} for f in fields}, "required": [f.name for f in fields if f.required]}, indent=2)


__all__ = ["all_of", "data_type", "describe", "first_success", "function", "json_object", "model", "regex", "schema", "verdict"]
