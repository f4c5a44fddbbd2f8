"""Semi-structured model output to typed columns: sections, converters, key / value and JSON formats.

A parser is a Column expression and yields one struct for each text: success, data, error, raw. Rows
never fail a job; what goes wrong is in `error`.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from captionloom.functions.textops import python_number, strip


@dataclass(frozen=True)
class Field:
    """One expected field; kind is str, float, int or list."""

    name: str
    description: str = ""
    kind: str = "str"
    required: bool = True


DEFAULT_FIELDS = (
    Field("aesthetic_score", "Score from 0.0 to 1.0", "float"),
    Field("nsfw_score", "Score from 0.0 to 1.0", "float"),
    Field("quality_score", "Score from 0.0 to 1.0", "float"),
    Field("title", "Short title"),
    Field("brief", "One or two sentences"),
    Field("description", "Full description"),
)
SQL_KINDS = {"str": "string", "float": "double", "int": "bigint", "list": "array<string>"}


# --- section headers: line -> name of the section that it opens, else null ------------------------------


def _known(name: Column, names: list[str], case_sensitive: bool) -> Column:
    if case_sensitive:
        return F.when(name.isin(names), name)
    return F.when(F.lower(name).isin([n.lower() for n in names]), F.lower(name))


def hash_header(line: Column, names: list[str], case_sensitive: bool = False) -> Column:
    """`# name rest`: one hash, then the name as the first word; the rest of the line is dropped."""
    return _known(F.regexp_extract(line, r"(?U)^\s*#\s*(\S+)", 1), names, case_sensitive)


def bracket_header(line: Column, names: list[str], case_sensitive: bool = False) -> Column:
    """`[name]` as a whole line."""
    return _known(F.regexp_extract(line, r"(?U)^\s*\[\s*(.*?)\s*\]\s*$", 1), names, case_sensitive)


def tag_header(line: Column, names: list[str], case_sensitive: bool = False) -> Column:
    """A line that starts with `<name>`; closing tags are content."""
    return _known(F.regexp_extract(line, r"(?U)^\s*<(\w+)>", 1), names, case_sensitive)


HEADERS = {"hash": hash_header, "bracket": bracket_header, "xml": tag_header}


def sections(text: Column, names: list[str], header: str = "hash", case_sensitive: bool = False, strip_content: bool = True, keep_blank: bool = True) -> Column:
    """array<struct<name, content, start_line, end_line>> of the sections that have content.

    Headers are found first, and each section is the slice of lines up to the next header, so nothing is
    carried from line to line.
    """
    match = HEADERS[header]
    lines = F.split(text, "\n")
    marks = F.filter(F.transform(lines, lambda x, i: F.struct(match(x, names, case_sensitive).alias("name"), i.alias("at"))), lambda m: m["name"].isNotNull())

    def cut(lines_and_marks: Column) -> Column:
        own, found = lines_and_marks["lines"], lines_and_marks["marks"]

        def section(m: Column, k: Column) -> Column:
            following = F.coalesce(F.get(found, k + 1)["at"], F.size(own))
            body = F.slice(own, m["at"] + 2, F.greatest(following - m["at"] - 1, F.lit(0)))
            body = body if keep_blank else F.filter(body, lambda x: strip(x) != "")
            content = F.array_join(body, "\n")
            return F.struct(m["name"].alias("name"), (strip(content) if strip_content else content).alias("content"), m["at"].cast("int").alias("start_line"), (following - 1).cast("int").alias("end_line"))

        return F.filter(F.transform(found, section), lambda s: s["content"] != "")

    # A one-element array names the intermediate arrays, so that they are computed once.
    return F.get(F.transform(F.array(F.struct(lines.alias("lines"), marks.alias("marks"))), cut), F.lit(0))


def last_content(found: Column, name: str) -> Column:
    """Content of the last section of that name, else null."""
    return F.try_element_at(F.filter(found, lambda s: s["name"] == name), F.lit(-1))["content"]


# --- converters ---------------------------------------------------------------------------------------

_FLOAT = r"(?i)^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$"
_SPECIAL = r"(?i)^[+-]?(inf|infinity|nan)$"


def _plain_float(value: Column) -> Column:
    own = strip(value)
    word = F.lower(F.regexp_replace(own, r"^[+-]", ""))
    special = F.when(word == "nan", F.lit(float("nan"))).when(own.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(own.rlike(_FLOAT), F.regexp_replace(own, "_", "").try_cast("double")).when(own.rlike(_SPECIAL), special)


def float_error(value: Column) -> Column:
    """Message where the value holds a number-like part that is no number (as `1.2.3`), else null."""
    part = F.regexp_extract(value, r"[\d.]+", 0)
    bad = _plain_float(value).isNull() & (part != "") & part.try_cast("double").isNull()
    return F.when(bad, F.concat(F.lit("could not convert string to float: '"), part, F.lit("'")))


def to_float(value: Column) -> Column:
    """The number that the text is, else the first run of digits and dots in it, else 0."""
    part = F.regexp_extract(value, r"[\d.]+", 0)
    return F.when(value.isNull(), None).otherwise(F.coalesce(_plain_float(value), F.when(part == "", F.lit(0.0)).otherwise(part.try_cast("double"))))


def to_int(value: Column) -> Column:
    """The whole number that the text is, else the first run of digits in it, else 0."""
    own = strip(value)
    whole = F.when(own.rlike(r"^[+-]?\d+(_\d+)*$"), F.regexp_replace(own, "_", "").try_cast("bigint"))
    part = F.regexp_extract(value, r"\d+", 0)
    return F.when(value.isNull(), None).otherwise(F.coalesce(whole, F.when(part == "", F.lit(0)).otherwise(part.try_cast("bigint")).cast("bigint")))


def to_list(value: Column, separators: str = r"[,\n]") -> Column:
    return F.filter(F.transform(F.split(value, separators), strip), lambda x: x != "")


CONVERTERS = {"float": to_float, "int": to_int, "list": to_list, "str": lambda c: c}


# --- the key / value format -----------------------------------------------------------------------------


def result(success: Column, data: Column, error: Column, raw: Column) -> Column:
    return F.struct(success.alias("success"), data.alias("data"), error.alias("error"), raw.alias("raw"))


def data_type(fields: tuple[Field, ...]) -> str:
    return "struct<" + ",".join(f"`{f.name}`:{SQL_KINDS.get(f.kind, 'string')}" for f in fields) + ">"


def _missing(fields: tuple[Field, ...], present) -> Column:
    names = F.array(*[F.when(~present(f), F.lit(f.name)) for f in fields if f.required])
    return F.array_join(F.filter(names, lambda x: x.isNotNull()), ", ")


def parse_key_values(text: Column, fields: tuple[Field, ...] = DEFAULT_FIELDS, header: str = "hash") -> Column:
    """Sections to typed fields. Partial data stays where required fields are missing; a value that cannot be
    converted fails its row alone."""
    raw = strip(text)
    names = [f.name for f in fields]

    def judge(s: Column) -> Column:
        content = {f.name: last_content(s["found"], f.name.lower()) for f in fields}
        none = F.size(s["found"]) == 0
        errors = [float_error(content[f.name]) for f in fields if f.kind == "float"]
        broken = F.coalesce(*errors) if errors else F.lit(None).cast("string")
        missing = _missing(fields, lambda f: content[f.name].isNotNull())
        data = F.struct(*[CONVERTERS.get(f.kind, CONVERTERS["str"])(content[f.name]).cast(SQL_KINDS.get(f.kind, "string")).alias(f.name) for f in fields])
        error = F.when(none, "No valid # key / value pairs found").when(broken.isNotNull(), F.concat(F.lit("Parse error: "), broken)).when(missing != "", F.concat(F.lit("Missing required fields: "), missing))
        return result(error.isNull(), F.when(~none & broken.isNull(), data), error, s["raw"])

    own = F.struct(raw.alias("raw"), sections(raw, names, header).alias("found"))
    return F.get(F.transform(F.array(own), judge), F.lit(0))


def format_key_values(values: dict[str, tuple[str, Column]]) -> Column:
    """`# name` and its value, for each (kind, column), with a blank line between; null fields are left out."""
    parts = []
    for name, (kind, c) in values.items():
        if kind == "list":
            value = F.array_join(F.transform(c, strip), ", ")
        elif kind == "str":
            value = strip(c)
        else:
            value = python_number(c) if kind == "float" else c.cast("string")
        parts.append(F.when(c.isNotNull(), F.concat(F.lit(f"# {name}\n"), value)))
    return F.regexp_replace(F.concat_ws("\n\n", *parts), r"(?U)\s+$", "")


def key_value_instruction(fields: tuple[Field, ...] = DEFAULT_FIELDS) -> str:
    """What a prompt says about the format; the first line it demands is the first field's."""
    shown = "\n\n".join(f"# {f.name}\n<{f.description}>" for f in fields)
    names = ", ".join(f.name for f in fields)
    return f"Answer with these fields, in this order: {names}\n\n{shown}\n\nThe first line is: # {fields[0].name}\nEvery field starts with # and its exact name; the value follows on the next lines. Use no other fields and no other formatting."


# --- the JSON format ------------------------------------------------------------------------------------

_FENCE = r"```(?:json)?\s*\n?([\s\S]*?)\n?```"


def fenced_json(text: Column) -> Column:
    """The inside of the first code fence, else the text; stripped."""
    own = strip(text)
    return F.when(own.rlike(_FENCE), strip(F.regexp_extract(own, _FENCE, 1))).otherwise(own)


def extracted_json(text: Column) -> Column:
    """A fence's inside, else the first brace up to the one that closes it (braces in strings do not count), else the text."""
    own = strip(text)
    start = F.instr(own, "{")
    # Marks, escaped pairs and the runs between them, so that the fold takes a step for each of these and not for each character.
    body = F.regexp_extract_all(F.substring(own, start, F.length(own)), F.lit(r'(?s)\\.|["{}]|[^"\\{}]++|\\'), 0)
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("depth"), F.lit(0).alias("end"), F.lit(False).alias("quoted"))

    def step(a: Column, x: Column) -> Column:
        # Outside strings a backslash escapes nothing, so the character after it counts.
        mark = F.when(a["quoted"], F.when(x == '"', x)).otherwise(F.right(x, F.lit(1)))
        depth = a["depth"] + F.when(a["quoted"], 0).when(mark == "{", 1).when(mark == "}", -1).otherwise(0)
        n = a["n"] + F.length(x)
        closed = (a["end"] == 0) & ~a["quoted"] & (mark == "}") & (depth == 0)
        return F.struct(n.alias("n"), depth.alias("depth"), F.when(closed, n).otherwise(a["end"]).alias("end"), (a["quoted"] != F.coalesce(mark == '"', F.lit(False))).alias("quoted"))

    end = F.aggregate(body, zero, step, lambda a: a["end"])
    braced = F.when((start > 0) & (end > 0), F.substring(own, start, end)).otherwise(own)
    return F.when(own.rlike(_FENCE), fenced_json(text)).otherwise(braced)


def _json_field(v: Column, f: Field) -> tuple[Column, Column]:
    """(present, converted value) of a field of a parsed JSON object."""
    path = f"$.{f.name}" if f.name.isidentifier() else f"$['{f.name}']"
    own = F.try_variant_get(v, path, "variant")
    kind = F.schema_of_variant(own)
    text = F.try_variant_get(v, path, "string")
    if f.kind == "float":
        value = F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0)).otherwise(F.coalesce(_plain_float(text), F.lit(0.0)))
    elif f.kind == "int":
        cut = F.when(kind == "BIGINT", text.try_cast("bigint")).when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0).cast("bigint"))
        number = F.when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), text.try_cast("double").try_cast("bigint"))
        whole = F.when((kind == "STRING") & strip(text).rlike(r"^[+-]?\d+$"), strip(text).try_cast("bigint"))
        value = F.coalesce(cut, number, whole, F.lit(0).cast("bigint"))
    elif f.kind == "list":
        empty = F.array().cast("array<string>")
        falsy = F.is_variant_null(own) | text.isin("", "false", "0", "0.0")
        value = F.when(kind.startswith("ARRAY"), F.try_variant_get(v, path, "array<string>")).when(falsy, empty).otherwise(F.array(text))
    else:
        value = text
    return own.isNotNull(), F.when(own.isNotNull(), value)


def parse_json_fields(text: Column, fields: tuple[Field, ...] = DEFAULT_FIELDS) -> Column:
    """A JSON object to typed fields, with the same result struct; strings are not coerced, and what a float, int or
    list field cannot hold becomes 0 or a list of one."""

    def judge(s: Column) -> Column:
        v = s["v"]
        own = {f.name: _json_field(v, f) for f in fields}
        missing = _missing(fields, lambda f: F.coalesce(own[f.name][0], F.lit(False)))
        data = F.struct(*[own[f.name][1].cast(SQL_KINDS.get(f.kind, "string")).alias(f.name) for f in fields])
        error = F.when(v.isNull(), "Invalid JSON").when(missing != "", F.concat(F.lit("Missing required fields: "), missing))
        return result(error.isNull(), F.when(v.isNotNull(), data), error, text)

    return F.get(F.transform(F.array(F.struct(F.try_parse_json(extracted_json(text)).alias("v"))), judge), F.lit(0))


def json_text(text: Column) -> Column:
    """A JSON string that escapes quotes, backslashes and control characters alone."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    safe = out
    for code in range(32):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(json.dumps(chr(code))[1:-1]))
    return F.concat(F.lit('"'), F.when(out.rlike(r"[\x00-\x1f]"), safe).otherwise(out), F.lit('"'))


def format_json(data: Column, fields: tuple[Field, ...] = DEFAULT_FIELDS) -> Column:
    """The fields as JSON text, indented by two; absent values are null and an empty list stays on one line."""

    def shown(f: Field) -> Column:
        v = data[f.name]
        if f.kind == "list":
            items = F.array_join(F.transform(v, lambda x: F.concat(F.lit("    "), F.coalesce(json_text(x), F.lit("null")))), ",\n")
            text = F.when(F.size(v) == 0, "[]").otherwise(F.concat(F.lit("[\n"), items, F.lit("\n  ]")))
        elif f.kind == "float":
            text = python_number(v.cast("double"))
        elif f.kind == "int":
            text = v.cast("string")
        else:
            text = json_text(v.cast("string"))
        return F.concat(F.lit(f"  {json.dumps(f.name, ensure_ascii=False)}: "), F.when(v.isNull(), "null").otherwise(text))

    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *[shown(f) for f in fields]), F.lit("\n}")) if fields else F.lit("{}")


def json_instruction(fields: tuple[Field, ...] = DEFAULT_FIELDS) -> str:
    hint = {"str": "string", "float": "number", "int": "integer", "list": "array"}
    return json.dumps({f.name: f"{hint.get(f.kind, 'string')}: {f.description}" for f in fields}, indent=2, ensure_ascii=False)


class KeyValueFormat:
    """What a format offers to a captioning plan: an instruction for the prompt and a parser; subclass to add others."""

    def __init__(self, fields: tuple[Field, ...] = DEFAULT_FIELDS):
        self.fields = fields

    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def instruction(self) -> str:
        return key_value_instruction(self.fields)

    def parse(self, text: Column) -> Column:
        return parse_key_values(text, self.fields)


class JsonFormat(KeyValueFormat):
    def format_output(self, data: Column) -> Column:
        return format_json(data, self.fields)

    def instruction(self) -> str:
        return json_instruction(self.fields)

    def parse(self, text: Column) -> Column:
        return parse_json_fields(text, self.fields)
