"""Prompt templates, compiled on the driver to one Column expression.

A placeholder is `{name}`, `{name:default}`, `{name!formatter}` or `{name:default!formatter}`; names may be
dotted paths. Only null counts as missing: it becomes the default, else the placeholder stays as it
is written, or raises in strict mode.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from captionloom.functions.textops import bullets, python_list, strip, title

Value = Column
#: Placeholder syntax (fixed by the template language).
PLACEHOLDER = re.compile(r"\{([A-Za-z_][A-Za-z0-9_.]*)(?::([^}!]*))?(?:!([A-Za-z_][A-Za-z0-9_]*))?\}")


@dataclass(frozen=True)
class Variable:
    name: str
    written: str
    default: str | None
    formatter: str | None


def _text(c: Column, is_list: bool) -> Column:
    return F.to_json(c) if is_list else c.cast("string")


@dataclass
class Engine:
    """Formatters take (column, whether it is a list) and give text."""

    formatters: dict[str, Callable[[Column, bool], Column]] = field(
        default_factory=lambda: {
            "upper": lambda c, is_list: F.upper(_text(c, is_list)),
            "lower": lambda c, is_list: F.lower(_text(c, is_list)),
            "title": lambda c, is_list: title(_text(c, is_list)),
            "strip": lambda c, is_list: strip(_text(c, is_list)),
            "json": lambda c, is_list: F.to_json(c, {"ignoreNullFields": "false"}) if is_list else F.regexp_replace(F.to_json(F.struct(c.alias("x")), {"ignoreNullFields": "false"}), r'(?s)^\{"x":(.*)\}$', "$1"),
            "list": lambda c, is_list: bullets(c.cast("array<string>")) if is_list else c.cast("string"),
            "csv": lambda c, is_list: python_list(c.cast("array<string>")) if is_list else c.cast("string"),
        }
    )

    def register(self, name: str, formatter: Callable[[Column, bool], Column]) -> None:
        self.formatters[name] = formatter

    def render(self, template: str, context: dict[str, Column], lists: frozenset[str] = frozenset(), strict: bool = False) -> Column:
        """context: name (or its first part) to column; lists: the names that hold arrays or structs."""
        parts: list[Column] = []
        at = 0
        for m in PLACEHOLDER.finditer(template):
            if m.start() > at:
                parts.append(F.lit(template[at : m.start()]))
            at = m.end()
            parts.append(self._part(variable(m), context, lists, strict))
        if at < len(template):
            parts.append(F.lit(template[at:]))
        return F.concat(*parts) if parts else F.lit("")

    def _part(self, v: Variable, context: dict[str, Column], lists: frozenset[str], strict: bool) -> Column:
        first, *rest = v.name.split(".")
        value = context.get(v.name, context.get(first))
        if v.name not in context:
            for name in rest if value is not None else []:
                value = value[name]
        if value is None:
            if v.default is not None:
                return F.lit(v.default)
            if strict:
                raise KeyError(v.name)
            return F.lit(v.written)
        if v.formatter and v.formatter not in self.formatters:
            raise ValueError(f"unknown formatter: {v.formatter}")
        is_list = v.name in lists
        shown = self.formatters[v.formatter](value, is_list) if v.formatter else _text(value, is_list)
        gone = F.lit(v.default) if v.default is not None else F.raise_error(F.lit(f"missing variable: {v.name}")).cast("string") if strict else F.lit(v.written)
        return F.when(value.isNull(), gone).otherwise(shown)


def variable(m: re.Match) -> Variable:
    return Variable(m.group(1), m.group(0), m.group(2), m.group(3))


def variables(template: str) -> list[Variable]:
    return [variable(m) for m in PLACEHOLDER.finditer(template)]


def variables_of(template: Column) -> Column:
    """The placeholders of a column of templates."""
    return F.regexp_extract_all(template, F.lit(f"({PLACEHOLDER.pattern})"), 1)


def missing_variables(template: str, given: set[str]) -> list[str]:
    """Whole names without a default whose first part is not given, as often as they are written."""
    return [v.name for v in variables(template) if v.default is None and v.name.split(".")[0] not in given]


@dataclass(frozen=True)
class Prompt:
    """A named template with the variables that it needs."""

    name: str
    template: str
    required: tuple[str, ...] = ()

    def render(self, engine: Engine, context: dict[str, Column], lists: frozenset[str] = frozenset(), strict: bool = False) -> Column:
        lacking = [n for n in self.required if n not in context]
        if lacking:
            raise KeyError(f"{self.name} needs {', '.join(lacking)}")
        return engine.render(self.template, context, lists, strict)


CAPTION = Prompt("caption", "Provide a structured caption for this image.\n\n{context:}\n\n{instruction:}")
DETAILED = Prompt("detailed", "Describe this image in detail: subjects, setting, colors, mood and style.\n\n{context:}\n\n{instruction:}")
CUSTOM = Prompt("custom", "{prompt}", ("prompt",))


# Chat layouts that model families were trained with, without and with a system text.
FAMILIES = {
    "gemma-3": ("<bos><start_of_turn>user\n<start_of_image>{prompt}<end_of_turn>\n<start_of_turn>model\n", "<bos><start_of_turn>user\n<start_of_image>{system}\n\n{prompt}<end_of_turn>\n<start_of_turn>model\n"),
    "gemma-3n": ("<start_of_turn>user\n<image_soft_token>{prompt}<end_of_turn>\n<start_of_turn>model\n", "<start_of_turn>user\n<image_soft_token>{system}\n\n{prompt}<end_of_turn>\n<start_of_turn>model\n"),
    "llava-1.5": ("USER: <image>\n{prompt}\nASSISTANT:", "USER: <image>\n{system}\n\n{prompt}\nASSISTANT:"),
    "llava-next": ("[INST] <image>\n{prompt} [/INST]", "[INST] <image>\n{system}\n\n{prompt} [/INST]"),
    "qwen2-vl": ("<|im_start|>user\n<|vision_start|><|image_pad|><|vision_end|>{prompt}<|im_end|>\n<|im_start|>assistant\n", "<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n<|vision_start|><|image_pad|><|vision_end|>{prompt}<|im_end|>\n<|im_start|>assistant\n"),
    "internvl": ("<|im_start|>user\n<image>\n{prompt}<|im_end|>\n<|im_start|>assistant\n", "<|im_start|>system\n{system}<|im_end|>\n<|im_start|>user\n<image>\n{prompt}<|im_end|>\n<|im_start|>assistant\n"),
    "default": ("<image>\n{prompt}", "<image>\n{system}\n\n{prompt}"),
}
# Parts of model names that tell the family, in the order in which they are tried.
FAMILY_MARKS = (
    ("gemma-3n", ("gemma-3n", "gemma3n")),
    ("gemma-3", ("gemma-3", "gemma3")),
    ("llava-next", ("llava-v1.6", "llava-next")),
    ("llava-1.5", ("llava-1.5", "llava-v1.5")),
    ("qwen2-vl", ("qwen2-vl", "qwen2.5-vl")),
    ("internvl", ("internvl",)),
)


def model_family(name: Column) -> Column:
    low, out = F.lower(name), None
    for family, marks in FAMILY_MARKS:
        found = F.lit(False)
        for mark in marks:
            found = found | low.contains(mark)
        out = F.when(found, family) if out is None else out.when(found, family)
    return out.otherwise("default")


def chat_prompt(family: Column, prompt: Column, system: Column | None = None) -> Column:
    """The prompt in its family's layout; without a system text (null or empty) the plain one."""
    system = F.lit(None).cast("string") if system is None else system
    has = F.coalesce(system, F.lit("")) != ""
    out = None
    for name, (plain, full) in FAMILIES.items():
        engine = Engine()
        made = F.when(has, engine.render(full, {"system": system, "prompt": prompt})).otherwise(engine.render(plain, {"prompt": prompt}))
        out = F.when(family == name, made) if out is None else out.when(family == name, made)
    return out


def chat_messages(prompt: Column, image_url: Column, system: Column | None = None, detail: str = "auto") -> Column:
    """JSON chat messages: an optional system message, then the user's text and image."""
    content = F.array(
        F.struct(F.lit("text").alias("type"), prompt.alias("text"), F.lit(None).cast("struct<url:string,detail:string>").alias("image_url")),
        F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), F.struct(image_url.alias("url"), F.lit(detail).alias("detail")).alias("image_url")),
    )
    user = F.to_json(F.struct(F.lit("user").alias("role"), content.alias("content")))
    first = F.lit(None).cast("string") if system is None else F.when(F.coalesce(system, F.lit("")) != "", F.to_json(F.struct(F.lit("system").alias("role"), system.alias("content"))))
    return F.concat(F.lit("["), F.concat_ws(",", first, user), F.lit("]"))
