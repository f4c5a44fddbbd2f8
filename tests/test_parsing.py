import random
import re

import pytest
from pyspark.sql import functions as F

from captionloom.functions import parsing, textops
from captionloom.functions.parsing import Field

FIELDS = (Field("aesthetic_score", kind="float"), Field("title"), Field("brief"))


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("r")).first().r


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("# title\nA\n# brief\nB", {"title": "A", "brief": "B"}),
        ("pre\n# TITLE extra words\nA\n\nB\n# brief\n\n# title\nZ", {"title": "Z"}),
        ("# title: Foo\nbar\n## title\nX\n#title\nY\n#unknown\nkept", {"title": "Y\n#unknown\nkept"}),
        ("", {}),
        ("# title", {}),
        ("#  aesthetic_score\r\n0.5\r\n# brief\r\nx # title y", {"aesthetic_score": 0.5, "brief": "x # title y"}),
        ("# title\nfirst\n# title\n\n# brief\nq", {"title": "first", "brief": "q"}),
    ],
)
def test_key_values(spark, text, want):
    r = one(spark, text, lambda c: parsing.parse_key_values(c, FIELDS))
    data = {} if r.data is None else {k: v for k, v in r.data.asDict().items() if v is not None}
    assert data == want
    if not want:
        assert r.error == "No valid # key / value pairs found" and not r.success
    else:
        assert (r.error or "").startswith("Missing required fields: ") == (len(want) < 3)


def fold(text, names):
    """Line by line, as the rules are told."""
    found, name, own, start = [], None, [], 0

    def close(end):
        body = "\n".join(own).strip()
        if name is not None and body:
            found.append((name, body, start, end))

    lines = text.split("\n")
    for n, line in enumerate(lines):
        m = re.match(r"\s*#\s*(\S+)", line)
        if m and m.group(1).lower() in names:
            close(n - 1)
            name, own, start = m.group(1).lower(), [], n
        elif name is not None:
            own.append(line)
    close(len(lines) - 1)
    return found


def test_sections_against_a_line_by_line_model(spark):
    rng = random.Random(5)
    parts = ["# title", "#brief", " # TITLE x", "## title", "# other", "", "  ", "text", "a # title", "#", "[title]"]
    texts = ["\n".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parsing.sections(F.col("t"), ["title", "brief"]).alias("s")).collect()
    for r in rows:
        assert [tuple(s) for s in r.s] == fold(r.t, {"title", "brief"}), repr(r.t)


@pytest.mark.parametrize(
    ("text", "want"),
    [("0.85", 0.85), (" 0.5 ", 0.5), ("-0.5ish", 0.5), ("8/10", 8.0), ("85%", 85.0), ("1e-3", 0.001), ("1_000", 1000.0), ("0.5f", 0.5), ("abc", 0.0), ("", 0.0), ("infinity", float("inf")), ("-inf", float("-inf")), (".5", 0.5), ("5.", 5.0), ("+3", 3.0)],
)
def test_floats(spark, text, want):
    assert one(spark, text, parsing.to_float) == want


def test_a_bad_float_fails_its_row_alone(spark):
    df = spark.createDataFrame([("# aesthetic_score\n0.85.",), ("# aesthetic_score\n0.85",)], "t string")
    rows = df.select(parsing.parse_key_values(F.col("t"), FIELDS[:1]).alias("r")).collect()
    assert rows[0].r.data is None and rows[0].r.error == "Parse error: could not convert string to float: '0.85.'"
    assert rows[1].r.success and rows[1].r.data.aesthetic_score == 0.85


@pytest.mark.parametrize(("text", "want"), [("3.7", 3), ("-4x", 4), ("-4", -4), ("none", 0), ("1_0", 10), (" 7 ", 7)])
def test_ints(spark, text, want):
    assert one(spark, text, parsing.to_int) == want


def test_json(spark):
    fields = (Field("a", kind="float"), Field("n", kind="int"), Field("l", kind="list"), Field("s"))
    parse = lambda t: one(spark, t, lambda c: parsing.parse_json_fields(c, fields))
    r = parse('text {"a": "0.7", "n": 3.7, "l": "x", "s": "}"} tail')
    assert r.success and (r.data.a, r.data.n, r.data.l, r.data.s) == (0.7, 3, ["x"], "}")
    r = parse('```json\n{"a": null, "n": "3.7", "l": null, "s": "q"}\n```')
    assert r.success and (r.data.a, r.data.n, r.data.l) == (0.0, 0, [])
    r = parse('{"a": true, "l": ["p", "q"]}')
    assert not r.success and r.error == "Missing required fields: n, s" and r.data.a == 1.0 and r.data.l == ["p", "q"]
    assert parse("no json").error == "Invalid JSON"
    assert parse('{"a": 1').error == "Invalid JSON"


def test_round_trip(spark):
    row = spark.createDataFrame([("T t", 0.5, 1e-05, ["a ", "b"])], "title string, x double, y double, tags array<string>")
    made = parsing.format_key_values({"title": ("str", F.col("title")), "x": ("float", F.col("x")), "y": ("float", F.col("y")), "tags": ("list", F.col("tags"))})
    text = row.select(made.alias("t")).first().t
    assert text == "# title\nT t\n\n# x\n0.5\n\n# y\n1e-05\n\n# tags\na, b"
    back = one(spark, text, lambda c: parsing.parse_key_values(c, (Field("title"), Field("x", kind="float"), Field("y", kind="float"), Field("tags", kind="list"))))
    assert back.success and (back.data.title, back.data.x, back.data.y, back.data.tags) == ("T t", 0.5, 1e-05, ["a", "b"])


@pytest.mark.parametrize("value", [0.0, 1.0, 0.1, 123456.75, 1e-05, 2.5e-07, 1e16, 1.5e20, 12345678.0, -0.25, 1e7])
def test_numbers_as_python_writes_them(spark, value):
    assert spark.range(1).select(textops.python_number(F.lit(value)).alias("r")).first().r == repr(value)


@pytest.mark.parametrize("text", ["they're x-ray 3d", "ÉCOLE été", "a1b2", ""])
def test_title(spark, text):
    assert one(spark, text, textops.title) == text.title()


def test_instructions_name_the_first_field():
    assert "The first line is: # aesthetic_score" in parsing.key_value_instruction(FIELDS)
    assert '"title": "string: ' in parsing.json_instruction(FIELDS)


def closing(text):
    """Character by character: the first brace up to the one that closes it, else the text."""
    own = text.strip()
    start = own.find("{")
    if start < 0:
        return own
    depth, quoted, escaped = 0, False, False
    for i, c in enumerate(own[start:], start):
        if not quoted and c in "{}":
            depth += 1 if c == "{" else -1
            if c == "}" and depth == 0:
                return own[start : i + 1]
        if c == '"' and not escaped:
            quoted = not quoted
        escaped = quoted and c == "\\" and not escaped
    return own


def test_braces_against_a_fold_over_characters(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice('{}"\\ab\n\U0001f600') for _ in range(rng.randrange(14))) for _ in range(4000)]
    texts += ['{"a": "}\\""} rest', '{"a": ' + '"\\n"' * 20000 + "} x", "x {" + '"' + "y" * 200000 + '"} z']
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", parsing.extracted_json(F.col("t")).alias("r")).collect()
    assert all(r.r == closing(texts[r.i]) for r in got) and len(got) == len(texts)


def test_json_output(spark):
    import json

    fields = (Field("title"), Field("score", kind="float"), Field("n", kind="int"), Field("tags", kind="list"))
    rows = [('a"\\\n\x01\x1f\x7fé\U0001f600', 0.1, 3, ["x", 'y"', "\t"]), (None, None, None, None), ("", 1e-7, -1, []), ("\\u000B", 1.0, 0, [None])]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, d struct<title string, score double, n int, tags array<string>>")
    got = df.select("i", parsing.JsonFormat(fields).format_output(F.col("d")).alias("t")).orderBy("i").collect()
    want = [json.dumps(dict(zip([f.name for f in fields], r, strict=True)), indent=2, ensure_ascii=False) for r in rows]
    assert [r.t for r in got] == want
