import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from captionloom.functions import contexts, keys, tags, templates, tokens, validating
from captionloom.functions.parsing import Field


def values(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_templates(spark):
    e = templates.Engine()
    ctx = {"a": F.lit(1), "t": F.array(F.lit("x"), F.lit("y")), "o": F.struct(F.lit(0).alias("k"), F.lit(None).cast("string").alias("z")), "q": F.lit("they're"), "n": F.lit(None).cast("string")}
    lists = frozenset({"t"})
    got = values(spark, a=e.render("{a}-{b:x}-{c}", ctx), b=e.render("{t!csv} {t!list}", ctx, lists), c=e.render("{o.k} {o.z:none} {n}", ctx), d=e.render('{"a": 1} {q!title} {q!upper}', ctx), f=e.render("{t!json} {q!json}", ctx, lists))
    assert got == {"a": "1-x-{c}", "b": "x, y - x\n- y", "c": "0 none {n}", "d": "{\"a\": 1} They'Re THEY'RE", "f": '["x","y"] "they\'re"'}
    with pytest.raises(KeyError):
        e.render("{c}", ctx, strict=True)
    with pytest.raises(ValueError):
        e.render("{a!nope}", ctx)
    with pytest.raises(PySparkException):
        spark.range(1).select(e.render("{n}", ctx, strict=True)).collect()
    e.register("twice", lambda c, is_list: F.concat(c, c))
    assert values(spark, x=e.render("{q!twice}", ctx))["x"] == "they'rethey're"
    assert templates.missing_variables("{a} {b:1} {c.d} {c.e}", {"a"}) == ["c.d", "c.e"]
    with pytest.raises(KeyError):
        templates.CUSTOM.render(e, {})


def test_model_families(spark):
    got = values(spark, a=templates.model_family(F.lit("Gemma3N-x")), b=templates.model_family(F.lit("gemma3")), c=templates.chat_prompt(F.lit("qwen2-vl"), F.lit("p"), F.lit("s")))
    assert got["a"] == "gemma-3n" and got["b"] == "gemma-3" and got["c"].startswith("<|im_start|>system\ns<|im_end|>")


def test_contexts(spark):
    got = values(
        spark,
        bad=contexts.format_item(F.lit("object_bbox"), F.lit('{"boxes": [{"x": 1}]}')),
        none=contexts.format_item(F.lit("object_bbox"), F.lit('{"boxes": []}')),
        tags=contexts.format_item(F.lit("tags"), F.lit('{"tags": ["a", "b"], "categories": {"c": ["d", "e"]}}')),
        seg=contexts.format_item(F.lit("segmentation"), F.lit('{"classes": ["a", "b"]}')),
    )
    assert got == {"bad": '[Unvalidated object_bbox]: {"boxes": [{"x": 1}]}', "none": "Detected Objects:", "tags": "Existing tags:\n  c: d, e", "seg": "Segmentation:\n  Detected classes: a, b"}
    with pytest.raises(PySparkException):
        spark.range(1).select(contexts.format_item(F.lit("smell"), F.lit("{}"))).collect()
    with pytest.raises(ValueError):
        contexts.add_item(F.array(), "smell", F.lit("{}"))


def test_keys(spark):
    got = values(
        spark,
        a=keys.image_id(F.lit("validation"), F.lit(7)),
        b=keys.image_id(F.lit("x"), F.lit(7), F.lit("a/b c.png")),
        c=keys.image_id(F.lit("x"), F.lit(7), F.lit("x.tar.gz")),
        d=keys.url_suffix(F.lit("http://h/x.JPEG?y")),
        e=keys.url_suffix(F.lit("http://h/page")),
        f=keys.url_suffix(F.lit("http://h/a.tar.gz")),
        g=keys.url_file_name(F.lit("http://h/a+b%20c.png"), F.lit(3)),
        h=keys.url_file_name(F.lit("http://h/x/"), F.lit(3)),
        i=F.length(keys.base64_plain(F.lit("x" * 100).cast("binary"))),
        j=keys.data_url(F.lit("http://x/y"), F.lit(None).cast("binary")),
        k=keys.route(F.lit("train"), F.lit(-1)),
        m=keys.route(F.lit("unknown"), F.lit(5)),
    )
    assert got == {"a": "val_00000007", "b": "a_b_c", "c": "x.tar", "d": "jpg", "e": "jpg", "f": "jpg", "g": "a+b c.png", "h": "0003.jpg", "i": 136, "j": "http://x/y", "k": "test", "m": None}


def test_tags(spark):
    p = F.array(*[F.lit(x) for x in (0.3, 0.9, 0.5, 0.5)])
    limits = F.array(*[F.lit(0.5)] * 4)
    got = values(spark, a=tags.above(p, 0.3), b=tags.ranked(p, limits, F.array(F.lit(0), F.lit(3), F.lit(2), F.lit(1))), c=tags.threshold_for(F.lit(None).cast("double"), F.lit("general"), {"general": 0.0}))
    assert got["a"] == [1, 2, 3] and [x.i for x in got["b"]] == [1, 2, 3] and got["c"] == 0.0
    a, b = F.array(F.struct(F.lit("x_y").alias("tag"), F.lit(0.25).alias("score"))), F.array(F.struct(F.lit("x_y").alias("tag"), F.lit(0.5).alias("score")))
    none = F.array().cast(tags.SCORED)
    got = values(spark, a=tags.scores_map(a, b), b=tags.prompt_lines_best(a, none, b), c=tags.show_scores(general=a, rating=none), d=tags.with_tags(F.lit("p"), F.lit("")))
    assert [tuple(x) for x in got["a"]] == [("x_y", 0.5)] and got["b"] == "Features: x y\nRating: x_y" and got["c"] == "# general\n  x_y: 0.250" and got["d"] == "p"


def test_validators(spark):
    fields = (Field("a", kind="int"), Field("b", kind="float", required=False))
    got = values(
        spark,
        lax=validating.model(fields)(F.lit('{"a": "3"}'))["valid"],
        strict=validating.model(fields, strict=True)(F.lit('{"a": "3"}'))["valid"],
        null=validating.json_object()(F.lit("null"))["valid"],
        group=validating.regex("(x)?(y)", 1)(F.lit("y")),
        enum=validating.schema({"properties": {"k": {"enum": ["p", "q"]}, "n": {"minimum": 2}}})(F.lit('{"k": "r", "n": 1}'))["error"],
        every=validating.all_of(validating.regex("a"), validating.regex("b", message="no b"))(F.lit("a"))["error"],
    )
    assert got["lax"] and not got["strict"] and not got["null"] and got["group"].valid and got["group"].value is None
    assert got["enum"] == "k is not one of the allowed values; n is less than 2" and got["every"] == "no b"
    with pytest.raises(ValueError):
        validating.all_of()

    def check(text):
        if text == "boom":
            raise RuntimeError("bad")
        return text.upper() if text != "none" else None

    rows = spark.createDataFrame([("ok",), ("none",), ("boom",)], "t string").select(validating.function(check, "failed")(F.col("t")).alias("r")).collect()
    assert [(r.r.valid, r.r.value, r.r.error) for r in rows] == [(True, "OK", None), (False, None, "failed"), (False, None, "failed: bad")]


def test_tokenizer_counts(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    texts = ["some words here", "", None, "ünï"]
    count = tokens.tokenizer_counts(path)
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select(count("t").alias("n")).collect()]
    own = Tokenizer.from_file(path)
    assert got == [len(own.encode(t or "", add_special_tokens=False).ids) for t in texts]
