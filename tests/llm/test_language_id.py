import random

import numpy as np
from pyspark.sql import functions as F

from captionloom.llm import language_id as li
from tests.llm.helpers import DOCS


def corpus(spark, n=240):
    rng = random.Random(6)
    parts = {"aa": ["tion", "ing", "the", "er"], "bb": ["ß", "sch", "ung", "ein"], "cc": ["ción", "ñ", "os", "rr"]}
    rows = []
    for i in range(n):
        lang = "abc"[i % 3] * 2
        words = ["".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 60))]
        rows.append((i, " ".join(words), lang, "s", 0))
    return spark.createDataFrame(rows, DOCS), rows


def sets(text):
    b = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in text.encode())
    return [{b[k : k + n] for k in range(len(b) - n + 1)} for n in li.ORDERS]


def test_kernel_is_the_mean_cosine_of_presence():
    texts = ["The cat.", "the hat 12", "ünder", "a", "tt"]
    got = li.Landmarks(texts).kernel(texts)
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            want = sum(len(p & q) / np.sqrt(len(p) * len(q)) for p, q in zip(sets(x), sets(y), strict=True) if p and q) / 3
            assert abs(got[i, j] - want) < 1e-5


def test_held_out_accuracy(spark):
    df, rows = corpus(spark)
    model = li.train(df, F.col("doc_id") % 4 != 2, landmarks=30)
    got = {r.doc_id: r for r in li.identify(df, model).collect()}
    held = [r for r in rows if r[0] % 4 == 2]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    blind = li.identify(df.withColumns({"lang": F.lit("zz"), "source": F.lit("q")}), model).collect()
    assert {r.doc_id: r.lang_pred for r in blind} == {i: r.lang_pred for i, r in got.items()}


def test_edges(spark):
    df, _ = corpus(spark, 60)
    odd = spark.createDataFrame([(900, None, "aa", "s", 0), (901, "", "bb", "s", 0), (902, "12 .,", None, "s", 0), (903, "tion the " * 40_000, None, "s", 0), (904, "é", "cc", "s", 0), (904, "é", "cc", "s", 0)], DOCS)
    model = li.train(df.union(odd), F.lit(True), landmarks=12)
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(odd, model).collect()}
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[903][0] == "aa" and 904 in got
    assert li.identify(df.limit(0), model).count() == 0
    none = li.train(df, F.lit(False))
    assert {r.lang_pred for r in li.identify(df.withColumn("SCORE", F.lit(1)), none).collect()} == {"und"}


def test_a_label_with_long_texts_alone_is_learnt(spark):
    df, _ = corpus(spark, 60)
    long = df.withColumn("text", F.when(F.col("lang") == "aa", F.repeat(F.concat("text", F.lit(" ")), 4_000)).otherwise(F.col("text")))
    for rows in (long, long.where("lang = 'aa'")):
        model = li.train(rows, F.lit(True), landmarks=12)
        got = [r.lang_pred for r in li.identify(rows.where("lang = 'aa'"), model).collect()]
        assert got.count("aa") >= 0.9 * len(got)
