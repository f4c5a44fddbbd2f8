import random

from pyspark.sql import functions as F

from captionloom.llm import toxicity as t
from tests.llm.helpers import docs


def corpus(n=400):
    rng = random.Random(2)
    plain = [f"word{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choices(plain, k=6)) for _ in range(rng.randint(2, 8))]
        toxic = i % 5 == 0
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(["vileness", "Scum", "grumly" + rng.choice(["x", "yy", "z"])])
        rows.append((i, ". ".join(sentences)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_places(spark):
    rows, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = t.train(docs(spark, rows), table, learn=F.col("doc_id") % 3 != 0)
    got = {r.doc_id: (r.score, r.offending) for r in t.score(docs(spark, rows), model).collect()}
    wrong = [i for i, _, y in labels if i % 3 == 0 and (got[i][0] >= 0.5) != bool(y)]
    assert len(wrong) <= 3
    for i, text in rows:
        for place in got[i][1]:
            assert any(w in text.split(". ")[place.sentence].lower() for w in ("vileness", "scum", "grumly")) or i in wrong
    again = t.train(docs(spark, rows), table, learn=F.col("doc_id") % 3 != 0)
    assert again.weights == model.weights


def test_noisy_or():
    model = t.Model({b"bad": 5.0}, -4.0)
    p = model.sentences("one. bad word! two")
    assert len(p) == 3 and abs(model.score("one. bad word! two") - (1 - (1 - p).prod())) < 1e-9
    whole, places = model.judged("one. bad word! two")
    assert whole == model.score("one. bad word! two") and [k for k, _ in places] == [1]
    together = t.Model({b"bad": 3.0}, -4.0)
    whole, places = together.judged("bad. " * 9 + "good.")
    assert whole >= 0.5 and len(places) == 1 and places[0][1] < 0.5
    assert t.tokens("A b.C") == [b"a", b"b", b"\x01", b"c"]


def test_edges(spark):
    model = t.Model({b"bad": 9.0}, -4.0)
    rows = [(1, None), (2, ""), (3, "..."), (4, "fine " * 50_000 + "bad"), (4, "bad"), (4, "bad")]
    df = docs(spark, rows).withColumns({"score": F.lit("old"), "Offending": F.lit(0)})
    got = [(r.doc_id, round(r["score_"], 3)) for r in t.score(df, model).collect()]
    assert sorted(got)[:3] == [(1, 0.0), (2, 0.0), (3, 0.0)] and sorted(got)[3][1] == sorted(got)[5][1] > 0.9
    assert t.score(docs(spark, []), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert t.score(docs(spark, rows), t.train(docs(spark, rows), none, learn=F.lit(True))).where("score != 0").count() == 0
    one = spark.createDataFrame([(4, 1), (None, 0)], "doc_id long, toxic int")
    assert t.train(docs(spark, rows), one, learn=F.lit(True)).score("x") == 1.0
