import random
import re

import pytest
from pyspark.sql import functions as F

from captionloom.llm import line_dedup as ld
from captionloom.llm import queries
from tests.llm.helpers import docs


def form(line):
    return re.sub(r"[ \t\r\f\v]+", " ", line.lower()).strip(" ")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, least, exact=None, edits=1):
    first, exact = {}, least if exact is None else exact
    for i, text in sorted(rows, key=lambda r: r[0]):
        for at, line in enumerate((text or "").split("\n")):
            if len(form(line)) >= exact:
                first.setdefault(form(line), (i, at))
    long = [f for f in first if len(f) >= least]
    late = {a for a in long for b in long if a != b and abs(len(a) - len(b)) <= edits and first[b] < first[a] and distance(a, b) <= edits}
    out = {}
    for i, text in rows:
        if text is None:
            out[i] = (None, 0, 0)
            continue
        kept, exact, near = [], 0, 0
        for at, line in enumerate(text.split("\n")):
            f = form(line)
            if f in late:
                near += 1
            elif f in first and first[f] != (i, at):
                exact += 1
            else:
                kept.append(line)
        out[i] = ("\n".join(kept), exact, near)
    return out


def classes_and_links(rows, least, exact=None, edits=1):
    """For each document: the smallest id that shared lines and near forms reach, and its lines' links."""
    first, own, holders = {}, {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        own[i] = [(at, form(x)) for at, x in enumerate((text or "").split("\n")) if len(form(x)) >= (least if exact is None else exact)]
        for at, f in own[i]:
            first.setdefault(f, (i, at))
            holders.setdefault(f, []).append(i)
    near = {a: [b for b in first if b != a and min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits] for a in first}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for f, ids in holders.items():
        for j in [*ids, *[first[b][0] for b in near[f]]]:
            x, y = find(ids[0]), find(j)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}, {i: sum(len(near[f]) + (len(holders[f]) > 1) for _, f in forms) for i, forms in own.items()}


def result(df):
    return {r.doc_id: (r.text, r.exact_dropped, r.near_dropped) for r in df.collect()}


def test_bit_parallel_distance(spark):
    rng, rows = random.Random(7), []
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 9)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "z"])
        rows.append(tuple(sorted((a, "".join(b)), key=len)))
    df = spark.createDataFrame(rows, "a string, b string")
    for threshold in (1, 2, 3):
        near = df.where(F.length("b") - F.length("a") <= threshold).withColumn("d", ld.edit_distance(F.col("a"), F.col("b"), threshold))
        for r in near.collect():
            want = distance(r.a, r.b)
            assert r.d == want if want <= threshold else r.d > threshold, (r, want)


def test_against_brute_force(spark):
    rng, rows = random.Random(3), []
    lines = ["".join(rng.choice("abcd ") for _ in range(rng.randint(6, 30))) for _ in range(60)]
    for i in range(80):
        own = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(lines))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randint(0, len(line))
                line[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "7", "É"])
            own.append("".join(line))
        rows.append((i, "\n".join(own)))
    rows += [(900, None), (901, ""), (902, "\n\n"), (903, lines[0] + "\n" + "y" * 60_000), (904, "y" * 60_000)]
    out = ld.line_dedup(docs(spark, rows), min_chars=8)
    assert result(out) == brute(rows, 8)
    classes, links = classes_and_links(rows, 8)
    assert {r.doc_id: (r.class_id, r.n_links) for r in out.collect()} == {i: (classes[i], links[i]) for i, _ in rows}


@pytest.mark.parametrize("edits", [2, 3])
def test_more_edits_against_brute_force(spark, edits, monkeypatch):
    # Keys are hot from four pairs on, so that lines go on to the finer splits.
    monkeypatch.setattr(ld, "KEY_PAIRS", 4)
    rng, rows = random.Random(edits), [(900, None), (901, ""), (902, "y" * 700), (903, "y" * 702)]
    lines = ["".join(rng.choice("abcd ") for _ in range(rng.randint(10, 30))) for _ in range(12)]
    for i in range(70):
        own = []
        for _ in range(rng.randint(0, 3)):
            line = list(rng.choice(lines))
            for _ in range(rng.choice([0, 1, 2, 2, 3, 4])):
                k = rng.randint(0, len(line))
                line[k : k + rng.randint(0, 1)] = rng.choice(["", "x", "7", "É"])
            own.append("".join(line))
        rows.append((i, "\n".join(own)))
    out = ld.line_dedup(docs(spark, rows), min_chars=8, threshold=edits)
    assert result(out) == brute(rows, 8, edits=edits)
    classes, links = classes_and_links(rows, 8, edits=edits)
    assert {r.doc_id: (r.class_id, r.n_links) for r in out.collect()} == {i: (classes[i], links[i]) for i, _ in rows}


def test_a_threshold_of_none_is_refused(spark):
    with pytest.raises(ValueError):
        ld.line_dedup(docs(spark, []), threshold=0)


def test_a_hot_line_with_many_variants(spark):
    rng = random.Random(9)
    base = "the quick brown fox jumps over the lazy dog and runs away"
    variants = []
    for _ in range(400):
        k = rng.randrange(len(base) - 6)
        variants.append(base[:k] + "".join(rng.choice("uvwxyz") for _ in range(5)) + base[k + 5 :])
    variants += [base[:k] + c + base[k + 1 :] for k in (3, 40) for c in "klmn"] + [base] * 30
    rng.shuffle(variants)
    rows = list(enumerate(variants))
    assert result(ld.line_dedup(docs(spark, rows))) == brute(rows, 30)


def test_edges(spark):
    assert ld.line_dedup(docs(spark, [])).count() == 0
    line = "a line that is long enough to be judged here"
    df = docs(spark, [(1, line), (2, line + "!"), (2, line + "!"), (3, "short\nshort"), (None, line)]).withColumns({"lines": F.lit("x"), "at": F.lit(1), "row": F.lit(2), "Line_Kept": F.lit(0)})
    got = sorted((str(r["doc_id"]), r["text"], r["line_kept_"], r["lines"]) for r in ld.line_dedup(df).collect())
    assert got == [("1", "", False, "x"), ("2", "", False, "x"), ("2", "", False, "x"), ("3", "short\nshort", True, "x"), ("None", line, True, "x")]


def test_classes_are_components(spark):
    a, b, c = ("line number one that is shared by some", "line number two, which others have", "a third one that stands nowhere else")
    rows = [(1, a), (2, f"{a}\n{b}"), (3, b), (4, c), (5, c[:-1]), (6, None)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ld.line_dedup(docs(spark, rows)).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (1, 1), 4: (4, 1), 5: (4, 1), 6: (6, 0)}


def test_hidden_names_and_repeated_rows(spark):
    line = "a line that is long enough to be judged here"
    df = docs(spark, [(1, line), (2, line), (2, line), (None, line), (None, line)])
    df = df.withColumns({n: F.lit(7) for n in ("__row", "__id", "__gone", "__places", "__left", "__links", "__root", "__row_of", "anchors", "line", "hits", "n")})
    out = ld.line_dedup(df)
    assert out.columns[: len(df.columns)] == df.columns
    got = sorted((str(r["doc_id"]), r["text"], str(r["class_id"]), r["__row"], r["__root"]) for r in out.collect())
    assert got == [("1", "", "1", 7, 7), ("2", "", "1", 7, 7), ("2", "", "1", 7, 7), ("None", line, "None", 7, 7), ("None", line, "None", 7, 7)]


def test_query_drops_exact_repeats_of_short_lines(spark, tmp_path):
    rows = [(1, "all rights reserved.\nown"), (2, "All  rights reserved.\n\nother"), (3, "all rights reserved!"), (4, "x\nx")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.exact_dropped, r.near_dropped) for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (0, 0), 2: (1, 0), 3: (0, 0), 4: (1, 0)}
