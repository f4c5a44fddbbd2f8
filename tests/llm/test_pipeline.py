import hashlib

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as cp
from captionloom.llm import bpe, decontamination, toxicity
from captionloom.llm.common import crc_of_id
from tests.llm import test_decontamination, test_line_dedup, test_near_dedup
from tests.llm.helpers import docs, table

SF = "/root/testdata/sf0.001"


def brute(spark, rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs(spark, rows), labels, learn=F.pmod(crc_of_id(), F.lit(5)) != 0)
    rows = [(i, t) for i, t in rows if model.score(t) < 0.5]
    lines = test_line_dedup.brute(rows, 30, 1)
    rows = [(i, lines[i][0]) for i, t in rows if t is None or lines[i][0] == t or lines[i][0].strip(" ")]
    near = test_near_dedup.brute(rows)
    rows = [(i, t) for i, t in rows if near[i][2]]
    found = test_decontamination.brute(rows, [(r[0], r[1]) for r in table("sf0.001", "benchmark")], decontamination.WINDOW)
    return [(i, t) for i, t in rows if not found[i][3]]


def test_run_against_brute_force(spark):
    rows = [(r[0], r[1]) for r in table("sf0.001", "documents")]
    want = brute(spark, rows)
    assert 0 < len(want) < len(rows)
    enc = bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.token_ids)) for r in cp.run(spark, SF).collect()}
    assert got.keys() == {i for i, _ in want}
    for i, t in want:
        ids = bpe.pack(enc.encode_ordinary(t))
        assert got[i] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), ids)


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    line = "a line that is long enough to be judged here, and more of it"
    df = docs(spark, [(1, None), (2, ""), (3, line), (4, line), (5, "x " * 30_000), (6, "short"), (6, "short"), (None, line)])
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        assert {r.doc_id for r in out.collect()} >= {1, 2, 5, 6}, name
        assert stage(spark, df.limit(0), SF).count() == 0, name
    assert cp.STAGES[-1][1](spark, df, SF).count() == 8
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
