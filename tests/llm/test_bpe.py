import hashlib
import random

import public_tokenizers
from pyspark.sql import functions as F

from captionloom.llm import bpe
from tests.llm.helpers import docs

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_pieces_do_not_change_the_tokens():
    enc, rng = bpe.encoder(PATH, PATTERN), random.Random(3)
    parts = ["word", " ", "  ", "\n", "\n\n", "it's", "'s", "12", "3.5", "é", "漢字。", "ß", "\t", "!", "...", " ", "😀", "<|endoftext|>", "A", "\r\n"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 200)))
        assert bpe.encode_text(enc, text, limit=rng.randint(1, 30)) == enc.encode_ordinary(text)


def test_runs_of_white_space_cut_out_do_not_change_the_tokens():
    enc, rng = bpe.encoder(PATH, PATTERN), random.Random(4)
    parts = ["word", "it's", "1", "!", "é", " ", " ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\x1c", "\x1f", "\u200b"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))
        assert bpe.encode_text(enc, text, limit=rng.choice([1, 8, 1000]), blank=rng.randint(2, 6)) == enc.encode_ordinary(text), repr(text)


def test_runs_of_millions(spark):
    texts = [" " * 2_000_000, "a" + "\n " * 1_000_000 + "b", "\t" * 2_000_000 + " c" + " " * 1_200_000, "x" * 1_000_000]
    for r in bpe.encode(docs(spark, list(enumerate(texts))), PATH, PATTERN, decoded_col="decoded").collect():
        assert bytes(r.decoded).decode() == texts[r.doc_id] and r.n_tokens == len(r.token_ids) // 4


def test_round_trip_and_edges(spark):
    texts = [None, "", "plain words", "ünïcödé 漢字 😀 \u0000", "<|endoftext|>", "a b " * 60_000, " " * 3000]
    df = docs(spark, list(enumerate(texts))).withColumn("decoded", F.lit("kept")).withColumn("N_Tokens", F.lit(1))
    out = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN)
    enc = bpe.encoder(PATH, PATTERN)
    for r in out.collect():
        t = r["text"] or ""
        assert bytes(r["decoded_"]).decode() == t
        ids = enc.encode_ordinary(t)
        assert r["n_tokens"] == len(ids) and bpe.unpack(r["token_ids"]) == ids and r["decoded"] == "kept"


def test_empty_table(spark):
    assert bpe.encode(docs(spark, []), PATH, PATTERN).count() == 0


def test_query_digests(spark):
    from captionloom.llm.queries import op5_byte_bpe
    from tests.llm.helpers import table

    texts, enc = {r[0]: r[1] or "" for r in table("sf0.001", "documents")}, bpe.encoder(PATH, PATTERN)
    rows = op5_byte_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(bpe.pack(enc.encode_ordinary(texts[r.doc_id]))).hexdigest()
