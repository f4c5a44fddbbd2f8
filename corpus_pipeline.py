"""The corpus pipeline: five operators, one after another, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. run() writes every stage's result as
Parquet in the shared folder that spark.checkpoint.dir names and reads it again as the next one's input; only the last
stage's rows stay, as a checkpoint that Spark deletes with them.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.llm import bpe, decontamination, line_dedup, near_dedup, toxicity
from captionloom.llm.common import crc_of_id, read, settle, without
from captionloom.llm.queries import RANK_FILE
from captionloom.operators.lineage import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    learn = F.pmod(crc_of_id(), F.lit(5)) != 0
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=learn)
    scored = toxicity.score(docs, model, score_col="toxicity_score", worst_col=None)
    return scored.where("toxicity_score < 0.5").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line repeats, short ones too; documents that lose all their text go."""
    out = line_dedup.line_dedup(docs, exact_chars=1, classes=False).where("line_kept")
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return without(docs, near_dedup.near_dedup(docs).where("NOT kept").select("doc_id")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    found = decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated").select("doc_id")).select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed, little-endian unsigned 32-bit), and digests of them and of the text decoded from them."""
    path, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    out = bpe.encode(docs, path, pattern, decoded_col="decoded", keep_text=False)
    return out.select("doc_id", "lang", "source", "n_chars", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenise),
]

#: Training, near duplicates and tokens are beyond SQL; tests/llm hold the pipeline against a brute-force version.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table.

    Null and empty texts go through all stages and have no tokens; repeated rows with the same id go or stay together; null ids
    stay; an empty table gives no rows; further columns pass through all stages but the last.
    """
    shared = shared_folder(spark)
    base = f"{shared.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, last = read(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            _delete(spark, last)
        docs, last = spark.read.parquet(path), path
    out = settle(STAGES[-1][1](spark, docs, sf_dir))
    _delete(spark, base)
    return out
