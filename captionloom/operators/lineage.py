"""Cutting lineage and sending the package, for jobs that must survive lost executors."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once for each application, wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    made = Path(tempfile.mkdtemp(prefix="captionloom-")) / "captionloom.zip"
    with zipfile.ZipFile(made, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(made))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a folder of this machine serves local sessions, as in
    tests; on a cluster no executor would see it, so the setting is asked for."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="captionloom-checkpoint-")


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that spark.checkpoint.dir names.

    A folder of our own is set only where a local session names none, as in tests.
    """
    spark = df.sparkSession
    ship(spark)
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    done = df.checkpoint(eager=True)._jdf
    # A checkpoint keeps the size that its plan was guessed to have. Over rounds of joins these guesses multiply into
    # numbers that take longer to compute than the query, so the rows start again without one.
    fresh = spark._jsparkSession.internalCreateDataFrame(done.queryExecution().toRdd(), done.schema(), False)
    return DataFrame(fresh, spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that nothing refers to any more (and checkpoints, where the session sets
    spark.cleaner.referenceTracking.cleanCheckpoints), as a round of an iterative job ends; by itself it waits until
    the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
