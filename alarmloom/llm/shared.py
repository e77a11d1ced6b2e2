"""Helpers that several of the text operators use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the shared folder the session names; set one only on a single machine."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = context.getConf().get("spark.checkpoint.dir")
    if not named and context.master.split("[")[0] != "local":
        raise RuntimeError("name a folder all executors share in spark.checkpoint.dir")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="alarmloom-"))


def cut_lineage(frame: DataFrame) -> DataFrame:
    """The rows as files in the shared folder, so that a lost executor costs no rerun."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def written(frame: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, smaller than a checkpoint."""
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    path = f"{folder}/table-{uuid.uuid4()}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by their bytes: 10,000 long texts or sets are much for a worker.

    A batch is in the JVM and in the worker at once, there along with what is made of it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def held_out(divisor: int, remainder: int) -> Column:
    """Whether a row's label is kept from training, by its doc_id alone."""
    kept = F.crc32(F.col("doc_id").cast("string")) % divisor == remainder
    return F.coalesce(kept, F.lit(True))


def sample_number(seed: str) -> Column:
    """A number in [0, 1) from doc_id, the same at every run, to sample by."""
    bits = F.xxhash64(F.lit(seed), F.col("doc_id")).bitwiseAND(0xFFFFFFFF)
    return bits / F.lit(float(1 << 32))
