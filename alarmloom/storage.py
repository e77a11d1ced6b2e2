"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in spark.checkpoint.dir, as Spark resolved it.

    Only where none is named and all runs on one machine (tests) a temporary folder is set.
    """
    context = spark.sparkContext
    named = context._jsc.sc().getCheckpointDir()
    if not named.isDefined():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and context.master.split("[")[0] != "local":
            raise RuntimeError("name a folder all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="alarmloom-"))
        named = context._jsc.sc().getCheckpointDir()
    return named.get()


def written(frame: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, sized by file."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4()}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
