"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset a local session gets a temporary folder; a cluster, whose executors could
    not see one, gets an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="rasterloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/rasterloom-{uuid.uuid4().hex}"


def materialise(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
