"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to spark.checkpoint.dir and read back; a local folder only where none is set, on a single machine."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="skysift-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
