"""Results that are stored once and read several times."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Where that is unset and all runs in one process, a folder of our own does; on a cluster it is an error.
    """
    sc = spark.sparkContext
    have = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not have:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is unset: set it to a folder that the driver and all executors share")
        have = "file://" + tempfile.mkdtemp(prefix="ledgerbeam-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(have)
    return have


def stored(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder; lost executors don't lose it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
