"""Cutting lineage in a way that survives the loss of executors."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    The folder named by the cluster (``spark.checkpoint.dir``, or ``setCheckpointDir``) always
    wins. Only a session in one process without one gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder would not survive an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="minelark-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/minelark/{spark.sparkContext.applicationId}/{uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, store it as a table in the shared folder and read it from there.

    Used where a costly input feeds several branches of one plan, and between the rounds
    of iterative operators. A stored table also has a known size, so a join broadcasts it
    only below the session's threshold; a checkpointed plan keeps the estimate of the plan
    it replaces, which grows without bound from round to round.
    """
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._settled_at = path
    return stored


def release(stored: DataFrame) -> None:
    """Delete a table that :func:`settle` stored, once nothing will read it: for rounds of a loop."""
    session = stored.sparkSession
    path = session._jvm.org.apache.hadoop.fs.Path(stored._settled_at)
    path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)
