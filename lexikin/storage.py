"""Reliable materialisation of intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as the cluster names it.

    Only a session that runs in one process may go without; it gets a temporary folder
    for its lifetime.
    """
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lexikin-shared-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/lexikin-{uuid.uuid4().hex}/{name}"


def durable(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read on from there.

    The result survives the loss of executors, and a plan behind it runs once.
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
