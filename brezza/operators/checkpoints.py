"""Cutting lineage in a folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


class NoSharedFolder(RuntimeError):
    """The session names no folder for checkpoints."""


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """The rows, written to the checkpoint folder that the session names (``spark.checkpoint.dir``), without their lineage.

    A session of one machine that names none has one beside its warehouse; on a cluster that is an error, as its executors share no such folder.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", "") and not context.getCheckpointDir():
        if not context.master.startswith("local[") and context.master != "local":
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A checkpointed table of short rows, to be broadcast where a count of its rows allows; joined as usual beyond that."""
    return F.broadcast(df) if df.count() <= most else df
