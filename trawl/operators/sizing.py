"""Materialising intermediate results and broadcasting only what was counted."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 200_000


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder the cluster names; only a local session
    that names none gets one of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return f"{shared}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"trawl-{name}-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(scratch_folder(spark, "checkpoint"))


def materialised(frame: DataFrame) -> DataFrame:
    """Write the rows once; later uses read them instead of computing them again.

    They are persisted while the checkpoint is written, which otherwise computes
    them a second time.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    held = frame.persist()
    try:
        return held.checkpoint()
    finally:
        held.unpersist()


def checked_broadcast(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Materialise and count; hint a broadcast only within the bound. Beyond it the
    join shuffles, and adaptive execution splits its hot keys."""
    kept = materialised(frame)
    return F.broadcast(kept) if within(kept, rows) else kept


def unless_few(side: DataFrame, written: DataFrame) -> DataFrame:
    """A side of a join that has about as many rows as some written ones. Spark broadcasts it by the size
    of their files, which says little of the rows it then holds; beyond the bound the join shuffles."""
    return side if within(written, BROADCAST_ROWS) else side.hint("merge")


def within(frame: DataFrame, rows: int) -> bool:
    return frame.limit(rows + 1).count() <= rows
