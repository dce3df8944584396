"""The operation log: its batches, snapshots of what they add up to, and the view of both.

A batch is a folder ``batch=N``. Compaction writes the current rows up to a batch as a snapshot and then, last,
a pointer to it; the view is the newest snapshot that has a pointer, without the keys of later batches, and
what these leave. A compaction cut off half-way has no pointer and changes nothing. The newest batch is never in
a snapshot: the stream may still write it again.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.operators import store

KEY = "_documentid"
SNAPSHOTS, POINTERS = "_snapshots", "_pointers"  # Spark leaves such names out when it reads the log
POINTER = "upto bigint, path string"


def log_of(spark: SparkSession, path: str) -> DataFrame:
    """All batches. A row is read when its batch runs, so a later batch knows better whatever its numbers: ``__order``."""
    return spark.read.parquet(path).withColumn("__order", F.struct("batch", "seq"))


def newest_pointer(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """The batch the newest finished snapshot goes up to, and its folder."""
    try:
        pointers = spark.read.schema(POINTER).parquet(f"{path}/{POINTERS}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    found = pointers.orderBy(F.desc("upto")).first()
    return (found["upto"], found["path"]) if found else None


def _write_snapshot(view: DataFrame, folder: str) -> None:
    view.write.parquet(folder)


def compact(spark: SparkSession, path: str) -> int | None:
    """Snapshot all batches but the newest; the last batch that is in it, or None if there is nothing new."""
    newest = log_of(spark, path).agg(F.max("batch").alias("b")).first()["b"]
    known = newest_pointer(spark, path)
    upto = newest - 1 if newest is not None else -1
    if upto < 0 or known is not None and known[0] >= upto:
        return None
    folder = f"{path}/{SNAPSHOTS}/upto={upto}-{uuid.uuid4().hex}"
    _write_snapshot(_view(spark, path, known, upto), folder)
    pointer = spark.createDataFrame([(upto, folder)], POINTER)
    pointer.coalesce(1).write.parquet(f"{path}/{POINTERS}/{uuid.uuid4().hex}")
    return upto


def current_view(spark: SparkSession, path: str) -> DataFrame:
    """Documents as they are after all logged operations."""
    return _view(spark, path, newest_pointer(spark, path))


def _view(spark: SparkSession, path: str, known: tuple[int, str] | None, upto: int | None = None) -> DataFrame:
    """Of batches up to ``upto``. Those in the snapshot are pruned as partitions."""
    log = log_of(spark, path)
    if upto is not None:
        log = log.where(F.col("batch") <= upto)
    if known is None:
        return store.latest(log, seq="__order").drop("__order", "batch")
    later = log.where(F.col("batch") > known[0])
    rows = store.latest(later, seq="__order").drop("__order", "batch")
    held = spark.read.parquet(known[1])
    return held.join(later.select(KEY).distinct(), KEY, "left_anti").unionByName(rows, allowMissingColumns=True)
