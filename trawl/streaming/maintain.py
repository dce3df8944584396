"""Continuous maintenance: a change stream appended to an operation log.

Writes may be held in the state of the stream until their object has been quiet for some time, so that
an object written over and over, also over several micro-batches, is worked out once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from trawl.operators import maintenance as M
from trawl.operators.sizing import materialised
from trawl.operators.spec import IndexSpec
from trawl.operators.variants import Variant
from trawl.streaming.held import held_writes
from trawl.streaming.log import current_view

__all__ = ["batch_log", "current_view", "maintain", "maintain_quiet"]


def batch_log(feed: DataFrame, spec: IndexSpec, variants: Sequence[Variant],
              documents: DataFrame, draft_excluded: bool = True) -> DataFrame:
    """Operation-log rows of one batch of changes; the same code for batch and stream."""
    writes = M.coalesce_writes(feed, spec.tree, [v.column for v in variants])
    return writes_log(writes, spec, variants, documents, draft_excluded)


def writes_log(writes: DataFrame, spec: IndexSpec, variants: Sequence[Variant],
               documents: DataFrame, draft_excluded: bool = True) -> DataFrame:
    """The same of writes that were merged before."""
    stale = M.dirty(M.trim_writes(writes), spec, variants)
    ops = M.operations(stale, documents, spec, variants, draft_excluded)
    newest = writes.agg(F.max("seq")).scalar()
    return M.log_entries(ops, documents, newest)


def maintain(stream: DataFrame, spec: IndexSpec, variants: Sequence[Variant],
             documents: Callable[[SparkSession], DataFrame], log_path: str,
             checkpoint: str, draft_excluded: bool = True) -> StreamingQuery:
    """Run until all present changes are applied.

    Every micro-batch writes its own folder of the log. A batch that is retried
    after a failure overwrites that folder, so it is applied once. ``documents``
    reads the current source rows again for each batch.
    """
    def log(batch: DataFrame, current: DataFrame) -> DataFrame:
        return batch_log(batch, spec, variants, current, draft_excluded)

    return _run(stream, log, documents, log_path, checkpoint, "append")


def maintain_quiet(stream: DataFrame, spec: IndexSpec, variants: Sequence[Variant],
                   documents: Callable[[SparkSession], DataFrame], log_path: str, checkpoint: str,
                   quiet: str = "10 minutes", late: str = "0 seconds", time: str = "at",
                   draft_excluded: bool = True) -> StreamingQuery:
    """As ``maintain``, but an object and state is worked out when no write of it has come for ``quiet``, by the times in
    column ``time``; what has come of it by then is one write. Objects that aren't quiet yet stay in the
    checkpoint for the next run. ``stream`` has the states already (``sources.changes.with_states``). A
    write later than the watermark by more than ``late`` begins anew, so none is lost."""
    names = [v.column for v in variants]
    writes = held_writes(stream, spec.tree, names, quiet, late, time)

    def log(batch: DataFrame, current: DataFrame) -> DataFrame:
        # used several times: the state is gone through once
        return writes_log(materialised(batch), spec, variants, current, draft_excluded)

    return _run(writes, log, documents, log_path, checkpoint, "update")


def _run(rows: DataFrame, log: Callable[[DataFrame, DataFrame], DataFrame], documents: Callable[[SparkSession], DataFrame],
         log_path: str, checkpoint: str, mode: str) -> StreamingQuery:
    def apply(batch: DataFrame, batch_id: int) -> None:
        entries = log(batch, documents(batch.sparkSession))
        entries.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

    return (
        rows.writeStream.foreachBatch(apply).outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
