"""Full and partial rebuilds of an index."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trawl.operators import criteria, store
from trawl.operators.variants import state_filter

BATCH = 200


def clear_obsolete(documents: DataFrame, classes: dict[str, bool]) -> DataFrame:
    """Keep documents of the listed classes; an empty list changes nothing."""
    if not classes:
        return documents
    return documents.where(criteria.classes(classes.items()))


def group_counts(rows: DataFrame, state: Sequence[str], batch: int = BATCH) -> DataFrame:
    """Rows and number of groups per class and state."""
    return rows.groupBy("ClassName", *state).agg(F.count("*").alias("total")).withColumn(
        "groups", F.ceil(F.col("total") / F.lit(batch)).cast("long")
    )


def group_of(groups: Column | int) -> Column:
    groups = groups if isinstance(groups, Column) else F.lit(groups)
    return F.pmod(F.col("ID"), groups)


def members(rows: DataFrame, groups: int, group: int) -> DataFrame:
    return rows.where(group_of(groups) == group)


def clear_predicate(cls: str, state: dict[str, str], groups: int | None = None,
                    group: int | None = None) -> Column:
    """Documents of a class in one state, optionally of one group only."""
    predicate = F.array_contains("ClassHierarchy", cls)
    for column, value in state.items():
        predicate = predicate & state_filter(column, value)
    if groups:
        predicate = predicate & (group_of(groups) == group)
    return predicate


def run_group(index: DataFrame, fresh: DataFrame, cls: str, state: dict[str, str],
              groups: int, group: int) -> DataFrame:
    """Replace one group: delete its old documents, add the current ones.

    ``fresh`` are all current indexable documents; the group is cut out by the
    same predicate, so the union over all groups is the full rebuild.
    """
    predicate = clear_predicate(cls, state, groups, group)
    kept = store.delete_where(index, predicate)
    return kept.unionByName(fresh.where(predicate), allowMissingColumns=True)


def clear_empty_states(index: DataFrame, counts: DataFrame, states: Iterable[dict[str, str]],
                       cls: str) -> DataFrame:
    """Delete the documents of states in which the class has no rows left.

    ``counts`` has one row per state that holds rows; states are configuration.
    """
    states = list(states)
    if not states:
        return index
    names = sorted({n for s in states for n in s})
    live = counts.select(*names).distinct().withColumn("__live", F.lit(True))
    of_class = F.array_contains("ClassHierarchy", cls)
    matched = index.join(
        live, [index[n].eqNullSafe(live[n]) for n in names], "left"
    ).drop(*[live[n] for n in names])
    return store.delete_where(matched, of_class & F.col("__live").isNull()).drop("__live")


def full(index: DataFrame, fresh: DataFrame, classes: dict[str, bool],
         states: Iterable[dict[str, str]]) -> DataFrame:
    """Rebuild all groups of all classes and states in one job.

    Documents of states that are not rebuilt (excluded ones) are cleared by the
    caller through ``clear_empty_states``; obsolete classes go here.
    """
    kept = clear_obsolete(index, classes)
    for cls in classes:
        for state in states:
            kept = store.delete_where(kept, clear_predicate(cls, state))
    return kept.unionByName(fresh, allowMissingColumns=True)
