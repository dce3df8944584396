"""From changed rows to stale documents to upserts and deletes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from trawl.operators.sizing import checked_broadcast, materialised
from trawl.operators.spec import Derivation, IndexSpec
from trawl.operators.variants import (
    Variant, combinations, common, document_id, state_excluded, state_json,
)
from trawl.sources.classes import ClassTree


def _class_map(tree: ClassTree, value) -> Column:
    pairs = [F.lit(x) for name in tree.classes for x in (name, value(name))]
    return F.create_map(*pairs)


def based(feed: DataFrame, tree: ClassTree) -> DataFrame:
    """Writes with the base class of their object and how deep their own class is below it."""
    depth = F.try_element_at(_class_map(tree, lambda n: len(tree.ancestry(n))), F.col("class"))
    base = F.try_element_at(_class_map(tree, tree.base), F.col("class"))
    return feed.withColumns({"base": base, "depth": depth})


def coalesce_writes(feed: DataFrame, tree: ClassTree, state: Sequence[str] = ()) -> DataFrame:
    """One row per object and state: most specific class, last value of each
    ``class:field``, first command.

    Grouped by field first, so an object written very often is reduced on the map
    side and the second group holds one row per distinct field only.
    """
    key = ["id", "base", *state]
    named = F.transform_keys("fields", lambda k, _: F.concat("class", F.lit(":"), k))
    rows = based(feed, tree).select(
        "seq", *key, "class", "depth", "command",
        F.explode_outer(named).alias("field", "value"),
    )
    per_field = rows.groupBy(*key, "field").agg(
        F.max_by("value", "seq").alias("value"),
        F.max_by("class", F.struct("depth", "class")).alias("class"),
        F.max("depth").alias("depth"),
        F.min_by("command", "seq").alias("command"),
        F.min("seq").alias("first_seq"), F.max("seq").alias("seq"),
        F.bool_or(F.col("command") == "delete").alias("deleted"),
    )
    entries = F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", "value")))
    return per_field.groupBy(*key).agg(
        F.max_by("class", F.struct("depth", "class")).alias("class"),
        F.min_by("command", "first_seq").alias("command"),
        F.max("seq").alias("seq"), F.bool_or("deleted").alias("deleted"),
        F.map_from_entries(F.array_sort(entries)).alias("fields"),
    )


def trim_writes(writes: DataFrame) -> DataFrame:
    """Writes that change nothing are dropped; deletes are kept, also those merged
    with an earlier write of the same batch."""
    kept = (F.col("command") == "delete") | (F.size("fields") > 0)
    return writes.where(kept | F.col("deleted") if "deleted" in writes.columns else kept)


def delete_rows(deleted: DataFrame, tree: ClassTree) -> DataFrame:
    """Change rows of deleted objects: one fieldless delete per table of the ancestry.

    ``deleted``: ``seq, class, id``.
    """
    tables = _class_map(tree, lambda n: ",".join(tree.hierarchy(n, False, with_table=True)))
    return deleted.select(
        "seq", F.explode(F.split(F.try_element_at(tables, F.col("class")), ",")).alias("table"),
        "class", "id", F.lit("delete").alias("command"),
        F.create_map().cast("map<string,string>").alias("fields"),
    )


def _is_a(tree: ClassTree, names: Iterable[str]) -> Column:
    covered = sorted({d for n in names for d in tree.descendants(n)})
    return F.col("class").isin(*covered)


def prune(writes: DataFrame, spec: IndexSpec) -> DataFrame:
    """Writes of classes the index depends on."""
    return writes.where(_is_a(spec.tree, spec.dependencies()))


def dirty_direct(writes: DataFrame, spec: IndexSpec, state: Sequence[str] = ()) -> DataFrame:
    """Objects that are themselves in the index: ``base, id, <state>``."""
    frames = []
    for name, children in spec.classes.items():
        inside = _is_a(spec.tree, [name]) if children else F.col("class") == name
        frames.append(writes.where(inside).select(
            F.lit(spec.tree.base(name)).alias("base"), "id", *state
        ))
    return reduce(DataFrame.unionByName, frames).distinct()


def touches(derivation: Derivation) -> Column:
    """Did the write change a field the index reads through this path?"""
    return F.arrays_overlap(F.map_keys("fields"), F.array(*map(F.lit, derivation.fields)))


def walk_back(tree: ClassTree, changed: DataFrame, derivation: Derivation) -> DataFrame:
    """Base objects reached from changed objects by following the path backwards.

    ``changed`` has ``id``. The reached keys are counted at every step: as long as
    they are few they are broadcast and the relation table is only scanned; many
    are joined by a shuffle.
    """
    at = checked_broadcast(changed.select("id").distinct())
    for hop in reversed(derivation.hops):
        relation = hop.relation
        if relation.kind == "has_one":
            links = tree.rows(hop.owner).select(F.col(relation.key).alias("id"), F.col("ID").alias("next"))
        elif relation.kind == "has_many":
            links = tree.rows(relation.target).select(
                F.col("ID").alias("id"), F.col(relation.key).alias("next")
            )
        else:
            links = relation.link.select(
                F.col(relation.far_key).alias("id"), F.col(relation.key).alias("next")
            )
        reached = (
            links.join(at, "id").select(F.col("next").alias("id"))
            .where(F.col("id").isNotNull()).distinct()
        )
        at = checked_broadcast(reached) if hop is not derivation.hops[0] else reached
    return at


def dirty_derived(writes: DataFrame, spec: IndexSpec, variants: Sequence[Variant] = ()) -> DataFrame:
    """Objects whose related rows changed, in every state of the changed class."""
    frames = []
    names = [v.column for v in variants]
    for derivation in spec.derivations():
        changed = writes.where(_is_a(spec.tree, derivation.classes) & touches(derivation))
        reached = walk_back(spec.tree, changed, derivation)
        used = common(variants, spec.tree, {c: True for c in derivation.classes})
        states = F.array(*[
            F.struct(*[F.lit(s.get(n)).cast("string").alias(n) for n in names])
            for s in combinations(used)
        ]) if names else None
        reached = reached.select(F.lit(derivation.base).alias("base"), "id")
        if names:
            reached = reached.select("base", "id", F.explode(states).alias("s")).select(
                "base", "id", *[F.col(f"s.{n}").alias(n) for n in names]
            )
        frames.append(reached)
    if not frames:
        return writes.limit(0).select(F.lit("").alias("base"), "id", *names)
    return reduce(DataFrame.unionByName, frames).distinct()


def dirty(writes: DataFrame, spec: IndexSpec, variants: Sequence[Variant] = ()) -> DataFrame:
    """Everything a batch of writes makes stale in one index."""
    names = [v.column for v in variants]
    relevant = prune(writes, spec)
    direct = dirty_direct(relevant, spec, names)
    return direct.unionByName(dirty_derived(relevant, spec, variants)).distinct()


def merge_dirty(per_index: dict[str, DataFrame], state: Sequence[str] = ()) -> DataFrame:
    """``base, id, <state>, indexes``: which indexes each stale object is in."""
    tagged = [d.withColumn("index", F.lit(name)) for name, d in per_index.items()]
    return (
        reduce(DataFrame.unionByName, tagged).groupBy("base", "id", *state)
        .agg(F.array_sort(F.collect_set("index")).alias("indexes"))
    )


def operations(stale: DataFrame, documents: DataFrame, spec: IndexSpec,
               variants: Sequence[Variant] = (), draft_excluded: bool = True,
               indexable: str = "indexable") -> DataFrame:
    """``_documentid, base, id, <state>, op`` for every stale object and state.

    ``documents`` are the current rows in all states with a boolean ``indexable``.
    Excluded states cause nothing; rows that may not be indexed and rows that are
    gone become deletes, the rest upserts.
    """
    names = [v.column for v in variants]
    considered = stale.where(~state_excluded(spec.excluded_states, draft_excluded)) if names else stale
    considered = considered.withColumn("state", state_json(variants)).withColumn(
        "_documentid", document_id(F.col("id"), F.col("base"), F.col("state"))
    )
    considered = materialised(considered)
    verdict = of_objects(documents, considered).select("_documentid", F.col(indexable).alias("__ok"))
    op = F.when(F.coalesce("__ok", F.lit(False)), F.lit("upsert")).otherwise(F.lit("delete"))
    return considered.join(verdict, "_documentid", "left").select(
        "_documentid", "base", "id", *names, op.alias("op")
    )


def of_objects(documents: DataFrame, stale: DataFrame) -> DataFrame:
    """Documents of the stale objects. The semi join is on the object's own key, so
    Spark can push it down to the source tables before any field is computed."""
    ids = checked_broadcast(stale.select(F.col("id").alias("ID")).distinct())
    return documents.join(ids, "ID", "left_semi")


def log_entries(ops: DataFrame, documents: DataFrame, seq: Column) -> DataFrame:
    """Operation-log rows: the document of an upsert, just the key of a delete."""
    body = of_objects(documents, ops).drop("indexable")
    return (
        ops.select("_documentid", "op").join(body, "_documentid", "left")
        .withColumn("seq", seq)
    )
