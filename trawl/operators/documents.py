"""Documents from related tables.

A document is one row: fixed columns, state columns and single-valued fields.
Fields that pass a "many" relation can have any number of values per object, so
they are kept long (``values``: one row per value) and never gathered into an
array; filters, facets and text analysis all read the long form.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from trawl.functions.values import convert
from trawl.operators.spec import FieldSpec, Hop, IndexSpec
from trawl.operators.variants import Variant, document_id, fan_out, state_json
from trawl.sources.classes import ClassTree, class_is

FIXED = ("_documentid", "ID", "ClassName", "ClassHierarchy", "base", "state")


def _link_column(hop: Hop) -> str:
    return hop.relation.key if hop.relation.kind == "has_one" else "ID"


def follow(tree: ClassTree, roots: DataFrame, hops: Sequence[Hop], leaves: Sequence[str]) -> DataFrame:
    """Objects at the end of a relation path: ``root_id, value_id, <leaves>``."""
    at = roots.select(F.col("ID").alias("root_id"), F.col(_link_column(hops[0])).alias("link"))
    for i, hop in enumerate(hops):
        relation = hop.relation
        target = tree.rows(relation.target)
        last = i == len(hops) - 1
        carried = list(leaves) if last else [_link_column(hops[i + 1])]
        key = relation.key if relation.kind == "has_many" else "ID"
        columns = [F.col(key).alias("target_key"), F.col("ID").alias("value_id")]
        columns += [F.col(c).alias(f"carried_{n}") for n, c in enumerate(carried)]
        target = target.select(*columns)
        if relation.kind == "many_many":
            pairs = relation.link.select(
                F.col(relation.key).alias("link"), F.col(relation.far_key).alias("far")
            ).distinct()
            at = at.join(pairs, "link").select("root_id", F.col("far").alias("link"))
        at = at.join(target, F.col("link") == F.col("target_key"))
        if last:
            named = [F.col(f"carried_{n}").alias(c) for n, c in enumerate(carried)]
            return at.select("root_id", "value_id", *named)
        at = at.select("root_id", F.col("carried_0").alias("link"))
    raise ValueError("a relation path needs at least one step")


ERRORS = "_errors"


def _failure(spec: FieldSpec, raw: Column, inside: Column) -> Column:
    """What could not be converted to the type of its field; null if it could or was absent."""
    kind = spec.index_type()
    failed = inside & raw.isNotNull() & convert(raw, kind).isNull()
    return F.when(failed, F.struct(F.lit(spec.name).alias("field"), raw.cast("string").alias("raw"),
                                   F.lit(f"not a {kind}").alias("reason")))


def _attach_single(tree: ClassTree, rows: DataFrame, hops: Sequence[Hop],
                   specs: Sequence[FieldSpec], errors: bool = False) -> DataFrame:
    """Left-join has_one targets straight onto the rows, one join per step. With ``errors`` the
    raw values stay beside them."""
    own = rows.columns
    link = F.col(hops[0].relation.key)
    for i, hop in enumerate(hops):
        last = i == len(hops) - 1
        target = tree.rows(hop.relation.target)
        if last:
            carried = [convert(F.col(s.field), s.index_type()).alias(s.name) for s in specs]
            carried += [F.col(s.field).alias(f"__raw_{s.name}") for s in specs if errors]
        else:
            carried = [F.col(hops[i + 1].relation.key).alias(f"__link{i}")]
        target = target.select(F.col("ID").alias("__target"), *carried)
        rows = rows.join(target, link == F.col("__target"), "left").drop("__target")
        link = F.col(f"__link{i}")
    guarded = {s.name: F.when(class_is(*s.origin), F.col(s.name)) for s in specs}
    raw = [F.col(f"__raw_{s.name}") for s in specs if errors]
    return rows.select(*own, *raw, *[expr.alias(n) for n, expr in guarded.items()])


def _by_path(specs: Sequence[FieldSpec]) -> dict[tuple[Hop, ...], list[FieldSpec]]:
    groups: dict[tuple[Hop, ...], list[FieldSpec]] = {}
    for s in specs:
        groups.setdefault(s.hops, []).append(s)
    return groups


def _class_rows(spec: IndexSpec, base: str) -> DataFrame:
    """Rows of all index classes that share a base table, each row once."""
    names = spec.tree.minimal_cover(
        [c for c, children in spec.classes.items() if spec.tree.base(c) == base and children]
    )
    exact = [
        c for c, children in spec.classes.items()
        if spec.tree.base(c) == base and not children and not spec.tree.is_a(c, names)
    ]
    frames = [spec.tree.rows(c) for c in names] + [spec.tree.rows(c, False) for c in exact]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def build_documents(spec: IndexSpec, variants: Sequence[Variant] = (),
                    gate: Column | None = None, keep: Sequence[str] = (), errors: bool = False) -> DataFrame:
    """One row per object and state, with every single-valued field of the index.

    ``gate`` drops rows that may not be indexed; ``keep`` passes raw columns on. A value that
    can't be converted is absent; with ``errors`` each row lists its own (``write_checked``).
    """
    frames = []
    for base in spec.base_classes():
        rows = _class_rows(spec, base)
        if gate is not None:
            rows = rows.where(gate)
        rows = rows.withColumn("base", F.lit(base))
        singles = [f for f in spec.fields().values() if not f.multi_valued and base in f.base]
        for hops, specs in _by_path([f for f in singles if f.hops]).items():
            rows = _attach_single(spec.tree, rows, hops, specs, errors)
        rows = fan_out(rows, variants).withColumn("state", state_json(variants))
        fields, failures = [], []
        for f in singles:
            if f.hops:
                fields.append(F.col(f.name))
                raw = F.col(f"__raw_{f.name}")
            elif f.field in rows.columns:
                raw = F.col(f.field)
                fields.append(F.when(class_is(*f.origin), convert(raw, f.index_type())).alias(f.name))
            else:
                continue
            if errors:
                failures.append(_failure(f, raw, class_is(*f.origin)))
        if errors:
            none = F.array().cast("array<struct<field:string,raw:string,reason:string>>")
            fields.append((F.filter(F.array(*failures), F.isnotnull) if failures else none).alias(ERRORS))
        frames.append(rows.select(
            document_id(F.col("ID"), F.col("base"), F.col("state")).alias("_documentid"),
            "ID", "ClassName", "ClassHierarchy", "base", "state",
            *[v.column for v in variants],
            *[c for c in keep if c in rows.columns], *fields,
        ))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@dataclass(frozen=True)
class Checked:
    """Documents as written, the values that failed (``_documentid, field, raw, reason``), and how many documents and
    failures the writing pass has counted."""

    documents: DataFrame
    errors: DataFrame
    n_documents: int
    n_errors: int


def write_checked(built: DataFrame, path: str) -> Checked:
    """Write documents that were built with ``errors`` once. One pass makes the documents, their failures and
    the counts; a retried task counts once."""
    spark, seen = built.sparkSession, Observation()
    built.observe(seen, F.count("*").alias("documents"), F.coalesce(F.sum(F.size(ERRORS)), F.lit(0)).alias("errors")) \
        .write.parquet(path)
    written, counts = spark.read.schema(built.schema).parquet(path), seen.get
    failed = written.select("_documentid", F.explode(ERRORS).alias("e")).select("_documentid", "e.*")
    return Checked(written.drop(ERRORS), failed, counts["documents"], counts["errors"])


def build_values(spec: IndexSpec, gate: Column | None = None) -> DataFrame | None:
    """Multi-valued fields, long: ``base, ID, field, value_id, value`` (as strings)."""
    frames = []
    for base in spec.base_classes():
        many = [f for f in spec.fields().values() if f.multi_valued and base in f.base]
        if not many:
            continue
        rows = _class_rows(spec, base)
        if gate is not None:
            rows = rows.where(gate)
        for hops, specs in _by_path(many).items():
            roots = rows.where(class_is(*specs[0].origin))
            leaves = list(dict.fromkeys(s.field for s in specs))
            reached = follow(spec.tree, roots, hops, leaves)
            for s in specs:
                value = convert(F.col(s.field), s.index_type()).cast("string")
                frames.append(
                    reached.select(
                        F.lit(base).alias("base"), F.col("root_id").alias("ID"),
                        F.lit(s.name).alias("field"), "value_id", value.alias("value"),
                    ).where(F.col("value").isNotNull())
                )
    return reduce(DataFrame.unionByName, frames) if frames else None


def copied(documents: DataFrame, pairs: Sequence[tuple[str, str]], key: str = "_documentid") -> DataFrame:
    """Copy fields, long: ``key, dest, source, value``; absent values are not copied."""
    entries = [
        F.struct(F.lit(dest).alias("dest"), F.lit(source).alias("source"),
                 F.col(source).cast("string").alias("value"))
        for source, dest in pairs if source in documents.columns
    ]
    return (
        documents.select(key, F.explode(F.array(*entries)).alias("c"))
        .select(key, "c.dest", "c.source", "c.value")
        .where(F.col("value").isNotNull())
    )


def stored(documents: DataFrame, spec: IndexSpec, default: bool = False) -> DataFrame:
    """What may be returned or highlighted: fixed columns and stored fields."""
    names = [n for n in spec.stored_fields(default) if n in documents.columns]
    return documents.select(*[c for c in FIXED if c in documents.columns], *names)
