"""Filters on fields with several values, by joins with the values table of an index.

A document may have any number of values of a field, one row each, so they are never gathered: what a
query requires of a field is a semi join, what it excludes an anti join, and all values that a batch of
queries names are one joined table. Values asked for become literals that prune the table's buckets and row groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from trawl.operators.criteria import MISSING, PRESENT, Range
from trawl.operators.variants import with_states

LITERALS = 1000
CLAUSES = "query_id string, clause int, required boolean"


@dataclass(frozen=True)
class Clause:
    """Documents with a value of ``field`` that passes any of the ``tests``; with ``others`` those whose values all
    fail. A query either requires them or excludes them."""

    query_id: str
    field: str
    tests: tuple[Any, ...]
    required: bool
    others: bool = False


def clauses_of(query_id: str, required: Mapping[str, Sequence[Any]], excluded: Mapping[str, Sequence[Any]]) -> list[Clause]:
    """Missing values turn a filter around: a field that is missing or has a listed value is one whose values, if it has any,
    don't all fail."""
    out = []
    for field, values in required.items():
        tests = tuple(v for v in values if v is not MISSING)
        if len(tests) < len(values):
            if PRESENT not in tests:
                out.append(Clause(query_id, field, tests, False, others=True))
        else:
            out.append(Clause(query_id, field, tests, True))
    for field, values in excluded.items():
        tests = tuple(v for v in values if v is not MISSING)
        if len(tests) < len(values):
            out.append(Clause(query_id, field, (PRESENT,), True))
        if tests:
            out.append(Clause(query_id, field, tests, False))
    return out


def on_values(queries: Iterable, columns: Iterable[str], current: Mapping[str, str]) -> list[Clause]:
    """The filters of queries on fields that no column of the documents has."""
    columns, out = set(columns), []
    for q in queries:
        required = {n: v for n, v in with_states(q.required, dict(current)).items() if n not in columns}
        excluded = {n: v for n, v in q.excluded.items() if n not in columns}
        out += clauses_of(q.query_id, required, excluded)
    return out


def by_values(matches: DataFrame, values: DataFrame | None, clauses: Sequence[Clause]) -> DataFrame:
    """Matches that pass every clause of their query."""
    if not clauses or values is None:
        return matches
    spark = matches.sparkSession
    # equal clauses of different queries are looked up once
    numbers = {key: i for i, key in enumerate(dict.fromkeys((c.field, c.tests, c.others) for c in clauses))}
    passing = _passing(values, numbers)
    rows = [(c.query_id, numbers[c.field, c.tests, c.others], c.required) for c in clauses]
    asked = F.broadcast(spark.createDataFrame(list(dict.fromkeys(rows)), CLAUSES))
    if any(c.required for c in clauses):
        wanted = asked.where("required")
        needed = F.broadcast(wanted.groupBy("query_id").agg(F.count("*").alias("n_needed")))
        met = (
            matches.select("query_id", "doc_id").join(wanted, "query_id")
            .join(passing, ["clause", "doc_id"], "left_semi")
            .groupBy("query_id", "doc_id").agg(F.count("*").alias("n_met"))
        )
        free = matches.join(needed, "query_id", "left_anti")
        bound = matches.join(met, ["query_id", "doc_id"]).join(needed, "query_id").where("n_met = n_needed")
        matches = free.unionByName(bound.select(*matches.columns))
    if any(not c.required for c in clauses):
        gone = (
            matches.select("query_id", "doc_id").join(asked.where("NOT required"), "query_id")
            .join(passing, ["clause", "doc_id"], "left_semi")
        )
        matches = matches.join(gone, ["query_id", "doc_id"], "left_anti")
    return matches


def _passing(values: DataFrame, numbers: Mapping[tuple, int]) -> DataFrame:
    """``clause, doc_id``: the documents of each clause."""
    spark = values.sparkSession
    equal, frames = [], []
    for (field, tests, others), i in numbers.items():
        wide = [t for t in tests if t is PRESENT or isinstance(t, Range) or _is_number(t)]
        single = [t for t in tests if t not in wide]
        if others:
            own = values.where(F.col("field") == field)
            bad = own.where(_any([_test(t) for t in tests])).select("doc_id") if tests else None
            own = own.select("doc_id")
            frames.append((own if bad is None else own.join(bad, "doc_id", "left_anti")).select(F.lit(i).alias("clause"), "doc_id"))
            continue
        equal += [(i, field, _string(t)) for t in single]
        if wide:
            frames.append(values.where((F.col("field") == field) & _any([_test(t) for t in wide]))
                          .select(F.lit(i).alias("clause"), "doc_id"))
    if equal:
        asked = F.broadcast(spark.createDataFrame(equal, "clause int, field string, value string"))
        frames.append(_cut(values, equal).join(asked, ["field", "value"]).select("clause", "doc_id"))
    return reduce(DataFrame.unionByName, frames)


def _cut(values: DataFrame, equal: list[tuple[int, str, str]]) -> DataFrame:
    from trawl.operators import store
    fields, texts = {f for _, f, _ in equal}, {v for _, _, v in equal}
    if len(texts) > LITERALS:
        return values.where(F.col("field").isin(*fields))
    kept = F.col("field").isin(*fields) & F.col("value").isin(*texts)
    if "bucket" in values.columns:
        kept = kept & F.col("bucket").isin(*{zlib.crc32(v.encode()) % store.BUCKETS for v in texts})
    return values.where(kept)


def _is_number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _string(value: Any) -> str:
    """As Spark writes a value of the type as a string."""
    if isinstance(value, bool):
        return str(value).lower()
    return str(value)


def _test(value: Any) -> Column:
    if value is PRESENT:
        return F.lit(True)
    if _is_number(value):
        value = Range(value, value)  # however the number is written
    if not isinstance(value, Range):
        return F.col("value") == _string(value)
    ends = [e for e in (value.start, value.end) if e is not None]
    numeric = bool(ends) and all(map(_is_number, ends))
    target, lit = (F.col("number"), F.lit) if numeric else (F.col("value"), lambda e: F.lit(_string(e)))
    verdict = target.isNotNull()
    if value.start is not None:
        verdict = verdict & (target >= lit(value.start))
    if value.end is not None:
        verdict = verdict & (target <= lit(value.end))
    return verdict


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
