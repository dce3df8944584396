"""Filter criteria as Columns: comparisons, AND/OR groups and value filters.

All negations are null-safe: a document without the field is not removed by a
condition on that field's value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F

EQUAL = "EQUAL"
NOT_EQUAL = "NOT_EQUAL"
GREATER_EQUAL = "GREATER_EQUAL"
GREATER_THAN = "GREATER_THAN"
LESS_EQUAL = "LESS_EQUAL"
LESS_THAN = "LESS_THAN"
IN = "IN"
NOT_IN = "NOT_IN"
ISNULL = "ISNULL"
ISNOTNULL = "ISNOTNULL"
CUSTOM = "CUSTOM"

AND = "AND"
OR = "OR"


class _Marker:
    def __init__(self, name: str):
        self.name = name

    def __repr__(self) -> str:
        return self.name


MISSING = _Marker("MISSING")
PRESENT = _Marker("PRESENT")


@dataclass(frozen=True)
class Range:
    """Inclusive range; a None end is open."""

    start: Any = None
    end: Any = None


def negate(predicate: Column) -> Column:
    return ~F.coalesce(predicate, F.lit(False))


Writer = Callable[["Criterion"], Column]


@dataclass(frozen=True)
class Criterion:
    """One comparison. A ``writer`` supplies the predicate itself and always wins."""

    target: str
    value: Any = None
    comparison: str = EQUAL
    writer: Writer | None = None

    def column(self) -> Column:
        if self.writer is not None:
            return self.writer(self)
        if self.comparison == CUSTOM:
            raise ValueError("a custom comparison needs a writer")
        if self.comparison in (IN, NOT_IN) and not isinstance(self.value, (list, tuple, set)):
            raise ValueError(f"{self.comparison} needs a list of values")
        target = F.col(self.target)
        compare = {
            EQUAL: lambda: target == self.value,
            NOT_EQUAL: lambda: negate(target == self.value),
            IN: lambda: target.isin(*self.value),
            NOT_IN: lambda: negate(target.isin(*self.value)),
            GREATER_EQUAL: lambda: target >= self.value,
            GREATER_THAN: lambda: target > self.value,
            LESS_EQUAL: lambda: target <= self.value,
            LESS_THAN: lambda: target < self.value,
            ISNULL: lambda: target.isNull(),
            ISNOTNULL: lambda: target.isNotNull(),
        }
        if self.comparison not in compare:
            raise ValueError(f"unknown comparison {self.comparison}")
        return compare[self.comparison]()


@dataclass
class Criteria:
    """Clauses joined by AND/OR, folded from left to right; groups may nest."""

    clauses: list[tuple[str, Criterion | Criteria]] = field(default_factory=list)

    @classmethod
    def of(cls, target, value=None, comparison: str = EQUAL, writer: Writer | None = None) -> Criteria:
        return cls()._add(AND, target, value, comparison, writer)

    def and_(self, target, value=None, comparison: str = EQUAL, writer: Writer | None = None) -> Criteria:
        return self._add(AND, target, value, comparison, writer)

    def or_(self, target, value=None, comparison: str = EQUAL, writer: Writer | None = None) -> Criteria:
        return self._add(OR, target, value, comparison, writer)

    def _add(self, conjunction, target, value, comparison, writer) -> Criteria:
        if not isinstance(target, (Criterion, Criteria)):
            target = Criterion(target, value, comparison, writer)
        self.clauses.append((conjunction, target))
        return self

    def column(self) -> Column:
        (_, first), *rest = self.clauses
        return reduce(
            lambda left, clause: (
                left & clause[1].column() if clause[0] == AND else left | clause[1].column()
            ),
            rest, first.column(),
        )


# Value filters ------------------------------------------------------------

def _holds(value: Any, target: Column, multi: bool) -> Column:
    present = (target.isNotNull() & (F.size(target) > 0)) if multi else target.isNotNull()
    if value is MISSING:
        return ~present
    if value is PRESENT:
        return present
    if isinstance(value, Range):
        def inside(v: Column) -> Column:
            low = F.lit(True) if value.start is None else v >= F.lit(value.start)
            high = F.lit(True) if value.end is None else v <= F.lit(value.end)
            return v.isNotNull() & low & high
        return F.exists(target, inside) if multi else inside(target)
    return F.array_contains(target, value) if multi else target == value


def any_of(name: str, values: Iterable[Any], multi: bool = False) -> Column:
    target = F.col(name)
    return reduce(lambda a, b: a | b, (_holds(v, target, multi) for v in values))


def require(filters: Mapping[str, Sequence[Any]], multi: Iterable[str] = ()) -> Column:
    """Any listed value within a field, every field."""
    return reduce(
        lambda a, b: a & b, (any_of(n, v, n in multi) for n, v in filters.items()), F.lit(True)
    )


def exclude(filters: Mapping[str, Sequence[Any]], multi: Iterable[str] = ()) -> Column:
    """No listed value in any field. Listing MISSING requires the field."""
    verdict = F.lit(True)
    for name, values in filters.items():
        others = [v for v in values if v is not MISSING]
        if len(others) < len(values):
            verdict = verdict & any_of(name, [PRESENT], name in multi)
        if others:
            verdict = verdict & negate(any_of(name, others, name in multi))
    return verdict


def classes(wanted: Iterable[tuple[str, bool]]) -> Column:
    """Any of the classes, each with or without its subclasses."""
    return reduce(
        lambda a, b: a | b,
        (
            F.array_contains("ClassHierarchy", c) if children else F.col("ClassName") == c
            for c, children in wanted
        ),
    )
