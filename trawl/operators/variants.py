"""Variants: the same object indexed once per state (draft/live, per site)."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from trawl.sources.classes import ClassTree, class_is

STAGE = "_versionedstage"
SUBSITE = "_subsite"
DRAFT = "Stage"
LIVE = "Live"


@dataclass(frozen=True)
class Variant:
    """``states`` are the values of ``column``; ``classes`` the classes it applies to.

    ``holds(row state)`` says whether a row exists in a state, as a Column.
    """

    column: str
    states: tuple[str, ...]
    classes: tuple[str, ...]
    holds: Callable[[Column], Column] = field(default=lambda state: F.lit(True))
    enabled: bool = True

    def applies_to(self, tree: ClassTree, name: str, children: bool = True) -> bool:
        names = tree.hierarchy(name, children) if children else tree.ancestry(name)
        return self.enabled and any(tree.is_a(n, self.classes) for n in names)


def common(variants: Iterable[Variant], tree: ClassTree, classes: dict[str, bool]) -> list[Variant]:
    """Variants that apply to at least one of the classes."""
    return [v for v in variants if any(v.applies_to(tree, c, s) for c, s in classes.items())]


def combinations(variants: Sequence[Variant]) -> list[dict[str, str]]:
    """Every combination of states; a variant without states is skipped."""
    used = [v for v in variants if v.states]
    return [
        dict(zip([v.column for v in used], chosen))
        for chosen in itertools.product(*(v.states for v in used))
    ]


def fan_out(rows: DataFrame, variants: Iterable[Variant]) -> DataFrame:
    """One row per state a row exists in; other classes keep a null state."""
    for v in variants:
        if not v.states or not v.enabled:
            rows = rows.withColumn(v.column, F.lit(None).cast("string"))
            continue
        listed = F.array(*map(F.lit, v.states))
        none = F.array(F.lit(None).cast("string"))
        applies = class_is(*v.classes)
        held = F.filter(listed, lambda state: v.holds(state))  # noqa: B023
        rows = rows.withColumn(v.column, F.explode(F.when(applies, held).otherwise(none)))
    return rows


def state_json(variants: Iterable[Variant]) -> Column:
    """The state as JSON with sorted keys; a row without any state gives ``[]``."""
    names = sorted(v.column for v in variants)
    if not names:
        return F.lit("[]")
    packed = F.to_json(F.struct(*names))
    return F.when(packed == "{}", F.lit("[]")).otherwise(packed)


def document_id(object_id: Column, base: Column, state: Column) -> Column:
    return F.concat_ws("-", object_id.cast("string"), base, state)


def state_filter(column: str, current: str | Sequence[str]) -> Column:
    """Documents of the current state, or that have no such state at all."""
    states = [current] if isinstance(current, str) else list(current)
    return F.col(column).isin(states) | F.col(column).isNull()


def state_excluded(excluded: Iterable[dict[str, str]], draft: bool = True) -> Column:
    """True for states no index may hold.

    An entry matches when all of its pairs do; any matching entry excludes. With
    ``draft`` the draft stage is always excluded.
    """
    verdict = F.lit(False)
    entries = list(excluded) + ([{STAGE: DRAFT}] if draft else [])
    for entry in entries:
        every = F.lit(True)
        for column, value in entry.items():
            every = every & F.col(column).eqNullSafe(F.lit(value))
        verdict = verdict | every
    return verdict


def with_states(required: dict[str, list], current: dict[str, str]) -> dict[str, list]:
    """Value filters of a query with those of the current states added.

    A stage filter is always added; a site filter only when the query has none.
    """
    from trawl.operators.criteria import MISSING

    out = {name: list(values) for name, values in required.items()}
    for column, state in current.items():
        if column == SUBSITE and out.get(column):
            continue
        out[column] = [*out.get(column, []), state, MISSING]
    return out
