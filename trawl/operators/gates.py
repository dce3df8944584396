"""Visibility: what may be indexed, and what a principal may see."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trawl.sources.classes import class_is

Override = Callable[[Column], Column]


def _valid() -> Column:
    return F.coalesce(F.col("ID") != 0, F.lit(False))


def _shown(show_in_search: Column | None) -> Column:
    if show_in_search is None:
        return F.lit(True)
    return F.coalesce(show_in_search.cast("boolean"), F.lit(True))


def indexable(show_in_search: Column | None, can_view: Column,
              skip_classes: Sequence[str] = (), override: Override | None = None) -> Column:
    """May the row be indexed: a saved object, shown in search, visible to anyone.

    Classes listed in ``skip_classes`` (and below) are not asked ``can_view``.
    ``override`` gets the verdict last and may change it.
    """
    allowed = F.coalesce(can_view, F.lit(False))
    if skip_classes:
        allowed = class_is(*skip_classes) | allowed
    verdict = _shown(show_in_search) & allowed
    return _valid() & (override(verdict) if override else verdict)


def viewable(rows: DataFrame, show_in_search: Column | None, principal: str,
             acl: DataFrame, override: Override | None = None) -> DataFrame:
    """Rows the principal may see; ``acl`` lists the (ID, principal) pairs allowed."""
    allowed = acl.where(F.col("principal") == principal).select("ID").distinct()
    verdict = _shown(show_in_search)
    kept = rows.where(_valid() & (override(verdict) if override else verdict))
    return kept.join(allowed, "ID", "left_semi")
