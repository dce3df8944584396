"""What an index contains: classes, fields, copies, analyzers, boosts, states."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from trawl.functions.analysis import Step
from trawl.sources.classes import ClassTree, Relation

DEFAULT_FIELD = "_text"

# Declared field type to index type.
FULLTEXT_TYPES = {"HTMLText": "htmltext", "HTMLVarchar": "htmltext"}
FILTER_TYPES = {
    "Boolean": "boolean",
    "Date": "tdate", "Datetime": "tdate", "DBDate": "tdate", "DBDatetime": "tdate",
    "SSDatetime": "tdate", "SS_Datetime": "tdate",
    "ForeignKey": "tint", "Int": "tint", "Float": "tfloat", "Double": "tdouble",
}
TEXT_TYPES = {"Varchar", "Text", "String", "HTMLText", "HTMLVarchar"}


@dataclass(frozen=True)
class Hop:
    owner: str
    relation: Relation


@dataclass(frozen=True)
class FieldSpec:
    """One resolved index field, named ``{origin}_{path}``."""

    name: str
    field: str
    path: str
    base: tuple[str, ...]
    origin: tuple[str, ...]
    cls: str
    hops: tuple[Hop, ...]
    type: str
    multi_valued: bool = False
    stored: bool = False

    def index_type(self, fulltext: bool = False) -> str:
        if fulltext:
            return FULLTEXT_TYPES.get(self.type, "text")
        return FILTER_TYPES.get(self.type, "string")


@dataclass
class IndexSpec:
    tree: ClassTree
    classes: dict[str, bool] = field(default_factory=dict)
    fulltext: dict[str, FieldSpec] = field(default_factory=dict)
    filters: dict[str, FieldSpec] = field(default_factory=dict)
    sorts: dict[str, FieldSpec] = field(default_factory=dict)
    boosts: dict[str, float] = field(default_factory=dict)
    copies: list[tuple[str, str]] = field(default_factory=list)
    copy_fields: tuple[str, ...] = (DEFAULT_FIELD,)
    analyzers: dict[str, Step] = field(default_factory=dict)
    excluded_states: list[dict[str, str]] = field(default_factory=list)

    # Declaring ----------------------------------------------------------

    def add_class(self, name: str, include_children: bool = True) -> IndexSpec:
        if self.fulltext or self.filters or self.sorts:
            raise ValueError("classes must be added before fields")
        self.classes[name] = include_children
        return self

    def add_fulltext_field(self, path: str, force_type: str | None = None,
                           stored: bool = False, boost: float | None = None) -> IndexSpec:
        found = self.resolve(path, force_type, stored)
        self.fulltext.update(found)
        if boost is not None:
            self.boosts.update(dict.fromkeys(found, boost))
        return self

    def add_filter_field(self, path: str, force_type: str | None = None) -> IndexSpec:
        self.filters.update(self.resolve(path, force_type))
        return self

    def add_sort_field(self, path: str, force_type: str | None = None) -> IndexSpec:
        self.sorts.update(self.resolve(path, force_type))
        return self

    def add_stored_field(self, path: str, force_type: str | None = None) -> IndexSpec:
        return self.add_fulltext_field(path, force_type, stored=True)

    def add_boosted_field(self, path: str, force_type: str | None = None,
                          boost: float = 2) -> IndexSpec:
        return self.add_fulltext_field(path, force_type, boost=boost)

    def add_all_fulltext_fields(self, include_subclasses: bool = True) -> IndexSpec:
        """Every text field of every class (and subclass) that has a table."""
        for name in self.classes:
            for cls in self.tree.hierarchy(name, include_subclasses, with_table=True):
                for column, declared in self.tree.field_types(cls).items():
                    if declared in TEXT_TYPES:
                        self.add_fulltext_field(column)
        return self

    def set_field_boosting(self, name: str, level: float | None) -> IndexSpec:
        if name not in self.fulltext:
            raise ValueError(f"no fulltext field {name}")
        if level is None:
            self.boosts.pop(name, None)
        else:
            self.boosts[name] = level
        return self

    def add_copy_field(self, source: str, dest: str) -> IndexSpec:
        self.copies.append((source, dest))
        return self

    def add_analyzer(self, path: str, steps: Step) -> IndexSpec:
        """Use another analysis chain for a field when indexing it."""
        self.analyzers.update(dict.fromkeys(self.resolve(path), steps))
        return self

    def exclude_variant_state(self, state: dict[str, str]) -> IndexSpec:
        self.excluded_states.append(state)
        return self

    # Resolving ----------------------------------------------------------

    def resolve(self, path: str, force_type: str | None = None,
                stored: bool = False) -> dict[str, FieldSpec]:
        """Index fields a dotted path stands for, one per origin class."""
        *steps, leaf = path.split(".")
        found: dict[str, FieldSpec] = {}
        for indexed, children in self.classes.items():
            for hops, cls in self._walk(indexed, children, steps):
                for owner, declared in self._leaf_types(cls, children, leaf):
                    origin = hops[0].owner if hops else owner
                    name = f"{origin}_{path.replace('.', '_')}"
                    found[name] = FieldSpec(
                        name=name, field=leaf, path=path, base=(self.tree.base(indexed),),
                        origin=(origin,), cls=owner, hops=hops,
                        type=force_type or declared, stored=stored,
                        multi_valued=any(h.relation.kind != "has_one" for h in hops),
                    )
        return found

    def _walk(self, start: str, children: bool, steps: list[str]):
        """All ways to follow the relation names from a class."""
        ends: list[tuple[tuple[Hop, ...], str]] = [((), start)]
        for step in steps:
            ends = [
                (hops + (Hop(owner, relation),), relation.target)
                for hops, cls in ends
                for owner in self.tree.hierarchy(cls, children)
                if (relation := self.tree.relation(owner, step)) is not None
            ]
        return ends

    def _leaf_types(self, cls: str, children: bool, leaf: str):
        """Classes a field is read from: the topmost that has it, per branch."""
        skipped: set[str] = set()
        for candidate in self.tree.hierarchy(cls, children):
            if candidate in skipped:
                continue
            declared = self.tree.field_types(candidate).get(leaf)
            if declared is None and leaf in self.tree.computed(candidate):
                declared = "String"
            if declared is not None:
                skipped.update(self.tree.descendants(candidate))
                yield candidate, declared

    # Reading ------------------------------------------------------------

    def fields(self) -> dict[str, FieldSpec]:
        """All fields: fulltext, then filter, then sort; one value per name."""
        merged = dict(self.fulltext)
        for extra in (self.filters, self.sorts):
            for name, spec in extra.items():
                merged.setdefault(name, spec)
        return merged

    def base_classes(self) -> list[str]:
        return list(dict.fromkeys(self.tree.base(c) for c in self.classes))

    def stored_fields(self, default: bool = False) -> list[str]:
        return [n for n, f in self.fulltext.items() if f.stored or default]

    def copy_pairs(self) -> list[tuple[str, str]]:
        """(source, destination) pairs: every fulltext field, then explicit copies."""
        default = [(name, dest) for dest in self.copy_fields for name in self.fulltext]
        return default + self.copies

    def query_fields(self) -> dict[str, float] | None:
        """Boosted fields plus the default field, or None when nothing is boosted."""
        if not self.boosts:
            return None
        return {**self.boosts, **({} if DEFAULT_FIELD in self.boosts else {DEFAULT_FIELD: 1.0})}

    def dependencies(self) -> list[str]:
        """Classes whose changes can touch the index, as a minimal cover."""
        return self.tree.minimal_cover(
            [*self.classes, *(f.cls for f in self.fields().values())]
        )

    def derivations(self) -> list[Derivation]:
        """Related fields grouped by the path that leads to them."""
        groups: dict[tuple, Derivation] = {}
        for spec in self.fields().values():
            if not spec.hops:
                continue
            key = (spec.base, spec.hops)
            used = groups.get(key, Derivation(spec.base[0], spec.hops, (), ()))
            groups[key] = replace(
                used,
                classes=tuple(self.tree.minimal_cover([*used.classes, spec.cls])),
                fields=tuple(dict.fromkeys([*used.fields, f"{spec.cls}:{spec.field}"])),
            )
        return list(groups.values())


@dataclass(frozen=True)
class Derivation:
    """A relation path from a base class, and the fields read at its end."""

    base: str
    hops: tuple[Hop, ...]
    classes: tuple[str, ...]
    fields: tuple[str, ...]


def restrict_classes(classes: dict[str, bool], wanted: str | Iterable[str] | None) -> dict[str, bool]:
    """The index classes, or those also named in a list or comma list."""
    if not wanted:
        return dict(classes)
    names = wanted.split(",") if isinstance(wanted, str) else list(wanted)
    return {c: children for c, children in classes.items() if c in names}
