"""Source classes: rows of a class tree, with inheritance and relations.

A class is a named DataFrame with a unique ``ID``; subclasses are unioned into
their parent's rows and tagged with ``ClassName`` and ``ClassHierarchy``. The
class tree itself is configuration (a handful of names), so it lives in Python
and enters plans as literals; the rows never do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Relation:
    """A named link to ``target``.

    ``has_one``: ``key`` is the foreign key on the owner. ``has_many``: ``key`` is
    the foreign key on the target. ``many_many``: ``link`` is the link table with
    ``key`` (owner side) and ``far_key`` (target side).
    """

    name: str
    kind: str
    target: str
    key: str
    link: DataFrame | None = None
    far_key: str | None = None


def has_one(name: str, target: str, key: str) -> Relation:
    return Relation(name, "has_one", target, key)


def has_many(name: str, target: str, key: str) -> Relation:
    return Relation(name, "has_many", target, key)


def many_many(name: str, target: str, link: DataFrame, key: str, far_key: str) -> Relation:
    return Relation(name, "many_many", target, key, link, far_key)


@dataclass(frozen=True)
class ClassDef:
    """``frame`` holds the rows whose concrete class this is (None: no table).

    ``computed`` maps a field name to a Column over the class' rows. ``types``
    overrides declared field types (for instance ``HTMLText``).
    """

    name: str
    frame: DataFrame | None = None
    parent: str | None = None
    relations: tuple[Relation, ...] = ()
    computed: dict[str, Callable[[], Column]] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)


# Spark type to the declared field type it stands for.
DECLARED = {
    "string": "Varchar", "boolean": "Boolean", "tinyint": "Int", "smallint": "Int",
    "int": "Int", "bigint": "Int", "float": "Float", "double": "Double",
    "date": "Date", "timestamp": "Datetime", "timestamp_ntz": "Datetime",
}


class ClassTree:
    def __init__(self, classes: Iterable[ClassDef]):
        self.classes = {c.name: c for c in classes}

    def ancestry(self, name: str) -> list[str]:
        """The class and everything above it, root first."""
        chain = []
        cursor: str | None = name
        while cursor is not None:
            chain.append(cursor)
            cursor = self.classes[cursor].parent
        return chain[::-1]

    def descendants(self, name: str) -> list[str]:
        """The class and everything below it, parents before children."""
        return [c for c in sorted(self.classes, key=lambda c: len(self.ancestry(c)))
                if name in self.ancestry(c)]

    def hierarchy(self, name: str, children: bool = True, with_table: bool = False) -> list[str]:
        names = self.ancestry(name)
        if children:
            names = names + [c for c in self.descendants(name) if c not in names]
        return [c for c in names if not with_table or self.classes[c].frame is not None]

    def base(self, name: str) -> str:
        return self.ancestry(name)[0]

    def is_a(self, name: str, others: Iterable[str]) -> bool:
        return bool(set(self.ancestry(name)) & set(others))

    def minimal_cover(self, names: Iterable[str]) -> list[str]:
        """Drop every class one of whose ancestors is listed too."""
        listed = list(dict.fromkeys(names))
        return [n for n in listed if not set(self.ancestry(n)[:-1]) & set(listed)]

    # Fields -------------------------------------------------------------

    def own_types(self, name: str) -> dict[str, str]:
        cls = self.classes[name]
        found = {}
        if cls.frame is not None:
            for column in cls.frame.schema.fields:
                spark_type = column.dataType.simpleString()
                found[column.name] = DECLARED.get(spark_type, "Varchar")
        return {**found, **cls.types}

    def field_types(self, name: str) -> dict[str, str]:
        """Declared types of a class, inherited ones included."""
        return {f: t for c in self.ancestry(name) for f, t in self.own_types(c).items()}

    def computed(self, name: str) -> dict[str, Callable[[], Column]]:
        return {f: e for c in self.ancestry(name) for f, e in self.classes[c].computed.items()}

    def relation(self, name: str, relation: str) -> Relation | None:
        """A relation the class itself declares; inherited ones are not repeated."""
        return next((r for r in self.classes[name].relations if r.name == relation), None)

    # Rows ---------------------------------------------------------------

    def rows(self, name: str, children: bool = True) -> DataFrame:
        """Rows of a class, tagged with ``ClassName`` and ``ClassHierarchy``."""
        wanted = self.descendants(name) if children else [name]
        frames = []
        for cls in wanted:
            frame = self.classes[cls].frame
            if frame is None:
                continue
            for column, expr in self.computed(cls).items():
                frame = frame.withColumn(column, expr())
            frames.append(frame.withColumns({
                "ClassName": F.lit(cls),
                "ClassHierarchy": F.array(*map(F.lit, self.ancestry(cls))),
            }))
        if not frames:
            raise ValueError(f"no class under {name} has a table")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        """The tree as a small table, for joins against class names in data."""
        rows = [(c, self.ancestry(c), self.base(c), len(self.ancestry(c))) for c in self.classes]
        return spark.createDataFrame(
            rows, "class string, ancestors array<string>, base string, depth int"
        )


def class_is(*origins: str) -> Column:
    """True for rows whose class is one of the origins or below one."""
    return F.arrays_overlap(F.col("ClassHierarchy"), F.array(*map(F.lit, origins)))
