"""Field resolution, documents, variants, visibility and criteria."""

import datetime

import pytest
from pyspark.sql import functions as F

from trawl.functions import analysis as A
from trawl.functions import values as V
from trawl.operators import criteria as C
from trawl.operators import documents as D
from trawl.operators import gates as G
from trawl.operators import variants as W
from trawl.operators.indexes import index_of
from trawl.operators.spec import IndexSpec, restrict_classes
from trawl.sources.changes import write_sites
from trawl.sources.classes import ClassDef, ClassTree, has_many, has_one, many_many


def classes(spark):
    """Containers with one related object of each kind, and a second container class."""
    box = spark.createDataFrame(
        [(1, "a", "x", 1), (2, "b", "y", 1), (3, "c", "z", 2)],
        "ID long, Field1 string, Field2 string, HasOneID long",
    )
    other = spark.createDataFrame([(1, "e")], "ID long, SomeField string")
    one = spark.createDataFrame([(1, "one"), (2, "two")], "ID long, Field1 string")
    many = spark.createDataFrame(
        [(1, "m1", 1, None), (2, "m2", 1, None), (3, "m3", None, 1)],
        "ID long, Field1 string, BoxID long, OtherID long",
    )
    tag = spark.createDataFrame([(1, "t1"), (2, "t2")], "ID long, Field1 string")
    link = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 2)], "BoxID long, TagID long")
    return ClassTree([
        ClassDef("Box", box, relations=(
            has_one("HasOne", "One", "HasOneID"), has_many("Many", "Many", "BoxID"),
            many_many("Tags", "Tag", link, "BoxID", "TagID"),
        )),
        ClassDef("Other", None, relations=(has_many("Many", "Many", "OtherID"),)),
        ClassDef("Extended", other, "Other"),
        ClassDef("One", one), ClassDef("Many", many), ClassDef("Tag", tag),
    ])


def test_names_and_kinds_of_related_fields(spark):
    spec = IndexSpec(classes(spark)).add_class("Box")
    for path in ("Field1", "HasOne.Field1", "Many.Field1", "Tags.Field1"):
        spec.add_fulltext_field(path)
    found = {n: (f.multi_valued, f.cls, f.origin, f.base) for n, f in spec.fulltext.items()}
    assert found == {
        "Box_Field1": (False, "Box", ("Box",), ("Box",)),
        "Box_HasOne_Field1": (False, "One", ("Box",), ("Box",)),
        "Box_Many_Field1": (True, "Many", ("Box",), ("Box",)),
        "Box_Tags_Field1": (True, "Tag", ("Box",), ("Box",)),
    }


def test_ambiguous_relation_gives_a_field_per_origin(spark):
    spec = IndexSpec(classes(spark)).add_class("Box").add_class("Extended")
    spec.add_fulltext_field("Many.Field1")
    # the relation is declared on Other, Extended only inherits it
    assert sorted(spec.fulltext) == ["Box_Many_Field1", "Other_Many_Field1"]
    rows = D.build_values(spec).collect()
    assert sorted((r.base, r.ID, r.field, r.value) for r in rows) == [
        ("Box", 1, "Box_Many_Field1", "m1"), ("Box", 1, "Box_Many_Field1", "m2"),
        ("Other", 1, "Other_Many_Field1", "m3"),
    ]


def test_values_of_relations(spark):
    spec = IndexSpec(classes(spark)).add_class("Box")
    spec.add_fulltext_field("HasOne.Field1").add_fulltext_field("Tags.Field1")
    docs = {r.ID: r.Box_HasOne_Field1 for r in D.build_documents(spec).collect()}
    assert docs == {1: "one", 2: "one", 3: "two"}
    # a link that is stored twice counts once
    values = sorted((r.ID, r.value) for r in D.build_values(spec).collect())
    assert values == [(1, "t1"), (1, "t2"), (2, "t2")]


def test_classes_are_frozen_by_fields(spark):
    spec = IndexSpec(classes(spark)).add_class("Box").add_fulltext_field("Field1")
    with pytest.raises(ValueError):
        spec.add_class("Other")


def test_boosts_copies_and_dependencies(spark):
    spec = IndexSpec(classes(spark)).add_class("Box")
    assert spec.query_fields() is None
    spec.add_boosted_field("Field1").add_fulltext_field("HasOne.Field1")
    assert spec.query_fields() == {"Box_Field1": 2, "_text": 1.0}
    spec.set_field_boosting("Box_HasOne_Field1", 1.5)
    assert spec.query_fields() == {"Box_Field1": 2, "Box_HasOne_Field1": 1.5, "_text": 1.0}
    spec.set_field_boosting("Box_Field1", None).set_field_boosting("Box_HasOne_Field1", None)
    assert spec.query_fields() is None
    with pytest.raises(ValueError):
        spec.set_field_boosting("Nope", 2)
    spec.add_copy_field("Box_Field1", "spell").add_copy_field("Box_Field1", "more")
    assert spec.copy_pairs() == [
        ("Box_Field1", "_text"), ("Box_HasOne_Field1", "_text"),
        ("Box_Field1", "spell"), ("Box_Field1", "more"),
    ]
    assert spec.dependencies() == ["Box", "One"]


def test_class_tree(spark):
    tree = classes(spark)
    assert tree.hierarchy("Other") == ["Other", "Extended"]
    assert tree.hierarchy("Extended", False) == ["Other", "Extended"]
    assert tree.hierarchy("Other", with_table=True) == ["Extended"]
    assert tree.minimal_cover(["Extended", "Box", "Other"]) == ["Box", "Other"]
    assert restrict_classes({"Box": True, "One": False}, "One,Zzz") == {"One": False}


def test_values_that_cannot_be_converted_are_absent(spark):
    rows = spark.createDataFrame([("2010-01-02 03:04:05",), ("",), ("0",), ("soon",), (None,)], "t string")
    shown = [r.x for r in rows.select(V.display_date(V.convert(F.col("t"), "tdate")).alias("x")).collect()]
    assert shown[0] == "2010-01-02T03:04:05Z"
    assert shown[1] is None and shown[3] is None and shown[4] is None
    numbers = spark.createDataFrame([(["1", "x", "", "3"],)], "t array<string>").select(
        V.convert_all(F.col("t"), "tint").alias("x")
    ).first()
    assert numbers.x == [1, 3]


# Variants -------------------------------------------------------------------

STAGE = W.Variant(W.STAGE, ("Stage", "Live"), ("Box",))
SITE = W.Variant(W.SUBSITE, ("0", "1"), ("Box",))


def test_combinations():
    empty = W.Variant("_none", (), ("Box",))
    assert W.combinations([STAGE, empty, SITE]) == [
        {W.STAGE: s, W.SUBSITE: t} for s in ("Stage", "Live") for t in ("0", "1")
    ]
    assert W.combinations([]) == [{}]


def test_document_ids(spark):
    spec = IndexSpec(classes(spark)).add_class("Box").add_class("Extended").add_fulltext_field("Field1")
    ids = {r._documentid for r in D.build_documents(spec, [STAGE, SITE]).collect()}
    assert '1-Box-{"_subsite":"0","_versionedstage":"Live"}' in ids
    assert "1-Other-[]" in ids
    assert len(ids) == 3 * 4 + 1


def test_excluded_states(spark):
    rows = spark.createDataFrame(
        [("Stage", "0"), ("Live", "0"), ("Live", "1"), (None, None)], f"{W.STAGE} string, {W.SUBSITE} string"
    )
    def kept(*args, **kw):
        return {(r[0], r[1]) for r in rows.where(~W.state_excluded(*args, **kw)).collect()}
    assert kept([]) == {("Live", "0"), ("Live", "1"), (None, None)}
    assert kept([{W.STAGE: "Live", W.SUBSITE: "1"}], draft=False) == {("Stage", "0"), ("Live", "0"), (None, None)}


def test_state_filters_of_queries():
    assert W.with_states({}, {W.STAGE: "Live", W.SUBSITE: "1"}) == {
        W.STAGE: ["Live", C.MISSING], W.SUBSITE: ["1", C.MISSING]
    }
    assert W.with_states({W.SUBSITE: ["2"]}, {W.SUBSITE: "1"}) == {W.SUBSITE: ["2"]}


@pytest.mark.parametrize("fields, sites", [
    ({"Page:SubsiteID": "0"}, ["0"]), ({"Page:SubsiteID": "3"}, ["3"]),
    ({"File:SubsiteID": "0"}, ["0", "1", "2"]), ({"File:SubsiteID": "2"}, ["2"]),
    ({"Title": "x"}, ["0", "1", "2"]),
])
def test_sites_of_writes(spark, fields, sites):
    row = spark.createDataFrame([(fields,)], "f map<string,string>").select(
        write_sites(F.col("f"), "Page:SubsiteID", "File:SubsiteID", ["0", "1", "2"]).alias("s")
    ).first()
    assert row.s == sites


# Visibility -----------------------------------------------------------------

def visible(spark, skip=(), override=None):
    rows = spark.createDataFrame(
        [(1, True, True, ["A"]), (2, False, True, ["A"]), (3, None, True, ["A"]),
         (4, True, False, ["A"]), (5, True, False, ["A", "B"]), (None, True, True, ["A"]),
         (0, True, True, ["A"])],
        "ID long, ShowInSearch boolean, ok boolean, ClassHierarchy array<string>",
    )
    gate = G.indexable(F.col("ShowInSearch"), F.col("ok"), skip, override)
    return [r.ID for r in rows.where(gate).collect()]


def test_gates(spark):
    assert visible(spark) == [1, 3]
    assert visible(spark, ["B"]) == [1, 3, 5]
    assert visible(spark, ["A"]) == [1, 3, 4, 5]
    assert visible(spark, override=lambda v: v | (F.col("ID") == 2)) == [1, 2, 3]


# Criteria -------------------------------------------------------------------

@pytest.fixture(scope="module")
def stock(spark):
    rows = [(1, "Test", 1, [1, 2]), (2, "Test", 2, []), (3, "Other", 3, [3]), (4, None, None, None)]
    return spark.createDataFrame(rows, "ID long, Title string, Stock int, Cat array<int>")


def ids(frame):
    return sorted(r.ID for r in frame.collect())


@pytest.mark.parametrize("comparison, value, target, expected", [
    (C.EQUAL, "Test", "Title", [1, 2]), (C.NOT_EQUAL, "Test", "Title", [3, 4]),
    (C.IN, [1, 2], "Stock", [1, 2]), (C.NOT_IN, [1, 2], "Stock", [3, 4]),
    (C.GREATER_EQUAL, 2, "Stock", [2, 3]), (C.GREATER_THAN, 2, "Stock", [3]),
    (C.LESS_EQUAL, 2, "Stock", [1, 2]), (C.LESS_THAN, 2, "Stock", [1]),
    (C.ISNULL, None, "Stock", [4]), (C.ISNOTNULL, None, "Stock", [1, 2, 3]),
])
def test_comparisons(stock, comparison, value, target, expected):
    assert ids(stock.where(C.Criterion(target, value, comparison).column())) == expected


def test_groups_fold_left_to_right(stock):
    flat = C.Criteria.of("ID", 1).or_("ID", 3).and_("Title", "Other")
    assert ids(stock.where(flat.column())) == [3]
    nested = C.Criteria.of("ID", 1).or_(C.Criteria.of("ID", 3).and_("Title", "Other"))
    assert ids(stock.where(nested.column())) == [1, 3]


def test_custom_writer(stock):
    wins = C.Criterion("ID", 2, C.EQUAL, lambda c: F.col(c.target) > c.value)
    assert ids(stock.where(wins.column())) == [3, 4]
    for bad in (C.Criterion("ID", 1, C.CUSTOM), C.Criterion("ID", 1, C.IN), C.Criterion("ID", 1, "LIKE")):
        with pytest.raises(ValueError):
            bad.column()


def test_value_filters(stock):
    assert ids(stock.where(C.require({"Title": ["Test", C.MISSING], "Stock": [C.Range(2, None), C.MISSING]}))) == [2, 4]
    assert ids(stock.where(C.require({"Cat": [2, 3]}, multi=["Cat"]))) == [1, 3]
    assert ids(stock.where(C.require({"Cat": [C.MISSING]}, multi=["Cat"]))) == [2, 4]
    assert ids(stock.where(C.require({"Cat": [C.Range(3, 9)]}, multi=["Cat"]))) == [3]
    assert ids(stock.where(C.exclude({"Stock": [C.Range(2, None)]}))) == [1, 4]
    assert ids(stock.where(C.exclude({"Stock": [C.MISSING]}))) == [1, 2, 3]
    assert ids(stock.where(C.exclude({"Stock": [C.PRESENT]}))) == [4]
    assert ids(stock.where(C.exclude({"Stock": [C.MISSING, 1]}))) == [2, 3]


def test_range_on_dates(spark):
    rows = spark.createDataFrame([(1, datetime.datetime(2011, 1, 1)), (2, datetime.datetime(2012, 1, 1)), (3, None)], "ID long, d timestamp")
    until = C.Range(None, datetime.datetime(2011, 12, 31))
    since = C.Range(datetime.datetime(2011, 12, 31), None)
    assert ids(rows.where(C.require({"d": [until]}))) == [1]
    assert ids(rows.where(C.exclude({"d": [since]}))) == [1, 3]


def test_index_of_a_specification(spark):
    """Several values, copies, an analyzer of its own, and objects without any text."""
    shelves = spark.createDataFrame([(1, "Top Shelf", "<b>Oak</b>"), (2, None, None)], "ID long, name string, info string")
    books = spark.createDataFrame(
        [(1, 1, "Red book"), (2, 1, "red sea"), (3, 2, None)], "ID long, ShelfID long, title string")
    tree = ClassTree([
        ClassDef("Shelf", shelves, types={"info": "HTMLText"}, relations=(has_many("Books", "Book", "ShelfID"),)),
        ClassDef("Book", books)])
    spec = IndexSpec(tree).add_class("Shelf").add_fulltext_field("name").add_fulltext_field("info")
    spec.add_fulltext_field("Books.title").add_analyzer("name", A.chain(A.keyword))
    spec.add_copy_field("Shelf_Books_title", "titles")
    index = index_of(spec)
    rows = sorted((r.field, r.term, r.doc_id, r.val_no) for r in index.postings.collect() if r.field != "_text")
    one = "1-Shelf-[]"
    assert rows == [
        ("Shelf_Books_title", "book", one, 1), ("Shelf_Books_title", "red", one, 1),
        ("Shelf_Books_title", "red", one, 2), ("Shelf_Books_title", "sea", one, 2),
        ("Shelf_info", "oak", one, 0), ("Shelf_name", "Top Shelf", one, 0),
        ("titles", "book", one, 1), ("titles", "red", one, 1), ("titles", "red", one, 2), ("titles", "sea", one, 2)]
    everything = {(r.term, r.source) for r in index.postings.where("field = '_text'").collect()}
    assert {("oak", "Shelf_info"), ("shelf", "Shelf_name"), ("sea", "Shelf_Books_title")} <= everything
    assert {r.doc_id for r in index.documents.collect()} == {one, "2-Shelf-[]"}


def test_failed_values_are_written_beside_documents(spark, tmp_path):
    """One pass gives documents, failures and counts; absent values and those of other classes don't fail."""
    rows = spark.createDataFrame(
        [(1, "7", "2024-01-01"), (2, "x", "nonsense"), (3, None, None), (4, "", "20240102")], "ID long, Size string, Made string")
    spec = IndexSpec(ClassTree([ClassDef("Item", rows)])).add_class("Item")
    spec.add_filter_field("Size", "Int").add_filter_field("Made", "Date")
    checked = D.write_checked(D.build_documents(spec, errors=True), str(tmp_path / "docs"))
    failed = sorted((r["_documentid"], r["field"], r["raw"], r["reason"]) for r in checked.errors.collect())
    assert failed == [("2-Item-[]", "Item_Made", "nonsense", "not a tdate"), ("2-Item-[]", "Item_Size", "x", "not a tint"),
                      ("4-Item-[]", "Item_Size", "", "not a tint")]
    assert (checked.n_documents, checked.n_errors) == (4, 3)
    plain = D.build_documents(spec)
    assert checked.documents.columns == plain.columns
    assert sorted(map(str, checked.documents.collect())) == sorted(map(str, plain.collect()))
    none = D.write_checked(D.build_documents(spec, gate=F.lit(False), errors=True), str(tmp_path / "none"))
    assert (none.n_documents, none.n_errors, none.errors.count()) == (0, 0, 0)
