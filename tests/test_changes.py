"""Stale documents, updates, streaming and reindexing."""

import math

import pytest
from pyspark.sql import functions as F

from trawl.operators import documents as D
from trawl.operators import maintenance as M
from trawl.operators import reindex as X
from trawl.operators import store
from trawl.operators.spec import IndexSpec
from trawl.operators.variants import STAGE, Variant
from trawl.sources.changes import SCHEMA, stream_changes, with_states
from trawl.sources.classes import ClassDef, ClassTree
from trawl.streaming import log as L
from trawl.streaming import maintain as T
from test_documents import classes

NO_FIELDS: dict = {}


def feed(spark, rows):
    return spark.createDataFrame(
        [(seq, cls, cls, oid, command, fields) for seq, cls, oid, command, fields in rows], SCHEMA
    )


def changed(spark, spec, rows, variants=()):
    names = [v.column for v in variants]
    writes = M.trim_writes(M.coalesce_writes(feed(spark, rows), spec.tree))
    for n in names:
        writes = writes.withColumn(n, F.lit("Stage"))
    return sorted(tuple(r) for r in M.dirty(writes, spec, variants).collect())


def test_has_one_change_reaches_its_owners(spark):
    spec = IndexSpec(classes(spark)).add_class("Box")
    spec.add_fulltext_field("Field1").add_fulltext_field("HasOne.Field1")
    assert changed(spark, spec, [(1, "One", 1, "update", {"Field1": "n"})]) == [("Box", 1), ("Box", 2)]
    # an unrelated field touches nothing
    assert changed(spark, spec, [(1, "One", 1, "update", {"Field2": "n"})]) == []
    assert changed(spark, spec, [(1, "One", 2, "update", {"Field1": "n"})]) == [("Box", 3)]
    # an object of the index itself
    assert changed(spark, spec, [(1, "Box", 9, "insert", {"Field2": "n"})]) == [("Box", 9)]


def test_many_changes_reach_their_owners(spark):
    spec = IndexSpec(classes(spark)).add_class("Box")
    spec.add_fulltext_field("Many.Field1").add_fulltext_field("Tags.Field1")
    rows = [(1, "Many", 1, "update", {"Field1": "n"}), (2, "Many", 2, "update", {"Field1": "n"})]
    assert changed(spark, spec, rows) == [("Box", 1)]
    assert changed(spark, spec, [(1, "Tag", 2, "update", {"Field1": "n"})]) == [("Box", 1), ("Box", 2)]


def test_derived_changes_fan_out_over_states(spark):
    spec = IndexSpec(classes(spark)).add_class("Box").add_fulltext_field("HasOne.Field1")
    variant = Variant(STAGE, ("Stage", "Live"), ("One",))
    assert changed(spark, spec, [(1, "One", 2, "update", {"Field1": "n"})], [variant]) == [
        ("Box", 3, "Live"), ("Box", 3, "Stage")
    ]


def test_coalescing(spark):
    rows = [
        (1, "Other", 1, "insert", {"A": "1"}), (2, "Extended", 1, "update", {"A": "2"}),
        (3, "Extended", 1, "update", {"A": "3", "B": "4"}), (4, "Other", 2, "update", NO_FIELDS),
        (5, "Other", 3, "update", NO_FIELDS), (6, "Other", 3, "delete", NO_FIELDS),
    ]
    merged = M.coalesce_writes(feed(spark, rows), classes(spark))
    by_id = {r.id: r for r in merged.collect()}
    assert by_id[1]["class"] == "Extended" and by_id[1].command == "insert" and by_id[1].seq == 3
    assert by_id[1].fields == {"Other:A": "1", "Extended:A": "3", "Extended:B": "4"}
    # nothing changed on 2; the delete of 3 is not lost to the write before it
    assert sorted(r.id for r in M.trim_writes(merged).collect()) == [1, 3]


def test_delete_rows_cover_the_ancestry(spark):
    gone = spark.createDataFrame([(1, "Extended", 5)], "seq long, class string, id long")
    rows = M.delete_rows(gone, classes(spark)).collect()
    assert [(r.table, r.id, r.command) for r in rows] == [("Extended", 5, "delete")]


def test_updates(spark):
    spec = IndexSpec(classes(spark)).add_class("Box").add_fulltext_field("Field1")
    variant = Variant(STAGE, ("Stage", "Live"), ("Box",), lambda s: (s == "Stage") | (F.col("ID") < 3))
    docs = D.build_documents(spec, [variant]).withColumn("indexable", F.col("ID") != 2)
    stale = spark.createDataFrame(
        [("Box", i, s) for i in (1, 2, 3, 9) for s in ("Stage", "Live")], f"base string, id long, {STAGE} string"
    )
    ops = {(r.id, r[STAGE]): r.op for r in M.operations(stale, docs, spec, [variant]).collect()}
    # drafts cause nothing; 2 may not be indexed; 3 is not live; 9 is gone
    assert ops == {(1, "Live"): "upsert", (2, "Live"): "delete", (3, "Live"): "delete", (9, "Live"): "delete"}
    spec.exclude_variant_state({STAGE: "Live"})
    every = M.operations(stale, docs, spec, [variant], draft_excluded=False).collect()
    assert {(r.id, r.op) for r in every} == {(1, "upsert"), (2, "delete"), (3, "upsert"), (9, "delete")}


def test_latest_wins_and_deletes_hide(spark):
    log = spark.createDataFrame(
        [("a", 1, "upsert", "x"), ("a", 3, "upsert", "z"), ("a", 2, "delete", None),
         ("b", 1, "upsert", "y"), ("b", 5, "delete", None)],
        "_documentid string, seq long, op string, v string",
    )
    assert [(r._documentid, r.v) for r in store.latest(log).collect()] == [("a", "z")]


def test_stream_equals_batch_and_rebuild(spark, tmp_path):
    spec = IndexSpec(classes(spark)).add_class("Box")
    spec.add_fulltext_field("Field1").add_fulltext_field("HasOne.Field1")
    rows = [
        (1, "Box", 1, "insert", {"Field1": "a"}), (2, "Box", 2, "insert", {"Field1": "b"}),
        (3, "Box", 7, "insert", {"Field1": "q"}), (4, "Box", 7, "delete", NO_FIELDS),
        (5, "One", 2, "update", {"Field1": "two"}),
    ]
    for i, row in enumerate(rows):
        feed(spark, [row]).coalesce(1).write.mode("append").parquet(str(tmp_path / "changes"))

    def documents(session):
        return D.build_documents(spec).withColumn("indexable", F.lit(True))

    query = T.maintain(
        stream_changes(spark, str(tmp_path / "changes"), files_per_batch=2), spec, [], documents,
        str(tmp_path / "log"), str(tmp_path / "checkpoint"),
    )
    query.awaitTermination()
    streamed = T.current_view(spark, str(tmp_path / "log"))
    batch = store.latest(T.batch_log(feed(spark, rows), spec, [], documents(spark)))
    fields = ["_documentid", "Box_Field1", "Box_HasOne_Field1"]
    as_rows = lambda f: sorted(tuple(r) for r in f.select(*fields).collect())
    assert as_rows(streamed) == as_rows(batch) == as_rows(D.build_documents(spec))


def test_writes_are_held_until_quiet(spark, tmp_path):
    """One write an object and state over several micro-batches and a restart, as the batch gives."""
    spec = IndexSpec(classes(spark)).add_class("Box").add_fulltext_field("Field1")
    stage = Variant("_versionedstage", ("Stage", "Live"), ("Box",))
    none = {k: "" for k in ()}
    rows = [
        (1, "Box", "Box", 1, "insert", {"Field1": "a"}, "2024-01-01 00:00:00"),
        (4, "Box", "Box", 1, "update", {"Field2": "late number"}, "2024-01-01 00:01:00"),
        (3, "Box_Live", "Box", 1, "update", {"Field1": "c"}, "2024-01-01 00:01:00"),
        (2, "Box", "Box", 1, "delete", none, "2024-01-01 00:02:00"),
        (5, "Box", "Box", 2, "insert", {"Field1": "b"}, "2024-01-01 00:05:00"),
        (6, "Box", "Box", 2, "update", {"Field1": "d"}, "2024-01-01 00:12:00"),
    ]
    schema = SCHEMA + ", at string"
    made = [(s, t, c, i, cmd, f, at) for s, t, c, i, cmd, f, at in rows]
    tick = [(None, None, None, None, None, None, "2024-01-02 00:00:00")]
    merged = []

    def documents(session):
        return D.build_documents(spec, [stage]).withColumn("indexable", F.lit(True))

    log = T.writes_log

    def kept(writes, *args):
        merged.extend(writes.collect())
        return log(writes, *args)

    def go_on(rows):
        for row in rows:
            spark.createDataFrame([row], schema).withColumn("at", F.col("at").cast("timestamp")).coalesce(1) \
                .write.mode("append").parquet(str(tmp_path / "changes"))
        stream = stream_changes(spark, str(tmp_path / "changes"), SCHEMA + ", at timestamp", files_per_batch=1)
        T.maintain_quiet(with_states(stream, "_versionedstage", ["Box"]), spec, [stage], documents, str(tmp_path / "log"),
                         str(tmp_path / "checkpoint"), quiet="10 minutes", draft_excluded=False).awaitTermination()

    T.writes_log = kept
    try:
        go_on(made[:3])
        assert merged == []
        go_on(made[3:])
        go_on(tick)
    finally:
        T.writes_log = log
    got = sorted((r["id"], r["_versionedstage"], r["class"], r["command"], r["seq"], r["deleted"], tuple(sorted(r["fields"].items()))) for r in merged)
    batch = spark.createDataFrame(made, schema)
    whole = M.coalesce_writes(with_states(batch, "_versionedstage", ["Box"]), spec.tree, ["_versionedstage"]).collect()
    expected = [(r["id"], r["_versionedstage"], r["class"], r["command"], r["seq"], r["deleted"], tuple(sorted(r["fields"].items()))) for r in whole]
    assert got == sorted(expected) and len(got) == 3


def test_states_of_writes(spark):
    rows = [(1, "Box_Live", "Box", 1, "update", {"SubsiteID": "2"}), (2, "Box", "Box", 1, "update", {"FileSubsiteID": "0"}),
            (3, "Box", "Box", 1, "update", {"FileSubsiteID": "1"}), (4, "Other_Live", "Other", 1, "update", {})]
    out = with_states(spark.createDataFrame(rows, SCHEMA), "stage", ["Box"], "site", ["Box"], all_sites=["0", "1"])
    assert sorted((r["seq"], r["stage"], r["site"]) for r in out.collect()) == [
        (1, "Live", "2"), (2, "Stage", "0"), (2, "Stage", "1"), (3, "Stage", "1"), (4, None, None)]
    assert with_states(spark.createDataFrame(rows, SCHEMA)).columns == spark.createDataFrame(rows, SCHEMA).columns


def test_log_compaction(spark, tmp_path):
    path = str(tmp_path / "log")

    def batch(n, *rows):
        spark.createDataFrame(rows, "_documentid string, op string, seq long, x int").write.mode("overwrite").parquet(f"{path}/batch={n}")

    def both():
        whole = store.latest(L.log_of(spark, path), seq="__order").drop("__order", "batch")
        pick = lambda f: sorted(tuple(r[c] for c in ("_documentid", "op", "seq", "x")) for r in f.collect())
        assert pick(L.current_view(spark, path)) == pick(whole)
        return {r[0]: r[3] for r in pick(whole)}

    batch(0, ("a", "upsert", 5, 1), ("b", "upsert", 6, 1))
    assert L.compact(spark, path) is None and both() == {"a": 1, "b": 1}
    # a later batch counts though its numbers are lower
    batch(1, ("a", "delete", 2, None), ("c", "upsert", 3, 2))
    assert L.compact(spark, path) == 0 and both() == {"b": 1, "c": 2}
    batch(2, ("a", "upsert", 1, 9), ("b", "delete", 1, None))
    assert both() == {"a": 9, "c": 2}
    # cut off before its pointer
    batch(3, ("d", "upsert", 1, 4))
    L._write_snapshot(spark.range(3), f"{path}/{L.SNAPSHOTS}/upto=2-cut")
    assert both() == {"a": 9, "c": 2, "d": 4}
    assert L.compact(spark, path) == 2 and L.compact(spark, path) is None and both() == {"a": 9, "c": 2, "d": 4}
    # the newest batch may be written again
    batch(3, ("d", "delete", 2, None), ("a", "upsert", 2, 10))
    assert both() == {"a": 10, "c": 2}
    later = L.current_view(spark, path)
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert any("batch" in p.split("]")[0] for p in plan.split("PartitionFilters")[1:])


# Reindexing -----------------------------------------------------------------

VARIANT = Variant("_testvariant", ("0", "1", "2"), ("Item",), lambda s: s == F.col("Variant").cast("string"))


@pytest.fixture(scope="module")
def items(spark):
    rows = spark.range(240).select(
        (F.col("id") + 1).alias("ID"), F.concat(F.lit("Item "), F.col("id")).alias("Title"),
        F.when(F.col("id") < 120, 0).otherwise(1).alias("Variant"),
    )
    spec = IndexSpec(ClassTree([ClassDef("Item", rows)])).add_class("Item").add_fulltext_field("Title")
    return spec, D.build_documents(spec, [VARIANT])


@pytest.mark.parametrize("batch, groups", [(21, 12), (120, 2), (119, 4), (121, 2), (2, 120)])
def test_group_counts(items, batch, groups):
    counts = X.group_counts(items[1], ["_testvariant"], batch).collect()
    assert sum(r.groups for r in counts) == groups
    assert {r.total for r in counts} == {120}


def test_one_group(items):
    rows = X.members(items[1].where("_testvariant = '1'"), 6, 2).collect()
    assert len(rows) == 20 and all(r.ID % 6 == 2 for r in rows)


def test_all_groups_are_the_full_rebuild(items):
    docs = items[1]
    stale = docs.withColumn("Item_Title", F.lit("old"))
    state = {"_testvariant": "1"}
    rebuilt = stale
    for group in range(6):
        rebuilt = X.run_group(rebuilt, docs, "Item", state, 6, group)
    titles = {(r.ID, r._testvariant, r.Item_Title) for r in rebuilt.collect()}
    assert len(titles) == 240
    assert all((t == "old") == (v == "0") for _, v, t in titles)
    whole = X.full(stale, docs, {"Item": True}, [{"_testvariant": s} for s in ("0", "1", "2")])
    assert sorted(r.Item_Title for r in whole.collect()) == sorted(r.Item_Title for r in docs.collect())


def test_empty_states_are_cleared(spark, items):
    docs = items[1]
    leftover = docs.where("_testvariant = '0'").withColumn("_testvariant", F.lit("2"))
    index = docs.unionByName(leftover)
    counts = X.group_counts(docs, ["_testvariant"])
    kept = X.clear_empty_states(index, counts, [{"_testvariant": s} for s in ("0", "1", "2")], "Item")
    assert kept.count() == 240 and math.isclose(kept.where("_testvariant = '2'").count(), 0)


def test_hot_parent_keeps_all_values(spark):
    """A third of all children under one parent: values stay one row each."""
    child = spark.range(3000).select(
        F.col("id").alias("ID"), F.concat(F.lit("v"), F.col("id")).alias("Name"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("ParentID"),
    )
    from trawl.sources.classes import has_many
    parent = spark.range(3000).select(F.col("id").alias("ID"))
    tree = ClassTree([
        ClassDef("Parent", parent, relations=(has_many("Children", "Child", "ParentID"),)),
        ClassDef("Child", child),
    ])
    values = D.build_values(IndexSpec(tree).add_class("Parent").add_fulltext_field("Children.Name"))
    counts = {r.ID: r["count"] for r in values.groupBy("ID").count().collect()}
    assert counts[1] == 1001 and sum(counts.values()) == 3000
