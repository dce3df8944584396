"""Writes merged in the state of a stream, one entry an object and state, until none has come for a while.

The state has a value with what is known of the object and a map with the last value of each field, so a
write touches the fields it names only. A timer, set anew by every write, emits the merged write and
clears the state. Merging follows ``maintenance.coalesce_writes``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trawl.operators.maintenance import based
from trawl.sources.classes import ClassTree

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KNOWN = T.StructType([
    T.StructField("class", T.StringType()), T.StructField("depth", T.IntegerType()), T.StructField("command", T.StringType()),
    T.StructField("first_seq", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("deleted", T.BooleanType())])
FIELD = T.StructType([T.StructField("field", T.StringType())])
VALUE = T.StructType([T.StructField("value", T.StringType()), T.StructField("seq", T.LongType())])


class Merge(StatefulProcessor):
    def __init__(self, quiet_ms: int, columns: Sequence[str]):
        self.quiet_ms, self.columns = quiet_ms, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", KNOWN)
        self.fields = handle.getMapState("fields", FIELD, VALUE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0] is None:
            return iter(())
        known = tuple(self.known.get()) if self.known.exists() else None
        latest, changed = 0, {}
        for row in rows:
            latest = max(latest, row["__ms"])
            own = (row["class"], row["depth"], row["command"], row["seq"], row["seq"], row["command"] == "delete")
            known = own if known is None else _merged(known, own)
            for entry in row["fields"] or ():
                field, value = entry["field"], entry["value"]
                if field not in changed or changed[field][1] <= row["seq"]:
                    changed[field] = (value, row["seq"])
        for field, (value, seq) in changed.items():
            if not self.fields.containsKey((field,)) or self.fields.getValue((field,))[1] <= seq:
                self.fields.updateValue((field,), (value, seq))
        self.known.update(known)
        for timer in list(self.handle.listTimers()):
            latest = max(latest, timer - self.quiet_ms)
            self.handle.deleteTimer(timer)
        # a write behind the watermark waits for the next one to move it
        self.handle.registerTimer(max(latest + self.quiet_ms, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        cls, _, command, _, seq, deleted = self.known.get()
        fields = [(k[0], v[0]) for k, v in self.fields.iterator()]
        self.known.clear()
        self.fields.clear()
        yield Row(*self.columns)(*key, cls, command, seq, deleted, [k for k, _ in fields], [v for _, v in fields])

    def close(self) -> None:
        pass


def _merged(a: tuple, b: tuple) -> tuple:
    """Of the most specific class, the first command and the last number."""
    cls, depth = max((a[0], a[1]), (b[0], b[1]), key=lambda x: (-1 if x[1] is None else x[1], x[0] or ""))
    return cls, depth, (a if a[3] <= b[3] else b)[2], min(a[3], b[3]), max(a[4], b[4]), a[5] or b[5]


def held_writes(stream: DataFrame, tree: ClassTree, state: Sequence[str], quiet: str, late: str, time: str) -> DataFrame:
    """The rows of ``coalesce_writes``, each when its object and state has been quiet. A row without an id only moves the time."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    quiet_ms = int(spark.sql(f"SELECT CAST(INTERVAL {quiet} AS INTERVAL DAY TO SECOND) AS i").first()["i"].total_seconds() * 1000)
    named = F.transform(F.map_entries("fields"), lambda e: F.struct(
        F.concat("class", F.lit(":"), e["key"]).alias("field"), e["value"].alias("value")))
    key = ["id", "base", *state]
    rows = based(stream, tree).withColumn("fields", named).withWatermark(time, late).select(
        time, F.unix_millis(time).alias("__ms"), "seq", *key, "class", "depth", "command", "fields")
    types = {f.name: f.dataType for f in rows.schema.fields}
    out = T.StructType([*(T.StructField(k, types[k]) for k in key), T.StructField("class", T.StringType()),
                        T.StructField("command", T.StringType()), T.StructField("seq", T.LongType()),
                        T.StructField("deleted", T.BooleanType()), T.StructField("names", T.ArrayType(T.StringType())),
                        T.StructField("values", T.ArrayType(T.StringType()))])
    # not filtered before: Spark would do so below the watermark
    merged = rows.groupBy(*key).transformWithState(
        statefulProcessor=Merge(quiet_ms, out.names), outputStructType=out, outputMode="Update", timeMode="EventTime")
    entries = F.array_sort(F.arrays_zip("names", "values"))
    return merged.withColumn("fields", F.map_from_entries(entries)).drop("names", "values")
