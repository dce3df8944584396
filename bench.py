"""Time the headline jobs and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.operators import matching as M
from trawl.operators import postings as P
from trawl.operators import ranking as R
from trawl.operators import store
from trawl.operators.search import search
from trawl.plans import catalog
from trawl.plans.sample import document_index, read

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Registered queries timed over the raw tables, one per kind of work.
REGISTERED = (
    "analyze_text", "analyze_html", "index_postings", "doc_build", "field_many_many",
    "field_has_many", "facet_multi", "crit_nested", "write_coalesce", "dirty_has_one",
    "index_upsert", "reindex_full",
)
Q = M.SearchQuery


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def word_pairs(spark: SparkSession, n: int) -> DataFrame:
    """``n`` two-word queries out of the benchmark texts."""
    words = F.split("text", r"\s+")
    rows = read(spark, SF, "benchmark").select("item_id", words.alias("w")).select(
        "item_id", F.posexplode(F.slice("w", F.lit(1), F.size("w") - 1)).alias("i", "first"), "w"
    )
    pairs = rows.select(
        F.concat_ws("-", "item_id", "i").alias("query_id"), F.lit(0).alias("call"),
        F.concat_ws(" ", "first", F.expr("w[i + 1]")).alias("text"),
        F.lit(False).alias("fuzzy"), F.array().cast("array<string>").alias("fields"),
        F.create_map().cast("map<string,double>").alias("boosts"),
    )
    return pairs.orderBy(F.xxhash64("query_id")).limit(n)


def main() -> None:
    spark = session()
    times: dict[str, float] = {}

    def timed(name: str, job, repeat: int = 1):
        best = None
        for _ in range(repeat):
            started = time.time()
            result = job()
            took = time.time() - started
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
        return result

    drain(catalog.QUERIES["analyze_text"](spark, SF.replace("sf0.1", "sf0.001")))
    root = tempfile.mkdtemp(prefix="bench-")
    index = timed("build_and_publish", lambda: store.publish(document_index(spark, SF), root, 1))

    # one document in a hundred is rewritten, half as many go
    docs = read(spark, SF, "documents").select("doc_id", "text")
    rewritten = docs.where("doc_id % 100 = 7").select("doc_id", F.concat(F.lit("thon "), "text").alias("text"))
    timed("publish_changes_1_percent", lambda: store.publish_changes(
        index, rewritten.drop("text"), [P.TextSource("_text", rewritten)], docs.where("doc_id % 200 = 8"), root, 2))

    def batch(n: int):
        wanted = M.wanted_terms(word_pairs(spark, n))
        # plain words: none of the kinds that are looked up
        return lambda: drain(R.page(M.match(index, wanted.where("kind = 'term'"), ("term",))))

    timed("batch_1000_queries", batch(1000), 2)
    one = [Q("q").add_search_term("anea thon").add_filter("lang", "en")]
    timed("search_two_terms", lambda: drain(search(index, one).hits), 2)
    phrase = [Q("q").add_search_term('"anea eriner thanea"')]
    timed("search_phrase", lambda: drain(search(index, phrase).hits), 2)
    fuzzy = [Q("q").add_fuzzy_search_term("thanedbel erinr")]
    timed("search_fuzzy", lambda: drain(search(index, fuzzy).hits), 2)
    wild = [Q("q").add_search_term("thane* *nedble")]
    timed("search_wildcard", lambda: drain(search(index, wild).hits), 2)
    for name in REGISTERED:
        timed(name, lambda: drain(catalog.QUERIES[name](spark, SF)), 2)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
