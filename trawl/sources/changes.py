"""The change feed: row writes as a table or a stream.

Columns: ``seq`` (arrival order), ``table``, ``class``, ``id``, ``command`` (insert,
update or delete), ``fields`` (map of column to new value) and one column per
variant the write belongs to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trawl.operators.variants import DRAFT, LIVE

SCHEMA = (
    "seq bigint, table string, class string, id bigint, command string,"
    " fields map<string,string>"
)


def read_changes(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_changes(spark: SparkSession, path: str, schema: str = SCHEMA,
                   files_per_batch: int = 100) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def table_class(table: Column) -> Column:
    """Class a table belongs to; live tables carry a suffix."""
    return F.regexp_replace(table, f"_{LIVE}$", "")


def table_stage(table: Column) -> Column:
    return F.when(table.rlike(f"^.*_{LIVE}$"), F.lit(LIVE)).otherwise(F.lit(DRAFT))


def with_states(feed: DataFrame, stage: str | None = None, staged: Sequence[str] = (), site: str | None = None,
                sited: Sequence[str] = (), page_key: str = "SubsiteID", file_key: str = "FileSubsiteID",
                all_sites: Sequence[str] = ()) -> DataFrame:
    """Writes in the states they are for: a row for each.

    The stage, in column ``stage``, follows from the table of ``staged`` classes and their live suffix; the
    sites, in column ``site``, from the fields of ``sited`` ones, every site where these say nothing. Writes of
    other classes have no such state.
    """
    cls = table_class(F.col("table"))
    none = F.lit(None).cast("string")
    rows = feed
    if stage is not None:
        rows = rows.withColumn(stage, F.when(cls.isin(*staged), table_stage(F.col("table"))).otherwise(none))
    if site is not None:
        sites = write_sites(F.col("fields"), page_key, file_key, list(all_sites))
        rows = rows.withColumn(site, F.explode(F.when(cls.isin(*sited), sites).otherwise(F.array(none))))
    return rows


def write_sites(fields: Column, page_key: str, file_key: str, all_sites: list[str]) -> Column:
    """Sites a write is for: a page's own site; a file's site unless it is the main
    one, whose files are everywhere; every site when the write does not say."""
    page = F.try_element_at(fields, F.lit(page_key))
    file = F.try_element_at(fields, F.lit(file_key))
    everywhere = F.array(*map(F.lit, all_sites))
    return (
        F.when(page.isNotNull(), F.array(page))
        .when(file.isNotNull() & (F.coalesce(file.try_cast("int"), F.lit(0)) != 0), F.array(file))
        .otherwise(everywhere)
    )
