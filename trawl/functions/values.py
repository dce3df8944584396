"""Conversion of source values to index types; what cannot be converted is absent."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Index type to the Spark type values are stored as.
STORED_AS = {
    "boolean": "boolean", "tint": "bigint", "tfloat": "float", "tdouble": "double",
    "tdate": "timestamp", "string": "string", "text": "string", "htmltext": "string",
}


def to_timestamp(value: Column) -> Column:
    """A date in any usual spelling; empty, zero and unreadable values are absent."""
    return F.coalesce(
        F.try_to_timestamp(value.cast("string")),
        F.try_to_timestamp(value.cast("string"), F.lit("yyyyMMdd")),
    )


def display_date(value: Column) -> Column:
    return F.date_format(value, DATE_FORMAT)


def convert(value: Column, index_type: str) -> Column:
    if index_type == "tdate":
        return to_timestamp(value)
    return value.try_cast(STORED_AS[index_type])


def convert_all(values: Column, index_type: str) -> Column:
    """Element-wise conversion of an array; absent elements are dropped."""
    return F.filter(F.transform(values, lambda v: convert(v, index_type)), F.isnotnull)
