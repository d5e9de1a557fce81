"""Semi-structured columns: one schema for all rows, found by an aggregate, and typed columns from it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merged_schema(rows: DataFrame, column: str) -> str:
    """The type that holds every value of a JSON column, as a Spark type. Schemas are merged where the rows are; texts that are no JSON count as null."""
    found = rows.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    return re.sub(r"\bOBJECT<", "STRUCT<", found)


def typed(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    """``rows`` with a column for each field at the top of the JSON objects in ``column``: ``prefix`` and the field's name, of the type that all rows together call for.
    Rows without the field, and values that are no objects, have null."""
    kind = merged_schema(rows, column)
    if not kind.startswith("STRUCT<"):
        return rows
    names = rows.sparkSession.createDataFrame([], f"s {kind}").schema["s"].dataType.names
    clash = {f"{prefix}{n}" for n in names} & set(rows.columns)
    if clash:
        raise ValueError(f"columns that are there already: {sorted(clash)}")
    whole = rows.withColumn("__typed", F.try_variant_get(F.try_parse_json(column), "$", kind))
    return whole.select(*rows.columns, *(F.col("__typed").getField(n).alias(f"{prefix}{n}") for n in names))
