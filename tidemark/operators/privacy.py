"""Personal data is marked on the column itself and travels with the schema, through Parquet too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

PII = {"pii": True}


def pii(column: Column, name: str) -> Column:
    return column.alias(name, metadata=PII)


def drop_pii(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in df.schema.fields if not f.metadata.get("pii")])
