"""Scans of stored tables; filters and column choices reach the files through Catalyst."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stored_table(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A whole table from files or, with a connector's format name and options, from a document store."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(location) if location else reader.load()


def find(df: DataFrame, condition: Column | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """Rows that meet ``condition``, with ``columns`` only."""
    rows = df if condition is None else df.where(condition)
    return rows.select(*columns) if columns else rows


def with_row_id(df: DataFrame) -> DataFrame:
    """Adds ``_id``, the place of a row in its Parquet file: unique, and the same each time the file is read."""
    place = F.concat_ws(":", "_metadata.file_name", "_metadata.row_index")
    return df.select(place.alias("_id"), *df.columns)


def parquet_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """One frame per table name, each built once and read only when used."""
    return {name: stored_table(spark, f"{folder}/{name}.parquet") for name in names}
