"""Appending tables, and tables in the order a chart wants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def connector_options(uri: str, database: str, collection: str) -> dict[str, str]:
    """Options of a document-store connector for one target collection."""
    return {"connection.uri": uri, "database": database, "collection": collection}


def append_table(
    df: DataFrame, location: str | None = None, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Appends all rows to a folder of files, or with a connector's format name and options to its collection."""
    writer = df.write.format(fmt).mode("append").options(**(options or {}))
    writer.save(location) if location else writer.save()


def append_tables(
    frames: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Appends each frame to the folder of its name."""
    for name, df in frames.items():
        append_table(df, f"{folder}/{name}", fmt, options)


def append_collections(frames: Mapping[str, DataFrame], fmt: str, uri: str, database: str) -> None:
    """Appends each frame to the collection of its name, through a connector on the session's class path."""
    for name, df in frames.items():
        append_table(df, None, fmt, connector_options(uri, database, name))


def chart_feed(df: DataFrame, key: str) -> DataFrame:
    """One row per key in key order, as bar charts take it."""
    return df.orderBy(key)
