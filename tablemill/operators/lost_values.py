"""Values that cleaning could not keep, recorded beside the cleaned row in the same pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.operators.columns import replace_columns

#: Null where nothing was lost; otherwise one entry per lost value. Parquet statistics tell the two apart when read.
LOST_VALUES = "lost_values"

RECORD_COLUMNS = ["table_name", "row_key", "column_name", "source_name", "original"]


def lost_values(new: Mapping[str, Column], sources: Mapping[str, Sequence[str]]) -> Column:
    """What is gone from a row: for each new column that is null, every one of its sources that is not.

    ``sources`` names the columns a new one is made of, where that is not the column of its own name.
    """
    entries = [
        F.when(
            value.isNull() & F.col(f"`{source}`").isNotNull(),
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(source).alias("source_name"),
                F.col(f"`{source}`").cast("string").alias("original"),
            ),
        )
        for name, value in new.items()
        for source in sources.get(name, (name,))
    ]
    found = F.array_compact(F.array(*entries))
    return F.when(F.size(found) > 0, found)


def replace_and_record(
    df: DataFrame, new: Mapping[str, Column], sources: Mapping[str, Sequence[str]], drop: Sequence[str] = ()
) -> DataFrame:
    """:func:`replace_columns` with the lost values as one more column; still one projection without a shuffle."""
    return replace_columns(df, {**new, LOST_VALUES: lost_values(new, sources)}, drop)


def without_lost_values(cleaned: DataFrame) -> DataFrame:
    return cleaned.drop(LOST_VALUES)


def lost_records(cleaned: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """One row per lost value of all tables: ``table_name, row_key, column_name, source_name, original``.

    ``cleaned`` are frames with lost values, as cleaned or as read back from where they were loaded; only their key
    and the lost values are read. ``keys`` names the key column of each. A null key gives a null ``row_key``.
    """
    each = [
        df.where(F.col(LOST_VALUES).isNotNull()).select(
            F.lit(name).alias("table_name"), F.col(keys[name]).cast("string").alias("row_key"), F.inline(LOST_VALUES)
        )
        for name, df in cleaned.items()
    ]
    return reduce(DataFrame.unionByName, each)


def lost_counts(records: DataFrame) -> DataFrame:
    """How many values of each source column each cleaned column has lost."""
    return records.groupBy("table_name", "column_name", "source_name").agg(F.count(F.lit(1)).alias("n"))
