"""Counts per key as one column per category value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.operators.counting import with_keys

def category_values(df: DataFrame, category: str) -> list:
    """The sorted non-null values of ``category``; they become columns, so they must be few.

    Stops with an error above ``spark.sql.pivotMaxValues``. The long form of the same answer,
    ``count_by_key(df, [key, category])``, has no such bound.
    """
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = df.where(F.col(category).isNotNull()).select(category).distinct().limit(bound + 1).collect()
    if len(found) > bound:
        raise ValueError(f"{category} has more than {bound} values; use count_by_key for the long form")
    return sorted(row[0] for row in found)


def pivot_counts(
    df: DataFrame,
    key: str,
    category: str,
    values: Sequence | None = None,
    complete: bool = False,
    drop_null_keys: bool = True,
) -> DataFrame:
    """Rows per key and category value; a combination without rows is null, not 0.

    ``values`` names the wanted category values and saves the job that looks them up. ``complete`` keeps only the
    keys that have every value. A key without any of the values has no row.
    """
    if values is None:
        values = category_values(df, category)
    names = [str(value) for value in values]
    if len(set(names)) < len(names) or len(set(values)) < len(values):
        raise ValueError("a category value is given twice")
    typed = [F.lit(value).cast(df.schema[category].dataType) for value in values]
    rows = with_keys(df, [key], drop_null_keys).where(F.col(category).isin(typed))
    wide = _conditional_counts(rows, key, category, typed, names)
    if complete:
        for name in names:
            wide = wide.where(F.col(f"`{name}`").isNotNull())
    return wide


def _conditional_counts(rows: DataFrame, key: str, category: str, values: list[Column], names: list[str]) -> DataFrame:
    """One shuffle, with one row of counters per key and map task, whatever the number of values. Values have the
    column's type and are compared as SQL does: NaN equals NaN and -0.0 equals 0.0."""
    counters = rows.groupBy(key).agg(
        *(F.count_if(F.col(category) == value).alias(name) for value, name in zip(values, names))
    )
    return counters.select(key, *(F.nullif(F.col(f"`{name}`"), F.lit(0)).alias(name) for name in names))
