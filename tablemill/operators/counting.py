"""Counts, distinct counts and rates per key.

Each operator aggregates on the map side before its shuffle, so a key that holds a large share of the rows reaches
the reducer as one small row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_keys(df: DataFrame, keys: Sequence[str], drop_null_keys: bool = True) -> DataFrame:
    """Rows whose keys are all present; a grouped answer per state has no row for an unknown state."""
    if not drop_null_keys:
        return df
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def count_by_key(
    df: DataFrame, keys: Sequence[str], value: str | None = None, name: str = "n", drop_null_keys: bool = True
) -> DataFrame:
    """Rows per key, or with ``value`` the non-null values of that column per key."""
    counted = F.count(F.col(value)) if value else F.count(F.lit(1))
    return with_keys(df, keys, drop_null_keys).groupBy(*keys).agg(counted.alias(name))


def distinct_by_key(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "n_distinct", drop_null_keys: bool = True
) -> DataFrame:
    """Different non-null values per key.

    Spark first groups by key and value, so the values of one large key are spread over all reducers.
    """
    return with_keys(df, keys, drop_null_keys).groupBy(*keys).agg(F.count_distinct(F.col(value)).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def filtered_count(
    df: DataFrame, condition: Column, keys: Sequence[str], name: str = "n", drop_null_keys: bool = True
) -> DataFrame:
    """Rows per key among those that meet ``condition``; keys without any such row are absent."""
    return count_by_key(df.where(condition), keys, name=name, drop_null_keys=drop_null_keys)


def with_total(counts: DataFrame, key: str, name: str = "n", flag: str = "is_total") -> DataFrame:
    """Adds the grand total of ``counts`` as one more row with a null key and ``flag`` set.

    ``counts`` is already grouped, and both branches share its shuffle, so the input is read once. The total is
    there, as 0, for an empty input as well.
    """
    groups = counts.select(key, name, F.lit(False).alias(flag))
    total = counts.agg(F.coalesce(F.sum(name), F.lit(0)).alias(name)).select(
        F.lit(None).cast(counts.schema[key].dataType).alias(key), name, F.lit(True).alias(flag)
    )
    return groups.unionByName(total)


def rate_by_key(df: DataFrame, keys: Sequence[str], flag: str, value, drop_null_keys: bool = True) -> DataFrame:
    """Per key: rows where ``flag`` equals ``value``, rows where it is known, and their ratio (null for 0 known)."""
    matched = F.count_if(F.col(flag) == F.lit(value))
    known = F.count(F.col(flag))
    return (
        with_keys(df, keys, drop_null_keys)
        .groupBy(*keys)
        .agg(matched.alias("n_match"), known.alias("n_known"))
        .withColumn("rate", F.try_divide(F.col("n_match").cast("double"), F.col("n_known").cast("double")))
    )


def top_rate(rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The single row with the highest rate; the smallest key wins a tie."""
    return rates.orderBy(F.desc_nulls_last("rate"), *keys).limit(1)
