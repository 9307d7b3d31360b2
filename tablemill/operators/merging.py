"""Putting separately counted tables side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators.pivots import pivot_counts


def merge_on_key(frames: Sequence[DataFrame], key: str, how: str = "full") -> DataFrame:
    """Joins grouped tables: ``full`` keeps every key, ``inner`` the keys found in all.

    Results of a ``groupBy`` are already partitioned by their key, so the first join adds no shuffle; and with one
    row per key no key can be skewed. To put plain row counts side by side, :func:`merge_counts` needs no join.
    """
    return reduce(lambda left, right: left.join(right, on=key, how=how), frames)


def merge_counts(
    frames: Mapping[str, DataFrame], key: str, how: str = "full", drop_null_keys: bool = True
) -> DataFrame:
    """Rows per key in each of several tables, one column per table: ``full`` or ``inner`` over their keys.

    The tables' rows are stacked under the name of their table and counted in one pass with one shuffle.
    """
    if how not in ("full", "inner"):
        raise ValueError(f"how must be full or inner, not {how}")
    tagged = [df.select(key, F.lit(name).alias("_table")) for name, df in frames.items()]
    stacked = reduce(DataFrame.unionByName, tagged)
    return pivot_counts(stacked, key, "_table", list(frames), complete=how == "inner", drop_null_keys=drop_null_keys)
