"""Cuts of a database table into queries that read each row once, planned from the counts of its keys."""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable, Sequence
from decimal import Decimal
from typing import Any, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Key ranges counted per planned part; neighbouring ones are put together until a part is full.
RANGES_PER_PART = 8


class Border(NamedTuple):
    """A cut before the key ``value``, or behind it."""

    value: Any
    behind: bool = False


def sql_literal(value: Any) -> str:
    """A key as standard SQL; other databases may need a function of their own in its place."""
    if isinstance(value, bool) or value is None or isinstance(value, float) and not math.isfinite(value):
        raise ValueError(f"{value!r} cannot be a border")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"keys of type {type(value).__name__} cannot be written as SQL")


def border_predicates(
    column: str, borders: Sequence[Border], literal: Callable[[Any], str] = sql_literal
) -> list[str]:
    """Conditions for the ranges between ascending borders. Every key meets exactly one of them, also one that the plan
    has not seen; null meets the first."""
    return [predicate for predicate, _ in _ranges(column, borders, literal)]


def _ranges(column: str, borders: Sequence[Border], literal: Callable[[Any], str]) -> list[tuple[str, Any]]:
    """The predicate of each range, and its key if it is of one key only."""
    ends = [None, *borders, None]
    found = []
    for low, high in zip(ends, ends[1:]):
        parts = []
        if low is not None:
            parts.append(f"{column} {'>' if low.behind else '>='} {literal(low.value)}")
        if high is not None:
            parts.append(f"{column} {'<=' if high.behind else '<'} {literal(high.value)}")
        predicate = " AND ".join(parts)
        if low is None:
            predicate = f"({predicate} OR {column} IS NULL)" if predicate else "1 = 1"
        one = low is not None and high is not None and low.value == high.value
        found.append((predicate, low.value if one else None))
    return found


def key_borders(
    keys: DataFrame, column: str, parts: int, count_column: str | None = None
) -> tuple[list[Border], dict[Any, float]]:
    """Borders of at most ``3 * parts`` ranges, and for the hot keys how many parts' shares of the rows each has.

    ``keys`` has a row per row of the table, or per key with its number of rows in ``count_column``; it may be a
    sample. A hot key has more than a part's share of the rows and a range of its own. Other ranges have about a
    part's share at most. Keys are counted by range in Spark; only a bounded number of ranges comes to the driver.
    """
    if parts < 1:
        raise ValueError("a plan has one part at least")
    rows = F.sum(count_column) if count_column else F.count(F.lit(1))
    counted = keys.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(rows.alias("n"))
    total = counted.agg(F.sum("n")).first()[0]
    if not total or parts == 1:
        return [], {}
    share = total / parts
    hot = counted.where(F.col("n") > share).orderBy("key").collect()  # fewer than ``parts``
    ranges = (
        counted.where(F.col("n") <= share)
        .repartitionByRange(RANGES_PER_PART * parts, "key")
        .withColumn("range", F.spark_partition_id())
        .groupBy("range")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("n").alias("n"))
        .collect()
    )
    borders: set[Border] = {Border(r.key, behind) for r in hot for behind in (False, True)}
    held, hot_keys = 0, [r.key for r in hot]
    for r in sorted(ranges, key=lambda r: r.low):
        if held and held + r.n > share:
            borders.add(Border(r.low))
            held = 0
        held += r.n
        if any(r.low < key < r.high for key in hot_keys):  # the hot keys' borders cut this range
            held = 0
    return sorted(borders), {r.key: r.n / share for r in hot}


def plan_cuts(
    keys: DataFrame,
    columns: Sequence[str],
    parts: int,
    count_column: str | None = None,
    literal: Callable[[Any], str] = sql_literal,
) -> list[str]:
    """Predicates for :func:`jdbc_table`, one task each, that part a table by the first of ``columns``.

    Where a key of it alone has more than a part's share, its rows are parted by the next column, so bunched keys cost
    no more than others as long as there is a column left. Together the predicates cover every row exactly once,
    nulls and keys that ``keys`` does not have among them. Text keys need a database that compares them by their
    bytes, as Spark does, and no float key may be NaN.
    """
    column, *others = columns
    borders, hot = key_borders(keys, column, parts, count_column)
    planned = []
    for predicate, key in _ranges(column, borders, literal):
        if key is None or not others:
            planned.append(predicate)
            continue
        own = keys.where(F.col(column) == F.lit(key))
        planned += [f"{predicate} AND ({p})" for p in plan_cuts(own, others, math.ceil(hot[key]), count_column, literal)]
    return planned
