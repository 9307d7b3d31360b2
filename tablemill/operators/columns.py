"""Replacing, dropping and checking columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def replace_columns(df: DataFrame, new: Mapping[str, Column], drop: Sequence[str] = ()) -> DataFrame:
    """One projection: untouched columns in their order, then the ``new`` ones in theirs, without ``drop``."""
    gone = {name.lower() for name in (*new, *drop)}
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in gone]
    return df.select(*kept, *(value.alias(name) for name, value in new.items()))


def count_lost(df: DataFrame, cleaned: Mapping[str, Column]) -> DataFrame:
    """One row: per column, how many values were present before and are null in ``cleaned``."""
    return df.agg(
        *(F.count_if(F.col(f"`{name}`").isNotNull() & value.isNull()).alias(name) for name, value in cleaned.items())
    )


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for a look at the data."""
    return df.limit(n)


def schema_differences(df: DataFrame, expected) -> list[str]:
    """Readable differences in names, types and order; empty when the schemas agree (nullability is ignored)."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    found = [f"missing {name} {kind}" for name, kind in want if (name, kind) not in have]
    found += [f"unexpected {name} {kind}" for name, kind in have if (name, kind) not in want]
    if not found and have != want:
        found.append("columns are in another order")
    return found


def schema_report(
    spark: SparkSession, tables: Mapping[str, DataFrame], expected: Mapping[str, T.StructType]
) -> DataFrame:
    """One row per column of a set of tables that is declared or found:

    ``table_name, column_name, expected, found`` (types; null where the column is not), ``expected_place,
    found_place`` (from 1), ``agrees`` (same type and place) and ``n_values``, how many values it has. The values of a
    table are counted in one pass over it. Tables named on one side only have their columns on that side; names are
    compared as they are written.
    """
    rows, counts = [], []
    for table in sorted({*tables, *expected}):
        found = _places_and_types(tables[table].schema) if table in tables else {}
        wanted = _places_and_types(expected[table]) if table in expected else {}
        for column in dict.fromkeys([*wanted, *found]):
            have, want = found.get(column, (None, None)), wanted.get(column, (None, None))
            rows.append((table, column, want[1], have[1], want[0], have[0], have == want))
        if found:
            values = F.array(
                *(F.struct(F.lit(c).alias("column_name"), F.count(F.col(f"`{c}`")).alias("n_values")) for c in found)
            )
            one = tables[table].agg(values.alias("_values"))
            counts.append(one.select(F.lit(table).alias("table_name"), F.inline("_values")))
    report = spark.createDataFrame(
        rows,
        "table_name string, column_name string, expected string, found string, expected_place int, found_place int, "
        "agrees boolean",
    )
    if not counts:
        return report.withColumn("n_values", F.lit(None).cast("bigint"))
    return report.join(reduce(DataFrame.unionByName, counts), ["table_name", "column_name"], "left")


def _places_and_types(schema: T.StructType) -> dict[str, tuple[int, str]]:
    return {f.name: (place, f.dataType.simpleString()) for place, f in enumerate(schema.fields, 1)}
