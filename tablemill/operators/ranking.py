"""The most frequent name of every key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators.counting import with_keys


def top_name_with_total(
    df: DataFrame, key: str, name: str, count_name: str = "n", total_name: str = "total", drop_null_keys: bool = True
) -> DataFrame:
    """Per key: the name with the most rows, its row count, and the row count of the key.

    A null name is a name of its own. The smallest name wins a tie, and any name wins over null.

    Rows are grouped by key and name first. The second grouping keeps one candidate and one running total per key
    and map task, so a key with very many names is never gathered in one task, as a window over the key would do.
    """
    per_name = with_keys(df, [key], drop_null_keys).groupBy(key, name).agg(F.count(F.lit(1)).alias("_n"))
    candidate = F.struct(
        (-F.col("_n")).alias("minus_n"), F.col(name).isNull().alias("unnamed"), F.col(name).alias("name")
    )
    best = per_name.groupBy(key).agg(F.min(candidate).alias("_best"), F.sum("_n").alias(total_name))
    return best.select(
        key,
        F.col("_best.name").alias(name),
        (-F.col("_best.minus_n")).alias(count_name),
        total_name,
    )
