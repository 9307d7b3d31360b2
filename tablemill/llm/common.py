"""What several operators of this package need: row keys, words, sizes and written intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tablemill.session import shared_dir

#: Bytes that part words: blank, and tab to carriage return. ``bytes.split()`` cuts at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def text_hash(text: Column) -> Column:
    """64 bits that tell texts of one document id apart; a null text is as an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns ``doc_id``, ``_h`` and ``text`` (null: empty) only, so other columns cannot clash.

    A row is known by its id and its text's hash. Rows that repeat both are the same document twice.
    """
    return docs.select(
        F.col(id_column).alias("doc_id"),
        text_hash(F.col(text_column)).alias("_h"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def written(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: later jobs read it, and a lost executor loses none of it."""
    path = shared_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.read.parquet(path)


def sampled(rows: DataFrame, key: str, n: int, value: Column) -> list[Row]:
    """At most ``n`` rows ``key, picked``, those with the smallest hashes of their keys; of rows with one key the
    smallest ``value``. All rows if there are no more keys.

    Hashes above a bound, which about ``3 * n`` keys keep, are left out first, so tasks hand on few rows however many
    tasks there are.
    """
    keys = rows.agg(F.approx_count_distinct(key).alias("n")).first().n
    order = F.xxhash64(key)
    if keys > 4 * n:
        rows = rows.where(order < -(1 << 63) + (3 * n << 64) // keys)
    few = rows.groupBy(key).agg(F.min(value).alias("picked"))
    return few.orderBy(order, key).limit(n).collect()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_column(batch, name: str) -> list[bytes]:
    """The column's texts as UTF-8; nulls are empty."""
    import pyarrow as pa

    return [value or b"" for value in batch.column(name).cast(pa.binary()).to_pylist()]
