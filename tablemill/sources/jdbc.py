"""Database tables over JDBC, read in parallel."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# The warehouse tables that the cleaning jobs take.
WAREHOUSE_TABLES = ("CDW_SAPP_BRANCH", "CDW_SAPP_CREDITCARD", "CDW_SAPP_CUSTOMER")


@dataclass(frozen=True)
class Connection:
    """Where the database is. Credentials are passed in, never stored in code."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        found = {"url": self.url, "driver": self.driver, "fetchsize": str(self.fetch_size)}
        if self.user is not None:
            found["user"] = self.user
        if self.password is not None:
            found["password"] = self.password
        return found


@dataclass(frozen=True)
class Split:
    """Cuts a scan into ``parts`` queries by ranges of a numeric or date column.

    The bounds only place the cuts; rows outside of them are read too. For a column whose values are bunched, pass
    ``predicates`` to :func:`jdbc_table` instead.
    """

    column: str
    lower: int | str
    upper: int | str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


def jdbc_options(connection: Connection, table: str, split: Split | None = None) -> dict[str, str]:
    options = {**connection.options(), "dbtable": table}
    if split is not None:
        options.update(split.options())
    return options


def jdbc_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
    single_task: bool = False,
) -> DataFrame:
    """One table, read by the ranges of ``split`` or by ``predicates``, SQL conditions that cut it into disjoint parts,
    one task each (``cuts.plan_cuts`` plans them). A single task reads all of it only on request."""
    if sum((split is not None, predicates is not None, single_task)) != 1:
        raise ValueError(f"give one of split, predicates and single_task for {table}")
    if predicates is not None:
        properties = {name: value for name, value in connection.options().items() if name != "url"}
        return spark.read.jdbc(connection.url, table, predicates=list(predicates), properties=properties)
    return spark.read.format("jdbc").options(**jdbc_options(connection, table, split)).load()


def jdbc_tables(
    spark: SparkSession,
    connection: Connection,
    tables: Iterable[str] = WAREHOUSE_TABLES,
    splits: Mapping[str, Split | Sequence[str]] | None = None,
    single_task: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """One frame per table name, each built once. ``splits`` has the ranges or the predicates of each table, but for
    those named in ``single_task``, which one task may read."""
    single, found = set(single_task), {}
    for table in tables:
        cut = (splits or {}).get(table)
        ranges, predicates = (cut, None) if isinstance(cut, Split) else (None, cut)
        found[table] = jdbc_table(spark, connection, table, ranges, predicates, table in single)
    return found
