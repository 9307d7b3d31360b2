"""Every registered query against DuckDB on the driver's tables."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
import acceptance

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return connection


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else round(value, 9)
        return value

    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


GAPS = {
    "join_outer_counts": ["customers", "suppliers", "nations"],
    "merge_grouped": ["customers", "suppliers", "nations"],
    "merge_winners_with_totals": ["n", "quantity_rows"],
    "pivot_outer": ["error"],
    "question_a2": ["P"],
}

KINDS = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(acceptance.ORACLES))
def test_query_matches_sql(spark, duck, name):
    ours = entry_module.queries()[name](spark, SF_DIR)
    result = duck.sql(entry_module.oracle_sql()[name])
    theirs = result.fetchall()
    assert sorted(ours.columns) == sorted(result.columns)
    types = {column: KINDS.get(str(kind), str(kind)) for column, kind in zip(result.columns, result.types)}
    assert dict(ours.dtypes) == types
    rows = [tuple(row) for row in ours.collect()]
    assert len(rows) == len(theirs)
    assert _bag(ours.columns, rows) == _bag(result.columns, theirs)
    assert rows, "a query without rows proves nothing"


def test_queries_without_sql(spark):
    without = set(acceptance.QUERIES) - set(entry_module.oracle_sql())
    assert not without


def test_gaps_show_in_the_rows(spark):
    """Queries with missing partners or cells have some, so that outer and inner forms differ."""
    run = {name: query(spark, SF_DIR) for name, query in acceptance.QUERIES.items() if name in GAPS}
    for name, columns in GAPS.items():
        counts = run[name].selectExpr(*(f"count_if(`{c}` IS NULL) AS `{c}`" for c in columns)).first()
        assert all(counts), (name, counts)
    inner = acceptance.QUERIES["join_inner_counts"](spark, SF_DIR).count()
    assert 0 < inner < run["join_outer_counts"].count()
    assert 0 < acceptance.QUERIES["question_a3"](spark, SF_DIR).count() < run["question_a2"].count()


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["user_id", "event_type", "n", "total"]
    assert result.count() > 0
