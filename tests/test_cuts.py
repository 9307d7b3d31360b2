"""Planned cuts: whatever the keys, each row is met by exactly one predicate, as an SQL engine judges them."""

from __future__ import annotations

import datetime
from decimal import Decimal

import duckdb
import pytest

from tablemill.sources.cuts import Border, border_predicates, key_borders, plan_cuts, sql_literal

DAY = datetime.date(2020, 1, 1)
KEY_SETS = {
    "even": ("bigint", list(range(1000))),
    "bunched": ("bigint", [5] * 700 + list(range(300))),
    "two hot": ("bigint", [-3] * 400 + [9] * 400 + list(range(200))),
    "one key": ("bigint", [7] * 50),
    "nulls": ("bigint", [None] * 500 + list(range(100))),
    "only nulls": ("bigint", [None] * 5),
    "none": ("bigint", []),
    "texts": ("string", ["", "a", "it's", "it''s", "Z", "zebra", "é", "中"] * 9 + ["hot"] * 200 + [None]),
    "dates": ("date", [DAY + datetime.timedelta(days=i % 90) for i in range(400)] + [None]),
    "times": ("timestamp", [datetime.datetime(2020, 1, 1, 0, 0, i % 60, 250) for i in range(200)]),
    "decimals": ("decimal(10,2)", [Decimal(i % 37) / 4 for i in range(300)]),
    "doubles": ("double", [i / 7 for i in range(300)] + [-0.5] * 300),
}


def times_met(kind, rows, predicates):
    """How many predicates each row meets, by DuckDB; rows are keys or tuples of keys."""
    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE t (k {kind.replace('string', 'varchar')}, o bigint)")
    if rows:
        connection.executemany("INSERT INTO t VALUES (?, ?)", [r if isinstance(r, tuple) else (r, 0) for r in rows])
    sums = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
    met = [n for n, in connection.sql(f"SELECT {sums} FROM t").fetchall()]
    sizes = [connection.sql(f"SELECT count(*) FROM t WHERE {p}").fetchall()[0][0] for p in predicates]
    return met, sizes


@pytest.mark.parametrize("name", KEY_SETS)
@pytest.mark.parametrize("parts", [1, 4, 40])
def test_each_row_is_met_once(spark, name, parts):
    kind, keys = KEY_SETS[name]
    frame = spark.createDataFrame([(k,) for k in keys], f"k {kind}").repartition(3)
    predicates = plan_cuts(frame, ["k"], parts)
    met, sizes = times_met(kind, keys, predicates)
    assert met == [1] * len(keys) and len(predicates) <= 3 * parts


def test_parts_are_even_and_hot_keys_stand_alone(spark):
    kind, keys = KEY_SETS["two hot"]
    predicates = plan_cuts(spark.createDataFrame([(k,) for k in keys], "k bigint"), ["k"], 10)
    _, sizes = times_met(kind, keys, predicates)
    assert sorted(sizes)[-2:] == [400, 401] or sorted(sizes)[-2:] == [400, 400]
    assert all(n <= 130 for n in sorted(sizes)[:-2])


def test_hot_keys_are_cut_by_the_next_column(spark):
    rows = [(5, i) for i in range(800)] + [(i, 0) for i in range(200)] + [(None, 3), (5, None)]
    frame = spark.createDataFrame(rows, "k bigint, o bigint").repartition(4)
    predicates = plan_cuts(frame, ["k", "o"], 8)
    met, sizes = times_met("bigint", rows, predicates)
    assert met == [1] * len(rows) and max(sizes) <= 250
    unseen = [(k, o) for k in (-9, 4, 5, 6, 10**6, None) for o in (-1, 5, 10**6, None)]
    assert times_met("bigint", unseen, predicates)[0] == [1] * len(unseen)


def test_counts_stand_for_rows(spark):
    rows = [(k, 100 if k == 3 else 1) for k in range(50)]
    frame = spark.createDataFrame(rows, "k bigint, n bigint")
    borders, hot = key_borders(frame, "k", 4, "n")
    assert list(hot) == [3] and hot[3] > 2 and {Border(3), Border(3, True)} <= set(borders)


def test_predicates_of_borders():
    assert border_predicates("K", []) == ["1 = 1"]
    assert border_predicates("K", [Border(5), Border(5, True)]) == ["(K < 5 OR K IS NULL)", "K >= 5 AND K <= 5", "K > 5"]
    assert sql_literal("it's") == "'it''s'" and sql_literal(DAY) == "DATE '2020-01-01'"
    for bad in (None, True, float("nan"), b"x"):
        with pytest.raises(ValueError):
            sql_literal(bad)
    with pytest.raises(ValueError):
        key_borders(None, "k", 0)
