"""Scans, counts, pivots, merges and rankings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.registry import query, table
from tablemill.operators import counting as C
from tablemill.operators.columns import sample_rows as sample_rows_of
from tablemill.operators.columns import schema_report
from tablemill.operators.merging import merge_counts, merge_on_key
from tablemill.operators.pivots import pivot_counts
from tablemill.operators.ranking import top_name_with_total
from tablemill.sinks.tables import chart_feed as chart_feed_of
from tablemill.sources.cuts import plan_cuts
from tablemill.sources.tables import find, parquet_tables

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
ORDER_STATUSES = ["F", "O", "P"]


def _counters(column: str, values: list[str]) -> str:
    return ", ".join(f"nullif(count(*) FILTER (WHERE {column} = '{v}'), 0) AS \"{v}\"" for v in values)


@query(
    "top1_with_total",
    """
    SELECT user_id, event_type, n, total FROM (
        SELECT user_id, event_type, count(*) AS n,
               cast(sum(count(*)) OVER (PARTITION BY user_id) AS bigint) AS total,
               row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place
        FROM events GROUP BY user_id, event_type)
    WHERE place = 1
    """,
)
def top1_with_total(spark, sf_dir):
    return top_name_with_total(table(spark, sf_dir, "events"), "user_id", "event_type")


@query(
    "top1_null_name",
    """
    SELECT part_key, returnflag, n, total FROM (
        SELECT l_partkey AS part_key, nullif(l_returnflag, 'N') AS returnflag, count(*) AS n,
               cast(sum(count(*)) OVER (PARTITION BY l_partkey) AS bigint) AS total,
               row_number() OVER (PARTITION BY l_partkey
                                  ORDER BY count(*) DESC, nullif(l_returnflag, 'N') NULLS LAST) AS place
        FROM lineitem GROUP BY 1, 2)
    WHERE place = 1
    """,
)
def top1_null_name(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part_key"), F.nullif(F.col("l_returnflag"), F.lit("N")).alias("returnflag")
    )
    return top_name_with_total(rows, "part_key", "returnflag")


@query("distinct_by_key", "SELECT lang, count(DISTINCT source) AS n_distinct FROM documents GROUP BY lang")
def distinct_by_key(spark, sf_dir):
    return C.distinct_by_key(table(spark, sf_dir, "documents"), ["lang"], "source")


@query(
    "distinct_by_key_large",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_distinct FROM lineitem GROUP BY l_returnflag",
)
def distinct_by_key_large(spark, sf_dir):
    return C.distinct_by_key(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_orderkey")


@query("count_by_key", "SELECT o_orderpriority, count(o_orderstatus) AS n FROM orders GROUP BY o_orderpriority")
def count_by_key(spark, sf_dir):
    return C.count_by_key(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus")


@query(
    "count_by_key_nulls",
    """
    SELECT nullif(o_orderpriority, '5-LOW') AS priority, count(nullif(o_orderstatus, 'P')) AS n
    FROM orders WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL GROUP BY 1
    """,
)
def count_by_key_nulls(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
    )
    return C.count_by_key(rows, ["priority"], "status")


@query(
    "count_by_key_keep_null",
    "SELECT nullif(o_orderpriority, '5-LOW') AS priority, count(*) AS n FROM orders GROUP BY 1",
)
def count_by_key_keep_null(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    )
    return C.count_by_key(rows, ["priority"], drop_null_keys=False)


# The first users have no errors.
_EVENT_TYPE = "CASE WHEN user_id <= 10 AND event_type = 'error' THEN 'click' ELSE event_type END"


@query(
    "pivot_outer",
    f"""SELECT user_id, {_counters('event_type', EVENT_TYPES)}
        FROM (SELECT user_id, {_EVENT_TYPE} AS event_type FROM events) GROUP BY user_id""",
)
def pivot_outer(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr("user_id", f"{_EVENT_TYPE} AS event_type")
    return pivot_counts(events, "user_id", "event_type", EVENT_TYPES)


@query(
    "pivot_discovered",
    f"SELECT o_custkey, {_counters('o_orderstatus', ORDER_STATUSES)} FROM orders GROUP BY o_custkey",
)
def pivot_discovered(spark, sf_dir):
    return pivot_counts(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus")


@query(
    "pivot_complete",
    f"""
    SELECT * FROM (SELECT o_custkey, {_counters('o_orderstatus', ORDER_STATUSES)} FROM orders GROUP BY o_custkey)
    WHERE "F" IS NOT NULL AND "O" IS NOT NULL AND "P" IS NOT NULL
    """,
)
def pivot_complete(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return pivot_counts(orders, "o_custkey", "o_orderstatus", ORDER_STATUSES, complete=True)


@query("distinct_values", "SELECT DISTINCT event_type FROM events")
def distinct_values(spark, sf_dir):
    return C.distinct_values(table(spark, sf_dir, "events"), "event_type")


@query(
    "filtered_count",
    "SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' AND value > 50 GROUP BY user_id",
)
def filtered_count(spark, sf_dir):
    condition = (F.col("event_type") == "purchase") & (F.col("value") > 50)
    return C.filtered_count(table(spark, sf_dir, "events"), condition, ["user_id"])


@query(
    "filtered_count_total",
    """
    SELECT user_id, count(*) AS n, grouping(user_id) = 1 AS is_total
    FROM events WHERE event_type = 'purchase' AND value > 50 GROUP BY ROLLUP (user_id)
    """,
)
def filtered_count_total(spark, sf_dir):
    return C.with_total(filtered_count(spark, sf_dir), "user_id")


_RATES = """
    SELECT c_nationkey, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS n_match, count(c_mktsegment) AS n_known,
           cast(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS double) / count(c_mktsegment) AS rate
    FROM customer GROUP BY c_nationkey
"""


@query("rate_by_key", _RATES)
def rate_by_key(spark, sf_dir):
    return C.rate_by_key(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_mktsegment", "BUILDING")


@query("top_rate", f"{_RATES} ORDER BY rate DESC, c_nationkey LIMIT 1")
def top_rate(spark, sf_dir):
    return C.top_rate(rate_by_key(spark, sf_dir), ["c_nationkey"])


@query("find_project", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def find_project(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return find(orders, F.col("o_orderstatus") == "F", ["o_orderkey", "o_totalprice"])


# Suppliers' nations are moved on by five, so that both sides have nations which the other lacks.
_NATION_COUNTS = """
    (SELECT c_nationkey AS nation, count(*) AS customers FROM customer GROUP BY 1) AS a
    {how} JOIN (SELECT s_nationkey + 5 AS nation, count(*) AS suppliers FROM supplier GROUP BY 1) AS b USING (nation)
    {how} JOIN (SELECT n_nationkey AS nation, count(*) AS nations FROM nation GROUP BY 1) AS c USING (nation)
"""


def _by_nation(spark, sf_dir) -> dict[str, DataFrame]:
    return {
        "customers": table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation"),
        "suppliers": table(spark, sf_dir, "supplier").withColumn("nation", F.col("s_nationkey") + 5),
        "nations": table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nation"),
    }


@query("join_outer_counts", f"SELECT nation, customers, suppliers, nations FROM {_NATION_COUNTS.format(how='FULL')}")
def join_outer_counts(spark, sf_dir):
    return merge_counts(_by_nation(spark, sf_dir), "nation", "full")


@query("join_inner_counts", f"SELECT nation, customers, suppliers, nations FROM {_NATION_COUNTS.format(how='INNER')}")
def join_inner_counts(spark, sf_dir):
    return merge_counts(_by_nation(spark, sf_dir), "nation", "inner")


@query("merge_grouped", f"SELECT nation, customers, suppliers, nations FROM {_NATION_COUNTS.format(how='FULL')}")
def merge_grouped(spark, sf_dir):
    counts = [C.count_by_key(df, ["nation"], name=name) for name, df in _by_nation(spark, sf_dir).items()]
    return merge_on_key(counts, "nation", "full")


# The first parts have no open line, part 30 has no total.
_LINE_STATUS = "CASE WHEN l_partkey <= 20 THEN 'F' ELSE l_linestatus END"


@query(
    "merge_winners_with_totals",
    f"""
    WITH counts AS (
        SELECT l_partkey, l_returnflag, count(*) AS n FROM lineitem WHERE {_LINE_STATUS} = 'O'
        GROUP BY l_partkey, l_returnflag),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_returnflag) AS place FROM counts),
    totals AS (
        SELECT nullif(l_partkey, 30) AS l_partkey, count(l_quantity) AS quantity_rows FROM lineitem
        GROUP BY 1 HAVING nullif(l_partkey, 30) IS NOT NULL)
    SELECT l_partkey, l_returnflag, n, quantity_rows
    FROM (SELECT * FROM ranked WHERE place = 1) AS winners FULL JOIN totals USING (l_partkey)
    """,
)
def merge_winners_with_totals(spark, sf_dir):
    """The most frequent flag among open lines next to a total over all lines of the part."""
    lines = table(spark, sf_dir, "lineitem")
    winners = top_name_with_total(lines.where(f"{_LINE_STATUS} = 'O'"), "l_partkey", "l_returnflag").drop("total")
    known = lines.withColumn("l_partkey", F.nullif(F.col("l_partkey"), F.lit(30)))
    totals = C.count_by_key(known, ["l_partkey"], "l_quantity", name="quantity_rows")
    return merge_on_key([winners, totals], "l_partkey", "full")


#: Of each table a key that is summed and a text whose characters are counted.
_SCANNED = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name"),
    "customer": ("c_custkey", "c_name"),
    "supplier": ("s_suppkey", "s_name"),
    "part": ("p_partkey", "p_name"),
    "orders": ("o_orderkey", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_returnflag"),
}


@query(
    "multi_table_scan",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n, cast(sum({key}) AS bigint) AS key_sum, "
        f"cast(sum(length({text})) AS bigint) AS n_chars FROM {name}"
        for name, (key, text) in _SCANNED.items()
    ),
)
def multi_table_scan(spark, sf_dir):
    tables = parquet_tables(spark, sf_dir, _SCANNED)
    sums = []
    for name, df in tables.items():
        key, text = _SCANNED[name]
        n, keys, chars = F.count(F.lit(1)), F.sum(F.col(key).cast("bigint")), F.sum(F.length(text))
        totals = df.agg(n.alias("n"), keys.alias("key_sum"), chars.alias("n_chars"))
        sums.append(totals.select(F.lit(name).alias("table_name"), "n", "key_sum", "n_chars"))
    return reduce(DataFrame.unionByName, sums)


_PLANNED_PARTS = 16


@query(
    "planned_cuts",
    """SELECT l_returnflag, l_linenumber, l_partkey, count(*) AS n, cast(1 AS bigint) AS times
       FROM lineitem GROUP BY ALL""",
)
def planned_cuts(spark, sf_dir):
    """The predicates planned for a bunched key, read as a database would: each of its keys is met by one of them."""
    columns = ["l_returnflag", "l_linenumber", "l_partkey"]
    keys = table(spark, sf_dir, "lineitem").groupBy(*columns).agg(F.count("*").alias("n"))
    predicates = plan_cuts(keys, columns, _PLANNED_PARTS, "n")
    met = reduce(lambda a, b: a + b, (F.expr(f"CASE WHEN {p} THEN 1L ELSE 0L END") for p in predicates))
    return keys.withColumn("times", met)


@query("sample_rows", "SELECT cast(2 AS bigint) AS n")
def sample_rows(spark, sf_dir):
    """Any two rows of the table, as the feature asks; counted are those found again in the table."""
    orders = table(spark, sf_dir, "orders")
    keys = sample_rows_of(orders, 2).select("o_orderkey")
    return orders.join(keys, "o_orderkey", "left_semi").agg(F.count("*").alias("n"))


@query(
    "chart_feed",
    "SELECT o_orderpriority, count(o_orderstatus) AS n FROM orders GROUP BY o_orderpriority ORDER BY o_orderpriority",
)
def chart_feed(spark, sf_dir):
    return chart_feed_of(count_by_key(spark, sf_dir), "o_orderpriority")


#: What customers and suppliers are declared as here: a column too many, one too few, another type, another order.
_DECLARED = {
    "customer": "c_custkey bigint, c_name string, c_phone string, c_nationkey string, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey bigint, s_name string, s_acctbal double",
}
_DECLARED_ROWS = ", ".join(
    f"('{name}', '{field.split()[0]}', '{field.split()[1]}', {place})"
    for name, fields in _DECLARED.items()
    for place, field in enumerate(fields.split(", "), 1)
)
_FOUND_COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
}
_VALUE_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{column}' AS column_name, count({column}) AS n_values FROM {name}"
    for name, columns in _FOUND_COLUMNS.items()
    for column in columns
)


@query(
    "schema_compare",
    f"""
    WITH declared(table_name, column_name, expected, expected_place) AS (VALUES {_DECLARED_ROWS}),
    found AS (
        SELECT DISTINCT table_name, column_name, cast(ordinal_position AS integer) AS found_place,
               CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS found
        FROM information_schema.columns WHERE table_name IN ('customer', 'supplier')),
    counts AS ({_VALUE_COUNTS})
    SELECT table_name, column_name, expected, found, cast(expected_place AS integer) AS expected_place, found_place,
           expected IS NOT DISTINCT FROM found AND expected_place IS NOT DISTINCT FROM found_place AS agrees, n_values
    FROM declared FULL JOIN found USING (table_name, column_name) LEFT JOIN counts USING (table_name, column_name)
    """,
)
def schema_compare(spark, sf_dir):
    declared = {name: T.StructType.fromDDL(fields) for name, fields in _DECLARED.items()}
    return schema_report(spark, parquet_tables(spark, sf_dir, _DECLARED), declared)
