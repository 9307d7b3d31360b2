"""The three cleaned tables: values, column order, plans."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plan_text import physical_plan
from tablemill.operators.columns import replace_columns, sample_rows, schema_differences, schema_report
from tablemill.operators.lost_values import LOST_VALUES, lost_counts, lost_records, without_lost_values
from tablemill.plans import warehouse
from tablemill.sinks.tables import append_tables
from tablemill.sources.tables import stored_table


def branch(spark):
    rows = [
        (1, "1234567890", "Main", "01234"),
        (2, None, "North", None),
        (3, "12345", "South", "Null"),
    ]
    return spark.createDataFrame(rows, "BRANCH_KEY bigint, BRANCH_PHONE string, BRANCH_NAME string, BRANCH_ZIP string")


def card(spark):
    rows = [(1, 2018, 1, 5, 9.5), (2, 2018, 12, 31, 1.0), (3, 2018, None, 5, 2.0), (4, None, 1, 5, 3.0)]
    return spark.createDataFrame(rows, "CARD_KEY bigint, YEAR int, MONTH int, DAY int, VALUE double")


def customer(spark):
    rows = [
        (1, "o'brien", "LEE", "mary-jane", "01234", "1234567", "12", "Main St"),
        (2, "mcDONALD", None, "", "abc", "123", None, "Main St"),
        (3, None, "X", None, None, None, "7", None),
    ]
    return spark.createDataFrame(
        rows,
        "CUST_KEY bigint, FIRST_NAME string, MIDDLE_NAME string, LAST_NAME string, CUST_ZIP string, "
        "CUST_PHONE string, APT_NO string, STREET_NAME string",
    )


def rows_of(df, key):
    return [tuple(row) for row in df.orderBy(key).collect()]


def test_clean_branch(spark):
    cleaned = warehouse.clean_branch(branch(spark))
    assert cleaned.columns == ["BRANCH_KEY", "BRANCH_NAME", "BRANCH_PHONE", "BRANCH_ZIP"]
    assert rows_of(cleaned, "BRANCH_KEY") == [
        (1, "Main", "(123)456-7890", "01234"), (2, "North", None, "9999"), (3, "South", None, "9999")
    ]
    lenient = rows_of(warehouse.clean_branch(branch(spark), strict=False), "BRANCH_KEY")
    assert lenient[2] == (3, "South", "(123)45-", "9999")
    assert tuple(warehouse.lost_branch_values(branch(spark)).first()) == (1, 0)


def test_clean_card(spark):
    cleaned = warehouse.clean_card(card(spark))
    assert cleaned.columns == ["CARD_KEY", "VALUE", "TIMEID"]
    assert rows_of(cleaned, "CARD_KEY") == [
        (1, 9.5, "2018-01-05"), (2, 1.0, "2018-12-31"), (3, 2.0, None), (4, 3.0, None)
    ]


def test_clean_customer(spark):
    cleaned = warehouse.clean_customer(customer(spark))
    assert cleaned.columns == [
        "CUST_KEY", "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME", "CUST_ZIP", "CUST_PHONE", "CUST_STREET"
    ]
    assert cleaned.schema["CUST_ZIP"].dataType == T.IntegerType()
    assert rows_of(cleaned, "CUST_KEY") == [
        (1, "O'Brien", "lee", "Mary-Jane", 1234, "123-4567", "12, Main St"),
        (2, "Mcdonald", None, "", None, None, None),
        (3, None, "x", None, None, None, None),
    ]
    lost = warehouse.lost_customer_values(customer(spark)).first().asDict()
    assert lost == {"FIRST_NAME": 0, "MIDDLE_NAME": 0, "LAST_NAME": 0, "CUST_ZIP": 1, "CUST_PHONE": 1}


KEYS = {"BRANCH": "BRANCH_KEY", "CREDITCARD": "CARD_KEY", "CUSTOMER": "CUST_KEY"}


def all_tables(spark):
    return dict(zip(warehouse.WAREHOUSE_TABLES, (branch(spark), card(spark), customer(spark))))


def test_nothing_is_lost_without_its_original(spark):
    cleaned = warehouse.clean_warehouse(all_tables(spark), record_lost=True)
    assert sorted(map(tuple, lost_records(cleaned, KEYS).collect())) == [
        ("BRANCH", "3", "BRANCH_PHONE", "BRANCH_PHONE", "12345"),
        ("CREDITCARD", "3", "TIMEID", "DAY", "5"),
        ("CREDITCARD", "3", "TIMEID", "YEAR", "2018"),
        ("CREDITCARD", "4", "TIMEID", "DAY", "5"),
        ("CREDITCARD", "4", "TIMEID", "MONTH", "1"),
        ("CUSTOMER", "2", "CUST_PHONE", "CUST_PHONE", "123"),
        ("CUSTOMER", "2", "CUST_STREET", "STREET_NAME", "Main St"),
        ("CUSTOMER", "2", "CUST_ZIP", "CUST_ZIP", "abc"),
        ("CUSTOMER", "3", "CUST_STREET", "APT_NO", "7"),
    ]
    counts = {tuple(r) for r in lost_counts(lost_records(cleaned, KEYS)).collect()}
    assert ("CREDITCARD", "TIMEID", "DAY", 2) in counts and len(counts) == 8


def test_recording_changes_no_cleaned_row(spark):
    plain, recorded = (warehouse.clean_warehouse(all_tables(spark), record_lost=flag) for flag in (False, True))
    for name, df in plain.items():
        assert without_lost_values(recorded[name]).schema == df.schema
        assert rows_of(without_lost_values(recorded[name]), KEYS[name]) == rows_of(df, KEYS[name])
    assert recorded["BRANCH"].where(f"{LOST_VALUES} IS NULL").count() == 2
    lenient = warehouse.clean_branch(branch(spark), strict=False, record_lost=True)
    assert lost_records({"BRANCH": lenient}, KEYS).count() == 0


def test_lost_values_are_read_back_from_the_loaded_table(spark, tmp_path):
    cleaned = warehouse.clean_warehouse(all_tables(spark), record_lost=True)
    append_tables(cleaned, str(tmp_path))
    back = {name: stored_table(spark, f"{tmp_path}/{name}") for name in cleaned}
    records = lost_records(back, KEYS)
    assert sorted(map(tuple, records.collect())) == sorted(map(tuple, lost_records(cleaned, KEYS).collect()))
    plan = physical_plan(lost_records({"BRANCH": back["BRANCH"]}, KEYS))
    assert "BRANCH_PHONE:" not in plan and "IsNotNull(lost_values)" in plan
    empty = {"BRANCH": warehouse.clean_branch(branch(spark).limit(0), record_lost=True)}
    assert lost_records(empty, KEYS).count() == 0


def test_cleaning_is_one_narrow_native_step(spark):
    for df in (
        warehouse.clean_branch(branch(spark)),
        warehouse.clean_card(card(spark)),
        warehouse.clean_customer(customer(spark)),
        *warehouse.clean_warehouse(all_tables(spark), record_lost=True).values(),
    ):
        plan = physical_plan(df)
        for word in ("Exchange", "Join", "EvalPython", "Sort"):
            assert word not in plan, plan


def test_whole_warehouse_round_trip(spark, tmp_path):
    sources = dict(zip(warehouse.WAREHOUSE_TABLES, (branch(spark), card(spark), customer(spark))))
    cleaned = warehouse.clean_warehouse(sources)
    assert list(cleaned) == ["BRANCH", "CUSTOMER", "CREDITCARD"]
    for _ in range(2):
        append_tables(cleaned, str(tmp_path), "json")
    for name, df in cleaned.items():
        back = stored_table(spark, f"{tmp_path}/{name}", "json", df.schema)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.unionByName(df).collect()))


def test_replaced_columns_move_to_the_end_in_step_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    changed = replace_columns(df, {"c": F.col("c") * 10, "A": F.col("a") * 10, "e": F.lit(5)}, drop=["d"])
    assert changed.columns == ["b", "c", "A", "e"]
    assert tuple(changed.first()) == (2, 30, 10, 5)


def test_sample_rows_and_schema_differences(spark):
    df = spark.range(10)
    assert sample_rows(df, 2).count() == 2
    assert schema_differences(df, T.StructType.fromDDL("id bigint")) == []
    assert schema_differences(df, T.StructType.fromDDL("id int")) == ["missing id int", "unexpected id bigint"]
    pair = spark.createDataFrame([(1, 2)], "a int, b int")
    assert schema_differences(pair, T.StructType.fromDDL("b int, a int")) == ["columns are in another order"]


def test_schema_report_over_a_table_set(spark):
    tables = {"a": spark.createDataFrame([(1, "x"), (2, None)], "id bigint, name string"), "b": spark.range(3)}
    declared = {
        "a": T.StructType.fromDDL("name string, id int, gone date"),
        "c": T.StructType.fromDDL("only string"),
    }
    got = sorted(map(tuple, schema_report(spark, tables, declared).collect()))
    assert got == [
        ("a", "gone", "date", None, 3, None, False, None),
        ("a", "id", "int", "bigint", 2, 1, False, 2),
        ("a", "name", "string", "string", 1, 2, False, 1),
        ("b", "id", None, "bigint", None, 1, False, 3),
        ("c", "only", "string", None, 1, None, False, None),
    ]
    same = schema_report(spark, {"b": tables["b"]}, {"b": T.StructType.fromDDL("id bigint")}).first()
    assert same.agrees and same.n_values == 3
    assert schema_report(spark, {}, declared).count() == 4 and schema_report(spark, {}, {}).count() == 0
