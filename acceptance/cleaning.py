"""Cleaning expressions one by one, then the three cleaned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.crosswalk import view, view_sql
from acceptance.registry import query, table
from tablemill.functions import text as X
from tablemill.operators.columns import replace_columns as replace_columns_of
from tablemill.operators.lost_values import lost_records
from tablemill.plans import warehouse


def _words_in_title_case(text: str) -> str:
    """``upper`` leaves a sharp s as it is, which opens a word as ``Ss``."""
    pieces = f"regexp_extract_all({text}, '[\\p{{L}}]+|[^\\p{{L}}]+')"
    first = "CASE WHEN x[1] = 'ß' THEN 'Ss' ELSE upper(x[1]) END"
    return f"array_to_string(list_transform({pieces}, lambda x: concat({first}, lower(x[2:]))), '')"


_MASK_10 = (
    "CASE WHEN length(BRANCH_PHONE) = 10 THEN concat('(', BRANCH_PHONE[1:3], ')', BRANCH_PHONE[4:6], '-', "
    "BRANCH_PHONE[7:10]) END"
)
_MASK_7 = "CASE WHEN length(CUST_PHONE) = 7 THEN concat(CUST_PHONE[1:3], '-', CUST_PHONE[4:7]) END"
_PADDED = "CASE WHEN length(cast({0} AS varchar)) = 1 THEN '0' || {0} ELSE cast({0} AS varchar) END"
_ZIP = "coalesce(nullif(BRANCH_ZIP, 'Null'), '9999')"
_DATE_KEY = f"YEAR || '-' || {_PADDED.format('MONTH')} || '-' || {_PADDED.format('DAY')}"
_STREET = "APT_NO || ', ' || STREET_NAME"


@query("phone_mask_10", f"SELECT BRANCH_KEY, {_MASK_10} AS phone FROM {view_sql('branch')}")
def phone_mask_10(spark, sf_dir):
    return view(spark, sf_dir, "branch").select("BRANCH_KEY", X.phone_mask_10(F.col("BRANCH_PHONE")).alias("phone"))


@query(
    "phone_mask_10_lenient",
    f"""SELECT BRANCH_KEY, '(' || BRANCH_PHONE[1:3] || ')' || BRANCH_PHONE[4:6] || '-' || BRANCH_PHONE[7:10] AS phone
        FROM {view_sql('branch')}""",
)
def phone_mask_10_lenient(spark, sf_dir):
    masked = X.phone_mask_10(F.col("BRANCH_PHONE"), strict=False)
    return view(spark, sf_dir, "branch").select("BRANCH_KEY", masked.alias("phone"))


@query("phone_mask_7", f"SELECT CUST_KEY, {_MASK_7} AS phone FROM {view_sql('customers')}")
def phone_mask_7(spark, sf_dir):
    return view(spark, sf_dir, "customers").select("CUST_KEY", X.phone_mask_7(F.col("CUST_PHONE")).alias("phone"))


@query("zip_default", f"SELECT BRANCH_KEY, {_ZIP} AS zip FROM {view_sql('branch')}")
def zip_default(spark, sf_dir):
    return view(spark, sf_dir, "branch").select("BRANCH_KEY", X.zip_or_default(F.col("BRANCH_ZIP")).alias("zip"))


@query("zero_pad", f"SELECT p_partkey, {_PADDED.format('p_size')} AS size_text FROM part")
def zero_pad(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.zero_pad(F.col("p_size")).alias("size_text"))


@query("date_key", f"SELECT CARD_KEY, {_DATE_KEY} AS TIMEID FROM {view_sql('card')}")
def date_key(spark, sf_dir):
    key = X.date_key(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))
    return view(spark, sf_dir, "card").select("CARD_KEY", key.alias("TIMEID"))


_NAME = "concat(p_name, '-o''', upper(p_brand))"


@query("title_case", f"SELECT p_partkey, {_words_in_title_case(_NAME)} AS name FROM part")
def title_case(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.title_case(F.expr(_NAME)).alias("name"))


@query("title_case_texts", f"SELECT doc_id, {_words_in_title_case('text')} AS title FROM documents")
def title_case_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.title_case(F.col("text")).alias("title"))


@query("lower_case", "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer")
def lower_case(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.lower_case(F.col("c_mktsegment")).alias("segment"))


@query("safe_int", f"SELECT CUST_KEY, try_cast(CUST_ZIP AS integer) AS zip FROM {view_sql('customers')}")
def safe_int(spark, sf_dir):
    return view(spark, sf_dir, "customers").select("CUST_KEY", X.safe_int(F.col("CUST_ZIP")).alias("zip"))


@query("street_concat", f"SELECT CUST_KEY, {_STREET} AS street FROM {view_sql('customers')}")
def street_concat(spark, sf_dir):
    street = X.street_line(F.col("APT_NO"), F.col("STREET_NAME"))
    return view(spark, sf_dir, "customers").select("CUST_KEY", street.alias("street"))


@query("replace_columns", "SELECT r_name, r_regionkey + 1 AS r_regionkey FROM region")
def replace_columns(spark, sf_dir):
    return replace_columns_of(table(spark, sf_dir, "region"), {"r_regionkey": F.col("r_regionkey") + 1})


@query(
    "clean_branch",
    f"SELECT BRANCH_KEY, BRANCH_NAME, {_MASK_10} AS BRANCH_PHONE, {_ZIP} AS BRANCH_ZIP FROM {view_sql('branch')}",
)
def clean_branch(spark, sf_dir):
    return warehouse.clean_branch(view(spark, sf_dir, "branch"))


@query("clean_card", f"SELECT CARD_KEY, AMOUNT, {_DATE_KEY} AS TIMEID FROM {view_sql('card')}")
def clean_card(spark, sf_dir):
    return warehouse.clean_card(view(spark, sf_dir, "card"))


@query(
    "clean_customer",
    f"""
    SELECT CUST_KEY, {_words_in_title_case('FIRST_NAME')} AS FIRST_NAME, lower(MIDDLE_NAME) AS MIDDLE_NAME,
           {_words_in_title_case('LAST_NAME')} AS LAST_NAME, try_cast(CUST_ZIP AS integer) AS CUST_ZIP,
           {_MASK_7} AS CUST_PHONE, {_STREET} AS CUST_STREET
    FROM {view_sql('customers')}
    """,
)
def clean_customer(spark, sf_dir):
    return warehouse.clean_customer(view(spark, sf_dir, "customers"))


@query(
    "lost_values",
    f"""
    SELECT cast(0 AS bigint) AS FIRST_NAME, cast(0 AS bigint) AS MIDDLE_NAME, cast(0 AS bigint) AS LAST_NAME,
           count(*) FILTER (WHERE CUST_ZIP IS NOT NULL AND try_cast(CUST_ZIP AS integer) IS NULL) AS CUST_ZIP,
           count(*) FILTER (WHERE CUST_PHONE IS NOT NULL AND length(CUST_PHONE) <> 7) AS CUST_PHONE
    FROM {view_sql('customers')}
    """,
)
def lost_values(spark, sf_dir):
    return warehouse.lost_customer_values(view(spark, sf_dir, "customers"))


KEYS = {"BRANCH": "BRANCH_KEY", "CREDITCARD": "CARD_KEY", "CUSTOMER": "CUST_KEY"}
_LOSSES = {
    "BRANCH": ("branch", {_MASK_10: ("BRANCH_PHONE", ["BRANCH_PHONE"]), _ZIP: ("BRANCH_ZIP", ["BRANCH_ZIP"])}),
    "CREDITCARD": ("card", {_DATE_KEY: ("TIMEID", ["YEAR", "MONTH", "DAY"])}),
    "CUSTOMER": (
        "customers",
        {
            _words_in_title_case("FIRST_NAME"): ("FIRST_NAME", ["FIRST_NAME"]),
            "lower(MIDDLE_NAME)": ("MIDDLE_NAME", ["MIDDLE_NAME"]),
            _words_in_title_case("LAST_NAME"): ("LAST_NAME", ["LAST_NAME"]),
            "try_cast(CUST_ZIP AS integer)": ("CUST_ZIP", ["CUST_ZIP"]),
            _MASK_7: ("CUST_PHONE", ["CUST_PHONE"]),
            _STREET: ("CUST_STREET", ["APT_NO", "STREET_NAME"]),
        },
    ),
}


def lost_sql(name: str) -> str:
    """The originals of all values of a table whose cleaned value is null."""
    source, columns = _LOSSES[name]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, cast({KEYS[name]} AS varchar) AS row_key, '{column}' AS column_name, "
        f"'{part}' AS source_name, cast({part} AS varchar) AS original FROM {view_sql(source)} "
        f"WHERE {part} IS NOT NULL AND ({cleaned}) IS NULL"
        for cleaned, (column, parts) in columns.items()
        for part in parts
    )


@query("clean_branch_lost", lost_sql("BRANCH"))
def clean_branch_lost(spark, sf_dir):
    return lost_records({"BRANCH": warehouse.clean_branch(view(spark, sf_dir, "branch"), record_lost=True)}, KEYS)


@query("clean_card_lost", lost_sql("CREDITCARD"))
def clean_card_lost(spark, sf_dir):
    """A date key without its month is null; year and day are kept here."""
    return lost_records({"CREDITCARD": warehouse.clean_card(view(spark, sf_dir, "card"), record_lost=True)}, KEYS)


@query("clean_customer_lost", lost_sql("CUSTOMER"))
def clean_customer_lost(spark, sf_dir):
    cleaned = warehouse.clean_customer(view(spark, sf_dir, "customers"), record_lost=True)
    return lost_records({"CUSTOMER": cleaned}, KEYS)
