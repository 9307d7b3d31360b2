"""Cleaning of the branch, credit-card and customer tables; one projection each, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.functions import text as X
from tablemill.operators.columns import count_lost, replace_columns
from tablemill.operators.lost_values import replace_and_record
from tablemill.sources.jdbc import WAREHOUSE_TABLES

#: What the columns made of others are made of; those go.
SOURCES = {"TIMEID": ("YEAR", "MONTH", "DAY"), "CUST_STREET": ("APT_NO", "STREET_NAME")}


def branch_columns(strict: bool = True) -> dict[str, Column]:
    return {
        "BRANCH_PHONE": X.phone_mask_10(F.col("BRANCH_PHONE"), strict),
        "BRANCH_ZIP": X.zip_or_default(F.col("BRANCH_ZIP")),
    }


def card_columns() -> dict[str, Column]:
    return {"TIMEID": X.date_key(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))}


def customer_columns(strict: bool = True) -> dict[str, Column]:
    return {
        "FIRST_NAME": X.title_case(F.col("FIRST_NAME")),
        "MIDDLE_NAME": X.lower_case(F.col("MIDDLE_NAME")),
        "LAST_NAME": X.title_case(F.col("LAST_NAME")),
        "CUST_ZIP": X.safe_int(F.col("CUST_ZIP")),
        "CUST_PHONE": X.phone_mask_7(F.col("CUST_PHONE"), strict),
        "CUST_STREET": X.street_line(F.col("APT_NO"), F.col("STREET_NAME")),
    }


def _cleaned(df: DataFrame, new: dict[str, Column], record_lost: bool, drop: tuple[str, ...] = ()) -> DataFrame:
    return replace_and_record(df, new, SOURCES, drop) if record_lost else replace_columns(df, new, drop)


def clean_branch(branch: DataFrame, strict: bool = True, record_lost: bool = False) -> DataFrame:
    """With ``record_lost`` each row has the originals of its values that became null in ``lost_values``."""
    return _cleaned(branch, branch_columns(strict), record_lost)


def clean_card(card: DataFrame, record_lost: bool = False) -> DataFrame:
    return _cleaned(card, card_columns(), record_lost, SOURCES["TIMEID"])


def clean_customer(customer: DataFrame, strict: bool = True, record_lost: bool = False) -> DataFrame:
    return _cleaned(customer, customer_columns(strict), record_lost, SOURCES["CUST_STREET"])


def lost_branch_values(branch: DataFrame) -> DataFrame:
    """How many phone numbers and zips the cleaning turned into null."""
    return count_lost(branch, branch_columns())


def lost_customer_values(customer: DataFrame) -> DataFrame:
    """How many values of each replaced column the cleaning turned into null."""
    replaced = {name: value for name, value in customer_columns().items() if name in customer.columns}
    return count_lost(customer, replaced)


def clean_warehouse(
    tables: Mapping[str, DataFrame], strict: bool = True, record_lost: bool = False
) -> dict[str, DataFrame]:
    """The three cleaned tables under the names they are stored by, from the tables under their source names.

    Loaded with ``record_lost``, a table holds its cleaned rows and the originals of all it could not keep;
    ``lost_records`` lists these, from the frames or from what was loaded."""
    branch, card, customer = (tables[name] for name in WAREHOUSE_TABLES)
    return {
        "BRANCH": clean_branch(branch, strict, record_lost),
        "CUSTOMER": clean_customer(customer, strict, record_lost),
        "CREDITCARD": clean_card(card, record_lost),
    }
