"""Cleaning expressions on hand-made edge values."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablemill.functions import text as X

TITLES = [
    "o'brien", "mary-jane", "mcDONALD", "", "3rd st", "ß straße", "ǆabc", "ΣΑΣ x", "中a", "éa b",
    "jean\tpaul_x",
    "ﬁne ªb ⅷx", "a.b c", "don’t", "𝐀b 𐐨𐐩", "  two  spaces ", "ALL CAPS", "x", "line\nbreak",
    "\ufdd0 marked \ufdd0text o'brien",
]


def values(spark, column, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(column)], f"i int, v {kind}")
    return [row[0] for row in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_phone_mask_10(spark):
    phones = ["1234567890", "12345", "12345678901", "", None]
    assert values(spark, phones, "string", X.phone_mask_10) == ["(123)456-7890", None, None, None, None]
    lenient = values(spark, phones, "string", lambda c: X.phone_mask_10(c, strict=False))
    assert lenient == ["(123)456-7890", "(123)45-", "(123)456-7890", "()-", None]
    assert values(spark, [1234567890], "bigint", X.phone_mask_10) == ["(123)456-7890"]


def test_phone_mask_7(spark):
    assert values(spark, ["1234567", "12", None], "string", X.phone_mask_7) == ["123-4567", None, None]
    assert values(spark, ["12"], "string", lambda c: X.phone_mask_7(c, strict=False)) == ["12-"]
    assert values(spark, [1234567], "int", X.phone_mask_7) == ["123-4567"]


def test_zip_or_default(spark):
    assert values(spark, ["01234", "Null", None, "null", ""], "string", X.zip_or_default) == [
        "01234", "9999", "9999", "null", ""
    ]
    assert values(spark, [None], "string", lambda c: X.zip_or_default(c, "0000")) == ["0000"]


def test_zero_pad_and_date_key(spark):
    assert values(spark, ["1", "12", "123", "", None], "string", X.zero_pad) == ["01", "12", "123", "", None]
    df = spark.createDataFrame(
        [(0, 2018, 1, 5), (1, 2018, 12, 25), (2, None, 1, 1), (3, 2018, None, 1), (4, 2018, 1, None)],
        "i int, y int, m int, d int",
    )
    keys = df.select("i", X.date_key(F.col("y"), F.col("m"), F.col("d")).alias("k")).orderBy("i").collect()
    assert [row.k for row in keys] == ["2018-01-05", "2018-12-25", None, None, None]


def test_title_case_is_pythons(spark):
    assert values(spark, TITLES + [None], "string", X.title_case) == [t.title() for t in TITLES] + [None]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ'-. 0éÉñß中", max_size=30), min_size=20, max_size=40))
def test_title_case_on_random_text(spark, texts):
    assert values(spark, texts, "string", X.title_case) == [t.title() for t in texts]


def test_lower_case(spark):
    assert values(spark, ["ANNA-Lena", None], "string", X.lower_case) == ["anna-lena", None]


def test_safe_int(spark):
    assert values(spark, ["01234", "abc", "", " 7 ", "1.5", "99999999999", None], "string", X.safe_int) == [
        1234, None, None, 7, None, None, None
    ]


@pytest.mark.parametrize("apartment, street, line", [("12", "Main St", "12, Main St"), (None, "Main St", None)])
def test_street_line(spark, apartment, street, line):
    df = spark.createDataFrame([(apartment, street)], "a string, s string")
    assert df.select(X.street_line(F.col("a"), F.col("s"))).first()[0] == line
