"""The eight questions on hand-made rows that hold every case they must tell apart."""

from __future__ import annotations

import pytest

from tablemill.plans import questions as Q
from tablemill.sources.parsing import accepted, parse_lines
from tablemill.sources.records import BENEFITS_COST_SHARING, INSURANCE


def as_dict(result):
    return {row[0]: row[1] if len(row) == 2 else tuple(row[1:]) for row in result.collect()}


@pytest.fixture(scope="module")
def areas(spark):
    rows = [
        ("AK", "North", "HIOS", 2014), ("AK", "North", "HIOS", 2015), ("AK", "South", "SERFF", 2016),
        ("AK", None, None, 2016),
        ("AL", "East", "OPM", 2014), ("AL", "East", "HIOS", 2015),
        ("AZ", None, "SERFF", 2014), ("AZ", "West", "SERFF", 2015), ("AZ", "West", "NEW", 2016),
        (None, "Lost", "HIOS", 2014),
    ]
    schema = "StateCode string, ServiceAreaName string, SourceName string, BusinessYear bigint"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def benefits(spark):
    rows = [("AK", "Dental"), ("AK", "Dental"), ("AK", "Vision"), ("AL", "Vision"), ("AL", "Dental"),
            ("AZ", None), ("AZ", None), ("AZ", "Dental"), (None, "Dental")]
    return spark.createDataFrame(rows, "StateCode string, BenefitName string")


@pytest.fixture(scope="module")
def insurance(spark):
    rows = [
        ("female", 2, "yes", "ne"), ("female", 0, "yes", "ne"), ("male", 3, "yes", "ne"), ("male", 0, "yes", "ne"),
        ("female", 1, "no", "ne"), ("male", 1, "no", "ne"), ("male", 1, "no", "ne"), ("female", 1, "no", "ne"),
        ("female", 1, "yes", "sw"), ("female", 2, "yes", "sw"), ("male", 1, "no", "sw"),
        ("female", 1, "no", "se"),
        ("female", 1, "yes", None),
    ]
    return spark.createDataFrame(rows, "sex string, children bigint, smoker string, region string")


def test_a1(areas):
    assert as_dict(Q.service_areas_per_state(areas)) == {"AK": 2, "AL": 1, "AZ": 1}


def test_a2(areas):
    wide = Q.sources_by_state(areas)
    assert wide.columns == ["StateCode", "HIOS", "NEW", "OPM", "SERFF"]
    assert as_dict(wide) == {"AK": (2, None, None, 1), "AL": (1, None, 1, None), "AZ": (None, 1, None, 2)}


def test_a3(areas):
    wide = Q.years_by_state(areas)
    assert wide.columns == ["StateCode", "2014", "2015", "2016"]
    assert as_dict(wide) == {"AK": (1, 1, 2), "AZ": (1, 1, 1)}
    assert as_dict(Q.years_by_state(areas, [2014, 2015])) == {"AK": (1, 1), "AL": (1, 1), "AZ": (1, 1)}


def test_b(areas):
    assert as_dict(Q.source_rows_per_state(areas)) == {"AK": 3, "AL": 2, "AZ": 3}


def test_c(benefits):
    result = Q.top_benefit_per_state(benefits)
    assert result.columns == ["StateCode", "BenefitName", "count", "TotalCustomers"]
    assert as_dict(result) == {"AK": ("Dental", 2, 3), "AL": ("Dental", 1, 2), "AZ": (None, 2, 3)}


def test_d(benefits):
    assert as_dict(Q.benefit_rows_per_state(benefits)) == {"AK": 3, "AL": 2, "AZ": 1}
    assert as_dict(Q.distinct_benefits_per_state(benefits)) == {"AK": 2, "AL": 2, "AZ": 1}


def test_e(insurance):
    rows = {(r.region, r.mothers, r.is_total) for r in Q.smoking_mothers(insurance).collect()}
    assert rows == {("ne", 1, False), ("sw", 2, False), (None, 3, True)}


def test_f(insurance):
    assert as_dict(Q.persons_by_smoking(insurance)) == {"ne": (4, 4), "sw": (1, 2), "se": (1, None)}
    assert as_dict(Q.smokers_per_region(insurance)) == {"ne": 4, "sw": 2}
    rates = as_dict(Q.smoker_rate_per_region(insurance))
    assert rates == {"ne": (4, 8, 0.5), "sw": (2, 3, 2 / 3), "se": (0, 1, 0.0)}
    assert Q.region_with_highest_rate(insurance).first().region == "sw"


def test_questions_on_parsed_lines(spark):
    """Empty text counts as present, as it does in the source files."""
    lines = ["Dental\t2014\t\t\t1\t\t\t\tP\tHIOS\tAK", "\t2014\t\t\t1\t\t\t\tP\tHIOS\tAK"]
    parsed = accepted(parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), BENEFITS_COST_SHARING))
    assert as_dict(Q.benefit_rows_per_state(parsed)) == {"AK": 2}
    people = ["30\tfemale\t20.5\t1\tyes\tne\t100.0", "30\tmale\t20.5\t1\tyes\tne\t100.0", "x\tmale\t1\t1\tyes\tne\t1"]
    parsed = accepted(parse_lines(spark.createDataFrame([(x,) for x in people], "value string"), INSURANCE))
    assert {(r.region, r.mothers) for r in Q.smoking_mothers(parsed).collect()} == {("ne", 1), (None, 1)}
