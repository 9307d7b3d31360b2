"""The eight questions on the landed tables; each is one grouped job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.operators.counting import (
    count_by_key,
    distinct_by_key,
    filtered_count,
    rate_by_key,
    top_rate,
    with_total,
)
from tablemill.operators.pivots import pivot_counts
from tablemill.operators.ranking import top_name_with_total

# Column names and the answers counted in the questions.
STATE = "StateCode"
REGION = "region"
SMOKER = "smoker"
YES = "yes"
FEMALE = "female"


def service_areas_per_state(service_area: DataFrame) -> DataFrame:
    """A1: different service area names per state."""
    return distinct_by_key(service_area, [STATE], "ServiceAreaName", name="ServiceAreaName")


def sources_by_state(service_area: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """A2: rows per state, one column per source; a state without a source shows null there."""
    return pivot_counts(service_area, STATE, "SourceName", sources)


def years_by_state(service_area: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """A3: rows per state, one column per year, for the states that have every year."""
    return pivot_counts(service_area, STATE, "BusinessYear", years, complete=True)


def source_rows_per_state(service_area: DataFrame) -> DataFrame:
    """B: rows with a source per state."""
    return count_by_key(service_area, [STATE], "SourceName", name="SourceName")


def top_benefit_per_state(benefits: DataFrame) -> DataFrame:
    """C: per state the benefit with the most rows, that number, and the state's number of rows."""
    return top_name_with_total(benefits, STATE, "BenefitName", count_name="count", total_name="TotalCustomers")


def benefit_rows_per_state(benefits: DataFrame) -> DataFrame:
    """D: rows with a benefit name per state."""
    return count_by_key(benefits, [STATE], "BenefitName", name="BenefitName")


def distinct_benefits_per_state(benefits: DataFrame) -> DataFrame:
    """D, the other reading: different benefit names per state."""
    return distinct_by_key(benefits, [STATE], "BenefitName", name="BenefitName")


def smoking_mothers(insurance: DataFrame) -> DataFrame:
    """E: women who smoke and have children, per region and in total."""
    condition = (F.col(SMOKER) == YES) & (F.col("sex") == FEMALE) & (F.col("children") > 0)
    return with_total(filtered_count(insurance, condition, [REGION], name="mothers"), REGION, name="mothers")


def persons_by_smoking(insurance: DataFrame, answers: Sequence[str] | None = None) -> DataFrame:
    """F as counted: rows per region, one column per answer to the smoking question."""
    return pivot_counts(insurance, REGION, SMOKER, answers)


def smokers_per_region(insurance: DataFrame) -> DataFrame:
    """F as charted: smokers per region that has any."""
    return filtered_count(insurance, F.col(SMOKER) == YES, [REGION], name="smokers")


def smoker_rate_per_region(insurance: DataFrame) -> DataFrame:
    """F as asked: smokers, persons and the share of smokers per region."""
    return rate_by_key(insurance, [REGION], SMOKER, YES)


def region_with_highest_rate(insurance: DataFrame) -> DataFrame:
    """F: the region that answers the question."""
    return top_rate(smoker_rate_per_region(insurance), [REGION])
