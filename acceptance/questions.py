"""The eight questions, asked of the test tables as :mod:`acceptance.crosswalk` presents them."""

from __future__ import annotations

from acceptance.crosswalk import view, view_sql
from acceptance.registry import query
from tablemill.plans import questions as Q

_AREAS = view_sql("service_area")
_BENEFITS = view_sql("benefits")
_INSURANCE = view_sql("insurance")
_SOURCES = ["F", "O", "P"]
_YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


def _counters(column: str, values: list) -> str:
    return ", ".join(f"nullif(count(*) FILTER (WHERE {column} = '{v}'), 0) AS \"{v}\"" for v in values)


@query(
    "question_a1",
    f"SELECT StateCode, count(DISTINCT ServiceAreaName) AS ServiceAreaName FROM {_AREAS} GROUP BY StateCode",
)
def question_a1(spark, sf_dir):
    return Q.service_areas_per_state(view(spark, sf_dir, "service_area"))


@query("question_a2", f"SELECT StateCode, {_counters('SourceName', _SOURCES)} FROM {_AREAS} GROUP BY StateCode")
def question_a2(spark, sf_dir):
    return Q.sources_by_state(view(spark, sf_dir, "service_area"))


@query(
    "question_a3",
    f"""
    SELECT * FROM (SELECT StateCode, {_counters('BusinessYear', _YEARS)} FROM {_AREAS} GROUP BY StateCode)
    WHERE {' AND '.join(f'"{year}" IS NOT NULL' for year in _YEARS)}
    """,
)
def question_a3(spark, sf_dir):
    return Q.years_by_state(view(spark, sf_dir, "service_area"), _YEARS)


@query("question_b", f"SELECT StateCode, count(SourceName) AS SourceName FROM {_AREAS} GROUP BY StateCode")
def question_b(spark, sf_dir):
    return Q.source_rows_per_state(view(spark, sf_dir, "service_area"))


@query(
    "question_c",
    f"""
    SELECT StateCode, BenefitName, n AS "count", TotalCustomers FROM (
        SELECT StateCode, BenefitName, count(*) AS n,
               cast(sum(count(*)) OVER (PARTITION BY StateCode) AS bigint) AS TotalCustomers,
               row_number() OVER (PARTITION BY StateCode ORDER BY count(*) DESC, BenefitName) AS place
        FROM {_BENEFITS} GROUP BY StateCode, BenefitName)
    WHERE place = 1
    """,
)
def question_c(spark, sf_dir):
    return Q.top_benefit_per_state(view(spark, sf_dir, "benefits"))


@query("question_d", f"SELECT StateCode, count(BenefitName) AS BenefitName FROM {_BENEFITS} GROUP BY StateCode")
def question_d(spark, sf_dir):
    return Q.benefit_rows_per_state(view(spark, sf_dir, "benefits"))


@query(
    "question_d_distinct",
    f"SELECT StateCode, count(DISTINCT BenefitName) AS BenefitName FROM {_BENEFITS} GROUP BY StateCode",
)
def question_d_distinct(spark, sf_dir):
    return Q.distinct_benefits_per_state(view(spark, sf_dir, "benefits"))


@query(
    "question_e",
    f"""
    SELECT region, count(*) AS mothers, grouping(region) = 1 AS is_total FROM {_INSURANCE}
    WHERE smoker = 'yes' AND sex = 'female' AND children > 0 GROUP BY ROLLUP (region)
    """,
)
def question_e(spark, sf_dir):
    return Q.smoking_mothers(view(spark, sf_dir, "insurance"))


@query("question_f_answers", f"SELECT region, {_counters('smoker', ['no', 'yes'])} FROM {_INSURANCE} GROUP BY region")
def question_f_answers(spark, sf_dir):
    return Q.persons_by_smoking(view(spark, sf_dir, "insurance"), ["no", "yes"])


@query(
    "question_f_counts",
    f"SELECT region, count(*) AS smokers FROM {_INSURANCE} WHERE smoker = 'yes' GROUP BY region",
)
def question_f_counts(spark, sf_dir):
    return Q.smokers_per_region(view(spark, sf_dir, "insurance"))


_RATES = f"""
    SELECT region, count(*) FILTER (WHERE smoker = 'yes') AS n_match, count(smoker) AS n_known,
           cast(count(*) FILTER (WHERE smoker = 'yes') AS double) / count(smoker) AS rate
    FROM {_INSURANCE} GROUP BY region
"""


@query("question_f_rates", _RATES)
def question_f_rates(spark, sf_dir):
    return Q.smoker_rate_per_region(view(spark, sf_dir, "insurance"))


@query("question_f_highest", f"{_RATES} ORDER BY rate DESC, region LIMIT 1")
def question_f_highest(spark, sf_dir):
    return Q.region_with_highest_rate(view(spark, sf_dir, "insurance"))
