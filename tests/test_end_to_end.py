"""From files as they are delivered to the answers as charts take them."""

from __future__ import annotations

from tablemill.plans import marketplace
from tablemill.plans import questions as Q
from tablemill.sinks.tables import chart_feed
from tablemill.sources.parsing import rejected
from tablemill.sources.records import BENEFITS_COST_SHARING, INSURANCE, NETWORK, PLAN_ATTRIBUTES, SERVICE_AREA
from tablemill.streaming.ingest import landed


def area(year, state, source, name, zips=""):
    return f"{year},{state},1,{source},6,2014-03-19,1,{state},S1,{name},No,,No,{zips},,1,,No"


def benefit(name, state):
    return f"{name}\t2014\t\tCovered\t1\t\t\t\tP1\tHIOS\t{state}"


def person(sex, children, smoker, region):
    return f"40\t{sex}\t25.5\t{children}\t{smoker}\t{region}\t1000.5"


def plan(number):
    return "\t".join(str(number) if i in (0, 1, 2, 3, 4, 13, 19) else f"text {i}" for i in range(43))


FILES = {
    "service_area/a.csv": (
        SERVICE_AREA,
        [
            area(2014, "AK", "HIOS", "North", '"99501, 99502"'), area(2015, "AK", "HIOS", "North"),
            area(2014, "AL", "SERFF", "East"), area(2014, "AL", "HIOS", "\"East, \"\"lower\"\"\""), "short,line",
        ],
    ),
    "benefits_1/a.txt": (BENEFITS_COST_SHARING, [benefit("Dental", "AK"), benefit("Vision", "AK")]),
    "benefits_2/a.txt": (BENEFITS_COST_SHARING, [benefit("Dental", "AK"), benefit("Vision", "AL")]),
    "insurance/a.txt": (
        INSURANCE,
        [person("female", 2, "yes", "ne"), person("female", 0, "yes", "ne"), person("male", 1, "no", "ne"),
         person("female", 1, "yes", "sw"), person("female", 1, "yes", "sw"), person("male", "many", "no", "sw")],
    ),
    "network/a.csv": (NETWORK, ["2014,AK,1,HIOS,6,2014-03-19,1,AK,\"Net, Inc.\",N1,http://x,1,,No"]),
    "plans/a.csv": (PLAN_ATTRIBUTES, [plan(1), plan(2)]),
}


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_delivered_files_to_charts(spark, tmp_path):
    for name, (record, lines) in FILES.items():
        file = tmp_path / name
        file.parent.mkdir(parents=True)
        file.write_text("\n".join([record.header, *lines]) + "\n")
    lake = str(tmp_path / "lake")

    for _ in range(2):
        areas = marketplace.service_area(spark, f"{tmp_path}/service_area", lake)
        benefits = marketplace.benefits_cost_sharing(spark, f"{tmp_path}/benefits_*", lake)
        insurance = marketplace.insurance(spark, f"{tmp_path}/insurance", lake)
        network = marketplace.network(spark, f"{tmp_path}/network", lake)
        plans = marketplace.plan_attributes(spark, f"{tmp_path}/plans", lake)

    assert network.first().NetworkName == "Net, Inc."
    assert sorted(row.AttributesID for row in plans.collect()) == [1, 2]
    assert rows(rejected(landed(spark, SERVICE_AREA, f"{lake}/ServiceArea"))) == [("short,line",)]
    assert rows(rejected(landed(spark, INSURANCE, f"{lake}/Insurance"))) == [(person("male", "many", "no", "sw"),)]

    assert rows(chart_feed(Q.service_areas_per_state(areas), "StateCode")) == [("AK", 1), ("AL", 2)]
    assert rows(chart_feed(Q.sources_by_state(areas), "StateCode")) == [("AK", 2, None), ("AL", 1, 1)]
    assert rows(chart_feed(Q.years_by_state(areas), "StateCode")) == [("AK", 1, 1)]
    assert rows(chart_feed(Q.source_rows_per_state(areas), "StateCode")) == [("AK", 2), ("AL", 2)]
    top = chart_feed(Q.top_benefit_per_state(benefits), "StateCode")
    assert rows(top) == [("AK", "Dental", 2, 3), ("AL", "Vision", 1, 1)]
    assert rows(chart_feed(Q.benefit_rows_per_state(benefits), "StateCode")) == [("AK", 3), ("AL", 1)]
    mothers = rows(Q.smoking_mothers(insurance).orderBy("is_total", "region"))
    assert mothers == [("ne", 1, False), ("sw", 2, False), (None, 3, True)]
    assert rows(Q.region_with_highest_rate(insurance)) == [("sw", 2, 2, 1.0)]
