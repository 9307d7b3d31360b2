"""Lines to records: every way in which a line can fit or not."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plan_text import physical_plan
from pyspark.sql import types as T

from tablemill.sources import parsing
from tablemill.sources.lines import lines_below_header, text_lines
from tablemill.sources.parsing import accepted, parse_lines, rejected
from tablemill.sources.records import (
    BENEFITS_COST_SHARING,
    INSURANCE,
    NETWORK,
    PLAN_ATTRIBUTES,
    RECORD_TYPES,
    REJECTED_LINE,
    SERVICE_AREA,
    RecordType,
)


def record_files(spark, record, path):
    return parse_lines(lines_below_header(spark, path), record)


def lines_of(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def good(spark, record, *lines):
    return [tuple(row) for row in accepted(parse_lines(lines_of(spark, *lines), record)).collect()]


def bad(spark, record, *lines):
    return sorted(row.value for row in rejected(parse_lines(lines_of(spark, *lines), record)).collect())


def test_declared_records():
    sizes = {name: len(record.schema.fields) for name, record in RECORD_TYPES.items()}
    assert sizes == {
        "PlanAttributes": 43, "Network": 14, "ServiceArea": 18, "Insurance": 7, "BenefitsCostSharing": 11
    }
    numbers = {
        name: [f.name for f in record.schema.fields if f.dataType.simpleString() != "string"]
        for name, record in RECORD_TYPES.items()
    }
    assert numbers["PlanAttributes"] == [
        "AttributesID",
        "BeginPrimaryCareCostSharingAfterNumberOfVisits",
        "BeginPrimaryCareDeductibleCoinsuranceAfterNumberOfCopays",
        "BenefitPackageId",
        "BusinessYear",
        "InpatientCopaymentMaximumDays",
        "IssuerId",
    ]
    assert numbers["Network"] == ["BusinessYear", "IssuerId", "VersionNum", "IssuerId2"]
    assert numbers["ServiceArea"] == ["BusinessYear", "IssuerId"]
    assert numbers["Insurance"] == ["age", "bmi", "children", "charges"]
    assert numbers["BenefitsCostSharing"] == []


def test_insurance_line(spark):
    assert good(spark, INSURANCE, "19\tfemale\t27.9\t0\tyes\tsouthwest\t16884.924") == [
        (19, "female", 27.9, 0, "yes", "southwest", 16884.924)
    ]


@pytest.mark.parametrize(
    "line",
    [
        "19\tfemale\t27.9\t0\tyes\tsouthwest",  # too few fields
        "19\tfemale\t27.9\t0\tyes\tsouthwest\t1.0\tmore",  # too many
        "x19\tfemale\t27.9\t0\tyes\tsouthwest\t1.0",  # text in a number field
        "\tfemale\t27.9\t0\tyes\tsouthwest\t1.0",  # empty number
        "19\tfemale\t27.9\t0.5\tyes\tsouthwest\t1.0",  # fraction in an integer field
        "",  # empty line
    ],
)
def test_lines_that_do_not_fit(spark, line):
    assert good(spark, INSURANCE, line) == []
    assert bad(spark, INSURANCE, line) == [line]


def test_message_without_text_is_rejected(spark):
    assert good(spark, BENEFITS_COST_SHARING, None) == []
    assert bad(spark, BENEFITS_COST_SHARING, None) == [""]


def test_numbers_may_have_blanks_around_them(spark):
    assert good(spark, INSURANCE, " 19 \tfemale\t 27.9\t0\tyes\tsouthwest\t1")[0][:3] == (19, "female", 27.9)


def test_empty_text_stays_empty_text(spark):
    line = "Dental\t2014\t\tCovered\t1\t\t\t\tP1\tHIOS\t"
    assert good(spark, BENEFITS_COST_SHARING, line) == [
        ("Dental", "2014", "", "Covered", "1", "", "", "", "P1", "HIOS", "")
    ]
    assert good(spark, BENEFITS_COST_SHARING, "\t" * 10) == [("",) * 11]
    assert bad(spark, BENEFITS_COST_SHARING, "\t" * 9, "\t" * 11, "") == ["", "\t" * 9, "\t" * 11]


def test_quotes_and_backslashes_are_plain_text_between_tabs(spark):
    line = '"lone\t2014\ta"b\t"q"\tc\\\td\\"\t\\n\t"\tP\t""\tAK'
    assert good(spark, BENEFITS_COST_SHARING, line) == [tuple(line.split("\t"))]


def service_area_line(zip_codes, justification="", year="2014"):
    return f"{year},AK,21989,HIOS,6,2014-03-19,21989,AK,AKS001,Area,Yes,,No,{zip_codes},{justification},12,Dental,No"


def test_quoted_commas_and_doubled_quotes(spark):
    row = good(spark, SERVICE_AREA, service_area_line('"99501, 99502"', '"says ""no"""'))[0]
    assert (row[0], row[13], row[14], row[17]) == (2014, "99501, 99502", 'says "no"', "No")
    assert row[11] == ""
    unquoted = service_area_line("99501, 99502")
    assert bad(spark, SERVICE_AREA, unquoted) == [unquoted]


def test_network_line(spark):
    line = "2014,AK,21989,HIOS,6,2014-03-19 07:06:49,21989,AK,Dental Net,AKN001,http://x,13,,No"
    assert good(spark, NETWORK, line) == [
        (2014, "AK", 21989, "HIOS", 6, "2014-03-19 07:06:49", 21989, "AK", "Dental Net", "AKN001", "http://x", "13",
         "", "No")
    ]


def test_plan_attributes_line(spark):
    fields = [f"t{i}" for i in range(43)]
    for i in (0, 1, 2, 3, 4, 13, 19):
        fields[i] = str(i + 100)
    expected = tuple(int(f) if f.isdigit() else f for f in fields)
    assert good(spark, PLAN_ATTRIBUTES, "\t".join(fields)) == [expected]


def test_files_lose_their_first_line_whatever_it_says(spark, tmp_path):
    line = "19\tfemale\t27.9\t0\tyes\tsouthwest\t1.5"
    (tmp_path / "a.txt").write_text(f"Some Other Header\n{line}\n{line}\n")
    (tmp_path / "b.txt").write_text(f"{INSURANCE.header}\n{line}\nbroken\n")
    rows = record_files(spark, INSURANCE, str(tmp_path))
    assert accepted(rows).count() == 3
    assert [row.value for row in rejected(rows).collect()] == ["broken"]


def test_rejected_file_lines_keep_their_text(spark, tmp_path):
    wrong_year = service_area_line('"99501, 99502"', '"says ""no"""', year="soon")
    no_year = service_area_line("1", year="")
    lines = [SERVICE_AREA.header, wrong_year, no_year, service_area_line("2")]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    rows = record_files(spark, SERVICE_AREA, str(tmp_path))
    assert sorted(row.value for row in rejected(rows).collect()) == sorted([wrong_year, no_year])
    assert accepted(rows).count() == 1


def test_rejects_do_not_depend_on_the_columns_in_use(spark, tmp_path):
    (tmp_path / "a.txt").write_text(f"{INSURANCE.header}\nx\tf\t1.0\t0\tyes\tne\t1.0\n1\tf\t1.0\t0\tyes\tne\t1.0\n")
    rows = record_files(spark, INSURANCE, str(tmp_path))
    assert accepted(rows).select("sex").count() == 1
    assert accepted(rows).count() == 1
    assert rejected(rows).count() == 1


def test_lines_with_any_character_stay_whole(spark, tmp_path):
    lines = ["a\ufdd0b\ufdd0c", "\x00a\x00", '"x', "  y  ", "#z", "\\", "\tq\t", "a\ufdd1b"]
    (tmp_path / "a.txt").write_text("\n".join(["header", *lines]) + "\n")
    assert [row.value for row in lines_below_header(spark, str(tmp_path)).collect()] == lines


def test_a_file_in_many_splits_loses_one_line_only(spark, tmp_path):
    lines = [f"{i}\tfemale\t27.9\t0\tyes\tsouthwest\t1.5" for i in range(500)]
    (tmp_path / "a.txt").write_text("\n".join(["header", *lines]) + "\n")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    settings_before = {name: spark.conf.get(name) for name in names}
    for name in settings_before:
        spark.conf.set(name, "512b")
    try:
        found = lines_below_header(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 20
        assert sorted(row.value for row in found.collect()) == sorted(lines)
    finally:
        for name, value in settings_before.items():
            spark.conf.set(name, value)


def test_very_many_fields_do_not_fail_the_job(spark):
    tabs, commas = "\t" * 300_000, "," * 300_000
    assert bad(spark, INSURANCE, tabs) == [tabs]
    assert bad(spark, SERVICE_AREA, commas) == [commas]
    many_zips = ", ".join(str(i) for i in range(30_000))
    assert good(spark, SERVICE_AREA, service_area_line(f'"{many_zips}"'))[0][13] == many_zips
    all_text = RecordType("Pairs", "a string, b string", ",", quoted=True)
    assert good(spark, all_text, f'x,"{commas}"') == [("x", commas)]
    doubled = '""' * 300_000
    assert good(spark, all_text, f'x,"{doubled}"') == [("x", '"' * 300_000)]
    assert bad(spark, all_text, f'x,"y"{commas}') == [f'x,"y"{commas}']
    assert good(spark, all_text, 'x,"y, z"', "x,y", ",") == [("x", "y, z"), ("x", "y"), ("", "")]
    assert bad(spark, all_text, "", '"', "x") == ["", '"', "x"]


def test_line_breaks_inside_a_message_are_text(spark):
    for last in ("No\nextra", "No\r\n", "\n"):
        line = service_area_line("1\n2").removesuffix("No") + last
        row = good(spark, SERVICE_AREA, line)[0]
        assert (row[13], row[17]) == ("1\n2", last)
    fields = [f"a\n{i}\r" for i in range(11)]
    assert good(spark, BENEFITS_COST_SHARING, "\t".join(fields)) == [tuple(fields)]


def test_text_lines_drop_a_known_header(spark, tmp_path):
    line = "19\tfemale\t27.9\t0\tyes\tsouthwest\t1.5"
    for name, mark in (("a", ""), ("b", "\ufeff")):
        (tmp_path / f"{name}.txt").write_text(f"{mark}{INSURANCE.header}\r\n{line}\r\n", newline="")
    assert [row.value for row in text_lines(spark, str(tmp_path), INSURANCE.header).collect()] == [line] * 2
    assert text_lines(spark, str(tmp_path)).count() == 4


def test_both_ways_of_reading_agree(spark, tmp_path):
    lines = [
        service_area_line('"99501, 99502"', '"says ""no"""'), service_area_line(""), service_area_line("1", year="x"),
        "short,line", service_area_line("  blanks  ", " b "),
    ]
    (tmp_path / "a.csv").write_text("\n".join([SERVICE_AREA.header, *lines]) + "\n")
    from_files = record_files(spark, SERVICE_AREA, str(tmp_path))
    from_lines = parse_lines(lines_of(spark, *lines), SERVICE_AREA)
    for pick in (accepted, rejected):
        assert sorted(map(str, pick(from_files).collect())) == sorted(map(str, pick(from_lines).collect()))


def test_a_record_may_have_a_field_named_value(spark):
    record = RecordType("Pairs", "id bigint, value string", ",", quoted=True)
    assert good(spark, record, "1,a") == [(1, "a")]


@pytest.mark.parametrize("separator", ["|", ".", ";", "\\", "||"])
def test_separators_are_plain_text(spark, separator):
    record = RecordType("Pairs", "id bigint, a string, b string", separator, quoted=False)
    assert good(spark, record, separator.join(["1", "x,y", ""])) == [(1, "x,y", "")]
    assert bad(spark, record, separator.join(["1", "x"])) == [separator.join(["1", "x"])]


def test_filters_do_not_cut_lines_again(spark):
    plan = physical_plan(accepted(parse_lines(lines_of(spark, "x"), INSURANCE)).where("smoker = 'yes'"))
    assert plan.count("split(") == 1, plan
    quoted = physical_plan(accepted(parse_lines(lines_of(spark, "x"), SERVICE_AREA)).where("StateCode = 'AK'"))
    assert quoted.count("from_csv") == 1, quoted
    for word in ("EvalPython", "Exchange"):
        assert word not in plan + quoted


def test_reject_column_comes_last():
    assert INSURANCE.landed_schema.names[-1] == REJECTED_LINE


PIECE = st.text(alphabet='ab"\\,\' é', max_size=4)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(PIECE, min_size=9, max_size=13), min_size=20, max_size=40))
def test_tab_lines_cut_as_plain_python_does(spark, pieces):
    lines = ["\t".join(fields) for fields in pieces]
    expected = sorted(tuple(fields) for fields in pieces if len(fields) == 11)
    assert sorted(good(spark, BENEFITS_COST_SHARING, *lines)) == expected
    assert bad(spark, BENEFITS_COST_SHARING, *lines) == sorted(
        line for line, fields in zip(lines, pieces) if len(fields) != 11
    )


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(PIECE, PIECE), min_size=20, max_size=40))
def test_quoted_fields_come_back_as_written(spark, pairs):
    quoted = [tuple('"' + text.replace('"', '""') + '"' for text in pair) for pair in pairs]
    rows = good(spark, SERVICE_AREA, *(service_area_line(zips, reason) for zips, reason in quoted))
    assert sorted((row[13], row[14]) for row in rows) == sorted(pairs)


@pytest.mark.parametrize("text", ["1.5d", "1.5f", "0x1p3", "1e", ".", "+", "1 2"])
def test_texts_that_are_no_numbers(spark, text):
    numbers = RecordType("Numbers", "a double", ",", quoted=False)
    assert bad(spark, numbers, text) == [text]


def test_texts_that_are_numbers(spark):
    numbers = RecordType("Numbers", "a double", ",", quoted=False)
    assert good(spark, numbers, " 1.5 ", "-.5e1", "5.", "+7", "inf") == [(1.5,), (-5.0,), (5.0,), (7.0,), (float("inf"),)]


def test_blank_lines_stay(spark, tmp_path):
    """Only the first line of a file goes, also where it is blank or the file is read in pieces."""
    (tmp_path / "a").write_text("h\n" + "\t" * 10 + "\n   \n\nA\tb\n")
    (tmp_path / "b").write_text("\nfirst\nsecond\n")
    (tmp_path / "c").write_text("head\n" + "".join(f"line {i}\n" for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = sorted(row.value for row in lines_below_header(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(["\t" * 10, "   ", "", "A\tb", "first", "second", *(f"line {i}" for i in range(2000))])


def test_texts_that_a_cast_takes_are_no_numbers(spark):
    taken = ["1", " 1 ", "+1", "-1.5", ".5", "5.", "1e3", "1E-3", "nan", "inf", "\t3\n", "1.0"]
    odd = ["1.5d", "2f", "2F", "0x1p3", "0X1P3", "1_0", "1,0", "", " ", "x", "1 2", "\u00015", "5\u007f", "\u00a05", "１", "1e"]
    rows = spark.createDataFrame([(t,) for t in taken + odd], "t string")
    got = rows.select("t", parsing._number(T.StructField("t", T.DoubleType())).alias("n")).collect()
    assert [r.t for r in got if r.n is not None] == taken


def test_a_line_of_very_many_fields_is_rejected_whatever_its_quotes(spark):
    lines = ["," * 50_000, '"a"' + ",x" * 50_000, '"' + "," * 50_000, '"' + "a," * 30_000 + '",1']
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r.value for r in rejected(parse_lines(frame, NETWORK)).collect()) == sorted(lines)
