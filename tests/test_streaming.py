"""Streams into landed tables: complete, repeatable, without duplicates."""

from __future__ import annotations

import gzip
import os
import time
from collections import Counter

import pytest

from pyspark.sql import functions as F

from tablemill.plans import marketplace
from tablemill.sinks.batches import BatchStore, append_once
from tablemill.sources.lines import (
    file_line_stream,
    file_stream_options,
    lines_below_header,
    stream_below_header,
    text_lines,
)
from tablemill.sources.parsing import accepted, parse_lines, rejected
from tablemill.sources.records import BENEFITS_COST_SHARING, INSURANCE, SERVICE_AREA
from tablemill.sources.tables import with_row_id
from tablemill.streaming.ingest import ingest_files, ingest_lines, landed
from tablemill.streaming.periods import land_periods, landed_periods

PERSON = "19\tfemale\t27.9\t0\tyes\tsouthwest\t16884.924"


def benefit(name, state):
    return f"{name}\t2014\t\tCovered\t1\t\t\t\tP1\tHIOS\t{state}"


def write(path, header, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(filter(None, [header, *lines])) + "\n")


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_lines_land_once_and_rejects_are_kept(spark, tmp_path):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    write(source / "a.txt", None, PERSON, "broken", PERSON)

    def run():
        return ingest_lines(file_line_stream(spark, str(source)), INSURANCE, target, checkpoint)

    for _ in range(2):
        rows = run()
        assert accepted(rows).count() == 2
        assert [row.value for row in rejected(rows).collect()] == ["broken"]
    write(source / "b.txt", None, PERSON)
    assert accepted(run()).count() == 3
    assert rejected(landed(spark, INSURANCE, target)).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    lines = [PERSON, "19\tmale\t\t0\tno\tne\t1", "", "1\tmale\t1e3\t0\tno\tne\t1"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([INSURANCE.header, *lines]) + "\n")
    stream = file_line_stream(spark, str(tmp_path / "in"), INSURANCE.header)
    streamed = ingest_lines(stream, INSURANCE, str(tmp_path / "t"), str(tmp_path / "cp"))
    batch = parse_lines(text_lines(spark, str(tmp_path / "in"), INSURANCE.header), INSURANCE)
    assert bag(streamed) == bag(batch) == bag(parse_lines(lines_below_header(spark, str(tmp_path / "in")), INSURANCE))
    assert streamed.count() == len(lines)


@pytest.mark.parametrize("record, line", [(INSURANCE, PERSON), (BENEFITS_COST_SHARING, benefit("Dental", "AK"))])
def test_headers_are_known_by_text_and_place(spark, tmp_path, record, line):
    """A first line of another text is rejected, even where it would do as a record; below, the header is a line."""
    wrong = line if record is INSURANCE else record.header.replace("State", "Region")
    texts = {
        "good.txt": [record.header, line, record.header, line],
        "mark.txt": ["\ufeff" + record.header, line],
        "wrong.txt": [wrong, line],
        "blank.txt": ["", line],
        "alone.txt": [record.header],
    }
    (tmp_path / "in").mkdir()
    for name, lines in texts.items():
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
    (tmp_path / "in" / "empty.txt").write_text("")
    batch = parse_lines(text_lines(spark, str(tmp_path / "in"), record.header), record)
    target = str(tmp_path / "t")
    streamed = ingest_files(spark, record, str(tmp_path / "in"), target, str(tmp_path / "cp"), header=record.header)
    assert bag(batch) == bag(streamed)
    n_text_headers = 0 if record is INSURANCE else 1  # a header of texts only is a record of texts
    assert accepted(streamed).count() == 5 + n_text_headers
    kept = sorted(row.value for row in rejected(streamed).collect())
    assert kept == sorted(["", wrong, *([record.header] if record is INSURANCE else [])])


def test_nothing_to_read_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = ingest_files(spark, INSURANCE, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp"))
    assert rows.columns == INSURANCE.landed_schema.names
    assert rows.count() == 0


def test_four_parts_in_one_stream_keep_equal_lines(spark, tmp_path):
    parts = ["one", "two", "three", "four"]
    for part in parts:
        lines = [benefit("Dental", "AK"), benefit(part, "AL")]
        write(tmp_path / f"part_{part}" / "x.txt", BENEFITS_COST_SHARING.header, *lines)
    write(tmp_path / "other" / "x.txt", BENEFITS_COST_SHARING.header, benefit("Other", "AK"))

    for _ in range(2):
        table = marketplace.benefits_cost_sharing(
            spark, f"{tmp_path}/part_*", str(tmp_path / "lake"), maxFilesPerTrigger="1"
        )
    names = Counter(row.BenefitName for row in table.collect())
    assert names == {"Dental": 4, **{part: 1 for part in parts}}


@pytest.mark.parametrize("bound", [{"maxFilesPerTrigger": "1"}, {"maxBytesPerTrigger": "1"}])
def test_batches_are_bounded(spark, tmp_path, bound):
    for i in range(3):
        write(tmp_path / "in" / f"{i}.txt", INSURANCE.header, PERSON)
    stream = stream_below_header(spark, str(tmp_path / "in"), bound)
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "t"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2, 2]  # a file each: its first line and one more


def test_quoted_files_through_a_stream(spark, tmp_path):
    line = '2014,AK,21989,HIOS,6,2014-03-19,21989,AK,AKS001,Area,Yes,,No,"1, 2","says ""no""",12,Dental,No'
    write(tmp_path / "in" / "a.csv", SERVICE_AREA.header, line)
    row = marketplace.service_area(spark, str(tmp_path / "in"), str(tmp_path / "lake")).first()
    assert (row.ZipCodes, row.PartialCountyJustification, row.County) == ("1, 2", 'says "no"', "")


def test_known_headers_are_dropped(spark, tmp_path):
    lines = [benefit("Dental", "AK"), "", "\t" * 10]
    for part in ("one", "two"):
        write(tmp_path / "in" / f"{part}.txt", BENEFITS_COST_SHARING.header)
        with open(tmp_path / "in" / f"{part}.txt", "a") as file:
            file.write("\n".join(lines) + "\n")
    lake = str(tmp_path / "lake")
    table = marketplace.benefits_cost_sharing(spark, str(tmp_path / "in"), lake, header=BENEFITS_COST_SHARING.header)
    assert Counter(row.BenefitName for row in table.collect()) == {"Dental": 2, "": 2}
    kept = rejected(landed(spark, BENEFITS_COST_SHARING, f"{lake}/BenefitsCostSharing")).collect()
    assert [row.value for row in kept] == ["", ""]


def test_compressed_files_and_dated_folders(spark, tmp_path):
    folder = tmp_path / "in" / "day=2014-03-19"
    folder.mkdir(parents=True)
    with gzip.open(folder / "a.txt.gz", "wt") as file:
        file.write(f"{INSURANCE.header}\n{PERSON}\n")
    write(folder / "b.txt", INSURANCE.header, PERSON)
    for name, header in (("one", None), ("two", INSURANCE.header)):
        table = marketplace.insurance(spark, str(tmp_path / "in"), str(tmp_path / name), header=header)
        assert table.columns == INSURANCE.schema.names
        assert table.count() == 2


def test_each_record_type_has_its_own_place(spark, tmp_path):
    write(tmp_path / "people" / "a.txt", INSURANCE.header, PERSON)
    write(tmp_path / "benefits" / "a.txt", BENEFITS_COST_SHARING.header, benefit("Dental", "AK"))
    lake = str(tmp_path / "lake")
    marketplace.insurance(spark, str(tmp_path / "people"), lake)
    marketplace.benefits_cost_sharing(spark, str(tmp_path / "benefits"), lake)
    assert landed(spark, INSURANCE, f"{lake}/Insurance").count() == 1
    assert landed(spark, BENEFITS_COST_SHARING, f"{lake}/BenefitsCostSharing").count() == 1


def test_lines_of_a_stream_from_anywhere(spark, tmp_path):
    """What a Kafka topic delivers has the same shape: one column of text."""
    write(tmp_path / "in" / "a.txt", None, PERSON)
    stream = spark.readStream.text(str(tmp_path / "in")).selectExpr("CAST(value AS BINARY) AS value")
    lines = stream.selectExpr("CAST(value AS STRING) AS value")
    assert marketplace.from_lines(lines, INSURANCE, str(tmp_path / "lake")).count() == 1


def test_forwarding_sends_each_row_once_under_its_own_id(spark, tmp_path):
    lake, target = str(tmp_path / "lake"), str(tmp_path / "collection")
    write(tmp_path / "in" / "a.txt", INSURANCE.header, PERSON, PERSON, "broken")
    for _ in range(2):
        marketplace.insurance(spark, str(tmp_path / "in"), lake)
        marketplace.to_collection(spark, INSURANCE, lake, "json", target=target)
    rows = spark.read.json(target).collect()
    assert len(rows) == 2 and len({row["_id"] for row in rows}) == 2
    write(tmp_path / "in" / "b.txt", INSURANCE.header, PERSON)
    marketplace.insurance(spark, str(tmp_path / "in"), lake)
    marketplace.to_collection(spark, INSURANCE, lake, "json", target=target)
    assert len({row["_id"] for row in spark.read.json(target).collect()}) == 3


def test_a_forwarded_batch_without_its_commit_is_not_appended_again(spark, tmp_path):
    """Neither one that the store has whole, nor one of which it has a part, as after the loss of a writer."""
    lake, target = tmp_path / "lake", str(tmp_path / "collection")
    write(tmp_path / "in" / "a.txt", INSURANCE.header, *[PERSON] * 10)
    marketplace.insurance(spark, str(tmp_path / "in"), str(lake))
    marketplace.to_collection(spark, INSURANCE, str(lake), "json", target=target)
    commits = lake / "_checkpoints" / "Insurance-json" / "commits"

    def forget_and_rerun():
        for name in ("0", ".0.crc"):
            (commits / name).unlink()
        marketplace.to_collection(spark, INSURANCE, str(lake), "json", target=target)
        return [row["_id"] for row in spark.read.json(target).collect()]

    ids = forget_and_rerun()
    assert len(ids) == 10 and len(set(ids)) == 10
    rows = spark.read.schema(f"_id string, _batch string, {INSURANCE.schema.toDDL()}").json(target)
    rows.where(F.col("_id").isin(ids[:4])).write.json(str(tmp_path / "part"))
    spark.read.schema(rows.schema).json(str(tmp_path / "part")).write.mode("overwrite").json(target)
    assert spark.read.json(target).count() == 4
    assert sorted(forget_and_rerun()) == sorted(ids)


def test_batches_of_other_streams_and_numbers_are_no_repeats(spark, tmp_path):
    store = BatchStore("parquet", str(tmp_path / "store"))
    rows = spark.createDataFrame([("x", 1), ("y", 2)], "_id string, v int")
    for batch in ("one:0", "one:0", "one:1", "two:0"):
        append_once(rows, batch, store)
    assert bag(spark.read.parquet(store.location).groupBy("_batch", "_id").count().drop("_id")) == {
        ("one:0", 1): 2, ("one:1", 1): 2, ("two:0", 1): 2
    }
    append_once(rows.limit(0), "three:0", store)
    append_once(rows, "four:0", BatchStore("json", str(tmp_path / "new")))
    assert spark.read.json(str(tmp_path / "new")).count() == 2


def test_periods_land_apart_and_late_files_still_land(spark, tmp_path):
    source, lake = tmp_path / "in", str(tmp_path / "lake")
    for period in ("2014-01", "2014-02", "2014-03"):
        write(source / period / "a.txt", INSURANCE.header, PERSON)
    (source / "_not_a_period").mkdir()
    rows = land_periods(spark, INSURANCE, str(source), lake)
    assert Counter(row.period for row in rows.collect()) == {"2014-01": 1, "2014-02": 1, "2014-03": 1}
    write(source / "2014-01" / "late.txt", INSURANCE.header, PERSON, "broken")
    write(source / "2014-03" / "b.txt", INSURANCE.header, PERSON)
    only = land_periods(spark, INSURANCE, str(source), lake, periods=["2014-03"])
    assert Counter(row.period for row in only.collect()) == {"2014-01": 1, "2014-02": 1, "2014-03": 2}
    for _ in range(2):
        rows = land_periods(spark, INSURANCE, str(source), lake)
        assert Counter(row.period for row in accepted(rows).collect()) == {"2014-01": 2, "2014-02": 1, "2014-03": 2}
    assert [row.value for row in rejected(rows).collect()] == ["broken"]
    assert landed_periods(spark, INSURANCE, lake, ["2014-02"]).count() == 1
    logged = [p.name for p in (tmp_path / "lake/_checkpoints/Insurance").iterdir()]
    assert sorted(logged) == ["2014-01", "2014-02", "2014-03"]
    nothing = land_periods(spark, INSURANCE, str(tmp_path / "none"), str(tmp_path / "other"))
    assert nothing.count() == 0 and nothing.columns == [*INSURANCE.landed_schema.names, "period"]


def test_rows_of_a_batch_that_was_never_committed_do_not_show(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    write(source / "p1" / "a.txt", INSURANCE.header, PERSON)
    land_periods(spark, INSURANCE, str(source), str(lake))
    (stray,) = [p for p in (lake / "Insurance/p1").iterdir() if p.suffix == ".parquet"]
    (lake / "Insurance/p1" / "part-stray.parquet").write_bytes(stray.read_bytes())
    assert landed_periods(spark, INSURANCE, str(lake)).count() == 1


def test_row_ids_are_the_same_each_time(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t"))
    ids = [bag(with_row_id(spark.read.parquet(str(tmp_path / "t")))) for _ in range(2)]
    assert ids[0] == ids[1]
    assert len({row[0] for row in ids[0]}) == 1000


def test_a_late_file_with_an_old_date_is_read(spark, tmp_path):
    source, lake = tmp_path / "in", str(tmp_path / "lake")
    for name in ("a", "b"):
        write(source / f"{name}.txt", INSURANCE.header, PERSON)
        assert marketplace.insurance(spark, str(source), lake, maxFilesPerTrigger="1").count() >= 1
    write(source / "late.txt", INSURANCE.header, PERSON)
    month_ago = time.time() - 30 * 24 * 3600
    os.utime(source / "late.txt", (month_ago, month_ago))
    assert marketplace.insurance(spark, str(source), lake, maxFilesPerTrigger="1").count() == 3


def test_a_run_that_died_before_its_commit_adds_nothing_twice(spark, tmp_path):
    """The batch was written but not noted as done, as after the loss of the driver."""
    source, lake = tmp_path / "in", tmp_path / "lake"
    write(source / "a.txt", INSURANCE.header, PERSON, PERSON)
    assert marketplace.insurance(spark, str(source), str(lake)).count() == 2
    commits = lake / "_checkpoints" / "Insurance" / "commits"
    for name in ("0", ".0.crc"):
        (commits / name).unlink()
    assert marketplace.insurance(spark, str(source), str(lake)).count() == 2
    write(source / "b.txt", INSURANCE.header, PERSON)
    assert marketplace.insurance(spark, str(source), str(lake)).count() == 3


def test_batches_have_a_bound_unless_one_is_given():
    assert file_stream_options()["maxFilesPerTrigger"] == "10000"
    assert file_stream_options({"maxFilesPerTrigger": "5"})["maxFilesPerTrigger"] == "5"
    assert "maxFilesPerTrigger" not in file_stream_options({"maxBytesPerTrigger": "1g"})
