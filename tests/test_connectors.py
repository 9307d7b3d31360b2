"""Options given to systems that are not here, and the shared folder."""

from __future__ import annotations

from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException

from tablemill.plans import marketplace
from tablemill.session import CHECKPOINT_DIR, shared_dir
from tablemill.sinks.kafka import encoded, publish_lines, publish_options
from tablemill.sinks.tables import append_collections, connector_options
from tablemill.sources.jdbc import WAREHOUSE_TABLES, Connection, Split, jdbc_options, jdbc_table, jdbc_tables
from tablemill.sources.lines import decoded, kafka_line_stream, kafka_options
from tablemill.sources.records import RECORD_TYPES

DATABASE = Connection("jdbc:mysql://db.example:3306/cdw", "com.mysql.cj.jdbc.Driver", user="reader", password="secret")


def test_jdbc_options():
    assert jdbc_options(DATABASE, "CDW_SAPP_BRANCH") == {
        "url": "jdbc:mysql://db.example:3306/cdw",
        "driver": "com.mysql.cj.jdbc.Driver",
        "dbtable": "CDW_SAPP_BRANCH",
        "user": "reader",
        "password": "secret",
        "fetchsize": "10000",
    }
    split = jdbc_options(Connection("jdbc:x", "d"), "T", Split("ID", 1, 1000, 20))
    assert split == {
        "url": "jdbc:x", "driver": "d", "fetchsize": "10000", "dbtable": "T", "partitionColumn": "ID",
        "lowerBound": "1", "upperBound": "1000", "numPartitions": "20",
    }
    assert WAREHOUSE_TABLES == ("CDW_SAPP_BRANCH", "CDW_SAPP_CREDITCARD", "CDW_SAPP_CUSTOMER")


def test_jdbc_split_and_predicates_exclude_each_other(spark):
    with pytest.raises(ValueError):
        jdbc_table(spark, DATABASE, "T", Split("ID", 1, 2, 2), ["ID < 5", "ID >= 5"])


def test_jdbc_tables_builds_each_table_once():
    session = MagicMock()
    reader = session.read.format.return_value
    small = ["CDW_SAPP_BRANCH", "CDW_SAPP_CREDITCARD"]
    tables = jdbc_tables(session, DATABASE, splits={"CDW_SAPP_CUSTOMER": Split("SSN", 0, 100, 8)}, single_task=small)
    assert list(tables) == list(WAREHOUSE_TABLES)
    assert [call.args for call in session.read.format.call_args_list] == [("jdbc",)] * 3
    given = [call.kwargs for call in reader.options.call_args_list]
    assert [options["dbtable"] for options in given] == list(WAREHOUSE_TABLES)
    assert [options.get("numPartitions") for options in given] == [None, None, "8"]


def test_jdbc_predicates_become_one_task_each():
    session = MagicMock()
    jdbc_table(session, DATABASE, "T", predicates=["ID < 5", "ID >= 5"])
    call = session.read.jdbc.call_args
    assert call.args == (DATABASE.url, "T")
    assert call.kwargs["predicates"] == ["ID < 5", "ID >= 5"]
    assert call.kwargs["properties"] == {
        "driver": "com.mysql.cj.jdbc.Driver", "fetchsize": "10000", "user": "reader", "password": "secret"
    }


def test_jdbc_tables_take_predicates_and_no_table_is_left_to_one_task_by_default():
    session = MagicMock()
    cuts = ["(ID < 5 OR ID IS NULL)", "ID >= 5"]
    jdbc_tables(session, DATABASE, ["T"], splits={"T": cuts})
    assert session.read.jdbc.call_args.kwargs["predicates"] == cuts
    with pytest.raises(ValueError, match="CDW_SAPP_BRANCH"):
        jdbc_tables(session, DATABASE)
    with pytest.raises(ValueError):
        jdbc_table(session, DATABASE, "T", Split("ID", 1, 2, 2), single_task=True)


def test_publishing_and_collections_write_through_their_connector():
    lines = MagicMock()
    publish_lines(lines, "h:9092", "Network")
    lines.selectExpr.assert_called_once_with("CAST(value AS BINARY) AS value")
    writer = lines.selectExpr.return_value.write
    writer.format.assert_called_once_with("kafka")
    writer.format.return_value.options.assert_called_once_with(**publish_options("h:9092", "Network"))

    branch = MagicMock()
    append_collections({"BRANCH": branch}, "mongodb", "mongodb://h", "CDW")
    branch.write.format.assert_called_once_with("mongodb")
    mode = branch.write.format.return_value.mode
    mode.assert_called_once_with("append")
    mode.return_value.options.assert_called_once_with(**connector_options("mongodb://h", "CDW", "BRANCH"))


def test_published_files_lose_their_headers(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("header\nx\ty\nz\n")
    sent = {}

    def publish(lines, servers, topic):
        sent[servers, topic] = [row.value for row in lines.collect()]

    monkeypatch.setattr(marketplace, "publish_lines", publish)
    marketplace.publish_files(spark, str(tmp_path), "h:9092", "Network")
    assert sent == {("h:9092", "Network"): ["x\ty", "z"]}


def test_all_topics_of_a_record_type_are_one_stream(monkeypatch):
    seen = {}
    monkeypatch.setattr(marketplace, "kafka_line_stream", lambda spark, options: seen.update(options))
    monkeypatch.setattr(marketplace, "from_lines", lambda lines, record, folder: None)
    marketplace.from_topics(
        None, marketplace.BENEFITS_COST_SHARING, "h:9092", "/lake", max_offsets_per_trigger=10, min_partitions=64
    )
    assert seen == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "BenefitsCostSharing_partOne,BenefitsCostSharing_partTwo,"
        "BenefitsCostSharing_partThree,BenefitsCostSharing_partFour",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
        "minPartitions": "64",
    }


def test_kafka_options():
    assert kafka_options("h:9092", "Network") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "Network", "startingOffsets": "earliest"
    }
    bounded = kafka_options("h:9092", "Network", max_offsets_per_trigger=1000, min_partitions=64)
    assert bounded["maxOffsetsPerTrigger"] == "1000" and bounded["minPartitions"] == "64"
    assert publish_options("h:9092", "Network") == {"kafka.bootstrap.servers": "h:9092", "topic": "Network"}


def test_every_record_type_has_topics():
    assert set(marketplace.TOPICS) == set(RECORD_TYPES)
    assert len(marketplace.TOPICS["BenefitsCostSharing"]) == 4


def test_kafka_without_its_connector_fails_at_once(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_line_stream(spark, kafka_options("h:9092", "Network"))


def test_jdbc_without_its_driver_fails_at_once(spark):
    with pytest.raises(Exception, match="com.mysql.cj.jdbc.Driver"):
        jdbc_table(spark, DATABASE, "CDW_SAPP_BRANCH", Split("BRANCH_CODE", 1, 1000, 4))


def test_collections_without_their_connector_fail_at_once(spark):
    with pytest.raises(Exception, match="mongodb"):
        append_collections({"BRANCH": spark.range(1)}, "mongodb", "mongodb://h", "CDW")


def test_message_text_survives_the_bytes(spark):
    lines = spark.createDataFrame([("grüße\t中",), ("",)], "value string")
    assert encoded(lines).dtypes == [("value", "binary")]
    assert {row.value for row in decoded(encoded(lines)).collect()} == {"grüße\t中", ""}


def test_connector_options():
    assert connector_options("mongodb://h", "Market", "Network") == {
        "connection.uri": "mongodb://h", "database": "Market", "collection": "Network"
    }


def test_shared_dir_is_new_each_time_and_below_the_named_folder(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get(CHECKPOINT_DIR) + "/x-")


class ClusterSession:
    """Only what ``shared_dir`` asks of a session."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "yarn"}.get(name, default)


def test_shared_dir_never_is_a_local_folder_of_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(ClusterSession(), "x")
