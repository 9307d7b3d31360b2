"""Landing the five marketplace record types, from files or from Kafka topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tablemill.sinks.batches import BatchStore
from tablemill.sinks.kafka import publish_lines
from tablemill.sources.lines import kafka_line_stream, kafka_options, lines_below_header
from tablemill.sources.parsing import accepted
from tablemill.sources.records import (
    BENEFITS_COST_SHARING,
    INSURANCE,
    NETWORK,
    PLAN_ATTRIBUTES,
    SERVICE_AREA,
    RecordType,
)
from tablemill.streaming.ingest import forward, ingest_files, ingest_lines
from tablemill.streaming.periods import land_periods, landed_periods

# The topics of each record type; the largest table comes in four parts.
TOPICS = {
    "PlanAttributes": ("PlanAttributes",),
    "Network": ("Network",),
    "ServiceArea": ("ServiceArea",),
    "Insurance": ("insurance",),
    "BenefitsCostSharing": (
        "BenefitsCostSharing_partOne",
        "BenefitsCostSharing_partTwo",
        "BenefitsCostSharing_partThree",
        "BenefitsCostSharing_partFour",
    ),
}


def from_files(
    spark: SparkSession,
    record: RecordType,
    path: str,
    folder: str,
    options: Mapping[str, str] | None = None,
    header: str | None = None,
) -> DataFrame:
    """Lands new files below ``path``; the table and its checkpoint live in ``folder`` under the record's name."""
    target, checkpoint = _places(record, folder)
    return accepted(ingest_files(spark, record, path, target, checkpoint, options, header))


def from_lines(lines: DataFrame, record: RecordType, folder: str) -> DataFrame:
    """Lands new lines of a stream."""
    target, checkpoint = _places(record, folder)
    return accepted(ingest_lines(lines, record, target, checkpoint))


def publish_files(spark: SparkSession, path: str, servers: str, topic: str) -> None:
    """Publishes the lines of delimited files, without the first line of each, to a topic."""
    publish_lines(lines_below_header(spark, path), servers, topic)


def from_topics(spark: SparkSession, record: RecordType, servers: str, folder: str, **bounds: int) -> DataFrame:
    """Lands new messages of all topics of a record type in one stream; ``bounds`` as in ``kafka_options``."""
    options = kafka_options(servers, ",".join(TOPICS[record.name]), **bounds)
    return from_lines(kafka_line_stream(spark, options), record, folder)


def plan_attributes(
    spark: SparkSession, path: str, folder: str, header: str | None = None, **options: str
) -> DataFrame:
    return from_files(spark, PLAN_ATTRIBUTES, path, folder, options, header)


def network(
    spark: SparkSession, path: str, folder: str, header: str | None = None, **options: str
) -> DataFrame:
    return from_files(spark, NETWORK, path, folder, options, header)


def service_area(
    spark: SparkSession, path: str, folder: str, header: str | None = None, **options: str
) -> DataFrame:
    return from_files(spark, SERVICE_AREA, path, folder, options, header)


def insurance(
    spark: SparkSession, path: str, folder: str, header: str | None = None, **options: str
) -> DataFrame:
    return from_files(spark, INSURANCE, path, folder, options, header)


def benefits_cost_sharing(
    spark: SparkSession, path: str, folder: str, header: str | None = None, **options: str
) -> DataFrame:
    """``path`` is a pattern over all parts; equal lines in different parts all stay."""
    return from_files(spark, BENEFITS_COST_SHARING, path, folder, options, header)


def to_collection(
    spark: SparkSession,
    record: RecordType,
    folder: str,
    fmt: str,
    options: Mapping[str, str] | None = None,
    target: str | None = None,
) -> None:
    """Sends what has newly landed in ``folder`` to a document collection, or to files below ``target``, each row once
    also after failures."""
    source, _ = _places(record, folder)
    store = BatchStore(fmt, target, options or {})
    forward(spark, record, source, store, f"{folder}/_checkpoints/{record.name}-{fmt}")


def _places(record: RecordType, folder: str) -> tuple[str, str]:
    return f"{folder}/{record.name}", f"{folder}/_checkpoints/{record.name}"
