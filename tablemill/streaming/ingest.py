"""Map-only streams into Parquet folders that a rerun does not duplicate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tablemill.sinks.batches import BatchStore, batch_appender
from tablemill.sources.lines import file_line_stream, file_stream_options, stream_below_header
from tablemill.sources.parsing import accepted, parse_lines
from tablemill.sources.records import RecordType
from tablemill.sources.tables import with_row_id


def land(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Runs a stream over everything that is there now, then stops.

    The checkpoint remembers what has been read and the file sink commits each batch once, so running it again adds
    only what is new.
    """
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).outputMode("append").start().awaitTermination()


def landed(spark: SparkSession, record: RecordType, target: str) -> DataFrame:
    """All landed rows, with the reject column; also right when nothing has been landed yet."""
    return spark.read.schema(record.landed_schema).parquet(target)


def forward(spark: SparkSession, record: RecordType, source: str, store: BatchStore, checkpoint: str) -> None:
    """Sends the accepted rows that have landed since the last run on to another store, each under its own ``_id``.

    The store needs no transactions: a batch that a lost driver left without its commit comes again with the same
    number and ids, and only rows that the store does not have are appended."""
    rows = spark.readStream.schema(record.landed_schema).options(**file_stream_options()).parquet(source)
    writer = accepted(with_row_id(rows)).writeStream.foreachBatch(batch_appender(record.name, store))
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_lines(lines: DataFrame, record: RecordType, target: str, checkpoint: str) -> DataFrame:
    """From a line stream (files or Kafka) to the landed table."""
    land(parse_lines(lines, record), target, checkpoint)
    return landed(lines.sparkSession, record, target)


def ingest_files(
    spark: SparkSession,
    record: RecordType,
    path: str,
    target: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    header: str | None = None,
) -> DataFrame:
    """From delimited files with header lines to the landed table.

    ``path`` may be a pattern that covers several parts; they are taken in by one stream, a bounded number of files
    (``maxFilesPerTrigger``) or bytes (``maxBytesPerTrigger``) per batch. Files lose their first line. With ``header``
    a first line of another text lands as a rejected line instead.
    """
    if header is None:
        lines = stream_below_header(spark, path, options)
    else:
        lines = file_line_stream(spark, path, header, options)
    return ingest_lines(lines, record, target, checkpoint)
