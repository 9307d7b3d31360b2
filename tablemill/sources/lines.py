"""Text lines as a table or a stream with one column ``value``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES_PER_BATCH = "10000"

#: True for the first line of a file that is not the header it should be.
FIRST_MISFITS = "first_misfits"


def file_stream_options(options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Bounds a batch to a number of files unless ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` is given.

    A file counts as new whatever its age. By default Spark passes over files a week older than the newest one read.
    """
    chosen = {"maxFileAge": "36500d", **(options or {})}
    if "maxBytesPerTrigger" not in chosen:
        chosen.setdefault("maxFilesPerTrigger", FILES_PER_BATCH)
    return chosen


def text_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Lines of files. With ``header`` a file loses its first line if that is the header, and a first line that is
    not has ``first_misfits`` true: parsing rejects it. Lines further down stay, also those equal to the header."""
    lines = spark.read.text(path)
    return lines if header is None else _below_first(lines, header)


def file_line_stream(
    spark: SparkSession, path: str, header: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The streaming form of :func:`text_lines`, over files present and future; ``options`` as in
    :func:`file_stream_options`."""
    lines = spark.readStream.options(**file_stream_options(options)).text(path)
    return lines if header is None else _below_first(lines, header)


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """``topic`` may be a list with commas. ``starting_offsets`` holds for the first run; later runs go on from their
    checkpoint.

    ``min_partitions`` above the topic's own number cuts large topic partitions into several tasks.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def decoded(messages: DataFrame) -> DataFrame:
    """Message bytes as text."""
    return messages.selectExpr("CAST(value AS STRING) AS value")


def kafka_line_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Lines published to a topic; needs the Kafka connector on the session's class path."""
    return decoded(spark.readStream.format("kafka").options(**options).load())


def lines_below_header(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files without the first line of each file, whatever it says. All other lines stay, blank ones too."""
    return _below_first(spark.read.text(path))


def stream_below_header(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The streaming form of :func:`lines_below_header`; ``options`` as in :func:`file_stream_options`."""
    return _below_first(spark.readStream.options(**file_stream_options(options)).text(path))


def _below_first(lines: DataFrame, header: str | None = None) -> DataFrame:
    """The text source keeps every line and gives those of a piece of a file in order, so the first line of a piece
    that begins where its file does is the file's first. No source option tells it, so batches of rows go through
    Python here. With a header only first lines with its text, with or without a byte order mark, are dropped."""
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    if header is None:
        return placed.mapInArrow(_drop_first(None), "value string")
    return placed.mapInArrow(_drop_first({header, "\ufeff" + header}), f"value string, {FIRST_MISFITS} boolean")


def _drop_first(headers: set[str] | None):
    """First lines go; with ``headers`` only those among them, and the others are marked."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            files, at = batch.column("file").dictionary_encode(), batch.column("at").to_numpy()
            codes = files.indices.to_numpy()
            new = np.concatenate([[True], (codes[1:] != codes[:-1]) | (at[1:] != at[:-1])])
            new[0] = (files[0].as_py(), at[0]) != last
            last = (files[len(files) - 1].as_py(), at[-1])
            value, first = batch.column("value"), new & (at == 0)
            if headers is None:
                yield pa.record_batch([value.filter(pa.array(~first))], names=["value"])
                continue
            misfits = first.copy()
            for k in np.flatnonzero(first).tolist():
                misfits[k] = value[k].as_py() not in headers
            stays = ~first | misfits
            columns = [value.filter(pa.array(stays)), pa.array(misfits[stays])]
            yield pa.record_batch(columns, names=["value", FIRST_MISFITS])

    return run
