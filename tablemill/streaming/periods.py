"""Landing by period: each period's folder of files has a stream, a checkpoint and a table of its own.

A stream remembers every file it has taken, and its table's log lists every file written. Both stay as small as a
period when the periods are landed apart, and a period that gets no more files costs nothing any more. A late file
lands when its period is landed again.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.sources.records import RecordType
from tablemill.streaming.ingest import ingest_files, landed

PERIOD = "period"


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly below a folder of any file system Spark reads; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = (status.getPath().getName() for status in files.listStatus(path) if status.isDirectory())
    return sorted(name for name in names if not name.startswith(("_", ".")))


def land_periods(
    spark: SparkSession,
    record: RecordType,
    source: str,
    folder: str,
    periods: Iterable[str] | None = None,
    options: Mapping[str, str] | None = None,
    header: str | None = None,
) -> DataFrame:
    """Lands what is new in the folders of ``source``, each named after its period, and reads all periods.

    ``periods`` are those to look at, say this month's and the last one's; without them all folders are. Landing a
    period again adds its late files only. ``options`` and ``header`` as in ``ingest_files``.
    """
    for period in subfolders(spark, source) if periods is None else periods:
        target, checkpoint = _places(record, folder, period)
        ingest_files(spark, record, f"{source}/{period}", target, checkpoint, options, header)
    return landed_periods(spark, record, folder)


def landed_periods(
    spark: SparkSession, record: RecordType, folder: str, periods: Iterable[str] | None = None
) -> DataFrame:
    """All landed rows of the given or of all periods, with the reject column and the ``period``.

    Each period is read through the log of its own table, so files of a batch that was never committed do not show;
    periods that a query leaves out are not read. Without any period there are no rows.
    """
    chosen = subfolders(spark, f"{folder}/{record.name}") if periods is None else list(periods)
    each = [
        landed(spark, record, _places(record, folder, period)[0]).withColumn(PERIOD, F.lit(period)) for period in chosen
    ]
    if not each:
        return spark.createDataFrame([], record.landed_schema.add(PERIOD, T.StringType(), False))
    return reduce(DataFrame.unionAll, each)


def _places(record: RecordType, folder: str, period: str) -> tuple[str, str]:
    return f"{folder}/{record.name}/{period}", f"{folder}/_checkpoints/{record.name}/{period}"
