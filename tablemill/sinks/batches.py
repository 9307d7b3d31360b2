"""Appending the batches of a stream to a store that knows no transactions, each row once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.sinks.tables import append_table
from tablemill.sources.tables import stored_table

ROW_ID, BATCH = "_id", "_batch"
_ROW_NAMES = T.StructType([T.StructField(name, T.StringType()) for name in (ROW_ID, BATCH)])


@dataclass(frozen=True)
class BatchStore:
    """Any store that Spark appends batches to and reads: a folder of files, or a collection by its connector."""

    fmt: str
    location: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def append(self, rows: DataFrame) -> None:
        append_table(rows, self.location, self.fmt, self.options)

    def ids_of(self, spark: SparkSession, batch: str) -> DataFrame | None:
        """The row ids that the store has of a batch; none if there is no store yet."""
        try:
            rows = stored_table(spark, self.location, self.fmt, _ROW_NAMES, self.options)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows.where(F.col(BATCH) == batch).select(ROW_ID)


def append_once(rows: DataFrame, batch: str, store: BatchStore, repeated: bool = True) -> None:
    """Appends the rows of a batch, each with its ``_id``, that the store does not have yet.

    A batch that comes again after a failure has the same name and the same ids, so what an earlier try has appended,
    all of it or a part, is left as it is. Only rows of that batch are read back and compared. ``repeated`` tells
    whether the batch may have been tried before; if not, nothing is read.
    """
    tagged = rows.withColumn(BATCH, F.lit(batch))
    known = store.ids_of(rows.sparkSession, batch) if repeated else None
    store.append(tagged if known is None else tagged.join(known, ROW_ID, "left_anti").select(*tagged.columns))


def batch_appender(stream: str, store: BatchStore) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``. ``stream`` names the stream among all that feed the store. Only the first batch of a run
    can be one that an earlier run left unfinished."""
    begun = False

    def append(rows: DataFrame, number: int) -> None:
        nonlocal begun
        append_once(rows, f"{stream}:{number}", store, repeated=not begun)
        begun = True

    return append
