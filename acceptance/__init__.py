"""Every operator run on the driver's tables, each with the SQL that must give the same rows."""

from acceptance import cleaning, counting, ingest, questions  # noqa: F401  (importing registers the queries)
from acceptance.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
