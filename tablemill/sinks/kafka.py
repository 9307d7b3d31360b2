"""Publishing lines to a topic, from all executors at once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def encoded(lines: DataFrame) -> DataFrame:
    """One message per line."""
    return lines.selectExpr("CAST(value AS BINARY) AS value")


def publish_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish_lines(lines: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the session's class path."""
    encoded(lines).write.format("kafka").options(**publish_options(servers, topic)).save()
