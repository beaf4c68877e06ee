"""A topic, read as a bounded batch. Needs Spark's Kafka connector."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidewright.names import require


def kafka_options(servers: str, topic: str, options: Mapping[str, object] | None = None) -> dict[str, str]:
    require(servers, "kafka source", "connection_url")
    require(topic, "kafka source", "topic")
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    settings.update({key: str(value) for key, value in (options or {}).items()})
    return settings


def read_kafka(
    spark: SparkSession, servers: str, topic: str, options: Mapping[str, object] | None = None
) -> DataFrame:
    """The records now in the topic; each of its partitions is read by a task."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, options)).load()
