"""Kafka publishing of JSON messages.

The Kafka connector jar is not on this image's classpath, so these functions
are exercised here only through the file publisher of the scoring stream;
on a cluster with the connector they write to the broker unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Batch write of a ``value`` column to a topic."""
    df.select("value").write.format("kafka") \
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
