"""Writers: tables, JSON files, Kafka topics, keyed upserts."""

from tarmac.sinks import kafka, tables  # noqa: F401
