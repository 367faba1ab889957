"""tarmac: flight-delay analytics and model serving as PySpark DataFrame jobs.

Subpackages
-----------
sources    declared-schema readers and the table-shaped views over the driver data
sinks      table, JSON, Kafka and keyed-upsert writers
functions  Column -> Column helpers (routes, delay classes, dates, id parsing)
operators  DataFrame -> DataFrame steps (features, forest, lookups, registry, scoring)
plans      the registered queries and their DuckDB oracle SQL
streaming  Structured Streaming request/response jobs built from the same operators
"""

__version__ = "0.1.0"
