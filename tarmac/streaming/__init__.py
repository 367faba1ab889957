"""Structured Streaming jobs: request stream, scoring with foreachBatch, response upserts."""
