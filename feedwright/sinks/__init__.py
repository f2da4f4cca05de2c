"""Sinks: CSV, partitioned tables, upsert versions, compaction and retention."""
