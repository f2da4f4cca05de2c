"""feedwright — table-load planning, extraction and data-quality checks as Spark jobs.

Every public function takes and returns DataFrames (or Columns); the run date is
always an explicit parameter. Sub-packages:

* ``functions``  — composed Column expressions (predicates, pretty sizes, repairs)
* ``sources``    — scans: raw/refined/delta, custom SQL, JDBC, CSV, XML, bytes
* ``operators``  — profiles, run-status, metadata, DQ checks, metrics, rules
* ``sinks``      — CSV, partitioned tables, upsert, compaction, retention
* ``plans``      — the composed jobs a user runs (planning, ingest, reconcile …)
* ``streaming``  — Structured Streaming variant of the delimiter repair
"""

__version__ = "0.1.0"
