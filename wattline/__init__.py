"""wattline: grid-telemetry analytics written as Spark DataFrame / SQL / Structured Streaming code.

Layout
------
sources/    scans and sinks: seed CSV, Kafka-shaped messages, Bronze and dead-letter tables, layout
functions/  Column helpers (derived measures, curves, hash-uniform draws, lookups)
operators/  DataFrame -> DataFrame operators (decode, derive, joins, silver windows, gold facts,
            quality checks, dimensions, operational tables)
plans/      bindings of the operators to the driver's tables and the query registry
streaming/  Structured Streaming jobs (ingest, dead letters, replay, rollups, alerts)
"""

__version__ = "0.1.0"
