"""ledgerflow: claims, policy and account analytics as Spark jobs.

Layout
------
sources/    staging adapters, file and JDBC sources, sinks
functions/  column-level helpers (surrogate keys, signed amounts, dates)
operators/  DataFrame -> DataFrame building blocks (SCD2, islands, spines,
            point-in-time joins, incremental loads, quality checks)
plans/      the named data jobs (dimensions, facts, reports, meter profiles)
streaming/  Structured Streaming forms of ingestion and velocity alerts
"""

__all__ = ["session"]
