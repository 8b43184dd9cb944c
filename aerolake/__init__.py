"""aerolake: flight-telemetry analytics written with the PySpark DataFrame,
SQL and Structured Streaming APIs.

Layout
------
``sources``    readers, contracts and sinks (positional JSON batches, Parquet
               partitions, JDBC, message sinks)
``functions``  Column -> Column helpers (cleaning, categories, calendar)
``operators``  DataFrame -> DataFrame operators (geofence joins, dedup,
               incremental upsert, data-quality checks, measures)
``plans``      the models built from those operators (silver, dimensions,
               fact, star, business questions) and the query registry
``streaming``  Structured Streaming drains and incremental refresh
"""

__version__ = "0.1.0"
