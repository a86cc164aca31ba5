"""blotter: incident analytics as lazy Spark DataFrame / SQL operators.

Layout
------
sources/    declared raw schemas, CSV / Parquet readers and writers, the typed
            step, and the domain extracts derived from the driver tables
functions/  Column -> Column helpers (tolerant casts, time-of-day buckets,
            descent labels, geodesic distance)
operators/  DataFrame -> DataFrame building blocks (filters, set ops,
            aggregates, ranking, top-k, joins with a chosen strategy)
plans/      the four composite questions and the query catalog
streaming/  incremental CSV -> Parquet conversion with Structured Streaming

Nothing here collects data to the driver; every function returns a lazy
DataFrame or Column.
"""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
