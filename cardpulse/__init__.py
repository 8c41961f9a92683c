"""cardpulse — card-transaction analytics on Spark.

Batch and streaming feature, detector and dashboard operators for card
transaction data, written against the DataFrame / SQL API so Catalyst plans
every join, aggregation and window.  Sub-packages:

* ``sources``    loaders, the transaction adapter, JSON decode, stream sources
* ``functions``  scalar column expressions (haversine, clamps, bands, ids)
* ``operators``  per-card features, joins, detectors, dashboards, alerts
* ``streaming``  Structured Streaming jobs, keyed state and sinks
* ``plans``      the named query catalogue with DuckDB oracle SQL
"""

__all__ = ["session", "schemas", "dimensions"]
