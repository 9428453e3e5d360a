"""canopy -- a Spark-native telemetry staging and query engine.

Long form everywhere: ``telemetry(point, unique_id, ts, value)``; per-table
loops of the original pipeline become keyed DataFrame operations on ``point``.
"""

__version__ = "0.1.0"
