"""tripmart: a Spark-native medallion + star-schema library for monthly trip files.

Layers: sources (scans, landing fixture, sinks) -> functions (column rules) ->
operators (silver, dimensions, fact, marts, quality, profiling) -> plans
(month orchestration and the query catalogue) -> streaming (landing-folder
stream that reuses the batch stages).
"""

__all__ = ["config", "session"]
