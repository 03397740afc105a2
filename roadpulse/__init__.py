"""roadpulse: road-speed telemetry analytics on Spark.

Readings (one speed per road segment per ~10 minutes) are cleaned, scored for
congestion against each segment's reference speed, enriched with a segment
lookup and aggregated historically (per month / year) and live (sliding
windows, Structured Streaming). Everything is DataFrame in, DataFrame out;
I/O lives in ``roadpulse.sources`` and the job wiring in ``roadpulse.plans``
and ``roadpulse.streaming``.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
