"""lakeforge: a Spark-native medallion pipeline.

Raw landing (partitioned parquet plus an ingest manifest), cleaning,
enrichment, aggregation, curated tables, data-quality checks and a
windowed transaction stream, all written as DataFrame / SQL /
Structured Streaming plans.  Every public function is a pure
``DataFrame -> DataFrame`` step; actions happen only at sinks.
"""

from lakeforge.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
