"""Broker envelope -> typed transaction rows.

The same function serves a batch DataFrame (landed envelopes, tests) and a
streaming one (``readStream``): JSON is parsed by a built-in expression, so
parsing stays inside codegen.  A value that is not valid JSON for the schema
yields a row whose payload fields are all NULL; it is removed later by the
status filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeforge.functions import fixed

TRANSACTION_SCHEMA = StructType()
for _name, _kind in fixed.TRANSACTION_FIELDS:
    TRANSACTION_SCHEMA.add(_name, _kind)


def parse_envelope(records: DataFrame, schema: StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """Envelope ``(value, timestamp)`` -> one column per payload field of ``schema``,
    then the broker's time as ``kafka_timestamp`` (the payload may have a ``timestamp`` of its own)."""
    broker_time = records["timestamp"]
    payload = F.from_json(records["value"].cast("string"), schema)
    return records.select(*[payload[name].alias(name) for name in schema.names], broker_time.alias("kafka_timestamp"))


def epoch_seconds_to_timestamp(c: str) -> F.Column:
    """Event times sent as fractional epoch seconds (ingest test messages)."""
    return F.timestamp_micros((F.col(c).cast("double") * 1_000_000).cast("bigint"))
