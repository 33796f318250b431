"""Source façade (S2, S3, S5, S6, S11) and ingest entry points.

Every source is a Spark reader, so extraction is distributed and lands in
RAW through ``ingest_batch`` without a pandas round trip.  Connector formats
(document store, wide-column store, Kafka, JDBC) need their connector jars
on the cluster; the same functions accept a file format (``json``,
``parquet``, ``csv``) and a path for landed extracts, which is what the
tests use.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeforge.sources.raw import ingest_batch

FILE_FORMATS = ("csv", "json", "parquet", "orc", "text")


def _load(spark: SparkSession, fmt: str, path: str | None, options: Mapping[str, str] | None,
          schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV / JSON / Parquet batch files (header on for CSV by default)."""
    if fmt not in FILE_FORMATS:
        raise ValueError(f"unsupported file format {fmt!r}")
    opts = {"header": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    return _load(spark, fmt, path, opts, schema)


def read_document_store(
    spark: SparkSession,
    fmt: str = "mongodb",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    query: Mapping[str, object] | None = None,
    limit: int | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Collection scan with an optional equality filter and head-N.

    The filter and limit are applied to the DataFrame, so the connector
    can push them to the store (instead of fetching everything first).
    ``_id`` is carried as a string.
    """
    df = _load(spark, fmt, path, options, schema)
    for key, value in (query or {}).items():
        df = df.filter(F.col(key) == F.lit(value))
    if "_id" in df.columns:
        kind = df.schema["_id"].dataType
        wrapped = isinstance(kind, StructType) and "$oid" in kind.names  # an object id in extended JSON
        df = df.withColumn("_id", F.col("_id.`$oid`" if wrapped else "_id").cast("string"))
    return df.limit(limit) if limit else df


def read_wide_column(
    spark: SparkSession,
    fmt: str = "org.apache.spark.sql.cassandra",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    uuid_columns: Sequence[str] = ("id",),
    schema: StructType | str | None = None,
) -> DataFrame:
    """S3: projection / limit over a wide-column table; UUIDs as strings."""
    df = _load(spark, fmt, path, options, schema)
    if columns:
        df = df.select(*columns)
    for c in uuid_columns:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("string"))
    return df.limit(limit) if limit else df


def read_api_landing(
    spark: SparkSession,
    path: str,
    source_url: str | None = None,
    schema: StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """API responses landed as JSON files, tagged with ``_source_url``.

    JSON lines by default (splittable); ``multi_line=True`` for one JSON
    document per file.  Without an explicit URL, the landed file name
    stands in for it.
    """
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    url = F.lit(source_url) if source_url else F.col("_metadata.file_path")
    return df.withColumn("_source_url", url)


def inline_rows(spark: SparkSession, rows: Sequence[Mapping[str, object]], schema: StructType | str) -> DataFrame:
    """Literal rows (model stand-ins, fixtures)."""
    return spark.createDataFrame([dict(r) for r in rows], schema=schema)


# --- ingest entry points (one uniform return: the manifest record) -------------

def ingest_from_document_store(spark, lake: str, dataset: str, ingested_at: dt.datetime | str | None = None,
                               **reader) -> dict | None:
    return ingest_batch(read_document_store(spark, **reader), lake, dataset, "mongodb", ingested_at)


def ingest_from_wide_column(spark, lake: str, dataset: str, ingested_at: dt.datetime | str | None = None,
                            **reader) -> dict | None:
    return ingest_batch(read_wide_column(spark, **reader), lake, dataset, "cassandra", ingested_at)


def ingest_from_api(spark, lake: str, dataset: str, path: str, source_url: str | None = None,
                    ingested_at: dt.datetime | str | None = None) -> dict | None:
    return ingest_batch(read_api_landing(spark, path, source_url), lake, dataset, "api", ingested_at)


def ingest_files(spark, lake: str, dataset: str, path: str, fmt: str = "parquet",
                 ingested_at: dt.datetime | str | None = None, **reader) -> dict | None:
    return ingest_batch(read_files(spark, path, fmt, **reader), lake, dataset, fmt, ingested_at)
