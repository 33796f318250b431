"""RAW layer: landing writes (K1), RAW scans (S1), ingest manifest.

Layout::

    <lake>/raw/<dataset>/year=YYYY/month=MM/day=DD/ingest_id=<id>/part-*.parquet
    <lake>/manifest/day=YYYY-MM-DD/ingest_id=<id>/   (JSON, one record per ingest)

* Partition values are zero-padded strings of the ingest time, so a scan
  filtered on year/month/day only lists the matching directories.
* Every ingest writes its own ``ingest_id`` partition with dynamic partition
  overwrite: re-running an ingest with the same id (a retried task, a
  replayed micro-batch) replaces its earlier output instead of adding a
  second copy.  Different ingests never touch each other's files.
* The manifest lives outside the data directory, so a scan of the dataset
  root only ever sees parquet; past days are compacted into one file each.
* The row count of an ingest is observed while the data is written (one
  job), not counted by a second scan.
* The manifest also records each ingest's schema.  A scan reads ingests of
  one schema together and brings types that changed between ingests to
  a common one (``sources/drift.py``), without reading file footers.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from lakeforge.functions.expressions import timestamp_literal
from lakeforge.session import list_paths, remove_folder
from lakeforge.sources import drift

PARTITION_COLUMNS = ("year", "month", "day", "ingest_id")

MANIFEST_SCHEMA = StructType(
    [
        StructField("dataset_name", StringType(), True),
        StructField("source_type", StringType(), True),
        StructField("ingest_id", StringType(), True),
        StructField("ingestion_timestamp", TimestampNTZType(), True),
        StructField("row_count", LongType(), True),
        StructField("columns", ArrayType(StringType()), True),
        StructField("file_path", StringType(), True),
        StructField("partition", StringType(), True),
        StructField("schema", StringType(), True),
    ]
)

#: Characters that a partition folder's name holds as %XX, as Spark and Hive write it (fixed values).
ESCAPED = "\"#%'*/:=?\\\x7f{[]^" + "".join(map(chr, range(1, 32)))


def raw_path(lake: str, dataset: str) -> str:
    return f"{lake.rstrip('/')}/raw/{dataset}"


def manifest_path(lake: str) -> str:
    return f"{lake.rstrip('/')}/manifest"


def _as_datetime(value: dt.datetime | str | None) -> dt.datetime:
    if value is None:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value.replace(tzinfo=None)


def partition_of(ingested_at: dt.datetime) -> str:
    return ingested_at.strftime("year=%Y/month=%m/day=%d")


def escaped(value: str) -> str:
    """A partition value as it stands in a folder's name."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def ingest_folder(partition: str, ingest_id: str) -> str:
    """Folder of an ingest under its dataset, as Spark names it."""
    return f"{partition}/ingest_id={escaped(ingest_id)}"


def ingest_batch(
    df: DataFrame,
    lake: str,
    dataset: str,
    source_type: str,
    ingested_at: dt.datetime | str | None = None,
    ingest_id: str | None = None,
    skip_empty: bool = False,
) -> dict | None:
    """K1 + E9: stamp ingest metadata, append under the ingest day, log a manifest row.

    Returns the manifest record (``None`` when ``skip_empty`` and no row was
    written: the record is then not logged either).  A retry replaces its
    earlier output only when it repeats both ``ingest_id`` and
    ``ingested_at`` (the day is part of the path); orchestrators should pass
    both, derived from the run.
    """
    spark = df.sparkSession
    when = _as_datetime(ingested_at)
    ingest_id = ingest_id or f"{when:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    stamped = df.withColumn("_ingestion_timestamp", timestamp_literal(when)).withColumn("_source", F.lit(source_type))
    data_columns = list(stamped.columns)
    laid_out = stamped.select(
        *data_columns,
        F.lit(f"{when:%Y}").alias("year"),
        F.lit(f"{when:%m}").alias("month"),
        F.lit(f"{when:%d}").alias("day"),
        F.lit(ingest_id).alias("ingest_id"),
    )
    obs = Observation(f"ingest_{uuid.uuid4().hex[:8]}")
    observed = laid_out.observe(obs, F.count(F.lit(1)).alias("rows"))
    target = raw_path(lake, dataset)
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS)
        .option("compression", "snappy")
        .parquet(target)
    )
    rows = int(obs.get.get("rows", 0))
    if rows == 0:
        # dynamic overwrite touches no partition without rows: an empty pull (or replay) writes
        # its folder itself, so the logged path exists, reads as empty, and old rows are gone
        folder = f"{target}/{ingest_folder(partition_of(when), ingest_id)}"
        if not skip_empty or list_paths(spark, folder):
            stamped.limit(0).coalesce(1).write.mode("overwrite").option("compression", "snappy").parquet(folder)
        if skip_empty:
            return None
    record = {
        "dataset_name": dataset,
        "source_type": source_type,
        "ingest_id": ingest_id,
        "ingestion_timestamp": when.isoformat(),
        "row_count": rows,
        "columns": data_columns,
        "file_path": f"{target}/{ingest_folder(partition_of(when), ingest_id)}",
        "partition": partition_of(when),
        "schema": stamped.schema.json(),
    }
    append_manifest(spark, lake, record)
    return record


def append_manifest(spark: SparkSession, lake: str, record: dict) -> None:
    """One JSON line per ingest, written next to (not inside) the data.

    The record is a single small row built on the driver; the file name
    carries the ingest id, so a replayed ingest rewrites its own record.
    """
    when = dt.datetime.fromisoformat(record["ingestion_timestamp"])
    row = dict(record, ingestion_timestamp=when)
    target = f"{manifest_path(lake)}/{ingest_folder(f'day={when:%Y-%m-%d}', record['ingest_id'])}"
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(target)


def read_raw(
    spark: SparkSession,
    lake: str,
    dataset: str,
    keep_partitions: bool = False,
    where: str | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Every parquet file of a dataset, any ingest day.

    Only ``*.parquet`` files count, found by partition discovery (a ``**`` glob
    would only match one directory level).  Columns are those of all ingests;
    an ingest that lacks one (an empty pull has metadata columns only) has NULL
    there.  A column whose type changed between ingests gets the type that
    holds all of them (``drift.common_type``: text beside anything is text), so
    no value is lost; ingests of one type are read together, each file with its
    own schema, as recorded in the manifest.

    A ``where`` on the partition columns, such as ``"year = 2025 AND month = 11"``,
    first chooses the folders by name: only their files are listed, and only
    their schemas count.  ``only``: ingest folders (see ``ingest_folders``) that count.
    """
    root = raw_path(lake, dataset)
    folders, exact = _folders(spark, root, where)
    if only is not None:
        only, exact, where = set(only), True, where or "true"
        folders = [f for f in folders if _name(f) in only]
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("basePath", root)
    if folders:
        whole = [root] if where is None or not exact else None
        df = drift.read(reader, _schemas(spark, lake, dataset, root, folders), PARTITION_TYPES, whole)
    else:  # no ingest folder (or none that the filter keeps): an error, or an empty frame with the dataset's columns
        df = reader.option("mergeSchema", "true").parquet(root)
    if where:
        df = df.filter(where)
    return df if keep_partitions else df.drop(*PARTITION_COLUMNS)


def ingest_folders(spark: SparkSession, lake: str, dataset: str, where: str | None = None) -> list[str]:
    """Names of the ingest folders (under the dataset's root) that a partition filter keeps, oldest first."""
    return [_name(f) for f in _folders(spark, raw_path(lake, dataset), where)[0]]


def _name(path: str) -> str:
    return "/".join(path.split("/")[-len(PARTITION_COLUMNS):])


PARTITION_TYPES = "year int, month int, day int, ingest_id string"


def _folders(spark: SparkSession, root: str, where: str | None) -> tuple[list[str], bool]:
    """Ingest folders that a partition filter keeps, oldest first (all, when it is not about
    partition columns alone: then the second value is False)."""
    found = []
    for path in list_paths(spark, "/".join([root, *[f"{n}=*" for n in PARTITION_COLUMNS]])):
        values = [part.split("=", 1)[1] for part in path.split("/")[-4:]]
        found.append((*[int(v) for v in values[:3]], unquote(values[3]), path))
    found.sort()
    if where is None or not found:
        return [f[-1] for f in found], True
    try:
        kept = spark.createDataFrame(found, f"{PARTITION_TYPES}, path string").filter(where).select("path").collect()
    except AnalysisException:
        return [f[-1] for f in found], False
    kept = {r["path"] for r in kept}
    return [f[-1] for f in found if f[-1] in kept], True


def _schemas(spark: SparkSession, lake: str, dataset: str, root: str, folders: list[str]) -> list[tuple[str, StructType]]:
    """(folder, schema) of ingest folders: as the manifest has it; of folders that it does not know, from their files."""
    names = [_name(f) for f in folders]
    first = min(re.sub(r"year=(\d+)/month=(\d+)/day=(\d+)/.*", r"\1-\2-\3", n) for n in names)
    records = read_manifest(spark, lake, since_day=first).where((F.col("dataset_name") == dataset) & F.col("schema").isNotNull())
    known: dict[str, StructType] = {}
    texts: dict[str, StructType] = {}
    for r in records.select("partition", "ingest_id", "schema").collect():
        if r["schema"] not in texts:
            texts[r["schema"]] = StructType.fromJson(json.loads(r["schema"]))
        known[ingest_folder(r["partition"], r["ingest_id"])] = texts[r["schema"]]
    out = []
    for path in folders:
        schema = known.get(_name(path))
        if schema is None:
            schema = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", "true").parquet(path).schema
        out.append((path, schema))
    return out


def read_manifest(spark: SparkSession, lake: str, day: str | None = None, since_day: str | None = None) -> DataFrame:
    """The ingest manifest as a typed table.

    Records are grouped in folders by ingest day, so ``day="YYYY-MM-DD"``
    (e.g. a daily completeness gate) lists one day's records only, and
    ``since_day`` those of a day and later ones.  Days that were compacted are
    one file; a record written since (a repeated ingest) takes the place of the one in there.
    """
    def wanted(folder: str) -> bool:
        its_day = re.search(r"day=([^/]*)", folder)[1]
        return (day is None or its_day == day) and (since_day is None or its_day >= since_day)

    paths = [p for p in list_paths(spark, f"{manifest_path(lake)}/day=*") if wanted(p)]
    old = [p for p in _compacted(spark, lake).values() if wanted(p)]
    reader = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true")
    single = reader.json(paths) if paths else None
    if not old:
        return single if single is not None else spark.createDataFrame([], MANIFEST_SCHEMA)
    compacted = reader.json(old)
    if single is None:
        return compacted
    key = ["dataset_name", "partition", "ingest_id"]
    newer = single.select(*[F.col(c).alias(f"_{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    return single.unionByName(compacted.join(newer, same, "left_anti"))


def compacted_path(lake: str) -> str:
    return f"{lake.rstrip('/')}/manifest_days"


def _compacted(spark: SparkSession, lake: str) -> dict[str, str]:
    """Day -> folder of its newest complete file."""
    done = [p.rsplit("/", 1)[0] for p in list_paths(spark, f"{compacted_path(lake)}/day=*/v_*/_SUCCESS")]
    return {p.split("/")[-2].split("=", 1)[1]: p for p in sorted(done)}


def compact_manifest(spark: SparkSession, lake: str, before_day: str) -> list[str]:
    """Fold the records of each day before ``before_day`` into one file; returns the days.

    A day's new file is complete before the single records and the older file go; until
    then, and after a stop in between, records of several places count once.
    """
    days = [p for p in list_paths(spark, f"{manifest_path(lake)}/day=*") if p.rsplit("=", 1)[1] < before_day]
    for path in days:
        day = path.rsplit("=", 1)[1]
        older = list_paths(spark, f"{compacted_path(lake)}/day={day}/v_*")
        read_manifest(spark, lake, day=day).coalesce(1).write.json(f"{compacted_path(lake)}/day={day}/v_{time.time_ns():020d}")
        for folder in (path, *older):
            remove_folder(spark, folder)
    return [p.rsplit("=", 1)[1] for p in days]


def ingest_report(manifest: DataFrame) -> DataFrame:
    """M1: ingests, rows and widest record per dataset, source and ingest day; ``stamped``:
    every ingest carries its metadata columns."""
    return manifest.groupBy("dataset_name", "source_type", "partition").agg(
        F.count(F.lit(1)).alias("ingests"),
        F.sum("row_count").alias("rows"),
        F.max(F.size("columns")).cast("bigint").alias("n_columns"),
        F.bool_and(F.array_contains("columns", "_ingestion_timestamp")).alias("stamped"),
        F.min("ingestion_timestamp").alias("first_ingest"),
        F.max("ingestion_timestamp").alias("last_ingest"),
    )
