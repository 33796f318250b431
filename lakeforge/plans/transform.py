"""RAW -> clean -> enrich -> PROCESSED (+ optional aggregate).

One pass over RAW: the enriched data is written once; the aggregate is
computed from the written PROCESSED files, not by recomputing RAW, and not
from an in-memory cache that an executor loss would throw away.  Incremental
runs keep PROCESSED by run (``plans/runs.py``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions import fixed
from lakeforge.operators.aggregate import aggregate_data
from lakeforge.operators.clean import clean_data, validated
from lakeforge.operators.enrich import enrich_data
from lakeforge.plans.runs import DIGEST, Digests, covered, digest, new_rows, register_runs, start_over, write_run
from lakeforge.plans.warehouse import read_processed, register_table
from lakeforge.sources.raw import ingest_folders, read_raw


def processed_path(lake: str, dataset: str) -> str:
    return f"{lake.rstrip('/')}/processed/{dataset}"


def save_to_processed(
    df: DataFrame,
    lake: str,
    dataset: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    files_per_partition: int | None = None,
    rebalance: bool = True,
) -> str:
    """K2: parquet under PROCESSED; overwrite or append; optional partitions.

    Without care, a partitioned write makes (tasks x partition values) small
    files.  By default rows are rebalanced on the partition columns (AQE's
    REBALANCE): each partition value goes to one task, a value larger than
    the advisory partition size is split across several, small ones are
    coalesced.

    ``files_per_partition`` instead bounds the count explicitly: rows are
    shuffled on the partition columns plus a deterministic hash bucket of
    the row, so each value is written by at most that many tasks.  The
    bucket is a hash, not ``rand()``, so a retried task sends every row to
    the same place.
    """
    path = processed_path(lake, dataset)
    if partition_by and files_per_partition:
        bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], bucket)
    elif partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def transform_pipeline(
    spark: SparkSession,
    lake: str,
    dataset_name: str,
    dataset_type: str,
    with_aggregation: bool = False,
    as_of: dt.datetime | str | None = None,
    subset: Sequence[str] | None = None,
    files_per_partition: int | None = None,
    raw_filter: str | None = None,
    mode: str = "overwrite",
    run_id: str | None = None,
) -> dict[str, str]:
    """Run the batch transform of one dataset; returns the written paths.

    ``mode="overwrite"`` processes the ingests that ``raw_filter`` keeps (all by
    default) and replaces PROCESSED.  ``mode="append"`` is an incremental run:
    it reads only those ingests (``"year = 2025 AND month = 11 AND day = 5"``
    lists no other folder), drops rows that another run, or the full run before
    it, has written already, and replaces only what an earlier attempt of the same run wrote
    (``run_id``; by default the filter names the run).  Day-by-day runs thus give
    the rows of one full run, and a repeated run adds nothing.  When the
    ingests of a run have lost rows since, run the later runs again as well: rows
    that they left to it are theirs then.
    """
    path = processed_path(lake, dataset_name)
    partition_cols = fixed.PARTITION_COLUMNS.get(dataset_type)
    raw = read_raw(spark, lake, dataset_name, where=raw_filter)
    if mode == "append":
        out = _append_run(raw, lake, dataset_name, dataset_type, run_id or raw_filter or "all", as_of, subset, partition_cols)
        register_runs(spark, f"processed_{dataset_name}", out)
    else:
        enriched = enrich_data(clean_data(raw, dataset_type, subset=subset), dataset_type, as_of)
        out = save_to_processed(enriched, lake, dataset_name, mode, partition_cols, files_per_partition)
        start_over(spark, path, ingest_folders(spark, lake, dataset_name, raw_filter))
        register_table(spark, f"processed_{dataset_name}", out, partitioned=bool(partition_cols))
    paths = {dataset_name: out}
    if with_aggregation:
        # after a single overwrite there is one schema: no footer merge needed
        agg = aggregate_data(read_processed(spark, out, merge_schema=mode != "overwrite"), dataset_type)
        agg_name = f"{dataset_name}_agg"
        paths[agg_name] = save_to_processed(agg, lake, agg_name)
        register_table(spark, f"processed_{agg_name}", paths[agg_name])
    return paths


#: Run id that stands for the last full run in the digest table.
FULL_RUN = "full run"


def _append_run(
    raw: DataFrame, lake: str, dataset: str, dataset_type: str, run_id: str, as_of: dt.datetime | str | None, subset: Sequence[str] | None,
    partition_cols: Sequence[str] | None,
) -> str:
    spark, path = raw.sparkSession, processed_path(lake, dataset)
    if subset is not None:
        raise ValueError("an incremental run de-duplicates whole rows; the latest row per key takes a full run")
    digests = Digests(spark, path)
    before = covered(spark, path)
    if before and not digests.runs():  # the first run since a full one
        rows = read_raw(spark, lake, dataset, only=before)
        digests.replace(FULL_RUN, rows.select(digest(rows).alias(DIGEST)).distinct())
    fresh = new_rows(raw, digests, run_id)
    enriched = enrich_data(validated(fresh, dataset_type, keep_metadata=(DIGEST,)), dataset_type, as_of)
    folder = write_run(enriched, path, run_id, partition_cols or ())
    digests.replace(run_id, spark.read.schema(f"{DIGEST} binary").parquet(folder))
    return path
