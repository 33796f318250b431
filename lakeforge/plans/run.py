"""P2 end-to-end run and P4 models-then-tests.

Stage order: ingest -> completeness gate -> batch transforms -> warehouse
(loads, layout, analytic views) -> models -> model tests -> ingest report.
Each stage reads what the previous one wrote, so a failed stage can be
re-run on its own and no stage keeps data in memory across stages.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions.expressions import timestamp_literal
from lakeforge.operators.quality import assert_complete, completeness, model_tests
from lakeforge.plans.models import dim_users, fact_transactions
from lakeforge.plans.parallel import concurrently
from lakeforge.plans.transform import transform_pipeline
from lakeforge.plans.warehouse import Warehouse, build_warehouse
from lakeforge.session import sized_shuffle
from lakeforge.sources.raw import ingest_batch, ingest_report, raw_path, read_manifest

# dataset -> (dataset type, aggregate?)
DATASETS = {
    "users": ("users", False),
    "transactions": ("transactions", True),
    "logs": ("logs", True),
}
# Layout columns per curated table: every column the original indexes.
INDEXES = {
    "users": ("country", "email", "user_id"),
    "transactions": ("category", "transaction_date", "user_id"),
    "logs": ("source", "level", "log_date"),
    "user_analytics": ("country", "age_group", "user_id"),
}


def ingests_since(spark: SparkSession, lake: str, since: dt.datetime | str | None = None) -> list[str]:
    """Ids of the non-empty ingests from a time on (default: midnight of today, UTC); only the
    manifest's folders of these days are read."""
    start = dt.datetime.fromisoformat(since) if isinstance(since, str) else since
    start = start or dt.datetime.now(dt.timezone.utc).replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None)
    manifest = read_manifest(spark, lake, since_day=f"{start:%Y-%m-%d}")
    rows = manifest.where((F.col("ingestion_timestamp") >= timestamp_literal(start)) & (F.col("row_count") > 0)).select("ingest_id").distinct().collect()
    return sorted(r["ingest_id"] for r in rows)


def models_then_tests(spark: SparkSession, wh: Warehouse, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Materialise dim_users and fact_transactions, then run their tests."""
    wh.create_schema()
    concurrently([
        lambda: wh.write_table(dim_users(spark.table(wh.qualified("users")), as_of), "dim_users"),
        lambda: wh.write_table(fact_transactions(spark.table(wh.qualified("transactions")), as_of), "fact_transactions"),
    ])
    models = {
        "dim_users": spark.table(wh.qualified("dim_users")),
        "fact_transactions": spark.table(wh.qualified("fact_transactions")),
    }
    return model_tests(models)


def process_landed(
    spark: SparkSession,
    lake: str,
    names: Sequence[str],
    as_of: dt.datetime | str | None = None,
    expected: Sequence[str] | None = None,
    ingest_ids: Sequence[str] | None = None,
    schema: str = "curated",
    since_day: str | None = None,
) -> dict[str, object]:
    """Everything after landing: gate, transforms, warehouse, models, tests.

    ``ingest_ids`` are those of this run: only what they brought passes the
    gate (an older ingest of a dataset does not stand in for a missing one).
    ``since_day`` ("YYYY-MM-DD"): the manifest is read from this day on.
    """
    manifest = read_manifest(spark, lake, since_day=since_day)
    arrived = manifest if ingest_ids is None else manifest.filter(F.col("ingest_id").isin(*ingest_ids))
    assert_complete(completeness(arrived, expected or names))

    def transform(dataset: str) -> Callable[[], dict[str, str]]:
        dataset_type, aggregate = DATASETS.get(dataset, ("generic", False))
        return lambda: transform_pipeline(spark, lake, dataset, dataset_type, aggregate, as_of)

    processed: dict[str, str] = {}
    wh = Warehouse(spark, f"{lake.rstrip('/')}/curated", schema)
    with sized_shuffle(spark, [raw_path(lake, d) for d in names]):
        for paths in concurrently([transform(d) for d in names]):
            processed.update(paths)
        curated = {d: processed[d] for d in names}
        table_info = build_warehouse(wh, curated, INDEXES, fresh=True)
        tests = models_then_tests(spark, wh, as_of)
    return {
        "processed": processed,
        "warehouse": wh,
        "table_info": table_info,
        "tests": tests,
        "ingest_report": ingest_report(manifest),
    }


def run_pipeline(
    spark: SparkSession,
    lake: str,
    batches: Sequence[tuple[DataFrame, str, str]],
    as_of: dt.datetime | str | None = None,
    expected: Sequence[str] | None = None,
    schema: str = "curated",
) -> dict[str, object]:
    """Land (df, dataset, source_type) batches, then ``process_landed``."""
    records = concurrently([
        (lambda b=b: ingest_batch(b[0], lake, b[1], b[2], as_of)) for b in batches
    ])
    return process_landed(spark, lake, [b[1] for b in batches], as_of, expected, [r["ingest_id"] for r in records], schema, min(r["ingestion_timestamp"] for r in records)[:10])
