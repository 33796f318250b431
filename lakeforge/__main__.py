"""Command line: ``python -m lakeforge <command> ...``.

Commands mirror the original entry points:

* ``ingest``    land a file batch (csv / json / parquet) in RAW
* ``transform`` RAW -> clean -> enrich -> PROCESSED (+ ``--aggregate``)
* ``warehouse`` PROCESSED -> curated tables, layout, analytic views
* ``report``    ingest report from the manifest
* ``stream``    per-merchant one-minute windows from a Kafka topic
* ``run``       the whole batch flow over datasets already landed in RAW
"""

from __future__ import annotations

import argparse
import sys

from lakeforge.session import build_session, sized_shuffle


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeforge")
    sub = p.add_subparsers(dest="command", required=True)

    ing = sub.add_parser("ingest", help="land a file batch in RAW")
    ing.add_argument("--dataset", required=True)
    ing.add_argument("--path", required=True)
    ing.add_argument("--format", default="parquet", choices=["csv", "json", "parquet", "orc"])
    ing.add_argument("--schema", default=None, help="column types, e.g. 'user_id bigint, email string, age int'")
    ing.add_argument("--data-lake", default="./data_lake")
    ing.add_argument("--ingest-id", default=None, help="stable id: a re-run replaces its own output")
    ing.add_argument("--ingested-at", default=None, help="ingest time 'YYYY-MM-DD HH:MM:SS' (default now)")

    tr = sub.add_parser("transform", help="batch transform of one dataset")
    tr.add_argument("--dataset", required=True)
    tr.add_argument("--type", required=True, choices=["users", "transactions", "logs", "generic"])
    tr.add_argument("--aggregate", action="store_true")
    tr.add_argument("--data-lake", default="./data_lake")
    tr.add_argument("--dedup-key", default=None, help="comma-separated key columns for keyed de-dup")
    tr.add_argument("--raw-filter", default=None, help="RAW partition filter, e.g. 'year = 2025 AND day = 5'")
    tr.add_argument("--mode", default="overwrite", choices=["overwrite", "append"], help="append: an incremental run")
    tr.add_argument("--run-id", default=None, help="name of an incremental run: a repeat replaces its own rows (default: the filter)")

    wh = sub.add_parser("warehouse", help="build curated tables and views")
    wh.add_argument("--data-lake", default="./data_lake")
    wh.add_argument("--datasets", default="users,transactions,logs")

    rp = sub.add_parser("report", help="ingest report")
    rp.add_argument("--data-lake", default="./data_lake")
    rp.add_argument("--compact-before", default=None, help="first fold the manifest's days before this one ('YYYY-MM-DD') into one file each")

    st = sub.add_parser("stream", help="merchant windows from a Kafka topic")
    st.add_argument("bootstrap_servers")
    st.add_argument("topic", nargs="?", default="transactions")
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--watermark", default=None, help="e.g. '10 minutes' for bounded state")
    st.add_argument("--starting-offsets", default="latest")

    rn = sub.add_parser("run", help="gate, transforms, warehouse, models and tests")
    rn.add_argument("--data-lake", default="./data_lake")
    rn.add_argument("--datasets", default="users,transactions,logs")
    rn.add_argument("--ingest-ids", default=None, help="ids of this run's ingests, comma-separated: only what they brought passes the gate")
    rn.add_argument("--since", default=None, help="or: ingests from this time on ('YYYY-MM-DD HH:MM:SS') are this run's (default: today's, UTC)")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession

    owned = SparkSession.getActiveSession() is None
    spark = build_session(app_name=f"lakeforge-{args.command}")
    try:
        if args.command == "ingest":
            from lakeforge.sources.connectors import read_files
            from lakeforge.sources.raw import ingest_batch

            rec = ingest_batch(read_files(spark, args.path, args.format, args.schema), args.data_lake, args.dataset,
                               args.format, ingested_at=args.ingested_at, ingest_id=args.ingest_id)
            print(rec)
        elif args.command == "transform":
            from lakeforge.plans.transform import transform_pipeline
            from lakeforge.sources.raw import raw_path

            subset = args.dedup_key.split(",") if args.dedup_key else None
            with sized_shuffle(spark, [raw_path(args.data_lake, args.dataset)]):
                print(transform_pipeline(spark, args.data_lake, args.dataset, args.type, args.aggregate, subset=subset,
                                         raw_filter=args.raw_filter, mode=args.mode, run_id=args.run_id))
        elif args.command == "warehouse":
            from lakeforge.plans.run import INDEXES
            from lakeforge.plans.transform import processed_path
            from lakeforge.plans.warehouse import Warehouse, build_warehouse

            names = args.datasets.split(",")
            wh = Warehouse(spark, f"{args.data_lake.rstrip('/')}/curated")
            paths = {d: processed_path(args.data_lake, d) for d in names}
            with sized_shuffle(spark, list(paths.values())):
                info = build_warehouse(wh, paths, INDEXES)
            info.show(truncate=False)
        elif args.command == "report":
            from lakeforge.sources.raw import compact_manifest, ingest_report, read_manifest

            if args.compact_before:
                compact_manifest(spark, args.data_lake, args.compact_before)
            ingest_report(read_manifest(spark, args.data_lake)).orderBy("dataset_name", "partition").show(
                truncate=False)
        elif args.command == "stream":
            from lakeforge.streaming.jobs import kafka_stream, merchant_stream, start_merchant_query

            src = kafka_stream(spark, args.bootstrap_servers, args.topic, args.starting_offsets)
            mode = "update" if args.watermark else "complete"
            query = start_merchant_query(merchant_stream(src, args.watermark), args.checkpoint, output_mode=mode)
            query.awaitTermination()
        elif args.command == "run":
            from lakeforge.plans.run import ingests_since, process_landed

            ids = args.ingest_ids.split(",") if args.ingest_ids else ingests_since(spark, args.data_lake, args.since)
            result = process_landed(spark, args.data_lake, args.datasets.split(","), ingest_ids=ids)
            result["tests"].show(truncate=False)
            result["ingest_report"].show(truncate=False)
    finally:
        if owned:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
