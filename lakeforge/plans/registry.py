"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query derives its logical input from the driver's tables
(``lakeforge.sources.testdata``), runs the library operator over the whole
input and returns the result lazily.  ``lakeforge.plans.oracle`` holds the
DuckDB SQL for the same keys.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions import fixed
from lakeforge.functions.expressions import pretty_size
from lakeforge.operators import aggregate as A
from lakeforge.operators import clean as C
from lakeforge.operators import enrich as E
from lakeforge.operators import quality as Q
from lakeforge.operators import setops as U
from lakeforge.plans import models as M
from lakeforge.session import list_files, shared_dir
from lakeforge.sources import raw as R
from lakeforge.sources import testdata as T
from lakeforge.streaming import envelope as EV
from lakeforge.streaming import windows as W

AS_OF = "2024-02-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


# --- processed datasets (clean -> enrich), as the batch transform builds them --

def users_processed(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return E.enrich_data(C.clean_data(T.users_raw(spark, sf_dir), "users"), "users", as_of)


def transactions_processed(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return E.enrich_data(C.clean_data(T.transactions_raw(spark, sf_dir), "transactions"), "transactions", as_of)


def logs_processed(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return E.enrich_data(C.clean_data(T.logs_raw(spark, sf_dir), "logs"), "logs", as_of)


RAW = {"users": T.users_raw, "transactions": T.transactions_raw, "logs": T.logs_raw}


def _no_processed_ts(df: DataFrame) -> DataFrame:
    # E8 is wall-clock (or injected) time; it is checked by unit tests instead.
    return df.drop("_processed_timestamp")


def q_clean_generic(spark, sf_dir):
    return C.clean_data(T.users_raw(spark, sf_dir), "generic")


def q_clean_users(spark, sf_dir):
    return C.clean_data(T.users_raw(spark, sf_dir), "users")


def q_clean_transactions(spark, sf_dir):
    return C.clean_data(T.transactions_raw(spark, sf_dir), "transactions")


def q_clean_logs(spark, sf_dir):
    return C.clean_data(T.logs_raw(spark, sf_dir), "logs")


def _union_all(frames):
    return reduce(DataFrame.unionByName, frames)


def q_clean_report(spark, sf_dir):
    return _union_all([C.clean_report(RAW[d](spark, sf_dir), d) for d in ("users", "transactions", "logs")])


def q_rejects_by_rule(spark, sf_dir):
    return _union_all([C.rejects_by_rule(RAW[d](spark, sf_dir), d) for d in ("users", "transactions", "logs")])


def q_enrich_users(spark, sf_dir):
    return _no_processed_ts(users_processed(spark, sf_dir))


def q_enrich_transactions(spark, sf_dir):
    return _no_processed_ts(transactions_processed(spark, sf_dir))


def q_enrich_logs(spark, sf_dir):
    return _no_processed_ts(logs_processed(spark, sf_dir))


def q_agg_transactions(spark, sf_dir):
    return A.aggregate_data(transactions_processed(spark, sf_dir), "transactions")


def q_agg_logs(spark, sf_dir):
    return A.aggregate_data(logs_processed(spark, sf_dir), "logs")


def q_user_analytics(spark, sf_dir):
    return A.user_analytics(users_processed(spark, sf_dir), transactions_processed(spark, sf_dir))


def q_transaction_summary(spark, sf_dir):
    return A.transaction_summary(transactions_processed(spark, sf_dir))


def models(spark, sf_dir):
    return {
        "dim_users": M.dim_users(users_processed(spark, sf_dir), AS_OF),
        "fact_transactions": M.fact_transactions(transactions_processed(spark, sf_dir), AS_OF),
    }


def q_dim_users(spark, sf_dir):
    return models(spark, sf_dir)["dim_users"]


def q_fact_transactions(spark, sf_dir):
    return models(spark, sf_dir)["fact_transactions"]


def _tests(kind):
    return [t for t in fixed.MODEL_TESTS if t[2] == kind]


def q_dq_unique(spark, sf_dir):
    return Q.model_tests(models(spark, sf_dir), _tests("unique"))


def q_dq_not_null(spark, sf_dir):
    return Q.model_tests(models(spark, sf_dir), _tests("not_null"))


def q_dq_relationships(spark, sf_dir):
    return Q.model_tests(models(spark, sf_dir), _tests("relationships"))


def _written_models(spark, sf_dir):
    """The models as files, as P4 tests them: each is cleaned once."""
    base, out = shared_dir(spark, "models", unique=True), {}
    for name, df in models(spark, sf_dir).items():
        df.write.parquet(f"{base}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{base}/{name}")
    return out


def q_dq_summary(spark, sf_dir):
    """Q4 over the written models."""
    return Q.model_tests(_written_models(spark, sf_dir))


def q_dq_alerts(spark, sf_dir):
    errors = Q.validation_errors(T.logs_raw(spark, sf_dir), "logs", "timestamp")
    return Q.error_rate_alert(errors)


def q_dq_test_alert(spark, sf_dir):
    """The failing-test gauge and whether the alert fires."""
    return Q.test_failure_alert(Q.model_tests(_written_models(spark, sf_dir)))


def q_clean_observed(spark, sf_dir):
    """C6 opt-in: row counts observed while the cleaned users are written
    (one job, no extra count jobs); the counts become a one-row frame."""
    cleaned, initial, distinct, final = C.clean_observed(T.users_raw(spark, sf_dir), "users")
    cleaned.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [("users", *[int(o.get["rows"]) for o in (initial, distinct, final)])],
        "dataset string, initial_count bigint, distinct_count bigint, final_count bigint",
    )


def q_row_counts(spark, sf_dir):
    return A.row_counts(
        {
            "users": users_processed(spark, sf_dir),
            "transactions": transactions_processed(spark, sf_dir),
            "logs": logs_processed(spark, sf_dir),
        }
    )


def q_freshness(spark, sf_dir):
    return A.freshness(transactions_processed(spark, sf_dir), "transaction_date", AS_OF, "transactions")


def q_limit_sample(spark, sf_dir):
    return U.head(q_dim_users(spark, sf_dir), 10, order_by=["user_id"])


def q_union_sources(spark, sf_dir):
    batch = q_fact_transactions(spark, sf_dir).select(
        "transaction_id",
        F.col("user_id").cast("string").alias("user_id"),
        "amount",
        "currency",
        "transaction_date",
        F.lit("batch").alias("origin"),
    )
    stream = T.stream_transactions(spark, sf_dir).select(
        "transaction_id",
        "user_id",
        "amount",
        "currency",
        F.col("timestamp").cast("date").alias("transaction_date"),
        F.lit("stream").alias("origin"),
    )
    return U.union_all([batch, stream])


def q_union_by_name(spark, sf_dir):
    batch = C.drop_metadata(T.transactions_raw(spark, sf_dir))
    stream = T.stream_transactions(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("bigint"))
    return U.union_by_name([batch, stream])


def stream_records(spark, sf_dir):
    return EV.parse_envelope(T.kafka_envelope(T.stream_transactions(spark, sf_dir)))


def q_json_envelope(spark, sf_dir):
    return stream_records(spark, sf_dir)


def q_merchant_minute(spark, sf_dir):
    return W.flatten_window(W.merchant_windows(stream_records(spark, sf_dir)))


DAY1, DAY2 = "2024-02-01 00:00:00", "2024-02-02 00:00:00"
EXPECTED_DATASETS = ("users", "transactions", "logs", "weather_api")


def _landed_users(spark, sf_dir):
    """Land the users extract on two days (K1), return the lake root."""
    lake = shared_dir(spark, "lake", unique=True)
    users = C.drop_metadata(T.users_raw(spark, sf_dir))
    R.ingest_batch(users, lake, "users", "customer", DAY1)
    R.ingest_batch(users, lake, "users", "customer", DAY2)
    return lake


def q_raw_roundtrip(spark, sf_dir):
    """K1 twice -> S1 -> clean: the re-ingested rows differ in ingest time,
    so the default exact de-dup keeps both copies (faithful order)."""
    lake = _landed_users(spark, sf_dir)
    return C.clean_data(R.read_raw(spark, lake, "users"), "users")


def q_raw_roundtrip_keyed(spark, sf_dir):
    """Same landing, keyed de-dup on user_id: latest ingest wins."""
    lake = _landed_users(spark, sf_dir)
    return C.clean_data(R.read_raw(spark, lake, "users"), "users", subset=["user_id"])


def _landed_all(spark, sf_dir):
    lake = shared_dir(spark, "lake", unique=True)
    R.ingest_batch(C.drop_metadata(T.users_raw(spark, sf_dir)), lake, "users", "customer", DAY1)
    R.ingest_batch(C.drop_metadata(T.transactions_raw(spark, sf_dir)), lake, "transactions", "orders", DAY1)
    R.ingest_batch(C.drop_metadata(T.logs_raw(spark, sf_dir)), lake, "logs", "events", DAY1)
    R.ingest_batch(C.drop_metadata(T.users_raw(spark, sf_dir)), lake, "users", "customer", DAY2)
    return lake


def q_ingest_report(spark, sf_dir):
    return R.ingest_report(R.read_manifest(spark, _landed_all(spark, sf_dir)))


def q_completeness(spark, sf_dir):
    return Q.completeness(R.read_manifest(spark, _landed_all(spark, sf_dir)), EXPECTED_DATASETS)


_RUNS: dict[tuple[str, str], dict] = {}


def full_run(spark, sf_dir):
    """P2 over the derived datasets, once per application and input folder."""
    key = (spark.conf.get("spark.app.id", "app"), sf_dir)
    if key not in _RUNS:
        from lakeforge.plans.run import run_pipeline

        batches = [
            (C.drop_metadata(T.users_raw(spark, sf_dir)), "users", "customer"),
            (C.drop_metadata(T.transactions_raw(spark, sf_dir)), "transactions", "orders"),
            (C.drop_metadata(T.logs_raw(spark, sf_dir)), "logs", "events"),
        ]
        schema = f"curated_{uuid.uuid4().hex[:8]}"  # one warehouse per input folder
        _RUNS[key] = run_pipeline(spark, shared_dir(spark, "lake", unique=True), batches, AS_OF, schema=schema)
    return _RUNS[key]


def q_warehouse_user_analytics(spark, sf_dir):
    return spark.table(full_run(spark, sf_dir)["warehouse"].qualified("user_analytics"))


def q_warehouse_transaction_summary(spark, sf_dir):
    return spark.table(full_run(spark, sf_dir)["warehouse"].qualified("transaction_summary"))


def q_warehouse_dq_summary(spark, sf_dir):
    return full_run(spark, sf_dir)["tests"]


def q_warehouse_table_info(spark, sf_dir):
    """Every table with whether it has bytes and whether its shown size fits them
    (the bytes themselves depend on the file encoding)."""
    info = full_run(spark, sf_dir)["warehouse"].get_table_info()
    shown = F.regexp_extract("size", r"^(\d+) ", 1).cast("double") * F.when(F.col("size").endswith("MB"), 1 << 20).when(F.col("size").endswith("kB"), 1 << 10).otherwise(1)
    return info.select(
        "table_name", (F.col("size_bytes") > 0).alias("has_bytes"),
        (F.abs(shown - F.col("size_bytes")) <= F.col("size_bytes") * 0.06).alias("size_fits"),
    )


STREAM_BATCHES = 4


STREAM_WATERMARK = "10 minutes"


def _landed_envelopes(spark, sf_dir, batches=STREAM_BATCHES):
    """Envelopes landed as files; returns (base, stream reader).

    The file source orders micro-batches by file modification time, not by
    event time, so with several batches some rows arrive after the
    watermark has passed them.
    """
    from lakeforge.streaming import jobs

    base = shared_dir(spark, "stream", unique=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    T.kafka_envelope(T.stream_transactions(spark, sf_dir)).repartitionByRange(parts, "timestamp").write.parquet(
        f"{base}/in"
    )
    per_trigger = max(1, -(-parts // batches)) if batches > 1 else None
    return base, jobs.envelope_file_stream(spark, f"{base}/in", max_files_per_trigger=per_trigger)


def q_merchant_minute_stream(spark, sf_dir):
    """W1/W2 through Structured Streaming: several micro-batches, complete mode."""
    from lakeforge.streaming import jobs

    base, envelopes = _landed_envelopes(spark, sf_dir)
    final = jobs.run_merchant_snapshot(envelopes, f"{base}/checkpoint", f"{base}/out")
    return W.flatten_window(spark.read.parquet(final))


def q_merchant_minute_watermarked(spark, sf_dir):
    """Watermarked append mode; windows closed by the watermark only.

    One data batch (then the no-data batch that advances the watermark), so
    no row is late; late-arrival drops are covered by the unit tests.
    """
    from lakeforge.streaming import jobs

    base, envelopes = _landed_envelopes(spark, sf_dir, batches=1)
    out = jobs.run_merchant_append(envelopes, f"{base}/checkpoint", f"{base}/out", STREAM_WATERMARK)
    return W.flatten_window(spark.read.parquet(out))


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
EVENTS_URL = "https://example.invalid/events"
# landing producers keep the microseconds (the text formats default to millis)
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def q_file_batch_csv(spark, sf_dir):
    """S6 + K1 + S1: the events table landed as CSV files, ingested, read back."""
    from lakeforge.sources import connectors as S

    base = shared_dir(spark, "landing", unique=True)
    T.table(spark, sf_dir, "events").write.option("header", "true").option("timestampNTZFormat", MICROS).csv(
        f"{base}/events_csv"
    )
    lake = f"{base}/lake"
    S.ingest_files(spark, lake, "events", f"{base}/events_csv", "csv", DAY1, schema=EVENTS_SCHEMA)
    return C.drop_metadata(R.read_raw(spark, lake, "events"))


def _landed_events_json(spark, sf_dir):
    base = shared_dir(spark, "landing", unique=True)
    events = T.table(spark, sf_dir, "events").withColumn("_id", F.col("event_id"))
    events.write.option("timestampNTZFormat", MICROS).json(f"{base}/events_json")
    return f"{base}/events_json"


def q_api_landing(spark, sf_dir):
    """The events table landed as JSON records (API responses), read with
    a schema and tagged with its source URL."""
    from lakeforge.sources import connectors as S

    return S.read_api_landing(spark, _landed_events_json(spark, sf_dir), EVENTS_URL, schema=EVENTS_SCHEMA)


def q_document_extract(spark, sf_dir):
    """The same landing read as a document extract; ids carried as strings."""
    from lakeforge.sources import connectors as S

    return S.read_document_store(spark, fmt="json", path=_landed_events_json(spark, sf_dir),
                                 schema=EVENTS_SCHEMA + ", _id bigint")


def q_document_find(spark, sf_dir):
    """S2 with an equality filter over documents with wrapped object ids."""
    from lakeforge.sources import connectors as S

    base = shared_dir(spark, "landing", unique=True)
    oid = F.struct(F.lpad(F.lower(F.hex("event_id")), 24, "0").alias("$oid"))
    T.table(spark, sf_dir, "events").withColumn("_id", oid).write.option("timestampNTZFormat", MICROS).json(base)
    return S.read_document_store(spark, fmt="json", path=base, query={"event_type": "error"},
                                 schema=EVENTS_SCHEMA + ", _id struct<`$oid`: string>")


def q_wide_column_extract(spark, sf_dir):
    """S3: projection over a wide-column extract; its id column as text."""
    from lakeforge.sources import connectors as S

    base = shared_dir(spark, "landing", unique=True)
    T.table(spark, sf_dir, "events").withColumnRenamed("event_id", "id").write.parquet(base)
    return S.read_wide_column(spark, fmt="parquet", path=base, columns=["id", "ts", "value"])


def _through_text(spark, df):
    """The frame landed as CSV and read back without types: every column is text."""
    from lakeforge.sources import connectors as S

    base = shared_dir(spark, "landing", unique=True)
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.option("header", "true").options(**spaces).csv(base)
    return S.read_files(spark, base, "csv", options=spaces)


def users_text(spark, sf_dir):
    """Users as text; every 19th or so has an age that is no number."""
    age = F.when(F.col("user_id") % 19 == 3, F.lit("unknown")).otherwise(F.col("age").cast("string"))
    return _through_text(spark, C.drop_metadata(T.users_raw(spark, sf_dir)).withColumn("age", age))


def transactions_text(spark, sf_dir):
    """Transactions as text; every 97th or so has an amount that is no number."""
    amount = F.when(F.col("transaction_id").cast("bigint") % 97 == 5, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    day = F.col("transaction_date").cast("date")
    return _through_text(spark, C.drop_metadata(T.transactions_raw(spark, sf_dir)).withColumns({"amount": amount, "transaction_date": day}))


def q_clean_users_text(spark, sf_dir):
    """C2 over untyped text: a bad age is dropped by its rule, it does not end the job."""
    return C.clean_data(users_text(spark, sf_dir), "users")


def q_clean_transactions_text(spark, sf_dir):
    """C3 over untyped text."""
    return C.clean_data(transactions_text(spark, sf_dir), "transactions")


def q_agg_transactions_text(spark, sf_dir):
    """C3, E3, A1 over untyped text: amounts compare and add up as numbers."""
    return A.aggregate_data(E.enrich_data(C.clean_data(transactions_text(spark, sf_dir), "transactions"), "transactions", AS_OF), "transactions")


def q_agg_raw_amounts(spark, sf_dir):
    """A1's money over amounts with digits below a cent; NaN amounts stay NaN in sum and average."""
    k = F.col("o_orderkey")
    amount = F.when(k % 997 == 3, F.lit(float("nan"))).otherwise(F.col("o_totalprice") * F.lit(0.31830988618379067))
    tx = T.table(spark, sf_dir, "orders").select(
        k.cast("string").alias("transaction_id"), F.col("o_custkey").alias("user_id"), amount.alias("amount"),
        F.col("o_orderdate").cast("date").alias("transaction_date"), F.col("o_orderpriority").alias("merchant"),
    )
    out = A.aggregate_data(tx, "transactions")
    return out.select("user_id", "total_transactions", F.round("total_amount", 5).alias("total_amount"), F.round("avg_amount", 5).alias("avg_amount"))


def q_agg_passthrough(spark, sf_dir):
    """A3: a type without an aggregate passes through."""
    return _no_processed_ts(A.aggregate_data(users_processed(spark, sf_dir), "users"))


def q_raw_one_day(spark, sf_dir):
    """S1 of one ingest day: only that day's folder is listed and read."""
    return R.read_raw(spark, _landed_users(spark, sf_dir), "users", where="year = 2024 AND month = 2 AND day = 2")


def q_processed_table(spark, sf_dir):
    """P1 + T2: RAW -> PROCESSED, partitioned, then read through its registered table."""
    from lakeforge.plans.transform import transform_pipeline

    lake, name = shared_dir(spark, "lake", unique=True), f"tx_{uuid.uuid4().hex[:8]}"
    R.ingest_batch(C.drop_metadata(T.transactions_raw(spark, sf_dir)), lake, name, "orders", DAY1)
    transform_pipeline(spark, lake, name, "transactions", as_of=AS_OF)
    return _no_processed_ts(spark.table(f"processed_{name}"))


def q_kafka_pull(spark, sf_dir):
    """Broker envelopes pulled in several bounded batches into RAW, read back."""
    from lakeforge.streaming import jobs

    base, envelopes = _landed_envelopes(spark, sf_dir)
    query = jobs.bounded_pull(envelopes, f"{base}/lake", "tx", f"{base}/checkpoint", EV.TRANSACTION_SCHEMA)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return C.drop_metadata(R.read_raw(spark, f"{base}/lake", "tx"))


def _warehouse(spark):
    from lakeforge.plans.warehouse import Warehouse

    return Warehouse(spark, shared_dir(spark, "warehouse", unique=True), f"curated_{uuid.uuid4().hex[:8]}")


def q_curated_replace_new_schema(spark, sf_dir):
    """K4: a replace whose frame has other columns and types; the table takes them over."""
    wh, users = _warehouse(spark), q_clean_users(spark, sf_dir)
    wh.write_table(users.drop("country").withColumn("user_id", F.col("user_id").cast("string")), "users")
    wh.write_table(users, "users")
    return spark.table(wh.qualified("users"))


def q_curated_append_by_name(spark, sf_dir):
    """K4: an append whose frame has the columns in another order."""
    wh, tx = _warehouse(spark), q_clean_transactions(spark, sf_dir)
    wh.write_table(tx, "transactions")
    wh.write_table(tx.select(*reversed(tx.columns)), "transactions", if_exists="append")
    return spark.table(wh.qualified("transactions"))


def q_view_refresh(spark, sf_dir):
    """A snapshot view with a layout, refreshed after its table grew."""
    wh, tx = _warehouse(spark), q_clean_transactions(spark, sf_dir)
    wh.write_table(tx, "transactions")
    wh.create_materialized_view(
        "per_user", f"SELECT user_id, count(*) AS n, max(amount) AS top FROM {wh.qualified('transactions')} GROUP BY user_id", cluster_by=("user_id",)
    )
    wh.write_table(tx, "transactions", if_exists="append")
    wh.refresh_materialized_view("per_user")
    return spark.table(wh.qualified("per_user"))


def q_pretty_sizes(spark, sf_dir):
    """F8: sizes in bytes as text, over sizes from bytes to petabytes."""
    size = F.floor(F.col("o_totalprice")).cast("bigint") * F.pow(F.lit(8), F.col("o_orderkey") % 13).cast("bigint")
    return T.table(spark, sf_dir, "orders").select("o_orderkey", pretty_size(size).alias("size"))


def q_merchant_minute_updates(spark, sf_dir):
    """W1 in update mode over several micro-batches: only changed windows are
    written per trigger; the result is the newest version of each window."""
    from lakeforge.streaming import jobs

    base, envelopes = _landed_envelopes(spark, sf_dir)
    out = jobs.run_merchant_updates(envelopes, f"{base}/checkpoint", f"{base}/out")
    return W.flatten_window(jobs.read_latest(spark, out))


def q_raw_ingest(spark, sf_dir):
    """K1 + E9: land transactions, read RAW back with its ingest metadata."""
    lake = shared_dir(spark, "lake", unique=True)
    R.ingest_batch(C.drop_metadata(T.transactions_raw(spark, sf_dir)), lake, "transactions", "orders", DAY1)
    return R.read_raw(spark, lake, "transactions")


def q_raw_type_drift(spark, sf_dir):
    """Users landed as untyped text, then typed: read together and cleaned."""
    lake = shared_dir(spark, "lake", unique=True)
    R.ingest_batch(users_text(spark, sf_dir), lake, "users", "files", DAY1)
    R.ingest_batch(C.drop_metadata(T.users_raw(spark, sf_dir)), lake, "users", "customer", DAY2)
    return C.clean_data(R.read_raw(spark, lake, "users"), "users")


def q_empty_replay(spark, sf_dir):
    """K1: an ingest whose id holds a time is pulled again and is empty: its rows go, its day's others stay."""
    lake = shared_dir(spark, "lake", unique=True)
    users, again = C.drop_metadata(T.users_raw(spark, sf_dir)), "scheduled__2024-02-01T00:00:00+00:00"
    R.ingest_batch(users, lake, "users", "customer", DAY1, ingest_id="first")
    R.ingest_batch(users, lake, "users", "customer", DAY1, ingest_id=again)
    R.ingest_batch(users.limit(0), lake, "users", "customer", DAY1, ingest_id=again)
    return R.ingest_report(R.read_manifest(spark, lake)).withColumn("rows_read", F.lit(R.read_raw(spark, lake, "users").count()))


def _pulled_twice(spark, sf_dir):
    """Transactions in three pulls of one ingest time, every row in two of them; (lake, dataset, filters)."""
    lake, name = shared_dir(spark, "lake", unique=True), f"tx_{uuid.uuid4().hex[:8]}"
    tx, part = C.drop_metadata(T.transactions_raw(spark, sf_dir)), F.col("transaction_id").cast("bigint") % 3
    for n in range(3):
        R.ingest_batch(tx.where(part != n), lake, name, "orders", DAY1, ingest_id=f"pull{n}")
    return lake, name, [f"ingest_id = 'pull{n}'" for n in range(3)]


def q_incremental_equals_full(spark, sf_dir):
    """Three incremental runs over pulls that overlap give the rows of one full run."""
    from lakeforge.plans.transform import transform_pipeline

    lake, name, filters = _pulled_twice(spark, sf_dir)
    for where in filters:
        transform_pipeline(spark, lake, name, "transactions", as_of=AS_OF, raw_filter=where, mode="append")
    return _no_processed_ts(spark.table(f"processed_{name}"))


def q_incremental_retry(spark, sf_dir):
    """K2: a full run over the first pull, then runs of which some are repeated: nothing is doubled."""
    from lakeforge.plans.transform import processed_path, transform_pipeline
    from lakeforge.plans.warehouse import read_processed

    lake, name, filters = _pulled_twice(spark, sf_dir)
    transform_pipeline(spark, lake, name, "transactions", as_of=AS_OF, raw_filter=filters[0])
    for n in (0, 1, 1, 2, 1):
        transform_pipeline(spark, lake, name, "transactions", as_of=AS_OF, raw_filter=filters[n], mode="append")
    return _no_processed_ts(read_processed(spark, processed_path(lake, name)))


def _land(spark, df, base, n):
    """Batch ``n`` of a file stream: a file of each of its tasks, newer than those of the batches before; how many."""
    folder = f"{base}/in/{n:03d}"
    df.write.parquet(folder)
    return len(list_files(spark, folder))


def _landed(spark, schema, base, files=None):
    """The landed files as a stream that takes the oldest first: all that there are, or so many a trigger."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(f"{base}/in/*")


ARRIVALS, LATE_EVERY = 8, 10  # batches by event time; of so many rows one comes a batch late


def _arrival(ts, start, end):
    """Batch of a row: its share of the table's time span, one batch later for some."""
    share = (F.unix_micros(ts.cast("timestamp")) - F.lit(start)) * ARRIVALS / F.lit(end - start + 1)
    return F.floor(share).cast("int") + F.when(F.col("event_id") % LATE_EVERY == 7, 1).otherwise(0)


def q_merchant_minute_late(spark, sf_dir):
    """Windows that the watermark has closed, and the rows that came too late for theirs, over
    ordered batches in which a tenth of the rows come a batch late."""
    from lakeforge.streaming import jobs

    base = shared_dir(spark, "stream", unique=True)
    events = T.table(spark, sf_dir, "events")
    start, end = events.agg(*[f(F.unix_micros(F.col("ts").cast("timestamp"))) for f in (F.min, F.max)]).first()
    batch = events.select(F.col("event_id").cast("string").alias("transaction_id"), _arrival(F.col("ts"), start, end).alias("arrives"))
    sent = T.stream_transactions(spark, sf_dir).join(batch.hint("merge"), "transaction_id")  # both sides grow with the input
    sent.write.parquet(f"{base}/sent")  # joined once, not for each batch
    sent = spark.read.schema(sent.schema).parquet(f"{base}/sent")
    envelopes = _landed(spark, jobs.ENVELOPE_SCHEMA, base)
    for n in range(ARRIVALS + 1):  # a run for each batch: its files are one micro-batch
        _land(spark, T.kafka_envelope(sent.where(F.col("arrives") == n).drop("arrives")), base, n)
        jobs.split_late(envelopes, f"{base}/split_checkpoint", f"{base}/split", STREAM_WATERMARK)
    windows, late = jobs.merchant_windows_and_late(envelopes, base, STREAM_WATERMARK)
    closed = W.flatten_window(windows).select(
        F.lit("window").alias("kind"), "window_start", "merchant", "transaction_count", "avg_amount", F.lit(None).cast("string").alias("transaction_id")
    )
    missed = late.select(
        F.lit("late").alias("kind"), F.window("timestamp", fixed.STREAM_WINDOW)["start"].alias("window_start"), "merchant",
        F.lit(None).cast("bigint").alias("transaction_count"), F.lit(None).cast("double").alias("avg_amount"), "transaction_id",
    )
    return closed.unionByName(missed)


def q_dq_alerts_stream(spark, sf_dir):
    """Q5b as a stream over ordered batches, stopped after each of them and started again."""
    from lakeforge.streaming import jobs

    base = shared_dir(spark, "stream", unique=True)
    logs = T.logs_raw(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    start, end = logs.agg(*[f(F.unix_micros("timestamp")) for f in (F.min, F.max)]).first()
    part = F.floor((F.unix_micros("timestamp") - F.lit(start)) * STREAM_BATCHES / F.lit(end - start + 1))
    for n in range(STREAM_BATCHES):
        _land(spark, logs.where(part == n), base, n)
        jobs.run_error_rates(_landed(spark, logs.schema, base), "logs", "timestamp", f"{base}/checkpoint", f"{base}/out", STREAM_WATERMARK)
    return jobs.error_alerts(spark, f"{base}/out")


def q_kafka_pull_bounded(spark, sf_dir):
    """Two runs of one bounded batch each over three batches of envelopes land the first two."""
    from lakeforge.streaming import jobs

    base = shared_dir(spark, "stream", unique=True)
    sent = T.stream_transactions(spark, sf_dir)
    files = [_land(spark, T.kafka_envelope(sent.where(F.col("transaction_id").cast("bigint") % 3 == n)), base, n) for n in range(3)]
    for held in files[:2]:  # the limit of a run is one batch
        jobs.pull_once(_landed(spark, jobs.ENVELOPE_SCHEMA, base, held), f"{base}/lake", "tx", f"{base}/checkpoint", EV.TRANSACTION_SCHEMA)
    return C.drop_metadata(R.read_raw(spark, f"{base}/lake", "tx"))


def _refreshed(spark, sf_dir, refresh):
    """Users and three overlapping pulls of transactions, in incremental runs with a refresh after each,
    one run repeated; the last refresh must have read the last run alone."""
    from lakeforge.plans.transform import processed_path, transform_pipeline

    wh = _warehouse(spark)
    lake, name, filters = _pulled_twice(spark, sf_dir)
    people = f"users_{name}"
    R.ingest_batch(C.drop_metadata(T.users_raw(spark, sf_dir)), lake, people, "customer", DAY1, ingest_id="all")
    transform_pipeline(spark, lake, people, "users", as_of=AS_OF, raw_filter="ingest_id = 'all'", mode="append")
    for n in (0, 1, 1, 2):
        transform_pipeline(spark, lake, name, "transactions", as_of=AS_OF, raw_filter=filters[n], mode="append")
        read = refresh(wh, processed_path(lake, people), processed_path(lake, name))
    if len(read) != 1:
        raise RuntimeError(f"the last refresh read {read}")
    return wh


def q_view_refresh_incremental(spark, sf_dir):
    """T4, V2: the summary merged from a stored state of each run."""
    from lakeforge.plans import incremental_views as I

    wh = _refreshed(spark, sf_dir, lambda wh, users, tx: I.refresh_transaction_summary(wh, tx))
    return spark.table(wh.qualified("transaction_summary"))


def q_view_refresh_incremental_users(spark, sf_dir):
    """T4, V1: users' sums and distinct transactions merged from a stored state of each run."""
    from lakeforge.plans import incremental_views as I

    return spark.table(_refreshed(spark, sf_dir, I.refresh_user_analytics).qualified("user_analytics"))


INDEXED = {"users": ("user_id", users_processed), "transactions": ("transaction_id", transactions_processed), "logs": ("log_id", logs_processed)}
INDEX_FILES = 64


def q_index_files_read(spark, sf_dir):
    """T5: for every indexed column an equality with the value of a row in the middle of the table:
    the rows that it finds, and whether fewer than half of the files may hold the value by their bounds."""
    from lakeforge.plans.layout import file_bounds, lookup_files
    from lakeforge.plans.run import INDEXES

    wh, out = _warehouse(spark), []
    for table, (key, source) in INDEXED.items():
        wh.write_table(source(spark, sf_dir), table)
        wh.create_indexes(table, INDEXES[table], files=INDEX_FILES)
        df, number = spark.table(wh.qualified(table)), F.col(key).cast("bigint")
        low, high = df.agg(F.min(number), F.max(number)).first()
        row = df.where(number >= (low + high) // 2).agg(*[F.min_by(c, number).alias(c) for c in INDEXES[table]]).first()
        bounds = file_bounds(df, INDEXES[table])
        for c in INDEXES[table]:
            files, touched = lookup_files(bounds, c, row[c])
            out.append((table, c, df.where(F.col(c) == F.lit(row[c])).count(), 2 * touched < files))
    return spark.createDataFrame(out, "table_name string, column_name string, rows_found bigint, under_half boolean")


def q_warehouse_table_files(spark, sf_dir):
    """Per curated table the rows of its files, and whether their bytes add up to those of the
    folder's listing (files without rows aside)."""
    from lakeforge.session import list_files

    wh, out = full_run(spark, sf_dir)["warehouse"], []
    for table in ("users", "transactions", "logs", "user_analytics", "transaction_summary", "dim_users", "fact_transactions"):
        files = wh.table_files(table).collect()
        listed = list_files(spark, wh.location(table))
        held = {f["file_path"].rsplit("/", 1)[1]: f["bytes"] for f in files}
        out.append((table, sum(f["rows"] for f in files), {n: b for n, b in listed.items() if n in held} == held and all(b > 0 for b in held.values())))
    return spark.createDataFrame(out, "table_name string, row_count bigint, bytes_as_listed boolean")


def q_curated_colocated(spark, sf_dir):
    """K4, V1: users and transactions in buckets of user_id; the view joins them without a shuffle."""
    wh = _warehouse(spark)
    wh.write_table(users_processed(spark, sf_dir), "users", bucket_by=["user_id"], buckets=16)
    wh.write_table(transactions_processed(spark, sf_dir), "transactions", bucket_by=["user_id"], buckets=16)
    return A.user_analytics(spark.table(wh.qualified("users")), spark.table(wh.qualified("transactions")))


def q_curated_colocated_relationship(spark, sf_dir):
    """K4, Q3: the reference of the fact table's users is tested over bucketed models."""
    wh = _warehouse(spark)
    for name, df in models(spark, sf_dir).items():
        wh.write_table(df, name, bucket_by=["user_id"], buckets=16)
    return Q.model_tests({name: spark.table(wh.qualified(name)) for name in ("dim_users", "fact_transactions")}, _tests("relationships"))


QUERIES: dict[str, Query] = {
    "clean_generic": q_clean_generic,
    "clean_users": q_clean_users,
    "clean_transactions": q_clean_transactions,
    "clean_logs": q_clean_logs,
    "clean_report": q_clean_report,
    "rejects_by_rule": q_rejects_by_rule,
    "enrich_users": q_enrich_users,
    "enrich_transactions": q_enrich_transactions,
    "enrich_logs": q_enrich_logs,
    "agg_transactions": q_agg_transactions,
    "agg_logs": q_agg_logs,
    "user_analytics": q_user_analytics,
    "transaction_summary": q_transaction_summary,
    "dim_users": q_dim_users,
    "fact_transactions": q_fact_transactions,
    "dq_unique": q_dq_unique,
    "dq_not_null": q_dq_not_null,
    "dq_relationships": q_dq_relationships,
    "dq_summary": q_dq_summary,
    "dq_alerts": q_dq_alerts,
    "dq_test_alert": q_dq_test_alert,
    "clean_observed": q_clean_observed,
    "row_counts": q_row_counts,
    "freshness": q_freshness,
    "limit_sample": q_limit_sample,
    "union_sources": q_union_sources,
    "union_by_name": q_union_by_name,
    "json_envelope": q_json_envelope,
    "merchant_minute": q_merchant_minute,
    "raw_roundtrip": q_raw_roundtrip,
    "raw_roundtrip_keyed": q_raw_roundtrip_keyed,
    "ingest_report": q_ingest_report,
    "completeness": q_completeness,
    "warehouse_user_analytics": q_warehouse_user_analytics,
    "warehouse_transaction_summary": q_warehouse_transaction_summary,
    "warehouse_dq_summary": q_warehouse_dq_summary,
    "warehouse_table_info": q_warehouse_table_info,
    "merchant_minute_stream": q_merchant_minute_stream,
    "merchant_minute_watermarked": q_merchant_minute_watermarked,
    "merchant_minute_updates": q_merchant_minute_updates,
    "raw_ingest": q_raw_ingest,
    "file_batch_csv": q_file_batch_csv,
    "api_landing": q_api_landing,
    "document_extract": q_document_extract,
    "document_find": q_document_find,
    "wide_column_extract": q_wide_column_extract,
    "clean_users_text": q_clean_users_text,
    "clean_transactions_text": q_clean_transactions_text,
    "agg_transactions_text": q_agg_transactions_text,
    "agg_raw_amounts": q_agg_raw_amounts,
    "agg_passthrough": q_agg_passthrough,
    "raw_one_day": q_raw_one_day,
    "processed_table": q_processed_table,
    "kafka_pull": q_kafka_pull,
    "curated_replace_new_schema": q_curated_replace_new_schema,
    "curated_append_by_name": q_curated_append_by_name,
    "view_refresh": q_view_refresh,
    "pretty_sizes": q_pretty_sizes,
    "raw_type_drift": q_raw_type_drift,
    "empty_replay": q_empty_replay,
    "incremental_equals_full": q_incremental_equals_full,
    "incremental_retry": q_incremental_retry,
    "view_refresh_incremental": q_view_refresh_incremental,
    "view_refresh_incremental_users": q_view_refresh_incremental_users,
    "merchant_minute_late": q_merchant_minute_late,
    "dq_alerts_stream": q_dq_alerts_stream,
    "kafka_pull_bounded": q_kafka_pull_bounded,
    "index_files_read": q_index_files_read,
    "warehouse_table_files": q_warehouse_table_files,
    "curated_colocated": q_curated_colocated,
    "curated_colocated_relationship": q_curated_colocated_relationship,
}
