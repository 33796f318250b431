"""Adapters from the driver's tables to the pipeline's logical datasets.

The pipeline works on ``users``, ``transactions``, ``logs`` and a stream of
transactions.  The test tables are TPC-H-like (customer, orders, events ...),
so each logical dataset is *derived* from one of them by Spark: every row of
the source table becomes one row of the dataset, and the values are shaped
so that every cleaning and enrichment branch is exercised (bad emails,
out-of-range ages, negative or missing amounts, unknown currencies, invalid
statuses and levels).  Work grows with the source tables; nothing is sampled.

``lakeforge.plans.oracle`` holds the same derivations as SQL text for the
DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions.expressions import timestamp_literal

# Ingest time stamped on the derived RAW rows, fixed so runs are reproducible.
DEFAULT_INGEST_TS = "2024-02-01 00:00:00"
# The customer extract arrives twice in the same landing batch (every user
# has one exact copy), which gives the exact de-duplication step real work.
EXTRACT_COPIES = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users_raw(spark: SparkSession, sf_dir: str, ingest_ts: str = DEFAULT_INGEST_TS) -> DataFrame:
    """users: user_id, name, email, age, country, registration_date + metadata."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation has 25 rows at every scale factor (fixed by the TPC-H schema):
    # a proven size bound, so it is broadcast and customer is never shuffled.
    joined = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    k = F.col("c_custkey")
    kind = k % 11
    email = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.lit("not-an-email"))
        .when(kind == 2, F.concat(F.lit(" u"), k.cast("string"), F.lit("@x.com")))
        .when(kind == 3, F.concat(F.lit("Admin."), k.cast("string"), F.lit("@Example.ORG")))
        .otherwise(F.concat(F.lit("User."), k.cast("string"), F.lit("@"), F.col("c_mktsegment"), F.lit(".com")))
    )
    age = F.when(k % 17 == 0, F.lit(None).cast("int")).otherwise((k % 131).cast("int") - 5)
    users = joined.select(
        k.alias("user_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("name"),
        email.alias("email"),
        age.alias("age"),
        F.col("n_name").alias("country"),
        F.make_date(F.lit(2020), (k % 12 + 1).cast("int"), (k % 28 + 1).cast("int")).alias("registration_date"),
        timestamp_literal(ingest_ts).alias("_ingestion_timestamp"),
        F.lit("customer").alias("_source"),
    )
    out = users
    for _ in range(EXTRACT_COPIES - 1):
        out = out.unionAll(users)
    return out


def transactions_raw(spark: SparkSession, sf_dir: str, ingest_ts: str = DEFAULT_INGEST_TS) -> DataFrame:
    """transactions: one per order, amounts with exactly two decimals."""
    orders = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    kind = k % 13
    amount = (
        F.when(kind == 0, F.lit(None).cast("double"))
        .when(kind == 1, F.lit(-1.0))
        .otherwise(F.floor(F.col("o_totalprice") / 5).cast("double") / F.lit(100.0))
    )
    cur = k % 5
    currency = (
        F.when(cur == 0, F.lit("USD"))
        .when(cur == 1, F.lit("GBP"))
        .when(cur == 2, F.lit("EUR"))
        .when(cur == 3, F.lit("XOF"))
        .otherwise(F.lit(None).cast("string"))
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("completed"))
        .when(F.col("o_orderstatus") == "P", F.lit("pending"))
        .when(k % 2 == 0, F.lit("failed"))
        .otherwise(F.lit("refunded"))
    )
    return orders.select(
        k.cast("string").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        amount.alias("amount"),
        currency.alias("currency"),
        F.col("o_orderdate").alias("transaction_date"),
        F.concat(F.lit("merchant_"), (k % 20).cast("string")).alias("merchant"),
        F.col("o_orderpriority").alias("category"),
        status.alias("status"),
        timestamp_literal(ingest_ts).alias("_ingestion_timestamp"),
        F.lit("orders").alias("_source"),
    )


def logs_raw(spark: SparkSession, sf_dir: str, ingest_ts: str = DEFAULT_INGEST_TS) -> DataFrame:
    """logs: one per event; purchases map to an invalid level."""
    events = table(spark, sf_dir, "events")
    et = F.col("event_type")
    level = (
        F.when(et == "error", F.lit("ERROR"))
        .when(et == "signup", F.lit("WARNING"))
        .when(et == "click", F.lit("INFO"))
        .when(et == "view", F.lit("DEBUG"))
        .otherwise(F.lit("TRACE"))
    )
    return events.select(
        F.col("event_id").alias("log_id"),
        F.col("ts").alias("timestamp"),
        level.alias("level"),
        F.concat(F.lit("svc_"), (F.col("user_id") % 6).cast("string")).alias("source"),
        timestamp_literal(ingest_ts).alias("_ingestion_timestamp"),
        F.lit("events").alias("_source"),
    )


def stream_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-shaped transactions (string ids, ``timestamp`` event time)."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").alias("amount"),
        F.when(F.col("event_id") % 2 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("currency"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("merchant_"), (F.col("user_id") % 20).cast("string")).alias("merchant"),
        F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("completed")).alias("status"),
    )


def kafka_envelope(stream: DataFrame) -> DataFrame:
    """Wrap stream rows as broker records: ``value`` = JSON bytes, ``timestamp``.

    The broker timestamp is taken from the event time (the producer sends
    events as they happen).
    """
    payload = F.to_json(F.struct(*[F.col(c) for c in stream.columns]))
    return stream.select(
        payload.cast("binary").alias("value"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )
