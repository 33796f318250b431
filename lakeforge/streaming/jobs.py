"""Structured Streaming jobs: sources (S4, S7), merchant aggregate.

Sources produce the broker envelope ``(value, timestamp)``.  The Kafka
connector is used when it is on the classpath; a file source with the same
envelope columns stands in for it in tests (the connector jar is not part of
this environment).

Sinks are written for restarts: every query has a checkpoint location under
the shared folder, and ``foreachBatch`` writers key their output by batch id,
so a replayed batch overwrites its own output instead of adding to it.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import BinaryType, StructField, StructType, TimestampType

from lakeforge.functions import fixed
from lakeforge.operators import quality as Q
from lakeforge.session import list_paths, remove_folder
from lakeforge.sources.raw import ingest_batch
from lakeforge.streaming.envelope import TRANSACTION_SCHEMA, parse_envelope
from lakeforge.streaming.windows import completed, merchant_windows

ENVELOPE_SCHEMA = StructType(
    [StructField("value", BinaryType(), True), StructField("timestamp", TimestampType(), True)]
)


# --- sources ---------------------------------------------------------------------

def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to a topic; ``(value, timestamp)`` plus Kafka metadata."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def envelope_file_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Landed envelope files as a stream (same columns as the Kafka source)."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


# --- W1 / W2 / W3 -------------------------------------------------------------

def merchant_stream(envelopes: DataFrame, watermark: str | None = None) -> DataFrame:
    """Envelope stream -> parsed transactions -> per merchant, per minute."""
    return merchant_windows(parse_envelope(envelopes, TRANSACTION_SCHEMA), watermark=watermark)


def start_merchant_query(
    aggregated: DataFrame,
    checkpoint: str,
    sink: str = "console",
    output_mode: str = "complete",
    trigger: str | None = fixed.STREAM_TRIGGER,
    available_now: bool = False,
    path: str | None = None,
) -> StreamingQuery:
    """Start the aggregate; complete mode rewrites the whole result.

    Use ``output_mode="update"`` or ``"append"`` with a watermarked
    aggregate (W3) to keep state bounded; append emits a window only once
    the watermark has passed its end.
    """
    writer = aggregated.writeStream.outputMode(output_mode).format(sink).option("checkpointLocation", checkpoint)
    if sink == "console":
        writer = writer.option("truncate", "false")
    if path:
        writer = writer.option("path", path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def _batches(spark: SparkSession, out_dir: str) -> dict[int, str]:
    """Completely written batch folders of a sink by batch id, from the store's listing."""
    done = [p.rsplit("/", 1)[0] for p in list_paths(spark, f"{out_dir}/batch_id=*/_SUCCESS")]
    return {int(p.rsplit("=", 1)[1]): p for p in done}


def latest_snapshot(spark: SparkSession, out_dir: str) -> str | None:
    """Folder of the newest complete snapshot; found in the store, so a restart finds it too."""
    done = _batches(spark, out_dir)
    return done[max(done)] if done else None


def snapshot_sink(out_dir: str, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer for complete-mode results.

    Each batch's full result goes to ``batch_id=<n>`` (overwrite, so a
    replay of batch n rewrites the same folder).  The last ``keep`` stay, so
    readers of the snapshot before the newest can finish.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id:010d}")
        for n, folder in _batches(batch.sparkSession, out_dir).items():
            if n <= batch_id - keep:
                remove_folder(batch.sparkSession, folder)

    return write


def run_merchant_snapshot(
    envelopes: DataFrame, checkpoint: str, out_dir: str, watermark: str | None = None
) -> str | None:
    """Run W1 over everything available now, complete mode, parquet snapshots.

    Returns the folder holding the final complete result, also when a
    restart finds nothing new.
    """
    query = (
        merchant_stream(envelopes, watermark)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(snapshot_sink(out_dir))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return latest_snapshot(envelopes.sparkSession, out_dir)


def run_merchant_append(envelopes: DataFrame, checkpoint: str, out_dir: str, watermark: str) -> str:
    """Watermarked aggregate in append mode into a parquet sink.

    State is bounded: a window is emitted once, when the watermark (newest
    event time seen minus ``watermark``) reaches its end, and then dropped
    from the state store.  The file sink's commit log makes the output
    exactly-once across restarts.
    """
    query = start_merchant_query(
        merchant_stream(envelopes, watermark), checkpoint, sink="parquet", output_mode="append",
        available_now=True, path=out_dir,
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return out_dir


def changes_sink(out_dir: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer for update mode: each batch's changed rows go to
    their own ``batch_id=<n>`` folder (a replay of batch n rewrites it)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id:010d}")

    return write


def read_latest(spark: SparkSession, out_dir: str, keys: tuple[str, ...] = ("window", "merchant")) -> DataFrame:
    """Current result of an update-mode sink: the newest version of each key.

    ``max(struct(batch_id, ...))`` per key is a partial aggregate, so a hot
    key's versions collapse map-side; nothing is rewritten on the write path.
    Reads the newest compacted base, if any, and the batches after it.
    """
    return _newest(spark, out_dir, keys).drop("batch_id")


def _base(spark: SparkSession, out_dir: str) -> tuple[str | None, int]:
    """Newest complete base of an update-mode sink and the last batch it holds."""
    done = list_paths(spark, f"{out_dir}/base/upto=*/_SUCCESS")
    folder = done[-1].rsplit("/", 1)[0] if done else None
    return folder, int(folder.rsplit("=", 1)[1]) if folder else -1


def _newest(spark: SparkSession, out_dir: str, keys: tuple[str, ...]) -> DataFrame:
    base, upto = _base(spark, out_dir)
    after = [folder for n, folder in sorted(_batches(spark, out_dir).items()) if n > upto]
    parts = [spark.read.parquet(base)] if base else []
    if after or not base:
        changes = spark.read.option("basePath", out_dir).parquet(*(after or [out_dir]))
        parts.append(changes.withColumn("batch_id", F.col("batch_id").cast("bigint")))
    df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    values = [c for c in df.columns if c not in keys and c != "batch_id"]
    latest = F.max(F.struct(F.col("batch_id"), *[F.col(c) for c in values])).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in ["batch_id", *values]])


def compact_updates(spark: SparkSession, out_dir: str, keys: tuple[str, ...] = ("window", "merchant")) -> str | None:
    """Fold the batches of an update-mode sink into one base, so that reads do
    not grow with the number of triggers.

    The base is written aside and counts once complete.  What the base before
    it already held is removed only now, so running readers can finish.
    """
    old, held = _base(spark, out_dir)
    done = _batches(spark, out_dir)
    upto = max([held, *done])
    new = f"{out_dir}/base/upto={upto:010d}"
    if upto == held:
        return new if old else None
    _newest(spark, out_dir, keys).write.mode("overwrite").parquet(new)
    for n, folder in done.items():
        if n <= held:
            remove_folder(spark, folder)
    for path in list_paths(spark, f"{out_dir}/base/upto=*"):
        if int(path.rsplit("=", 1)[1]) < held:
            remove_folder(spark, path)
    return new


def run_merchant_updates(
    envelopes: DataFrame, checkpoint: str, out_dir: str, watermark: str | None = None
) -> str:
    """W1 in update mode: each trigger writes only the windows it changed.

    Output volume per trigger is proportional to the new data, not to the
    whole result (complete mode rewrites everything every trigger).  With
    ``watermark`` the state is bounded as well.
    """
    query = (
        merchant_stream(envelopes, watermark)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(changes_sink(out_dir))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return out_dir


# --- W3: rows too late for their window ----------------------------------------

def split_late(
    envelopes: DataFrame, checkpoint: str, out_dir: str, delay: str, window: str = fixed.STREAM_WINDOW, schema: StructType = TRANSACTION_SCHEMA
) -> str:
    """Part a stream, batch by batch, into rows in time and rows too late; returns ``out_dir``.

    The watermark of a batch is the newest event time of all batches before it,
    less ``delay``; a row is late if its window has ended by then.  Rows go to
    ``on_time/batch_id=<n>`` and ``late/batch_id=<n>`` (``late``: with the watermark that they missed), the
    newest event time to ``progress/batch_id=<n>``.  A replayed batch reads the progress of the
    batches before it again, so it parts its rows as it did.  An aggregate
    with the same watermark over ``on_time`` drops nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = completed(parse_envelope(batch, schema)).where("timestamp is not null")
        mark = _watermark(spark, f"{out_dir}/progress", batch_id, delay)
        ends = F.window("timestamp", window)["end"]
        missed = (ends <= mark) if mark is not None else F.lit(False)
        parted = rows.withColumn("_late", missed)
        batch_folder = f"batch_id={batch_id:010d}"
        parted.where("not _late").drop("_late").write.mode("overwrite").parquet(f"{out_dir}/on_time/{batch_folder}")
        late = parted.where("_late").drop("_late").withColumn("watermark", F.lit(None).cast("timestamp") if mark is None else mark)
        late.write.mode("overwrite").parquet(f"{out_dir}/late/{batch_folder}")
        newest = F.max("timestamp") if mark is None else F.greatest(F.max("timestamp"), mark + F.expr(f"INTERVAL {delay}"))
        rows.agg(newest.alias("newest")).write.mode("overwrite").parquet(f"{out_dir}/progress/{batch_folder}")

    query = envelopes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return out_dir


def _watermark(spark: SparkSession, progress: str, batch_id: int, delay: str) -> Column | None:
    """Newest event time of the batches before this one, less ``delay``; None if there is none.

    A batch's record is one row with the newest time up to its own end, so the record before this batch is enough.
    """
    before = {n: folder for n, folder in _batches(spark, progress).items() if n < batch_id}
    newest = spark.read.parquet(before[max(before)]).first()["newest"] if before else None
    return None if newest is None else F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")


def merchant_windows_and_late(envelopes: DataFrame, base: str, delay: str) -> tuple[DataFrame, DataFrame]:
    """W3 with its late rows: (windows that the watermark has closed, rows that came too late for theirs)."""
    spark = envelopes.sparkSession
    out = split_late(envelopes, f"{base}/split_checkpoint", f"{base}/split", delay)
    on_time = spark.readStream.schema(spark.read.parquet(f"{out}/on_time").drop("batch_id").schema).parquet(f"{out}/on_time/batch_id=*")
    query = start_merchant_query(
        merchant_windows(on_time, watermark=delay), f"{base}/checkpoint", sink="parquet", output_mode="append", available_now=True, path=f"{base}/windows",
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return spark.read.parquet(f"{base}/windows"), spark.read.parquet(f"{out}/late").drop("batch_id")


# --- Q5b as a stream -------------------------------------------------------------

def run_error_rates(rows: DataFrame, dataset_type: str, time_col: str, checkpoint: str, out_dir: str, delay: str) -> str:
    """Q5b over a stream: rejected rows per minute, then over the sliding range, one evaluation a step.

    Two chained aggregates in append mode under one watermark: an evaluation is
    written once, when the watermark has passed its end, so state holds no
    more than the range and ``delay``.  Exact copies of a row count once if the second comes
    while the watermark has not passed it.  ``error_alerts`` reads the result.
    """
    timed = rows.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, delay)
    errors = Q.validation_errors(timed, dataset_type, time_col)
    query = (
        Q.error_rates(errors)
        .writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).option("path", out_dir)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return out_dir


def error_alerts(spark: SparkSession, out_dir: str) -> DataFrame:
    """Alerts of the evaluations that a stream has written: as ``quality.error_rate_alert`` gives them."""
    return Q.held_alerts(spark.read.parquet(out_dir))


# --- S4: bounded pull into RAW -------------------------------------------------

def hourly_kafka_ingest(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    lake: str,
    dataset: str,
    checkpoint: str,
    schema: StructType,
    max_messages: int = fixed.KAFKA_HOURLY_MAX_MESSAGES,
) -> None:
    """S7 -> S4 wiring: one run lands at most ``max_messages``, from the earliest uncommitted offset."""
    source = kafka_stream(spark, bootstrap_servers, topic, "earliest", max_offsets_per_trigger=max_messages)
    pull_once(source, lake, dataset, checkpoint, schema, source_type="kafka")


def bounded_pull(
    envelopes: DataFrame,
    lake: str,
    dataset: str,
    checkpoint: str,
    schema: StructType,
    source_type: str = "kafka",
) -> StreamingQuery:
    """S4, until caught up: land whatever is available now (bounded per trigger by the source's
    ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``) as RAW ingests.

    The checkpoint plays the consumer group's role: a restart resumes after
    the last committed batch.  Each micro-batch is one ingest whose id is the
    batch id and whose ingest time is the newest broker timestamp in the
    batch, so a replayed batch lands in the same partition and overwrites
    it.  Empty batches write nothing.
    """
    return _pull(envelopes, lake, dataset, checkpoint, schema, source_type).trigger(availableNow=True).start()


#: An interval that no run lives to see the end of.
ONE_BATCH = "36500 days"


def pull_once(
    envelopes: DataFrame, lake: str, dataset: str, checkpoint: str, schema: StructType, source_type: str = "kafka", poll_seconds: float = 0.2
) -> None:
    """S4, one bounded batch: at most as many messages as the source's limit a trigger, however many wait.

    The next run resumes after them.  (``availableNow`` would go on to the
    last message, and a ``once`` trigger would ignore the limit.)
    """
    query = _pull(envelopes, lake, dataset, checkpoint, schema, source_type).trigger(processingTime=ONE_BATCH).start()
    try:
        while query.isActive and query.status["message"] != "Waiting for next trigger":
            time.sleep(poll_seconds)
    finally:
        query.stop()
    if query.exception():
        raise query.exception()


def _pull(envelopes: DataFrame, lake: str, dataset: str, checkpoint: str, schema: StructType, source_type: str) -> DataStreamWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rows = parse_envelope(batch, schema)
            newest = rows.agg(F.max(F.col("kafka_timestamp").cast("timestamp_ntz")).alias("t")).first()["t"]
            if newest is None:  # no broker times in this batch: its rows still land, on a fixed day so that a replay finds them
                newest = dt.datetime(1970, 1, 1)
            ingest_batch(
                rows.drop("kafka_timestamp"),
                lake,
                dataset,
                source_type,
                ingested_at=newest,
                ingest_id=f"{dataset}-b{batch_id:010d}",
                skip_empty=True,
            )
        finally:
            batch.unpersist()

    return envelopes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
