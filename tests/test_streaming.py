"""stream = batch, restarts, malformed input."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeforge.sources import raw as R
from lakeforge.sources import testdata as T
from lakeforge.streaming import envelope as EV
from lakeforge.streaming import jobs as J
from lakeforge.streaming import windows as W
from tests.conftest import SF_SMOKE, rows


def land_envelopes(spark, base, files=4):
    env = T.kafka_envelope(T.stream_transactions(spark, SF_SMOKE))
    env.repartitionByRange(files, "timestamp").write.parquet(os.path.join(base, "in"))
    return env


def test_stream_equals_batch(spark, tmp_path):
    base = str(tmp_path)
    env = land_envelopes(spark, base)
    batch = W.flatten_window(W.merchant_windows(EV.parse_envelope(env)))
    stream_in = J.envelope_file_stream(spark, os.path.join(base, "in"), max_files_per_trigger=1)
    final = J.run_merchant_snapshot(stream_in, os.path.join(base, "ck"), os.path.join(base, "out"))
    # one micro-batch per file; the last two snapshots stay
    kept = sorted(d for d in os.listdir(os.path.join(base, "out")) if d.startswith("batch_id="))
    assert kept == ["batch_id=0000000002", "batch_id=0000000003"]
    assert rows(W.flatten_window(spark.read.parquet(final))) == rows(batch)
    # a restart that finds nothing new still names the newest snapshot
    assert J.run_merchant_snapshot(stream_in, os.path.join(base, "ck"), os.path.join(base, "out")) == final


def test_restart_from_checkpoint_adds_nothing(spark, tmp_path):
    base = str(tmp_path)
    land_envelopes(spark, base, files=2)
    src = os.path.join(base, "in")
    lake = os.path.join(base, "lake")
    ck = os.path.join(base, "ck_pull")
    q = J.bounded_pull(J.envelope_file_stream(spark, src, max_files_per_trigger=1), lake, "tx_stream", ck,
                       EV.TRANSACTION_SCHEMA)
    q.awaitTermination()
    first = R.read_raw(spark, lake, "tx_stream").count()
    assert first == spark.read.parquet(src).count()
    q2 = J.bounded_pull(J.envelope_file_stream(spark, src), lake, "tx_stream", ck, EV.TRANSACTION_SCHEMA)
    q2.awaitTermination()
    assert R.read_raw(spark, lake, "tx_stream").count() == first
    manifest = R.read_manifest(spark, lake)
    assert manifest.count() == 2 and manifest.agg(F.sum("row_count")).first()[0] == first


def test_malformed_payloads_are_dropped(spark):
    ts = dt.datetime(2025, 1, 1, 0, 0, 30)
    good = '{"transaction_id":"1","amount":2.5,"timestamp":"2025-01-01T00:00:10","merchant":"m","status":"completed"}'
    wrong_type = '{"transaction_id":"2","amount":"lots","timestamp":"2025-01-01T00:00:20","merchant":"m","status":"completed"}'
    no_ts = '{"transaction_id":"3","amount":1.0,"merchant":"m","status":"completed"}'
    records = spark.createDataFrame(
        [(v.encode(), ts) for v in (good, "{not json", wrong_type, no_ts)], "value binary, timestamp timestamp"
    )
    parsed = EV.parse_envelope(records)
    assert parsed.count() == 4
    assert parsed.filter(F.col("status").isNull()).count() == 1  # malformed JSON: all-null payload
    bad_field = parsed.filter(F.col("transaction_id") == "2").first()
    assert bad_field["amount"] is None and bad_field["status"] == "completed"  # wrong type: that field only
    agg = W.merchant_windows(parsed).collect()
    # the missing-timestamp row has no window; the wrong-type row counts but has no amount
    assert [(r["merchant"], r["transaction_count"], r["avg_amount"]) for r in agg] == [("m", 2, 2.5)]


def test_watermark_append_emits_closed_windows_only(spark, tmp_path):
    base = str(tmp_path)
    t0 = dt.datetime(2025, 1, 1, 0, 0, 5)

    def env(rows_):
        return spark.createDataFrame(
            [(('{"transaction_id":"%s","amount":1.0,"timestamp":"%s","merchant":"m","status":"completed"}'
               % (i, t.isoformat())).encode(), t) for i, t in rows_],
            "value binary, timestamp timestamp",
        )

    env([(1, t0), (2, t0 + dt.timedelta(minutes=5))]).coalesce(1).write.parquet(os.path.join(base, "in", "a"))
    stream = J.envelope_file_stream(spark, os.path.join(base, "in", "*"), max_files_per_trigger=1)
    agg = J.merchant_stream(stream, watermark="1 minute")
    q = J.start_merchant_query(agg, os.path.join(base, "ck"), sink="parquet", output_mode="append",
                               available_now=True, path=os.path.join(base, "out"))
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(base, "out"))
    # only the first window is closed by the watermark (max event time - 1 minute)
    assert [r["transaction_count"] for r in out.collect()] == [1]


def test_epoch_seconds_event_time(spark):
    df = spark.createDataFrame([(1700000000.25,)], "timestamp double")
    got = df.select(EV.epoch_seconds_to_timestamp("timestamp").alias("t")).first()["t"]
    assert got is not None


def _envelopes(spark, items):
    return spark.createDataFrame(
        [(('{"transaction_id":"%s","amount":1.0,"timestamp":"%s","merchant":"m","status":"completed"}'
           % (i, t.isoformat())).encode(), t) for i, t in items],
        "value binary, timestamp timestamp",
    )


def test_row_late_by_one_hour(spark, tmp_path):
    base = str(tmp_path)
    t0 = dt.datetime(2025, 1, 1, 12, 0, 5)

    def run(watermark, name):
        stream = J.envelope_file_stream(spark, f"{base}/in/*", max_files_per_trigger=1)
        if watermark is None:  # faithful: complete mode, no watermark
            return spark.read.parquet(J.run_merchant_snapshot(stream, f"{base}/ck_{name}", f"{base}/out_{name}"))
        return spark.read.parquet(J.run_merchant_append(stream, f"{base}/ck_{name}", f"{base}/out_{name}", watermark))

    _envelopes(spark, [(1, t0), (2, t0 + dt.timedelta(minutes=5))]).coalesce(1).write.parquet(f"{base}/in/b1")
    run(None, "c")
    run("1 minute", "a")
    # the late row arrives after both queries have seen the 12:05 event; restart from the checkpoints
    _envelopes(spark, [(3, t0 - dt.timedelta(hours=1))]).coalesce(1).write.parquet(f"{base}/in/b2")
    faithful = run(None, "c")
    assert sorted(r["window"]["start"].hour for r in faithful.collect()) == [11, 12, 12]  # late rows still update
    bounded = run("1 minute", "a")
    assert [r["window"]["start"].hour for r in bounded.collect()] == [12]  # dropped: behind the watermark


def test_console_sink_complete_mode(spark, tmp_path):
    base = str(tmp_path)
    land_envelopes(spark, base, files=2)
    stream = J.envelope_file_stream(spark, os.path.join(base, "in"))
    q = J.start_merchant_query(J.merchant_stream(stream), os.path.join(base, "ck"), sink="console",
                               available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == spark.read.parquet(os.path.join(base, "in")).count()


def test_update_mode_writes_only_changes(spark, tmp_path):
    base = str(tmp_path)
    env = land_envelopes(spark, base, files=4)
    batch = W.flatten_window(W.merchant_windows(EV.parse_envelope(env)))
    stream = J.envelope_file_stream(spark, os.path.join(base, "in"), max_files_per_trigger=1)
    out = J.run_merchant_updates(stream, os.path.join(base, "ck"), os.path.join(base, "out"))
    assert rows(W.flatten_window(J.read_latest(spark, out))) == rows(batch)
    written = spark.read.parquet(out).count()
    assert written < 4 * batch.count()  # complete mode would rewrite the growing result each batch
    folders = lambda: sorted(f for f in os.listdir(out) if f.startswith("batch_id"))
    n = len(folders())
    first = J.compact_updates(spark, out)
    assert rows(W.flatten_window(J.read_latest(spark, out))) == rows(batch) and len(folders()) == n
    assert J.compact_updates(spark, out) == first  # nothing new
    # later batches come on top of the base; the next compaction removes what the first one held
    _envelopes(spark, [(1, dt.datetime(2030, 1, 1))]).coalesce(1).write.mode("append").parquet(os.path.join(base, "in"))
    J.run_merchant_updates(stream, os.path.join(base, "ck"), out)
    assert J.read_latest(spark, out).count() == batch.count() + 1
    second = J.compact_updates(spark, out)
    assert J.read_latest(spark, out).count() == batch.count() + 1
    assert len(folders()) == 1 and sorted(os.listdir(os.path.join(out, "base"))) == [os.path.basename(p) for p in (first, second)]


def arrivals(spark, base, parts):
    """Envelopes landed one batch after the other, one file each."""
    for n, part in enumerate(parts):
        T.kafka_envelope(part).coalesce(1).write.parquet(os.path.join(base, "in", f"{n:03d}"))
    return J.ENVELOPE_SCHEMA


def sent(spark, minutes):
    """One completed transaction at each minute of the day."""
    at = dt.datetime(2025, 1, 1)
    data = [(f"{i}", "u", 2.0, "EUR", at + dt.timedelta(minutes=m), "m", "completed") for i, m in enumerate(minutes)]
    return spark.createDataFrame(data, "transaction_id string, user_id string, amount double, currency string, timestamp timestamp, merchant string, status string")


def envelope_stream(spark, base):
    return spark.readStream.schema(J.ENVELOPE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in", "*"))


def test_late_rows_land_beside_the_windows(spark, tmp_path):
    base = str(tmp_path)
    # minute 100 comes an hour late, in the third batch; minute 155 is behind the newest time but within the delay
    arrivals(spark, base, [sent(spark, [0, 60, 130]), sent(spark, [160, 155]), sent(spark, [100, 152, 200]), sent(spark, [300])])
    windows, late = J.merchant_windows_and_late(envelope_stream(spark, base), base, "10 minutes")
    minute = lambda t: int((t - dt.datetime(2025, 1, 1)).total_seconds() // 60)
    assert [(minute(r["timestamp"]), minute(r["watermark"])) for r in late.collect()] == [(100, 150)]
    assert sorted(minute(r["window"]["start"]) for r in windows.collect()) == [0, 60, 130, 152, 155, 160, 200]  # 300 is open
    # a replayed batch parts its rows as it did: batches after it do not count
    progress = os.path.join(base, "split", "progress")
    assert minute(spark.range(1).select(J._watermark(spark, progress, 2, "10 minutes")).first()[0]) == 150
    assert J._watermark(spark, progress, 0, "10 minutes") is None
    # nothing new: nothing changes
    again, late = J.merchant_windows_and_late(envelope_stream(spark, base), base, "10 minutes")
    assert again.count() == 7 and late.count() == 1


def test_late_rows_of_the_smoke_data(spark):
    from lakeforge.plans import registry

    got = registry.q_merchant_minute_late(spark, SF_SMOKE)
    kinds = {r["kind"]: r["count"] for r in got.groupBy("kind").count().collect()}
    assert kinds["late"] > 20 and kinds["window"] > 100


def test_alerts_of_a_stream_equal_those_of_the_batch(spark, tmp_path):
    from lakeforge.operators import quality as Q

    base, start = str(tmp_path), dt.datetime(2025, 1, 1)
    # 40 errors a minute for a quarter of an hour, then one now and then, and good rows after them
    minutes = [m for m in range(15) for _ in range(40)] + [40, 41, 60]
    data = [(i, start + dt.timedelta(minutes=m, seconds=i % 60), "TRACE", "s") for i, m in enumerate(minutes)]
    data += [(1000 + i, start + dt.timedelta(minutes=90 + i), "INFO", "s") for i in range(3)]
    logs = spark.createDataFrame(data, "log_id long, timestamp timestamp, level string, source string")
    for n, part in enumerate(("minute(timestamp) < 8 AND hour(timestamp) = 0", "minute(timestamp) >= 8 AND hour(timestamp) = 0", "hour(timestamp) >= 1")):
        logs.where(part).union(logs.where(part).limit(2)).coalesce(1).write.parquet(os.path.join(base, "in", f"{n}"))  # two rows twice
        stream = spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in", "*"))
        J.run_error_rates(stream, "logs", "timestamp", os.path.join(base, "ck"), os.path.join(base, "out"), "10 minutes")  # started anew for each file
    want = Q.error_rate_alert(Q.validation_errors(logs, "logs", "timestamp"))
    assert rows(J.error_alerts(spark, os.path.join(base, "out"))) == rows(want)
    assert want.where("firing").count() > 3


def test_pull_once_lands_one_batch_a_run(spark, tmp_path):
    base = str(tmp_path)
    arrivals(spark, base, [sent(spark, [n, n + 1]) for n in (0, 10, 20)])
    landed = []
    for _ in range(4):
        J.pull_once(envelope_stream(spark, base), os.path.join(base, "lake"), "tx", os.path.join(base, "ck"), EV.TRANSACTION_SCHEMA)
        landed.append(R.read_raw(spark, os.path.join(base, "lake"), "tx").count())
    assert landed == [2, 4, 6, 6]


@pytest.fixture
def many_files(spark, tmp_path, monkeypatch):
    """(input folder whose events are in 4 files, folder of the query's stream)."""
    from lakeforge.plans import registry

    start = F.lit("2025-01-01").cast("timestamp_ntz")
    spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("event_id"), (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod(F.xxhash64("id"), F.lit(80_000)))).alias("ts"),
        (F.col("id") % 40).alias("user_id"), F.element_at(F.array(*map(F.lit, ("view", "click", "error", "purchase"))), (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 100).cast("double").alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(registry, "shared_dir", lambda spark, *parts, unique=False: f"{tmp_path}/shared")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield f"{tmp_path}/sf", f"{tmp_path}/shared"
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def files_of_batches(base, batches):
    return [len([f for f in os.listdir(os.path.join(base, "in", f"{n:03d}")) if f.endswith(".parquet")]) for n in range(batches)]


def test_no_task_holds_a_landed_batch_of_late_rows(spark, many_files):
    from lakeforge.plans import registry

    sf_dir, base = many_files
    got = registry.q_merchant_minute_late(spark, sf_dir)
    assert got.where("kind = 'late'").count() > 20 and got.where("kind = 'window'").count() > 100
    assert min(files_of_batches(base, registry.ARRIVALS)) > 1
    sent = registry.T.stream_transactions(spark, sf_dir)
    for n, part in enumerate(sorted(os.listdir(os.path.join(base, "split", "progress")))):  # a landed batch is a micro-batch
        assert part == f"batch_id={n:010d}"
        landed = EV.parse_envelope(spark.read.parquet(os.path.join(base, "in", f"{n:03d}"))).where("status = 'completed'")
        parted = [spark.read.parquet(os.path.join(base, "split", kind, part)) for kind in ("on_time", "late")]
        assert rows(landed, "transaction_id") == rows(parted[0].select("transaction_id").union(parted[1].select("transaction_id")))
    assert n == registry.ARRIVALS
    assert spark.read.parquet(*[os.path.join(base, "in", f"{k:03d}") for k in range(n + 1)]).count() == sent.count()


def test_a_bounded_pull_takes_a_batch_of_many_files(spark, many_files):
    from lakeforge.plans import registry

    sf_dir, base = many_files
    got = registry.q_kafka_pull_bounded(spark, sf_dir)
    assert min(files_of_batches(base, 3)) > 1
    assert rows(got, "transaction_id") == sorted((str(n),) for n in range(4000) if n % 3 < 2)


def test_alerts_of_batches_of_many_files(spark, many_files):
    from lakeforge.operators import quality as Q
    from lakeforge.plans import registry

    sf_dir, base = many_files
    got = rows(registry.q_dq_alerts_stream(spark, sf_dir))
    assert min(files_of_batches(base, registry.STREAM_BATCHES)) > 1
    logs = registry.T.logs_raw(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    closed = logs.agg(F.max("timestamp") - F.expr("INTERVAL 10 minutes")).first()[0]  # by the watermark
    want = rows(Q.error_rate_alert(Q.validation_errors(logs, "logs", "timestamp")).where(F.col("window_end") <= F.lit(closed)))
    assert got == want and want
