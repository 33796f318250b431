"""Q1-Q5, M2: model tests pass on clean data and fail on seeded bad rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import quality as Q

DIM = "user_id string, name string, email string, age_group string"
FACT = "transaction_id string, user_id string, amount double"


def clean_models(spark):
    dim = spark.createDataFrame([("u1", "A", "a@x", "young"), ("u2", "B", "b@x", "adult")], DIM)
    fact = spark.createDataFrame([("t1", "u1", 100.0), ("t2", "u2", 200.0)], FACT)
    return {"dim_users": dim, "fact_transactions": fact}


def results(df):
    return {(r["test_name"], r["model"], r["column_name"]): (r["failures"], r["passed"]) for r in df.collect()}


def test_all_seven_pass_on_clean_models(spark):
    out = results(Q.model_tests(clean_models(spark)))
    assert len(out) == 7
    assert all(passed for _, passed in out.values())
    assert Q.failing_tests(Q.model_tests(clean_models(spark))).first()[0] == 0


def test_seeded_bad_rows_fail(spark):
    dim = spark.createDataFrame(
        [("u1", "A", "a@x", "young"), ("u1", "A2", "a2@x", "young"), (None, "N", None, "adult"),
         ("u2", "B", "b@x", "adult"), ("u2", "B", "b@x", "adult"), ("u2", "B", "b@x", "adult")],
        DIM,
    )
    fact = spark.createDataFrame(
        [("t1", "u1", 1.0), ("t1", "u9", 1.0), ("t2", "u9", 1.0), ("t3", None, 1.0), (None, "u2", 1.0)], FACT
    )
    out = results(Q.model_tests({"dim_users": dim, "fact_transactions": fact}))
    assert out[("unique", "dim_users", "user_id")] == (2, False)  # u1 and u2 repeat; NULL ignored
    assert out[("not_null", "dim_users", "user_id")] == (1, False)
    assert out[("not_null", "dim_users", "email")] == (1, False)
    assert out[("unique", "fact_transactions", "transaction_id")] == (1, False)
    assert out[("not_null", "fact_transactions", "transaction_id")] == (1, False)
    assert out[("not_null", "fact_transactions", "user_id")] == (1, False)
    assert out[("relationships", "fact_transactions", "user_id")] == (2, False)  # two rows of orphan u9
    alert = Q.test_failure_alert(Q.model_tests({"dim_users": dim, "fact_transactions": fact})).first()
    assert alert["failing_tests"] == 7 and alert["firing"]


def test_failing_tests_fire_after_a_minute(spark):
    at = lambda m, s=0: dt.datetime(2025, 1, 1, 0, m, s)
    history = spark.createDataFrame(
        [(at(0, 5), True), (at(1), False), (at(2, 7), False), (at(2, 7), False), (at(3), True), (at(4), False), (at(6), False)],
        "evaluated timestamp_ntz, passed boolean",
    )
    out = {r["evaluated_at"].minute: (r["failing_tests"], r["pending"], r["firing"]) for r in Q.test_failure_alert(history, "evaluated").collect()}
    assert out == {0: (0, False, False), 1: (1, True, False), 2: (2, True, True), 3: (0, False, False), 4: (1, True, False), 6: (1, True, False)}


def _errors(spark, minute_counts):
    base = dt.datetime(2025, 1, 1, 0, 0)
    data = []
    for minute, n in minute_counts.items():
        for i in range(n):
            data.append((base + dt.timedelta(minutes=minute, seconds=i % 60),))
    return spark.createDataFrame(data, "event_time timestamp_ntz")


def test_error_rate_alert_fires_only_when_held(spark):
    # 40 errors per minute from minute 0 to 11: every 5-minute window
    # covering only those minutes has 200 errors (0.67/s > 0.1/s).
    burst = {m: 40 for m in range(12)}
    out = Q.error_rate_alert(_errors(spark, burst)).orderBy("window_end").collect()
    pending = [r["window_end"] for r in out if r["pending"]]
    firing = [r["window_end"] for r in out if r["firing"]]
    base = dt.datetime(2025, 1, 1)
    # windows ending at minute 1..16 contain errors; rate > 0.1/s needs > 30 errors
    assert pending[0] == base + dt.timedelta(minutes=1)
    # firing needs pending at this and the previous 5 evaluations
    assert firing[0] == base + dt.timedelta(minutes=6)
    assert all(p in pending for p in firing)
    assert len(firing) == len(pending) - 5


def test_error_rate_alert_quiet(spark):
    out = Q.error_rate_alert(_errors(spark, {0: 3, 10: 3})).collect()
    assert out and not any(r["pending"] or r["firing"] for r in out)


def test_validation_errors_uses_rules(spark):
    ts = dt.datetime(2025, 1, 1, 0, 0)
    df = spark.createDataFrame(
        [(1, ts, "INFO"), (2, ts, "TRACE"), (3, None, "TRACE"), (4, ts, "error")],
        "log_id int, timestamp timestamp_ntz, level string",
    )
    assert Q.validation_errors(df, "logs", "timestamp").count() == 2


def test_completeness_gate(spark):
    manifest = spark.createDataFrame([("users",), ("logs",), ("users",)], "dataset_name string")
    report = Q.completeness(manifest, ["users", "logs", "transactions"])
    got = {r["dataset"]: r["present"] for r in report.collect()}
    assert got == {"users": True, "logs": True, "transactions": False}
    with pytest.raises(RuntimeError, match="transactions"):
        Q.assert_complete(report)
    Q.assert_complete(Q.completeness(manifest, ["users"]))


def test_validation_errors_of_untyped_text(spark):
    """A text amount compares as a number; what is no number is an error, not the end of the job."""
    data = [("t1", "9.5", "completed"), ("t2", "-1", "completed"), ("t3", "n/a", "completed"), ("t4", "3", "other")]
    tx = spark.createDataFrame(data, "transaction_id string, amount string, status string").withColumn("at", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    assert Q.validation_errors(tx, "transactions", "at").count() == 3
