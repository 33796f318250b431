"""C1-C6 and Q6 on hand-made rows with hand-computed answers."""

import datetime as dt

from pyspark.sql import functions as F

from lakeforge.operators import clean as C
from tests.conftest import rows

T1 = dt.datetime(2025, 11, 5, 10, 0, 0)
T2 = dt.datetime(2025, 11, 6, 10, 0, 0)
USERS_SCHEMA = "user_id string, name string, email string, age int, _ingestion_timestamp timestamp, _source string"


def users(spark):
    data = [
        ("u1", " Ann ", "Ann@Example.com", 30, T1, "faker"),
        ("u1", " Ann ", "Ann@Example.com", 30, T1, "faker"),  # exact copy
        ("u1", " Ann ", "Ann@Example.com", 30, T2, "faker"),  # re-ingest, other time (D5)
        ("u2", "Bob", " bob@x.com", 40, T1, "faker"),  # leading space: rejected (D16)
        ("u3", "Cy", None, 40, T1, "faker"),  # null email
        ("u4", "Di", "not-an-email", 40, T1, "faker"),
        ("u5", "Ed", "é@b.com", 40, T1, "faker"),  # \w is ASCII: rejected
        ("a-1", "A", "a@b.co", -1, T1, "faker"),
        ("a0", "A", "a@b.co", 0, T1, "faker"),
        ("a120", "A", "a@b.co", 120, T1, "faker"),
        ("a121", "A", "a@b.co", 121, T1, "faker"),
        ("anull", "A", "a@b.co", None, T1, "faker"),
    ]
    return spark.createDataFrame(data, USERS_SCHEMA)


def test_clean_users_rules_and_order(spark):
    out = C.clean_data(users(spark), "users")
    assert out.columns == ["user_id", "name", "email", "age"]
    got = rows(out)
    # u1 twice: the re-ingested row differs in _ingestion_timestamp (D5);
    # emails are lower-cased/trimmed only after validation.
    assert got == [
        ("a0", "A", "a@b.co", 0),
        ("a120", "A", "a@b.co", 120),
        ("u1", "Ann", "ann@example.com", 30),
        ("u1", "Ann", "ann@example.com", 30),
    ]


def test_keyed_dedup_keeps_latest(spark):
    out = C.clean_data(users(spark), "users", subset=["user_id"])
    assert rows(out, "user_id") == [("a0",), ("a120",), ("u1",)]


def test_keyed_dedup_picks_latest_ingest(spark):
    df = spark.createDataFrame(
        [("k", 1, T1), ("k", 2, T2), ("j", 5, T1)], "k string, v int, _ingestion_timestamp timestamp"
    )
    assert rows(C.deduplicate(df, ["k"]), "k", "v") == [("j", 5), ("k", 2)]


def test_metadata_columns_dropped_and_kept(spark):
    df = spark.createDataFrame([("x", "1", "m")], "_id string, a string, _source string")
    assert C.clean_data(df, "generic").columns == ["a"]  # D6: _id dropped by default
    assert C.clean_data(df, "generic", keep_metadata=["_id"]).columns == ["_id", "a"]


def test_clean_transactions(spark):
    schema = "transaction_id string, amount double, status string"
    data = [
        ("t1", 10.0, "completed"),
        ("t2", None, "completed"),
        ("t3", -1.0, "pending"),
        ("t4", 0.0, "failed"),
        ("t5", 0.01, "failed"),
        (None, 5.0, "completed"),
        ("t6", 5.0, "refunded"),
        ("t7", 5.0, None),
        ("t8", float("nan"), "completed"),  # NaN > 0 is true in Spark
    ]
    out = C.clean_data(spark.createDataFrame(data, schema), "transactions")
    assert sorted(r[0] for r in out.collect()) == ["t1", "t5", "t8"]


def test_clean_logs_case_sensitive(spark):
    data = [(1, T1, "INFO"), (2, T1, "error"), (3, T1, "TRACE"), (4, None, "ERROR"), (5, T1, "DEBUG")]
    out = C.clean_data(spark.createDataFrame(data, "log_id int, timestamp timestamp, level string"), "logs")
    assert sorted(r[0] for r in out.collect()) == [1, 5]


def test_rejects_by_rule_counts(spark):
    out = C.rejects_by_rule(users(spark), "users")
    got = {(r["step"], r["rule"]): r["rejected"] for r in out.collect()}
    assert got == {
        (0, "duplicates"): 1,
        (1, "email_not_null"): 1,
        (2, "email_format"): 3,
        (3, "age_range"): 3,
    }


def test_clean_report_invariant(spark):
    df = users(spark)
    report = C.clean_report(df, "users").first()
    final = C.clean_data(df, "users").count()
    rejected = C.rejects_by_rule(df, "users").filter("step > 0").agg(F.sum("rejected")).first()[0]
    assert report["initial_count"] == df.count() == 12
    assert report["duplicates_removed"] == 1
    assert report["final_count"] == final == 4
    assert report["initial_count"] - report["duplicates_removed"] - rejected == final


def test_observed_counts_in_one_action(spark):
    cleaned, initial, distinct, final = C.clean_observed(users(spark), "users")
    n = cleaned.count()
    assert initial.get["rows"] == 12
    assert distinct.get["rows"] == 11
    assert final.get["rows"] == n == 4


def test_text_columns_get_their_types(spark):
    tx = spark.createDataFrame(
        [("t1", "9.5"), ("t2", "abc"), ("t3", "100.0"), ("t4", ""), ("t5", None), ("t6", "-1"), ("t7", " 7 ")], "transaction_id string, amount string"
    ).withColumn("status", F.lit("completed"))
    out = C.clean_data(tx, "transactions")
    assert dict(out.dtypes)["amount"] == "double"
    assert rows(out, "transaction_id", "amount") == [("t1", 9.5), ("t3", 100.0), ("t7", 7.0)]
    assert C.clean_report(tx, "transactions").first()["final_count"] == 3
    assert C.rejects_by_rule(tx, "transactions").filter("rule = 'amount_not_null'").first()["rejected"] == 3
    people = spark.createDataFrame([("a@x.com", "30"), ("b@x.com", "30.0"), ("c@x.com", "old"), ("d@x.com", "121")], "email string, age string")
    aged = C.clean_data(people.withColumn("name", F.lit("n")), "users")
    assert dict(aged.dtypes)["age"] == "int"
    assert rows(aged, "email", "age") == [("a@x.com", 30), ("b@x.com", 30)]


def test_clean_is_idempotent(spark):
    once = C.clean_data(users(spark), "users", subset=["user_id"])
    twice = C.clean_data(once, "users", subset=["user_id"])
    assert rows(once) == rows(twice)


def test_unknown_type_rejected(spark):
    import pytest

    with pytest.raises(ValueError):
        C.clean_data(users(spark), "bogus")
