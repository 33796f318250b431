"""E1-E9 boundaries."""

import datetime as dt

from lakeforge.operators import enrich as E
from tests.conftest import rows


def test_users_age_group_and_domain(spark):
    df = spark.createDataFrame(
        [(24, "a@b.com"), (25, "x@sub.b.org"), (49, "nope"), (50, "q@r.s"), (None, None)],
        "age int, email string",
    )
    got = rows(E.enrich_users(df), "age", "age_group", "email_domain")
    assert got == [
        (24, "young", "b.com"),
        (25, "adult", "sub.b.org"),
        (49, "adult", ""),
        (50, "senior", "r.s"),
        (None, "senior", None),  # null age falls through to senior (D17)
    ]


def test_transactions_eur_category_dates(spark):
    df = spark.createDataFrame(
        [
            ("t1", 100.0, "USD", "2025-11-05"),
            ("t2", 100.0, "GBP", "2025-12-31"),
            ("t3", 49.99, "EUR", "2025-01-01"),
            ("t4", 50.0, None, "garbage"),
            ("t5", 499.99, "XOF", None),
            ("t6", 500.0, "USD", "2024-02-29"),
            ("t7", 0.01, "GBP", "2024-02-30"),
        ],
        "transaction_id string, amount double, currency string, transaction_date string",
    )
    out = E.enrich_transactions(df)
    got = {r["transaction_id"]: r for r in out.collect()}
    assert got["t1"]["amount_eur"] == 100.0 * 0.92
    assert got["t2"]["amount_eur"] == 100.0 * 1.17
    assert got["t3"]["amount_eur"] == 49.99
    assert got["t4"]["amount_eur"] == 50.0  # null currency passes unchanged
    assert got["t5"]["amount_eur"] == 499.99  # unknown currency passes unchanged
    assert [got[k]["amount_category"] for k in ("t7", "t3", "t4", "t5", "t6")] == [
        "small", "small", "medium", "medium", "large"]
    assert got["t1"]["transaction_date"] == dt.date(2025, 11, 5)
    assert (got["t2"]["transaction_year"], got["t2"]["transaction_month"], got["t2"]["transaction_day"]) == (
        2025, 12, 31)
    # ANSI mode is on in Spark 4: malformed dates must become NULL, not fail.
    assert got["t4"]["transaction_date"] is None and got["t4"]["transaction_year"] is None
    assert got["t7"]["transaction_date"] is None
    assert got["t6"]["transaction_day"] == 29


def test_transaction_timestamp_input(spark):
    df = spark.createDataFrame(
        [("t", 1.0, "USD", dt.datetime(2025, 3, 4, 23, 59))],
        "transaction_id string, amount double, currency string, transaction_date timestamp_ntz",
    )
    r = E.enrich_transactions(df).first()
    assert r["transaction_date"] == dt.date(2025, 3, 4) and r["transaction_month"] == 3


def test_logs_parts_and_severity(spark):
    ts = dt.datetime(2025, 11, 5, 13, 45)
    df = spark.createDataFrame(
        [(1, ts, "ERROR"), (2, ts, "WARNING"), (3, ts, "INFO"), (4, ts, "DEBUG")],
        "log_id int, timestamp timestamp_ntz, level string",
    )
    got = rows(E.enrich_logs(df), "log_id", "log_date", "log_hour", "severity_level")
    assert got == [
        (1, dt.date(2025, 11, 5), 13, 3),
        (2, dt.date(2025, 11, 5), 13, 2),
        (3, dt.date(2025, 11, 5), 13, 1),
        (4, dt.date(2025, 11, 5), 13, 1),
    ]


def test_processed_timestamp_injected_and_live(spark):
    df = spark.createDataFrame([(1,)], "x int")
    fixed_ts = E.enrich_data(df, "generic", as_of="2025-01-02 03:04:05").first()["_processed_timestamp"]
    assert fixed_ts == dt.datetime(2025, 1, 2, 3, 4, 5)
    live = E.enrich_data(df, "generic").first()["_processed_timestamp"]
    assert live is not None
