"""A1-A5, V1, V2 against literal SQL on small inputs."""

import datetime as dt

from lakeforge.operators import aggregate as A
from tests.conftest import rows

D = dt.date


def tx(spark):
    data = [
        ("t1", 1, 10.10, D(2025, 1, 3), "m1", "c1", "completed", 2025, 1),
        ("t2", 1, 20.20, D(2025, 2, 3), "m2", "c1", "pending", 2025, 2),
        ("t3", 1, 30.30, D(2025, 2, 9), "m1", "c2", "completed", 2025, 2),
        ("t4", 2, 5.05, D(2024, 12, 1), "m3", "c1", "failed", 2024, 12),
        ("t5", 9, 1.00, D(2024, 12, 2), "m3", "c1", "failed", 2024, 12),  # user 9 has no user row
    ]
    schema = ("transaction_id string, user_id int, amount double, transaction_date date, merchant string, "
              "category string, status string, transaction_year int, transaction_month int")
    return spark.createDataFrame(data, schema)


def users(spark):
    data = [
        (1, "Ann", "a@x.com", 30, "adult", "FR", D(2020, 1, 1)),
        (2, "Bob", "b@x.com", 20, "young", "DE", D(2020, 1, 2)),
        (3, "Cy", "c@x.com", 60, "senior", "FR", D(2020, 1, 3)),  # no transactions
        (2, "Bob", "b@x.com", 20, "young", "DE", D(2020, 1, 2)),  # copy (re-ingested user)
    ]
    schema = "user_id int, name string, email string, age int, age_group string, country string, registration_date date"
    return spark.createDataFrame(data, schema)


def test_transactions_per_user(spark):
    got = {r["user_id"]: r for r in A.transactions_per_user(tx(spark)).collect()}
    u1 = got[1]
    assert u1["total_transactions"] == 3
    assert u1["total_amount"] == 60.6  # exact decimal sum
    assert u1["avg_amount"] == 60.6 / 3
    assert (u1["min_amount"], u1["max_amount"]) == (10.10, 30.30)
    assert u1["last_transaction_date"] == D(2025, 2, 9)
    assert u1["unique_merchants"] == 2


def test_user_analytics_matches_literal_sql(spark):
    users(spark).createOrReplaceTempView("ua_users")
    tx(spark).createOrReplaceTempView("ua_tx")
    literal = spark.sql(
        """SELECT u.user_id, u.name, u.email, u.age, u.age_group, u.country,
             COUNT(DISTINCT t.transaction_id) AS total_transactions,
             COALESCE(CAST(SUM(CAST(t.amount AS DECIMAL(18,2))) AS DOUBLE), 0D) AS total_spent,
             COALESCE(CAST(SUM(CAST(t.amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(t.amount), 0D)
               AS avg_transaction_amount,
             COALESCE(MAX(t.transaction_date), u.registration_date) AS last_transaction_date
           FROM ua_users u LEFT JOIN ua_tx t ON u.user_id = t.user_id
           GROUP BY u.user_id, u.name, u.email, u.age, u.age_group, u.country, u.registration_date"""
    )
    ours = A.user_analytics(users(spark), tx(spark))
    assert rows(ours) == rows(literal)
    got = {r["user_id"]: r for r in ours.collect()}
    assert got[2]["total_spent"] == 10.10  # the user copy doubles the joined sum
    assert got[3]["total_transactions"] == 0 and got[3]["total_spent"] == 0.0
    assert got[3]["last_transaction_date"] == D(2020, 1, 3)  # falls back to registration


def test_transaction_summary(spark):
    out = A.transaction_summary(tx(spark)).collect()
    assert [(r["transaction_year"], r["transaction_month"]) for r in out][0] == (2025, 2)
    key = {(r["transaction_year"], r["transaction_month"], r["category"], r["status"]): r for r in out}
    r = key[(2024, 12, "c1", "failed")]
    assert (r["transaction_count"], r["total_amount"], r["min_amount"], r["max_amount"]) == (2, 6.05, 1.0, 5.05)


def test_logs_per_source_ordered(spark):
    data = [(1, "b", "INFO", D(2025, 1, 2)), (2, "a", "INFO", D(2025, 1, 2)), (3, "a", "INFO", D(2025, 1, 1)),
            (4, "a", "INFO", D(2025, 1, 1))]
    df = spark.createDataFrame(data, "log_id int, source string, level string, log_date date")
    got = [tuple(r) for r in A.logs_per_source(df).collect()]
    assert got == [("a", "INFO", D(2025, 1, 1), 2), ("a", "INFO", D(2025, 1, 2), 1), ("b", "INFO", D(2025, 1, 2), 1)]


def test_generic_pass_through(spark):
    df = tx(spark)
    assert A.aggregate_data(df, "users") is df


def test_row_counts_and_freshness(spark):
    counts = rows(A.row_counts({"tx": tx(spark), "users": users(spark)}))
    assert counts == [("tx", 5), ("users", 4)]
    f = A.freshness(tx(spark), "transaction_date", "2025-02-10 00:00:00", "tx").first()
    assert f["minutes"] == 24 * 60.0


def test_group_counts_sum_to_input(spark):
    total = A.transaction_summary(tx(spark)).groupBy().sum("transaction_count").first()[0]
    assert total == tx(spark).count()
