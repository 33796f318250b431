"""Property tests: the skew-proof rewrites equal their literal definitions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeforge.operators import aggregate as A
from lakeforge.operators import clean as C
from tests.conftest import rows

USERS = "user_id int, name string, email string, age int, age_group string, country string, registration_date date"
TX = "transaction_id string, user_id int, amount double, transaction_date date"

user_rows = st.lists(
    st.tuples(st.integers(0, 5), st.sampled_from(["A", "B"]), st.integers(18, 70)), min_size=1, max_size=12
)
tx_rows = st.lists(
    st.tuples(
        st.integers(0, 15),
        st.integers(0, 7),
        st.one_of(st.none(), st.integers(1, 99999).map(lambda c: c / 100)),
        st.integers(1, 28),
    ),
    max_size=25,
)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(users=user_rows, txs=tx_rows)
def test_user_analytics_equals_literal_join(spark, users, txs):
    u = spark.createDataFrame(
        [(uid, name, f"{name}@x.com", age, "adult", "FR", dt.date(2020, 1, 1)) for uid, name, age in users], USERS
    )
    t = spark.createDataFrame(
        [(f"t{tid}", uid, amt, dt.date(2025, 1, day)) for tid, uid, amt, day in txs], TX
    )
    u.createOrReplaceTempView("prop_users")
    t.createOrReplaceTempView("prop_tx")
    literal = spark.sql(
        """SELECT u.user_id, u.name, u.email, u.age, u.age_group, u.country,
             COUNT(DISTINCT t.transaction_id) AS total_transactions,
             COALESCE(CAST(SUM(CAST(t.amount AS DECIMAL(18,2))) AS DOUBLE), 0D) AS total_spent,
             COALESCE(try_divide(CAST(SUM(CAST(t.amount AS DECIMAL(18,2))) AS DOUBLE), COUNT(t.amount)), 0D)
               AS avg_transaction_amount,
             COALESCE(MAX(t.transaction_date), u.registration_date) AS last_transaction_date
           FROM prop_users u LEFT JOIN prop_tx t ON u.user_id = t.user_id
           GROUP BY u.user_id, u.name, u.email, u.age, u.age_group, u.country, u.registration_date"""
    )
    assert rows(A.user_analytics(u, t)) == rows(literal)


keyed_rows = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=20
)


@SETTINGS
@given(data=keyed_rows)
def test_keyed_dedup_equals_row_number(spark, data):
    base = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame(
        [(k, base + dt.timedelta(days=d), v) for k, d, v in data], "k int, _ingestion_timestamp timestamp, v int"
    )
    ours = C.deduplicate(df, ["k"])
    w = Window.partitionBy("k").orderBy(F.desc("_ingestion_timestamp"), F.desc("v"))
    reference = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert rows(ours) == rows(reference)
