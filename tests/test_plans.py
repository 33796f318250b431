"""Plan-shape properties the scale design relies on, and hot-key correctness."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import aggregate as A
from lakeforge.plans import registry
from tests.conftest import SF_SMOKE, rows

IN_FLIGHT = [
    "clean_users", "clean_transactions", "rejects_by_rule", "agg_transactions", "agg_logs", "user_analytics",
    "transaction_summary", "dq_summary", "dq_alerts", "merchant_minute", "union_sources",
]


def plan_tree(spark, df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    tree = buf.getvalue().split("\n\n\n")[0]
    return [re.sub(r"^[\s:|+\-]*", "", line) for line in tree.splitlines()[1:]]


@pytest.fixture
def big_input_plans(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large inputs
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("key", IN_FLIGHT)
def test_every_shuffle_follows_an_aggregate_or_feeds_a_join(spark, big_input_plans, key):
    nodes = plan_tree(spark, registry.QUERIES[key](spark, SF_SMOKE))
    assert not any("EvalPython" in n or "InPandas" in n for n in nodes), "no Python on the row path"
    for i, node in enumerate(nodes):
        if node.startswith("Exchange ("):
            below = next(n for n in nodes[i + 1:] if not n.startswith(("Project", "Filter")))
            aggregates = ("HashAggregate", "ObjectHashAggregate", "SortAggregate")
            assert below.startswith((*aggregates, "Union")), f"{key}: shuffle of raw rows above {below}"


def test_no_unpartitioned_window(spark, big_input_plans):
    for key in IN_FLIGHT:
        nodes = plan_tree(spark, registry.QUERIES[key](spark, SF_SMOKE))
        assert not any(n.startswith("Window") for n in nodes), key


def test_hot_user_third_of_rows(spark):
    # one user owns a third of all transactions; results must equal the literal query
    hot = [(f"h{i}", 7, float(i % 50) + 0.25, f"m{i % 5}") for i in range(600)]
    cold = [(f"c{i}", i % 300, 1.5, f"m{i % 3}") for i in range(1200)]
    tx = spark.createDataFrame(hot + cold, "transaction_id string, user_id int, amount double, merchant string")
    tx = tx.withColumn("transaction_date", F.to_date(F.lit("2025-01-01")))
    ours = A.transactions_per_user(tx)
    tx.createOrReplaceTempView("hot_tx")
    literal = spark.sql(
        """SELECT user_id, count(transaction_id) AS total_transactions,
             CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
             CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS avg_amount,
             max(amount) AS max_amount, min(amount) AS min_amount,
             max(transaction_date) AS last_transaction_date, count(DISTINCT merchant) AS unique_merchants
           FROM hot_tx GROUP BY user_id"""
    )
    assert rows(ours) == rows(literal)
    hot_row = ours.filter("user_id = 7").first()
    assert hot_row["total_transactions"] == 604 and hot_row["unique_merchants"] == 5
