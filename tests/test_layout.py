"""T5 layout, T6 files, bucketed curated tables (K4)."""

import os

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import aggregate as A
from lakeforge.operators import quality as Q
from lakeforge.plans import layout as L
from lakeforge.plans import registry
from lakeforge.plans import warehouse as W
from tests.conftest import SF_SMOKE, rows


def people(spark, n=20_000):
    k = F.xxhash64("id")
    return spark.range(n).select(
        F.col("id").alias("user_id"), F.concat(F.lit("user."), F.hex(k), F.lit("@x.com")).alias("email"),
        F.concat(F.lit("country "), F.pmod(k, F.lit(25))).alias("country"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 7).alias("v"),
    )


def rows_read(df):
    """Rows that the scan hands on: those of the row groups that its filters let pass."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_an_equality_on_any_column_reads_few_files_and_row_groups(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="layout_skip")
    wh.write_table(people(spark), "users")
    columns = ("country", "email", "user_id")
    wh.create_indexes("users", columns, files=64)
    table = spark.table("layout_skip.users")
    assert rows(table) == rows(people(spark))
    bounds = L.file_bounds(table, columns)
    some = table.where("user_id IN (0, 7777, 19999)").collect()
    for c in columns:
        for r in some:
            files, touched = L.lookup_files(bounds, c, r[c])
            assert files == 64 and 0 < touched < files / 2, (c, files, touched)
    # Bloom filters: of the files within whose bounds the value falls, only its own is read
    for c in ("email", "user_id"):
        assert rows_read(spark.table("layout_skip.users").where(F.col(c) == some[1][c])) < 20_000 / 16


def test_a_sorted_layout_would_serve_its_first_column_only(spark, lake):
    """What the curve is for: behind country, email and user_id alone skip nothing."""
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="layout_sorted")
    wh.write_table(people(spark).repartitionByRange(16, "country", "email").sortWithinPartitions("country", "email"), "users")
    bounds = L.file_bounds(spark.table("layout_sorted.users"), ["country", "user_id"])
    files, touched = L.lookup_files(bounds, "user_id", 7777)
    assert touched > files * 0.9


def test_a_hot_value_is_spread_over_files(spark):
    hot = people(spark, 4000).withColumn("country", F.when(F.col("user_id") % 2 == 0, "hot").otherwise(F.col("country")))
    made = L.clustered(hot, ["country"], files=16)
    per_file = [r[0] for r in made.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(per_file) < 4 * 4000 / 16 and sum(per_file) == 4000


def test_layout_of_odd_columns(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, None), (2, "b")], "k int, s string")
    assert rows(L.clustered(df, ["k", "s"])) == rows(df)
    assert rows(L.clustered(df.limit(0), ["k", "s"])) == []
    assert rows(L.clustered(df.select(F.lit(1).alias("k"), "s"), ["k"])) == rows(df.select(F.lit(1).alias("k"), "s"))


def test_curve_keeps_neighbours_in_every_column(spark):
    grid = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    place = grid.select("x", "y", L.morton([F.col("x"), F.col("y")], bits=3).alias("p")).collect()
    want = {}
    for x in range(8):
        for y in range(8):
            want[x, y] = sum(((x >> b & 1) << (2 * b + 1)) | ((y >> b & 1) << (2 * b)) for b in range(3))
    assert {(r["x"], r["y"]): r["p"] for r in place} == want


def test_table_sizes_are_those_of_the_present_files(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="layout_sizes")
    assert wh.get_table_info("layout_sizes").collect() == [] if wh.create_schema() is None else False
    for n in (500, 5000):  # the older version stays on disk and does not count
        wh.write_table(people(spark, n), "users")
    wh.write_table(people(spark, 0), "nobody")
    folder = wh.location("users").replace("file:", "")
    on_disk = sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet"))
    info = {r["table_name"]: r for r in wh.get_table_info().collect()}
    assert info["users"]["size_bytes"] == on_disk and info["nobody"]["size_bytes"] == 0
    assert wh.table_files("users").agg(F.sum("rows")).first()[0] == 5000


def test_a_version_of_the_same_columns_takes_over_in_one_step(spark, lake, monkeypatch):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="layout_swap")
    wh.write_table(people(spark, 10), "users")
    said = []
    real = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), real(text, *a, **k))[1])
    wh.write_table(people(spark, 20), "users")
    assert any("SET LOCATION" in s for s in said) and not any(s.startswith("DROP TABLE") for s in said)
    assert spark.table("layout_swap.users").count() == 20
    wh.write_table(people(spark, 5).drop("v"), "users")
    assert any(s.startswith("DROP TABLE") for s in said) and spark.table("layout_swap.users").columns == ["user_id", "email", "country"]


@pytest.fixture
def colocated(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="layout_buckets")
    wh.write_table(registry.users_processed(spark, SF_SMOKE), "users", bucket_by=["user_id"], buckets=4)
    wh.write_table(registry.transactions_processed(spark, SF_SMOKE), "transactions", bucket_by=["user_id"], buckets=4)
    for name, df in registry.models(spark, SF_SMOKE).items():
        wh.write_table(df, name, bucket_by=["user_id"], buckets=4)
    return wh


def test_co_located_tables_join_without_a_shuffle_on_the_key(spark, colocated):
    users, tx = spark.table("layout_buckets.users"), spark.table("layout_buckets.transactions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        view = A.user_analytics(users, tx)
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        test = Q.model_tests({m: spark.table(f"layout_buckets.{m}") for m in ("dim_users", "fact_transactions")}, [("fact_transactions", "user_id", "relationships")])
        plan = test._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") == 2  # one row of counts is gathered
        assert rows(view) == rows(registry.q_user_analytics(spark, SF_SMOKE))
        assert rows(test) == rows(registry.q_dq_relationships(spark, SF_SMOKE))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_are_replaced_and_appended(spark, colocated):
    n = spark.table("layout_buckets.users").count()
    users = registry.users_processed(spark, SF_SMOKE)
    colocated.write_table(users, "users", if_exists="append")
    assert spark.table("layout_buckets.users").count() == 2 * n
    colocated.write_table(users, "users", bucket_by=["user_id"], buckets=4)
    assert spark.table("layout_buckets.users").count() == n
    spec = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED layout_buckets.users").collect()}
    assert spec["Num Buckets"] == "4"


@pytest.mark.parametrize("copies", [1, 500])
def test_the_sample_is_the_smallest_hashes_and_leaves_the_tasks_under_a_bound(spark, monkeypatch, copies):
    base = people(spark, 20_000 // copies).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("n").repartition(8)
    sent, collect = [], type(base).collect

    def collected(df):
        got = collect(df)
        sent.append((len(got), df._jdf.queryExecution().executedPlan().toString()))
        return got

    monkeypatch.setattr(type(base), "collect", collected)
    monkeypatch.setattr(L, "SAMPLE", 100)
    assert L.clustered(base, ["country", "user_id"], 8).count() == base.count()
    # a top-n would send SAMPLE rows of each of the 8 tasks
    assert sent and not any("TakeOrdered" in plan for _, plan in sent) and max(n for n, _ in sent) < 5 * 100
    tie = F.xxhash64(*base.columns)
    want = [r[0] for r in collect(base.select(tie.alias("t")).orderBy("t").limit(100))]
    got = L.smallest(base, ["country", "email", "user_id", "v"], tie, 100)
    assert [r["_tie"] for r in got] == want
    assert len(L.smallest(base.limit(7), ["country"], tie, 100)) == 7 and L.smallest(base.limit(0), ["country"], tie, 100) == []
