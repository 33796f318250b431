"""K2-K4, T1-T7, S8, S10, P1, P2 round trips."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeforge.plans import warehouse as W
from lakeforge.plans.transform import save_to_processed, transform_pipeline
from lakeforge.sources import raw as R


def tx(spark, n=6, offset=0):
    data = [
        (f"t{i + offset}", i % 3, 10.0 + i, "USD", dt.datetime(2025, 1 + i % 2, 1 + i % 28), "m", "cat", "completed")
        for i in range(n)
    ]
    schema = ("transaction_id string, user_id int, amount double, currency string, transaction_date timestamp, "
              "merchant string, category string, status string")
    return spark.createDataFrame(data, schema)


def test_register_table_recovers_partitions(spark, lake):
    path = save_to_processed(tx(spark).withColumn("p", F.col("user_id")), lake, "ptx", partition_by=["p"])
    W.register_table(spark, "processed_ptx", path, partitioned=True)  # D8: would read 0 rows
    assert spark.table("processed_ptx").count() == 6


def test_processed_scan_keeps_partition_columns(spark, lake):
    path = save_to_processed(tx(spark).withColumn("y", F.lit(2025)), lake, "t", partition_by=["y"])
    assert "y" in W.read_processed(spark, path).columns  # D9
    with pytest.raises(FileNotFoundError):
        W.read_processed(spark, os.path.join(lake, "processed", "missing"))


def test_files_per_partition_bounds_files(spark, lake):
    df = tx(spark, 40).withColumn("p", F.col("user_id"))
    path = save_to_processed(df, lake, "bounded", partition_by=["p"], files_per_partition=2)
    for p in range(3):
        files = [f for f in os.listdir(os.path.join(path, f"p={p}")) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2
    assert spark.read.parquet(path).count() == 40


def test_load_modes(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_modes")
    p1 = save_to_processed(tx(spark, 4), lake, "a")
    assert wh.load_from_processed(p1, "tx") == 4
    assert wh.load_from_processed(p1, "tx", if_exists="append") == 4
    assert spark.table("wh_modes.tx").count() == 8
    assert wh.load_from_processed(p1, "tx", if_exists="replace") == 4
    assert spark.table("wh_modes.tx").count() == 4
    with pytest.raises(ValueError):
        wh.load_from_processed(p1, "tx", if_exists="fail")


def test_materialized_view_create_and_refresh(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_mv")
    p1 = save_to_processed(tx(spark, 4), lake, "a")
    wh.load_from_processed(p1, "tx")
    wh.create_materialized_view("by_user", "SELECT user_id, count(*) AS n FROM wh_mv.tx GROUP BY user_id")
    assert spark.table("wh_mv.by_user").agg(F.sum("n")).first()[0] == 4
    wh.write_table(tx(spark, 3, offset=100), "tx", if_exists="append")
    assert spark.table("wh_mv.by_user").agg(F.sum("n")).first()[0] == 4  # a snapshot
    wh.refresh_materialized_view("by_user")
    assert spark.table("wh_mv.by_user").agg(F.sum("n")).first()[0] == 7


def test_replace_from_itself(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_self")
    wh.write_table(tx(spark, 4), "tx")
    wh.write_table(spark.table("wh_self.tx").filter("user_id = 0"), "tx")  # reads the table it replaces
    assert spark.table("wh_self.tx").count() == 2


def test_indexes_as_layout_and_table_info(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_idx")
    wh.write_table(tx(spark, 20), "tx")
    wh.create_indexes("tx", ["user_id", "transaction_date"])  # both columns along one curve: tests/test_layout.py
    assert spark.table("wh_idx.tx").count() == 20
    wh.create_indexes("tx", ["user_id"])
    df = spark.table("wh_idx.tx")
    assert df.count() == 20
    per_file = df.groupBy(F.input_file_name().alias("f")).agg(F.min("user_id").alias("lo"), F.max("user_id").alias("hi"))
    spans = sorted((r["lo"], r["hi"]) for r in per_file.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))  # range-partitioned: files do not overlap
    info = wh.get_table_info().collect()
    assert [r["table_name"] for r in info] == ["tx"]
    assert info[0]["size_bytes"] > 0 and info[0]["size"].endswith("bytes")


def test_execute_query(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_q")
    wh.write_table(tx(spark, 5), "tx")
    assert wh.execute_query("SELECT count(*) AS n FROM wh_q.tx").first()["n"] == 5


def test_transform_pipeline_end_to_end(spark, lake):
    R.ingest_batch(tx(spark, 6), lake, "transactions", "faker", "2025-11-05 00:00:00")
    R.ingest_batch(tx(spark, 6), lake, "transactions", "faker", "2025-11-05 00:00:00")  # same time: exact dups
    paths = transform_pipeline(spark, lake, "transactions", "transactions", with_aggregation=True,
                               as_of="2025-11-05 01:00:00")
    processed = spark.table("processed_transactions")
    assert processed.count() == 6
    assert {"transaction_year", "transaction_month", "amount_eur"} <= set(processed.columns)
    assert os.path.isdir(os.path.join(paths["transactions"], "transaction_year=2025"))
    agg = spark.table("processed_transactions_agg")
    assert agg.agg(F.sum("total_transactions")).first()[0] == 6


def test_load_with_layout_writes_once(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_lay")
    p1 = save_to_processed(tx(spark, 20), lake, "a")
    assert wh.load_from_processed(p1, "tx", cluster_by=["user_id"]) == 20
    versions = [d for d in os.listdir(wh.table_path("tx")) if d.startswith("v_")]
    assert len(versions) == 1  # no second rewrite for the layout
    per_file = spark.table("wh_lay.tx").groupBy(F.input_file_name()).agg(F.min("user_id"), F.max("user_id"))
    spans = sorted(tuple(r[1:]) for r in per_file.collect())
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_incremental_transform_reads_one_day(spark, lake):
    R.ingest_batch(tx(spark, 6), lake, "tx_inc", "faker", "2025-11-05 00:00:00")
    transform_pipeline(spark, lake, "tx_inc", "transactions", as_of="2025-11-05 01:00:00")
    R.ingest_batch(tx(spark, 4, offset=50), lake, "tx_inc", "faker", "2025-11-06 00:00:00")
    transform_pipeline(spark, lake, "tx_inc", "transactions", as_of="2025-11-06 01:00:00",
                       raw_filter="year = 2025 AND month = 11 AND day = 6", mode="append")
    processed = spark.table("processed_tx_inc")
    assert processed.count() == 10
    assert processed.filter("_processed_timestamp = '2025-11-06 01:00:00'").count() == 4


def test_warehouse_build_fails_loudly(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_fail")
    with pytest.raises(FileNotFoundError):  # D10: no warning-and-continue
        W.build_warehouse(wh, {"users": os.path.join(lake, "processed", "nope")})


def test_replace_takes_over_the_new_schema(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_drift")
    wh.write_table(spark.createDataFrame([("1", "a")], "k string, name string"), "t")
    wh.write_table(spark.createDataFrame([(1, "a", 2.0)], "k long, name string, more double"), "t")
    assert spark.table("wh_drift.t").dtypes == [("k", "bigint"), ("name", "string"), ("more", "double")]
    assert [tuple(r) for r in spark.table("wh_drift.t").collect()] == [(1, "a", 2.0)]


def test_append_goes_by_name(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_names")
    wh.write_table(spark.createDataFrame([("k1", "n1")], "k string, name string"), "t")
    wh.write_table(spark.createDataFrame([("n2", "k2")], "name string, k string"), "t", if_exists="append")
    assert sorted(tuple(r) for r in spark.table("wh_names.t").collect()) == [("k1", "n1"), ("k2", "n2")]
    with pytest.raises(ValueError):
        wh.write_table(spark.createDataFrame([("x", 1)], "k string, other int"), "t", if_exists="append")


def test_failed_view_keeps_the_old_one(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_keep")
    wh.write_table(tx(spark, 4), "tx")
    wh.create_materialized_view("v", "SELECT user_id FROM wh_keep.tx")
    with pytest.raises(Exception):
        wh.create_materialized_view("v", "SELECT raise_error('no') AS user_id FROM wh_keep.tx")
    assert spark.table("wh_keep.v").count() == 4
    with pytest.raises(ValueError):
        wh.create_materialized_view("w", lambda s, schema: s.table("wh_keep.tx"))


def test_old_versions_are_removed(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_versions")
    for n in (4, 3, 2, 1):
        wh.write_table(tx(spark, n), "tx")
    assert spark.table("wh_versions.tx").count() == 1
    assert len([d for d in os.listdir(os.path.join(lake, "curated", "wh_versions", "tx")) if d.startswith("v_")]) == 2


def test_view_layout_survives_a_refresh(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_layout")
    wh.write_table(tx(spark, 4), "tx")
    wh.create_materialized_view("v", "SELECT * FROM wh_layout.tx", cluster_by=("user_id",))
    wh.write_table(tx(spark, 3, offset=100), "tx", if_exists="append")
    wh.refresh_materialized_view("v")
    props = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES wh_layout.v").collect()}
    assert spark.table("wh_layout.v").count() == 7 and props[W.LAYOUT_PROP] == "user_id"


def test_jdbc_warehouse_refuses_catalog_work(spark, lake):
    wh = W.Warehouse(spark, os.path.join(lake, "curated"), schema="wh_db", jdbc={"url": "jdbc:none:"})
    for call in (lambda: wh.get_table_info(), lambda: wh.create_indexes("t", ["k"]), lambda: wh.create_materialized_view("v", "SELECT 1 AS x")):
        with pytest.raises(NotImplementedError):
            call()
