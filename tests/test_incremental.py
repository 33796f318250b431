"""Incremental P1: runs that are repeated, overlap, come by day, and change types."""

import os

import pytest
from pyspark.sql import functions as F

from lakeforge.plans.runs import DIGEST, RUN, Digests, digest, new_rows, read_runs, run_folders
from lakeforge.plans.transform import processed_path, transform_pipeline
from lakeforge.plans.warehouse import Warehouse, read_processed
from lakeforge.sources import raw as R
from lakeforge.sources import testdata as T
from lakeforge.operators import clean as C
from tests.conftest import SF_SMOKE, rows

DAY = "2025-11-05 10:00:00"
AS_OF = "2025-12-01 00:00:00"


def landed(spark, lake):
    """Transactions in three ingests of one ingest time; every row is in two of them."""
    tx = C.drop_metadata(T.transactions_raw(spark, SF_SMOKE))
    k = F.col("transaction_id").cast("bigint") % 3
    for n, name in enumerate("abc"):
        R.ingest_batch(tx.where(k != n), lake, "tx", "orders", DAY, ingest_id=name)
    return tx.count()


def run(spark, lake, ingest, **options):
    return transform_pipeline(spark, lake, "tx", "transactions", raw_filter=f"ingest_id = '{ingest}'", mode="append", as_of=AS_OF, **options)["tx"]


def test_runs_by_ingest_give_the_rows_of_a_full_run(spark, lake):
    landed(spark, lake)
    full = read_processed(spark, transform_pipeline(spark, lake, "tx", "transactions", as_of=AS_OF)["tx"])
    order = full.columns
    full = rows(full)
    lake2 = lake + "2"
    os.makedirs(lake2)
    os.symlink(lake + "/raw", lake2 + "/raw")
    os.symlink(lake + "/manifest", lake2 + "/manifest")
    for ingest in "abcbac":  # a repeated run, in any order, changes nothing
        path = run(spark, lake2, ingest)
        if ingest == "c":
            assert rows(read_processed(spark, path).select(order)) == full
            assert rows(spark.table("processed_tx").select(order)) == full
    assert len(run_folders(spark, path)) == 3 and not {RUN, DIGEST} & set(read_processed(spark, path).columns)


def test_a_day_reads_its_folder_only_and_a_repeated_day_adds_nothing(spark, lake):
    tx = C.drop_metadata(T.transactions_raw(spark, SF_SMOKE))
    k = F.col("transaction_id").cast("bigint") % 2
    for day in (0, 1):
        R.ingest_batch(tx.where(k == day), lake, "tx", "orders", f"2025-11-0{day + 5} 10:00:00")
    for day in (5, 6, 6, 5, 6):
        where = f"year = 2025 AND month = 11 AND day = {day}"
        assert all(f"/day=0{day}/" in f for f in R.read_raw(spark, lake, "tx", where=where).inputFiles())
        out = transform_pipeline(spark, lake, "tx", "transactions", raw_filter=where, mode="append", as_of=AS_OF)["tx"]
    want = C.clean_data(T.transactions_raw(spark, SF_SMOKE), "transactions")
    assert rows(read_processed(spark, out).select("transaction_id", "amount")) == rows(want.select("transaction_id", "amount"))


def test_a_smaller_repeat_leaves_no_old_partition(spark, lake):
    tx = C.drop_metadata(T.transactions_raw(spark, SF_SMOKE))
    R.ingest_batch(tx, lake, "tx", "orders", DAY, ingest_id="a")
    run(spark, lake, "a")
    few = tx.where("year(transaction_date) = 1995")
    R.ingest_batch(few, lake, "tx", "orders", DAY, ingest_id="a")
    out = run(spark, lake, "a")
    assert {r[0] for r in read_processed(spark, out).select("transaction_year").distinct().collect()} == {1995}
    digests = Digests(spark, out)
    assert digests.of_others("none").count() == read_processed(spark, out).count()


def test_a_run_that_stopped_before_its_digests_is_repaired_by_its_retry(spark, lake):
    landed(spark, lake)
    run(spark, lake, "a")
    path = run(spark, lake, "b")
    spark.sql(f"ALTER TABLE {Digests(spark, path).name} DROP PARTITION ({RUN} = \"ingest_id = 'b'\")")
    run(spark, lake, "b")
    path = run(spark, lake, "c")
    got = read_processed(spark, path)
    assert got.count() == got.dropDuplicates(["transaction_id"]).count() == C.clean_data(T.transactions_raw(spark, SF_SMOKE), "transactions").count()


def test_only_the_runs_own_rows_are_shuffled(spark, lake):
    landed(spark, lake)
    path = run(spark, lake, "a")
    digests = Digests(spark, path)
    raw = R.read_raw(spark, lake, "tx", where="ingest_id = 'b'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for a table too large to broadcast
    try:
        plan = new_rows(raw, digests, "b")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    table = [x for x in plan.splitlines() if "FileScan parquet" in x and digests.name in x]
    assert len(table) == 1 and "Bucketed: true" in table[0] and "PartitionFilters: [isnotnull(_run_id" in table[0]
    # one shuffle of rows by digest, and one of the Bloom filter's words; none above the digest table
    assert plan.count("Exchange hashpartitioning(_digest") == 1 and plan.count("Exchange hashpartitioning(") == 2


def test_types_that_change_between_runs(spark, lake):
    R.ingest_batch(spark.createDataFrame([("1", "x"), ("2", None)], "id string, v string"), lake, "g", "f", DAY, ingest_id="a")
    R.ingest_batch(spark.createDataFrame([(3, 0.5), (4, None)], "id bigint, w double"), lake, "g", "f", DAY, ingest_id="b")
    for ingest in "abb":
        path = transform_pipeline(spark, lake, "g", "generic", raw_filter=f"ingest_id = '{ingest}'", mode="append", as_of=AS_OF)["g"]
    want = [("1", "x", None), ("2", None, None), ("3", None, 0.5), ("4", None, None)]
    assert rows(read_processed(spark, path).select("id", "v", "w")) == want
    assert rows(spark.table("processed_g").select("id", "v", "w")) == want
    assert rows(read_runs(spark, path, ["ingest_id = 'b'"]).select("id")) == [(3,), (4,)]  # its own types
    wh = Warehouse(spark, lake + "/curated", "incremental_types")
    assert wh.load_from_processed(path, "g") == 4
    assert rows(spark.table("incremental_types.g").select("id", "v", "w")) == want


def test_digests_do_not_depend_on_missing_columns_order_or_type(spark):
    a = spark.createDataFrame([(1, "x", None)], "id int, v string, w string")
    b = spark.createDataFrame([("x", 1)], "v string, id bigint")
    c = spark.createDataFrame([("x", "1", "")], "v string, id string, w string")
    one, two, three = (df.select(digest(df).alias("d")).first()["d"] for df in (a, b, c))
    assert one == two != three


def test_runs_after_a_full_run_add_what_it_has_not_read(spark, lake):
    landed(spark, lake)
    n = C.clean_data(T.transactions_raw(spark, SF_SMOKE), "transactions").count()
    path = transform_pipeline(spark, lake, "tx", "transactions", raw_filter="ingest_id = 'a'", as_of=AS_OF)["tx"]
    first = read_processed(spark, path).count()
    assert first < n
    run(spark, lake, "a")  # the full run has read it
    assert read_processed(spark, path).count() == first == spark.table("processed_tx").count()
    for ingest in "bbcb":
        run(spark, lake, ingest)
    assert read_processed(spark, path).select("transaction_id").distinct().count() == n == spark.table("processed_tx").count()
    transform_pipeline(spark, lake, "tx", "transactions", as_of=AS_OF)  # takes the place of all runs
    assert read_processed(spark, path).count() == n == spark.table("processed_tx").count() and not run_folders(spark, path)
    run(spark, lake, "c")
    assert read_processed(spark, path).count() == n


def test_keyed_de_dup_takes_a_full_run(spark, lake):
    landed(spark, lake)
    with pytest.raises(ValueError, match="full run"):
        run(spark, lake, "a", subset=["transaction_id"])


def test_views_refresh_from_the_changed_runs_only(spark, lake):
    from lakeforge.plans import incremental_views as I
    from lakeforge.operators import aggregate as A
    from lakeforge.operators import enrich as E

    landed(spark, lake)
    wh = Warehouse(spark, lake + "/curated", "incremental_views")
    R.ingest_batch(C.drop_metadata(T.users_raw(spark, SF_SMOKE)), lake, "people", "customer", DAY, ingest_id="u")
    users = transform_pipeline(spark, lake, "people", "users", raw_filter="ingest_id = 'u'", mode="append", as_of=AS_OF)["people"]

    def refreshed():
        read = I.refresh_user_analytics(wh, users, processed_path(lake, "tx")), I.refresh_transaction_summary(wh, processed_path(lake, "tx"))
        now = read_processed(spark, processed_path(lake, "tx"))
        assert rows(spark.table("incremental_views.user_analytics")) == rows(A.user_analytics(read_processed(spark, users), now))
        assert rows(spark.table("incremental_views.transaction_summary")) == rows(A.transaction_summary(now))
        return tuple(len(r) for r in read)

    run(spark, lake, "a")
    assert refreshed() == (2, 1)
    run(spark, lake, "b")
    assert refreshed() == (1, 1)
    assert refreshed() == (0, 0)
    run(spark, lake, "a")  # the same rows in new files
    assert refreshed() == (1, 1)
    # transactions that are new rows with old ids: their pairs belong to run a, until it loses them
    tx = C.drop_metadata(T.transactions_raw(spark, SF_SMOKE))
    R.ingest_batch(tx.withColumn("amount", F.col("amount") + 1), lake, "tx", "orders", DAY, ingest_id="c")
    run(spark, lake, "c")
    assert refreshed() == (1, 1)
    R.ingest_batch(tx.where("transaction_id % 5 = 0"), lake, "tx", "orders", DAY, ingest_id="a")
    run(spark, lake, "a")
    assert refreshed() == (3, 1)
    transform_pipeline(spark, lake, "tx", "transactions", as_of=AS_OF)  # a full run in their place
    assert refreshed() == (1, 1)
