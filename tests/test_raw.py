"""K1, S1, S9, M1 round trips, including the D1, D2, D7 cases."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lakeforge.sources import raw as R
from tests.conftest import rows


def frame(spark, n, offset=0):
    return spark.createDataFrame([(f"id{i + offset}", i) for i in range(n)], "id string, v int")


def test_ingest_and_read_back_across_days(spark, lake):
    r1 = R.ingest_batch(frame(spark, 3), lake, "ds", "faker", "2025-11-05 10:00:00")
    R.ingest_batch(frame(spark, 2, 10), lake, "ds", "faker", "2025-11-06 09:00:00")
    assert r1["row_count"] == 3 and r1["partition"] == "year=2025/month=11/day=05"
    # three directory levels + ingest id: the dataset root is read with discovery
    assert os.path.isdir(os.path.join(lake, "raw", "ds", "year=2025", "month=11", "day=05"))
    df = R.read_raw(spark, lake, "ds")
    assert df.columns == ["id", "v", "_ingestion_timestamp", "_source"]
    assert df.count() == 5
    one_day = R.read_raw(spark, lake, "ds", where="day = 6")
    assert one_day.count() == 2


def test_partition_filter_prunes_directories(spark, lake, capsys):
    R.ingest_batch(frame(spark, 3), lake, "ds", "faker", "2025-11-05 10:00:00")
    R.ingest_batch(frame(spark, 2), lake, "ds", "faker", "2025-11-06 10:00:00")
    R.read_raw(spark, lake, "ds", where="day = 6").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan


def test_partition_filter_lists_only_its_folders(spark, lake):
    R.ingest_batch(frame(spark, 3), lake, "ds", "faker", "2025-11-05 10:00:00", ingest_id="a")
    R.ingest_batch(frame(spark, 2), lake, "ds", "faker", "2025-11-06 10:00:00", ingest_id="b")
    other = spark.createDataFrame([("z", "x")], "id string, extra string")  # its footer is not met by a read of day 6
    R.ingest_batch(other, lake, "ds", "faker", "2025-11-07 10:00:00", ingest_id="c")
    one = R.read_raw(spark, lake, "ds", where="year = 2025 AND day = 6")
    assert one.count() == 2 and "extra" not in one.columns
    assert all("/day=06/" in f for f in one.inputFiles())
    assert R.read_raw(spark, lake, "ds", where="ingest_id = 'a'").count() == 3
    assert R.read_raw(spark, lake, "ds", where="day = 9").count() == 0
    assert R.read_raw(spark, lake, "ds", where="extra IS NULL AND day < 7").count() == 5  # not about folders alone


def test_shuffles_widen_with_the_input(spark, lake):
    from lakeforge.session import folder_bytes, sized_shuffle

    R.ingest_batch(frame(spark, 3), lake, "ds", "faker", "2025-11-05 10:00:00")
    key, have = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    size = folder_bytes(spark, [R.raw_path(lake, "ds"), f"{lake}/missing"])
    assert size > 0
    with sized_shuffle(spark, [R.raw_path(lake, "ds")], bytes_per_shuffle_partition=100) as width:
        assert width == -(-size // 100) and spark.conf.get(key) == str(width)
    assert spark.conf.get(key) == have
    with sized_shuffle(spark, [R.raw_path(lake, "ds")]) as width:
        assert str(width) == have


def test_sidecar_json_is_ignored(spark, lake):
    rec = R.ingest_batch(frame(spark, 3), lake, "ds", "faker", "2025-11-05 10:00:00")
    leaf = rec["file_path"]  # the sidecar sits beside the parquet files (D2)
    with open(os.path.join(leaf, "sidecar.json"), "w") as fh:
        fh.write('{"row_count": 3}')
    assert R.read_raw(spark, lake, "ds").count() == 3


def test_metadata_only_file_merges(spark, lake):
    R.ingest_batch(frame(spark, 3), lake, "ds", "faker", "2025-11-05 10:00:00")
    empty_pull = spark.createDataFrame([(None,)], "dummy string").select()  # no data columns
    R.ingest_batch(empty_pull.limit(1), lake, "ds", "mongodb", "2025-11-06 10:00:00")  # D7
    df = R.read_raw(spark, lake, "ds")
    assert set(df.columns) == {"id", "v", "_ingestion_timestamp", "_source"}
    assert df.count() == 4 and df.filter(F.col("id").isNull()).count() == 1


def test_replayed_ingest_does_not_duplicate(spark, lake):
    for _ in range(2):
        R.ingest_batch(frame(spark, 3), lake, "ds", "kafka", "2025-11-05 10:00:00", ingest_id="batch-7")
    assert R.read_raw(spark, lake, "ds").count() == 3
    assert R.read_manifest(spark, lake).count() == 1


def test_skip_empty_writes_nothing(spark, lake):
    assert R.ingest_batch(frame(spark, 0), lake, "ds", "kafka", skip_empty=True) is None
    assert not os.path.exists(R.manifest_path(lake))


def test_manifest_and_report(spark, lake):
    R.ingest_batch(frame(spark, 3), lake, "a", "faker", "2025-11-05 10:00:00")
    R.ingest_batch(frame(spark, 4), lake, "a", "faker", "2025-11-05 11:00:00")
    R.ingest_batch(frame(spark, 5), lake, "b", "api", "2025-11-06 10:00:00")
    m = R.read_manifest(spark, lake)
    assert m.first()["columns"] == ["id", "v", "_ingestion_timestamp", "_source"]
    rep = rows(R.ingest_report(m), "dataset_name", "source_type", "partition", "ingests", "rows")
    assert rep == [("a", "faker", "year=2025/month=11/day=05", 2, 7), ("b", "api", "year=2025/month=11/day=06", 1, 5)]


def test_manifest_by_day(spark, lake):
    R.ingest_batch(frame(spark, 3), lake, "a", "faker", "2025-11-05 10:00:00")
    R.ingest_batch(frame(spark, 4), lake, "a", "faker", "2025-11-06 11:00:00")
    assert R.read_manifest(spark, lake, day="2025-11-06").first()["row_count"] == 4
    assert R.read_manifest(spark, lake).count() == 2


def test_raw_timestamps_are_microseconds(spark, lake):
    import glob

    import pyarrow.parquet as pq

    rec = R.ingest_batch(frame(spark, 2), lake, "ts", "faker", "2025-11-05 10:00:00.123456")
    files = glob.glob(f"{rec['file_path']}/*.parquet")
    field = pq.read_schema(files[0]).field("_ingestion_timestamp")
    assert str(field.type).startswith("timestamp[us")  # D3: never nanoseconds


def test_empty_replay_clears_and_empty_pull_reads(spark, lake):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    R.ingest_batch(df, lake, "e", "src", "2025-01-02 00:00:00", "one")
    R.ingest_batch(df.limit(0), lake, "e", "src", "2025-01-02 00:00:00", "one")
    assert R.read_raw(spark, lake, "e").count() == 0
    R.ingest_batch(df.limit(0), lake, "only_empty", "src", "2025-01-02 00:00:00", "one")
    assert R.read_raw(spark, lake, "only_empty").count() == 0


def test_types_that_change_between_ingests(spark, lake):
    """Text on day 1, numbers on day 2, another column on day 3: nothing is lost, nothing fails."""
    text = spark.createDataFrame([("u-1", "41", "2024-01-05"), ("2", "n/a", None)], "id string, v string, day_of string")
    typed = spark.createDataFrame([(3, 7, dt.date(2024, 1, 6))], "id bigint, v int, day_of date")
    wider = spark.createDataFrame([(4, 1 << 40, 0.5)], "id bigint, v bigint, Extra double")
    for n, df in enumerate((text, typed, wider)):
        R.ingest_batch(df, lake, "ds", "files", f"2025-11-0{n + 5} 10:00:00")
    got = R.read_raw(spark, lake, "ds").select("id", "v", "day_of", "Extra")
    assert got.dtypes == [("id", "string"), ("v", "string"), ("day_of", "string"), ("Extra", "double")]
    assert rows(got) == [("2", "n/a", None, None), ("3", "7", "2024-01-06", None), ("4", str(1 << 40), None, 0.5), ("u-1", "41", "2024-01-05", None)]
    # of the days that a filter keeps only their types count
    late = R.read_raw(spark, lake, "ds", where="day > 5").select("id", "v", "Extra")
    assert late.dtypes == [("id", "bigint"), ("v", "bigint"), ("Extra", "double")]
    assert sorted(r["v"] for r in late.collect()) == [7, 1 << 40]


def test_schemas_come_from_the_files_where_no_record_has_them(spark, lake):
    R.ingest_batch(frame(spark, 2), lake, "ds", "faker", "2025-11-05 10:00:00")
    R.ingest_batch(spark.createDataFrame([(7, "x")], "id bigint, v string"), lake, "ds", "faker", "2025-11-06 10:00:00")
    os.rename(R.manifest_path(lake), lake + "/elsewhere")
    got = R.read_raw(spark, lake, "ds")
    assert rows(got.select("id", "v")) == [("7", "x"), ("id0", "0"), ("id1", "1")]


def test_unchanged_types_are_one_scan_without_footers(spark, lake):
    R.ingest_batch(frame(spark, 2), lake, "ds", "faker", "2025-11-05 10:00:00")
    R.ingest_batch(frame(spark, 2).withColumn("w", F.lit(1)), lake, "ds", "faker", "2025-11-06 10:00:00")
    plan = R.read_raw(spark, lake, "ds")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan


def test_common_types():
    from pyspark.sql import types as T

    from lakeforge.sources.drift import common_type

    kind = lambda x: T.StructType.fromDDL(f"a {x}")["a"].dataType
    for a, b, want in [
        ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("int", "double", "double"), ("float", "double", "double"),
        ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(38,10)", "bigint", "decimal(38,10)"), ("decimal(38,2)", "decimal(38,10)", "string"),
        ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "int", "string"), ("string", "date", "string"),
        ("array<int>", "array<string>", "string"), ("struct<a:int>", "struct<a:int>", "struct<a:int>"),
    ]:
        for x, y in ((a, b), (b, a)):
            assert common_type(kind(x), kind(y)).simpleString() == want, (x, y)


def test_empty_replay_with_a_time_as_its_id(spark, lake):
    """K1: Spark writes some characters of a partition value as %XX; an empty replay finds the same folder."""
    run = "manual__2025-11-05T10:00:00+00:00 #1 100%"
    for n in (3, 0, 2):
        rec = R.ingest_batch(frame(spark, n), lake, "ds", "faker", "2025-11-05 10:00:00", ingest_id=run)
        assert rec["row_count"] == n and os.path.isdir(rec["file_path"])
        assert R.read_raw(spark, lake, "ds").count() == n
        kept = R.read_raw(spark, lake, "ds", keep_partitions=True, where=f"ingest_id = '{run}'")
        assert kept.count() == n and {r["ingest_id"] for r in kept.collect()} <= {run}
    assert len(os.listdir(os.path.join(lake, "raw", "ds", "year=2025", "month=11", "day=05"))) == 1
    assert R.read_manifest(spark, lake).count() == 1


def test_compacted_manifest_days(spark, lake):
    """Past days become one file; a repeated ingest's new record counts, not the old one."""
    for day in ("05", "06", "07"):
        for k in range(3):
            R.ingest_batch(frame(spark, k + 1), lake, "ds", "faker", f"2025-11-{day} 10:00:00", ingest_id=f"i{day}{k}")
    want = rows(R.read_manifest(spark, lake))
    assert R.compact_manifest(spark, lake, "2025-11-07") == ["2025-11-05", "2025-11-06"]
    assert R.compact_manifest(spark, lake, "2025-11-07") == []
    assert rows(R.read_manifest(spark, lake)) == want
    assert sorted(os.listdir(R.manifest_path(lake))) == ["day=2025-11-07"]
    files = [f for _, _, fs in os.walk(R.compacted_path(lake)) for f in fs if f.endswith(".json")]
    assert len(files) == 2
    R.ingest_batch(frame(spark, 9), lake, "ds", "faker", "2025-11-05 10:00:00", ingest_id="i050")  # again, after the compaction
    got = {r["ingest_id"]: r["row_count"] for r in R.read_manifest(spark, lake).collect()}
    assert len(got) == R.read_manifest(spark, lake).count() == 9 and got["i050"] == 9
    assert R.read_manifest(spark, lake, day="2025-11-05").count() == 3 and R.read_manifest(spark, lake, since_day="2025-11-06").count() == 6
    assert R.compact_manifest(spark, lake, "2025-11-06") == ["2025-11-05"]
    assert {r["ingest_id"]: r["row_count"] for r in R.read_manifest(spark, lake).collect()} == got
    assert R.read_raw(spark, lake, "ds").count() == sum(got.values())
