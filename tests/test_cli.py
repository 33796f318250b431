"""Command line entry points, in-process on the test session."""

from lakeforge.__main__ import main
from lakeforge.sources import raw as R


def test_ingest_transform_warehouse_run(spark, tmp_path, capsys):
    lake = str(tmp_path / "lake")
    users = tmp_path / "users.csv"
    users.write_text("user_id,name,email,age,country,registration_date\n"
                     "1, Ann ,Ann@x.com,30,FR,2020-01-01\n2,Bob,bad,40,DE,2020-01-02\n")
    tx = tmp_path / "tx.json"
    tx.write_text('{"transaction_id":"t1","user_id":1,"amount":12.5,"currency":"USD",'
                  '"transaction_date":"2025-01-02","merchant":"m","category":"c","status":"completed"}\n')
    assert main(["ingest", "--dataset", "users", "--path", str(users), "--format", "csv", "--data-lake", lake]) == 0
    assert main(["ingest", "--dataset", "transactions", "--path", str(tx), "--format", "json",
                 "--data-lake", lake, "--ingest-id", "tx-1"]) == 0
    assert R.read_raw(spark, lake, "users").count() == 2
    assert main(["run", "--data-lake", lake, "--datasets", "users,transactions"]) == 0
    out = capsys.readouterr().out
    assert "relationships" in out and "unique" in out
    assert spark.table("curated.user_analytics").count() == 1  # Bob's email is invalid
    assert main(["report", "--data-lake", lake]) == 0


def test_run_is_gated_by_its_own_ingests(spark, tmp_path):
    """M2: an ingest of an earlier day does not stand in for a missing one, unless it is named."""
    import pytest

    lake = str(tmp_path / "lake")
    row = '{"transaction_id":"t1","user_id":1,"amount":12.5,"currency":"USD","transaction_date":"2025-01-02","merchant":"m","category":"c","status":"completed"}\n'
    (tmp_path / "logs.json").write_text('{"log_id":1,"timestamp":"2025-01-02T00:00:00","level":"INFO","source":"s"}\n')
    (tmp_path / "tx.json").write_text(row)
    for name, at in (("logs", "2020-01-01 00:00:00"), ("tx", None)):
        args = ["ingest", "--dataset", name, "--path", str(tmp_path / f"{name}.json"), "--format", "json", "--data-lake", lake, "--ingest-id", f"{name}-1"]
        assert main(args + (["--ingested-at", at] if at else [])) == 0
    with pytest.raises(RuntimeError, match="missing datasets: logs"):
        main(["run", "--data-lake", lake, "--datasets", "logs,tx"])
    with pytest.raises(RuntimeError, match="missing datasets: tx"):
        main(["run", "--data-lake", lake, "--datasets", "logs,tx", "--ingest-ids", "logs-1"])
    from lakeforge.plans.run import ingests_since

    assert ingests_since(spark, lake) == ["tx-1"] and ingests_since(spark, lake, "2019-12-31 12:00:00") == ["logs-1", "tx-1"]


def test_text_then_typed_ingests_transform(spark, tmp_path):
    """An untyped CSV of one day and typed records of the next."""
    lake = str(tmp_path / "lake")
    users = tmp_path / "users.csv"
    users.write_text("user_id,name,email,age,country,registration_date\n1, Ann ,Ann@x.com,30,FR,2020-01-01\nx2,Bob,b@y.de,n/a,DE,2020-01-02\n")
    assert main(["ingest", "--dataset", "people", "--path", str(users), "--format", "csv", "--data-lake", lake, "--ingested-at", "2025-01-01 00:00:00"]) == 0
    R.ingest_batch(spark.createDataFrame([(3, "Cy", "c@z.org", 40, "IT")], "user_id bigint, name string, email string, age int, country string"), lake, "people", "db", "2025-01-02 00:00:00")
    assert main(["transform", "--dataset", "people", "--type", "users", "--data-lake", lake]) == 0
    got = spark.table("processed_people").select("user_id", "email", "age", "age_group").collect()
    assert sorted(tuple(r) for r in got) == [("1", "ann@x.com", 30, "adult"), ("3", "c@z.org", 40, "adult")]
