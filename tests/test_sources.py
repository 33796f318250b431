"""S2, S3, S5, S6, S10, S11 through landed files."""

import json
import os

from lakeforge.sources import connectors as S
from lakeforge.sources import raw as R


def test_document_store_filter_limit_and_id(spark, tmp_path):
    path = str(tmp_path / "farms.json")
    with open(path, "w") as fh:
        for i in range(5):
            fh.write(json.dumps({"_id": {"$oid": f"abc{i}"}, "farm_name": f"f{i}", "location": "north" if i % 2 else "south",
                                 "size": float(i)}) + "\n")
    df = S.read_document_store(spark, fmt="json", path=path, query={"location": "south"})
    assert df.count() == 3
    assert dict(df.dtypes)["_id"] == "string"
    assert S.read_document_store(spark, fmt="json", path=path, limit=2).count() == 2


def test_wide_column_projection_and_uuid(spark, tmp_path):
    path = str(tmp_path / "farms_wc")
    spark.createDataFrame(
        [("123e4567-e89b-12d3-a456-426614174000", "a", "x", 1.5)], "id string, name string, location string, size double"
    ).write.parquet(path)
    df = S.read_wide_column(spark, fmt="parquet", path=path, columns=["id", "name"], limit=20)
    assert df.columns == ["id", "name"] and df.count() == 1


def test_api_landing_and_ingest(spark, tmp_path):
    land = tmp_path / "weather"
    land.mkdir()
    (land / "resp1.json").write_text(json.dumps({"time": "2025-11-05T00:00", "temperature_2m": 11.2,
                                                 "precipitation": 0.0}))
    df = S.read_api_landing(spark, str(land), source_url="https://example.invalid/forecast", multi_line=True)
    assert df.first()["_source_url"] == "https://example.invalid/forecast"
    lake = str(tmp_path / "lake")
    rec = S.ingest_from_api(spark, lake, "weather_api", str(land), "https://example.invalid/forecast",
                            "2025-11-05 16:15:06")  # one object per line is also one document
    assert rec["row_count"] == 1
    assert "_source_url" in R.read_raw(spark, lake, "weather_api").columns


def test_file_formats(spark, tmp_path):
    csv = tmp_path / "a.csv"
    csv.write_text("x,y\n1,a\n2,b\n")
    assert S.read_files(spark, str(csv), "csv").count() == 2
    lake = str(tmp_path / "lake")
    S.ingest_files(spark, lake, "csvset", str(csv), "csv", "2025-11-05 00:00:00")
    assert R.read_raw(spark, lake, "csvset").count() == 2
    assert os.path.isdir(os.path.join(lake, "raw", "csvset", "year=2025"))


def test_inline_rows_and_sql(spark):
    df = S.inline_rows(spark, [{"user_id": "user_1", "name": "Alice"}, {"user_id": "user_2", "name": "Bob"}],
                       "user_id string, name string")
    df.createOrReplaceTempView("inline_users")
    assert spark.sql("SELECT count(*) AS n FROM inline_users").first()["n"] == 2


def test_document_store_object_ids(spark, tmp_path):
    from lakeforge.sources.connectors import read_document_store

    path = tmp_path / "docs.json"
    path.write_text('{"_id": {"$oid": "abc0"}, "k": 1}\n{"_id": {"$oid": "abc1"}, "k": 2}\n')
    got = read_document_store(spark, fmt="json", path=str(path), query={"k": 2}, limit=5)
    assert [r["_id"] for r in got.collect()] == ["abc1"]
