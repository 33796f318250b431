"""P2 end to end on the smoke data: warehouse results equal the in-flight queries."""

from lakeforge.plans import registry
from lakeforge.plans.run import run_pipeline
from lakeforge.operators import clean as C
from lakeforge.sources import testdata as T
from tests.conftest import SF_SMOKE, rows


def test_run_pipeline_matches_in_flight_queries(spark, lake):
    batches = [
        (C.drop_metadata(T.users_raw(spark, SF_SMOKE)), "users", "customer"),
        (C.drop_metadata(T.transactions_raw(spark, SF_SMOKE)), "transactions", "orders"),
        (C.drop_metadata(T.logs_raw(spark, SF_SMOKE)), "logs", "events"),
    ]
    result = run_pipeline(spark, lake, batches, registry.AS_OF, schema="run_test")
    assert rows(spark.table("run_test.user_analytics")) == rows(registry.q_user_analytics(spark, SF_SMOKE))
    assert rows(spark.table("run_test.transaction_summary")) == rows(registry.q_transaction_summary(spark, SF_SMOKE))
    assert rows(result["tests"]) == rows(registry.q_dq_summary(spark, SF_SMOKE))
    report = {r["dataset_name"]: r["rows"] for r in result["ingest_report"].collect()}
    assert report == {name: df.count() for df, name, _ in batches}
    # table info is taken at the end of the warehouse build (P3), before the models
    info = [r["table_name"] for r in result["table_info"].collect()]
    assert info == ["logs", "transaction_summary", "transactions", "user_analytics", "users"]
