"""Physical-plan summary of the registered queries -> PLANS.md.

For each query that plans without writing (the lake / stream / warehouse
queries write before they return, so they are skipped), this explains the
plan and counts: hash and range shuffles, single-partition exchanges (the
final merge of a global aggregate), broadcasts, join strategies, Expand
nodes, Python evaluation nodes and scans with pushed filters.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeforge.plans import registry  # noqa: E402
from lakeforge.session import build_session  # noqa: E402

WRITES = {
    "raw_roundtrip", "raw_roundtrip_keyed", "raw_ingest", "ingest_report", "completeness",
    "warehouse_user_analytics", "warehouse_transaction_summary", "warehouse_dq_summary",
    "warehouse_table_info", "merchant_minute_stream", "merchant_minute_watermarked",
    "file_batch_csv", "api_landing", "document_extract", "clean_observed", "merchant_minute_updates",
    "document_find", "wide_column_extract", "clean_users_text", "clean_transactions_text", "agg_transactions_text",
    "raw_one_day", "processed_table", "kafka_pull", "kafka_pull_bounded", "curated_replace_new_schema", "curated_append_by_name",
    "curated_colocated", "curated_colocated_relationship", "view_refresh", "view_refresh_incremental",
    "view_refresh_incremental_users", "raw_type_drift", "empty_replay", "incremental_equals_full", "incremental_retry",
    "index_files_read", "warehouse_table_files", "merchant_minute_late", "dq_alerts_stream", "dq_summary", "dq_test_alert",
}


def summarize(text: str) -> dict[str, object]:
    names: dict[str, str] = {}
    args: dict[str, str] = {}
    for block in re.split(r"\n(?=\(\d+\) )", text):
        head = re.match(r"\((\d+)\) (.+)", block)
        if not head:
            continue
        names[head.group(1)] = head.group(2).strip()
        arg = re.search(r"^Arguments: (.*)$", block, flags=re.M)
        args[head.group(1)] = arg.group(1) if arg else ""
    out = {"hash": 0, "range": 0, "single": 0, "broadcast": 0, "smj": 0, "bhj": 0, "shj": 0,
           "expand": 0, "python": 0, "scans": 0, "pushed": 0}
    for n, name in names.items():
        a = args.get(n, "")
        if name.startswith("Exchange"):
            if a.startswith("hashpartitioning"):
                out["hash"] += 1
            elif a.startswith("rangepartitioning"):
                out["range"] += 1
            elif a.startswith("SinglePartition"):
                out["single"] += 1
        elif name.startswith("BroadcastExchange"):
            out["broadcast"] += 1
        elif name.startswith("SortMergeJoin"):
            out["smj"] += 1
        elif name.startswith("BroadcastHashJoin"):
            out["bhj"] += 1
        elif name.startswith("ShuffledHashJoin"):
            out["shj"] += 1
        elif name.startswith("Expand"):
            out["expand"] += 1
        elif "EvalPython" in name or "ArrowEvalPython" in name or "FlatMapGroupsInPandas" in name:
            out["python"] += 1
        elif name.startswith("Scan parquet"):
            out["scans"] += 1
    out["pushed"] = len(re.findall(r"^PushedFilters: \[.+\]", text, flags=re.M))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=200)
    # Plans as a large cluster would see them: no static broadcast of the
    # derived tables (AQE may still choose one at runtime from real sizes).
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = []
    for key, fn in registry.QUERIES.items():
        if key in WRITES:
            continue
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain("formatted")
        rows.append((key, summarize(buf.getvalue())))
    cols = ["hash", "range", "single", "broadcast", "smj", "bhj", "expand", "python", "scans", "pushed"]
    print("# Physical plans of the registered queries\n")
    print("Generated by `python tools/plan_report.py` with `autoBroadcastJoinThreshold=-1` (the")
    print("plan a large input gets; AQE may still switch a join to broadcast from runtime sizes).")
    print("Columns: hash / range = shuffles by key or range; single = one-row-per-task merge of a")
    print("global aggregate; smj / bhj = join strategy; expand = row-multiplying Expand nodes;")
    print("python = Python evaluation nodes; pushed = scans with pushed-down filters.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---:" for _ in cols) + " |")
    for key, s in rows:
        print(f"| {key} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
