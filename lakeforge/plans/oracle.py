"""DuckDB SQL for the cross-check of every registered query.

Each entry is plain SQL over the driver's tables (registered as views), with
the adapters of ``lakeforge.sources.testdata`` written as CTEs.  Conventions
that keep both engines bit-identical:

* money sums: ``CAST(sum(CAST(x AS DECIMAL(38,10))) AS DOUBLE)``, averages =
  that sum / count;
* integer-valued date parts cast to INTEGER (Spark's width);
* double literals written as ``0.92::DOUBLE``.
"""

from __future__ import annotations

from lakeforge.functions import fixed
from lakeforge.sources.testdata import DEFAULT_INGEST_TS, EXTRACT_COPIES

AS_OF = "2024-02-01 00:00:00"

EMAIL_RE = fixed.EMAIL_PATTERN
DOMAIN_RE = fixed.EMAIL_DOMAIN_PATTERN


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


USERS_RAW = f"""
  users_base AS (
    SELECT c_custkey AS user_id, concat(' ', c_name, ' ') AS name,
      CASE WHEN c_custkey % 11 = 0 THEN NULL
           WHEN c_custkey % 11 = 1 THEN 'not-an-email'
           WHEN c_custkey % 11 = 2 THEN concat(' u', CAST(c_custkey AS VARCHAR), '@x.com')
           WHEN c_custkey % 11 = 3 THEN concat('Admin.', CAST(c_custkey AS VARCHAR), '@Example.ORG')
           ELSE concat('User.', CAST(c_custkey AS VARCHAR), '@', c_mktsegment, '.com') END AS email,
      CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 131 AS INTEGER) - 5 END AS age,
      n_name AS country,
      make_date(2020, CAST(c_custkey % 12 + 1 AS INTEGER), CAST(c_custkey % 28 + 1 AS INTEGER)) AS registration_date,
      TIMESTAMP '{DEFAULT_INGEST_TS}' AS _ingestion_timestamp, 'customer' AS _source
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
  users_raw AS ({" UNION ALL ".join(["SELECT * FROM users_base"] * EXTRACT_COPIES)})"""

TRANSACTIONS_RAW = f"""
  transactions_raw AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_custkey AS user_id,
      CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 13 = 1 THEN -1.0::DOUBLE
           ELSE CAST(floor(o_totalprice / 5) AS DOUBLE) / 100.0::DOUBLE END AS amount,
      CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' WHEN 2 THEN 'EUR' WHEN 3 THEN 'XOF' END AS currency,
      o_orderdate AS transaction_date,
      concat('merchant_', CAST(o_orderkey % 20 AS VARCHAR)) AS merchant,
      o_orderpriority AS category,
      CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'pending'
           WHEN o_orderkey % 2 = 0 THEN 'failed' ELSE 'refunded' END AS status,
      TIMESTAMP '{DEFAULT_INGEST_TS}' AS _ingestion_timestamp, 'orders' AS _source
    FROM orders)"""

LOGS_RAW = f"""
  logs_raw AS (
    SELECT event_id AS log_id, ts AS "timestamp",
      CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'click' THEN 'INFO'
                      WHEN 'view' THEN 'DEBUG' ELSE 'TRACE' END AS level,
      concat('svc_', CAST(user_id % 6 AS VARCHAR)) AS source,
      TIMESTAMP '{DEFAULT_INGEST_TS}' AS _ingestion_timestamp, 'events' AS _source
    FROM events)"""

STREAM_TX = """
  stream_tx AS (
    SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id,
      value AS amount, CASE WHEN event_id % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
      ts AS "timestamp", concat('merchant_', CAST(user_id % 20 AS VARCHAR)) AS merchant,
      CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status
    FROM events)"""

USERS_RULE_SQL = [
    "email IS NOT NULL",
    f"regexp_matches(email, '{EMAIL_RE}')",
    f"age BETWEEN {fixed.AGE_MIN} AND {fixed.AGE_MAX}",
]
TX_RULE_SQL = [
    "amount IS NOT NULL",
    "amount > 0",
    "transaction_id IS NOT NULL",
    f"status IN ({_in(fixed.VALID_STATUSES)})",
]
LOGS_RULE_SQL = ['"timestamp" IS NOT NULL', f"level IN ({_in(fixed.VALID_LEVELS)})"]
RULE_NAMES = {
    "users": ["email_not_null", "email_format", "age_range"],
    "transactions": ["amount_not_null", "amount_positive", "transaction_id_not_null", "status_valid"],
    "logs": ["timestamp_not_null", "level_valid"],
}
RULE_SQL = {"users": USERS_RULE_SQL, "transactions": TX_RULE_SQL, "logs": LOGS_RULE_SQL}
RAW_CTE = {"users": USERS_RAW, "transactions": TRANSACTIONS_RAW, "logs": LOGS_RAW}

USERS_CLEAN = f"""
  users_clean AS (
    SELECT user_id, trim(name) AS name, lower(trim(email)) AS email, age, country, registration_date
    FROM (SELECT DISTINCT * FROM users_raw)
    WHERE {' AND '.join(USERS_RULE_SQL)})"""

TX_CLEAN = f"""
  transactions_clean AS (
    SELECT transaction_id, user_id, amount, currency, transaction_date, merchant, category, status
    FROM (SELECT DISTINCT * FROM transactions_raw)
    WHERE {' AND '.join(TX_RULE_SQL)})"""

LOGS_CLEAN = f"""
  logs_clean AS (
    SELECT log_id, "timestamp", level, source
    FROM (SELECT DISTINCT * FROM logs_raw)
    WHERE {' AND '.join(LOGS_RULE_SQL)})"""

USERS_PROCESSED = f"""
  users_processed AS (
    SELECT *,
      CASE WHEN age < 25 THEN 'young' WHEN age < 50 THEN 'adult' ELSE 'senior' END AS age_group,
      regexp_extract(email, '{DOMAIN_RE}', 1) AS email_domain
    FROM users_clean)"""

TX_PROCESSED = """
  transactions_processed AS (
    SELECT transaction_id, user_id, amount, currency, CAST(transaction_date AS DATE) AS transaction_date,
      merchant, category, status,
      CASE WHEN currency = 'USD' THEN amount * 0.92::DOUBLE
           WHEN currency = 'GBP' THEN amount * 1.17::DOUBLE ELSE amount END AS amount_eur,
      CASE WHEN amount < 50 THEN 'small' WHEN amount < 500 THEN 'medium' ELSE 'large' END AS amount_category,
      CAST(year(transaction_date) AS INTEGER) AS transaction_year,
      CAST(month(transaction_date) AS INTEGER) AS transaction_month,
      CAST(day(transaction_date) AS INTEGER) AS transaction_day
    FROM transactions_clean)"""

LOGS_PROCESSED = """
  logs_processed AS (
    SELECT *, CAST("timestamp" AS DATE) AS log_date, CAST(hour("timestamp") AS INTEGER) AS log_hour,
      CASE WHEN level = 'ERROR' THEN 3 WHEN level = 'WARNING' THEN 2 ELSE 1 END AS severity_level
    FROM logs_clean)"""

USERS_CHAIN = [USERS_RAW, USERS_CLEAN, USERS_PROCESSED]
TX_CHAIN = [TRANSACTIONS_RAW, TX_CLEAN, TX_PROCESSED]
LOGS_CHAIN = [LOGS_RAW, LOGS_CLEAN, LOGS_PROCESSED]


def with_ctes(ctes, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def money_sum(col: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({col} AS DECIMAL(38,10))) AS DOUBLE)"


def money_avg(col: str, scale: int = 2) -> str:
    return f"{money_sum(col, scale)} / count({col})"


def _rejects(dataset: str) -> str:
    preds = [f"coalesce({p}, false)" for p in RULE_SQL[dataset]]
    parts = [f"SELECT '{dataset}' AS dataset, 0 AS step, 'duplicates' AS rule, "
             f"CAST(sum(_copies) - count(*) AS BIGINT) AS rejected FROM {dataset}_d"]
    for i, name in enumerate(RULE_NAMES[dataset]):
        before = " AND ".join(preds[:i]) or "true"
        parts.append(
            f"SELECT '{dataset}', {i + 1}, '{name}', "
            f"CAST(count(*) FILTER (WHERE {before} AND NOT {preds[i]}) AS BIGINT) FROM {dataset}_d"
        )
    return "\nUNION ALL\n".join(parts)


def _distinct_with_copies(dataset: str) -> str:
    return f"\n  {dataset}_d AS (SELECT *, count(*) AS _copies FROM {dataset}_raw GROUP BY ALL)"


def _clean_report(dataset: str) -> str:
    ok = " AND ".join(f"coalesce({p}, false)" for p in RULE_SQL[dataset])
    return (
        f"SELECT '{dataset}' AS dataset, CAST(sum(_copies) AS BIGINT) AS initial_count, "
        f"CAST(sum(_copies) - count(*) AS BIGINT) AS duplicates_removed, "
        f"CAST(count(*) FILTER (WHERE {ok}) AS BIGINT) AS final_count FROM {dataset}_d"
    )


DATASETS = ("users", "transactions", "logs")


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_generic"] = with_ctes(
        [USERS_RAW],
        "SELECT user_id, name, email, age, country, registration_date FROM (SELECT DISTINCT * FROM users_raw)",
    )
    q["clean_users"] = with_ctes([USERS_RAW, USERS_CLEAN], "SELECT * FROM users_clean")
    q["clean_transactions"] = with_ctes([TRANSACTIONS_RAW, TX_CLEAN], "SELECT * FROM transactions_clean")
    q["clean_logs"] = with_ctes([LOGS_RAW, LOGS_CLEAN], "SELECT * FROM logs_clean")
    all_raw = [RAW_CTE[d] for d in DATASETS] + [_distinct_with_copies(d) for d in DATASETS]
    q["clean_report"] = with_ctes(all_raw, "\nUNION ALL\n".join(_clean_report(d) for d in DATASETS))
    q["rejects_by_rule"] = with_ctes(all_raw, "\nUNION ALL\n".join(_rejects(d) for d in DATASETS))
    q["enrich_users"] = with_ctes(USERS_CHAIN, "SELECT * FROM users_processed")
    q["enrich_transactions"] = with_ctes(TX_CHAIN, "SELECT * FROM transactions_processed")
    q["enrich_logs"] = with_ctes(LOGS_CHAIN, "SELECT * FROM logs_processed")
    q["agg_transactions"] = with_ctes(
        TX_CHAIN,
        f"""SELECT user_id, count(transaction_id) AS total_transactions,
          {money_sum('amount')} AS total_amount, {money_avg('amount')} AS avg_amount,
          max(amount) AS max_amount, min(amount) AS min_amount,
          max(transaction_date) AS last_transaction_date, count(DISTINCT merchant) AS unique_merchants
        FROM transactions_processed GROUP BY user_id""",
    )
    q["agg_logs"] = with_ctes(
        LOGS_CHAIN,
        """SELECT source, level, log_date, count(log_id) AS log_count
        FROM logs_processed GROUP BY source, level, log_date ORDER BY log_date, source, level""",
    )
    q["user_analytics"] = with_ctes(
        USERS_CHAIN + TX_CHAIN,
        f"""SELECT u.user_id, u.name, u.email, u.age, u.age_group, u.country,
          count(DISTINCT t.transaction_id) AS total_transactions,
          coalesce({money_sum('t.amount')}, 0.0::DOUBLE) AS total_spent,
          coalesce({money_avg('t.amount')}, 0.0::DOUBLE) AS avg_transaction_amount,
          coalesce(max(t.transaction_date), u.registration_date) AS last_transaction_date
        FROM users_processed u LEFT JOIN transactions_processed t ON u.user_id = t.user_id
        GROUP BY u.user_id, u.name, u.email, u.age, u.age_group, u.country, u.registration_date""",
    )
    q["transaction_summary"] = with_ctes(
        TX_CHAIN,
        f"""SELECT transaction_year, transaction_month, category, status,
          count(*) AS transaction_count, {money_sum('amount')} AS total_amount,
          {money_avg('amount')} AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount
        FROM transactions_processed
        GROUP BY transaction_year, transaction_month, category, status
        ORDER BY transaction_year DESC, transaction_month DESC""",
    )
    models = USERS_CHAIN + TX_CHAIN + [DIM_USERS, FACT_TX]
    q["dim_users"] = with_ctes(models, "SELECT * FROM dim_users")
    q["fact_transactions"] = with_ctes(models, "SELECT * FROM fact_transactions")
    tests = {
        "unique": _unique_tests(),
        "not_null": _not_null_tests(),
        "relationships": _relationship_tests(),
    }
    q["dq_unique"] = with_ctes(models, tests["unique"])
    q["dq_not_null"] = with_ctes(models, tests["not_null"])
    q["dq_relationships"] = with_ctes(models, tests["relationships"])
    q["dq_summary"] = with_ctes(models, "\nUNION ALL\n".join(tests.values()))
    q["dq_alerts"] = "WITH " + LOGS_RAW + ",\n" + _error_rate_alert()
    q["dq_test_alert"] = with_ctes(
        models,
        "SELECT 'DataTestFailure' AS alert, CAST(count(*) FILTER (WHERE NOT passed) AS BIGINT) AS failing_tests, "
        "count(*) FILTER (WHERE NOT passed) > 0 AS firing FROM (" + "\nUNION ALL\n".join(tests.values()) + ")",
    )
    q["clean_observed"] = with_ctes(
        [USERS_RAW, USERS_CLEAN],
        "SELECT 'users' AS dataset, (SELECT count(*) FROM users_raw) AS initial_count, "
        "(SELECT count(*) FROM (SELECT DISTINCT * FROM users_raw)) AS distinct_count, "
        "(SELECT count(*) FROM users_clean) AS final_count",
    )
    q["row_counts"] = with_ctes(
        USERS_CHAIN + TX_CHAIN + LOGS_CHAIN,
        """SELECT 'users' AS table_name, count(*) AS row_count FROM users_processed
        UNION ALL SELECT 'transactions', count(*) FROM transactions_processed
        UNION ALL SELECT 'logs', count(*) FROM logs_processed""",
    )
    q["freshness"] = with_ctes(
        TX_CHAIN,
        f"""SELECT 'transactions' AS dataset,
          (epoch(TIMESTAMP '{AS_OF}') - epoch(CAST(max(transaction_date) AS TIMESTAMP))) / 60.0::DOUBLE AS minutes
        FROM transactions_processed""",
    )
    q["limit_sample"] = with_ctes(models, "SELECT * FROM dim_users ORDER BY user_id LIMIT 10")
    q["union_sources"] = with_ctes(
        models + [STREAM_TX],
        """SELECT transaction_id, CAST(user_id AS VARCHAR) AS user_id, amount, currency, transaction_date,
          'batch' AS origin FROM fact_transactions
        UNION ALL
        SELECT transaction_id, user_id, amount, currency, CAST("timestamp" AS DATE), 'stream' FROM stream_tx""",
    )
    q["union_by_name"] = with_ctes(
        [TRANSACTIONS_RAW, STREAM_TX],
        """SELECT * EXCLUDE (_ingestion_timestamp, _source) FROM transactions_raw
        UNION ALL BY NAME
        SELECT * REPLACE (CAST(user_id AS BIGINT) AS user_id) FROM stream_tx""",
    )
    q["json_envelope"] = with_ctes([STREAM_TX, STREAM_PARSED], "SELECT * FROM stream_parsed")
    q["merchant_minute"] = with_ctes(
        [STREAM_TX, STREAM_PARSED],
        """SELECT time_bucket(INTERVAL '1 minute', "timestamp") AS window_start,
          time_bucket(INTERVAL '1 minute', "timestamp") + INTERVAL '1 minute' AS window_end,
          merchant, count(transaction_id) AS transaction_count, avg(amount) AS avg_amount
        FROM stream_parsed WHERE status = 'completed' GROUP BY ALL""",
    )
    q["raw_roundtrip"] = with_ctes(
        [USERS_RAW, USERS_CLEAN], "SELECT * FROM users_clean UNION ALL SELECT * FROM users_clean"
    )
    q["raw_roundtrip_keyed"] = with_ctes([USERS_RAW, USERS_CLEAN], "SELECT * FROM users_clean")
    d1, d2 = "year=2024/month=02/day=01", "year=2024/month=02/day=02"
    t1, t2 = "TIMESTAMP '2024-02-01 00:00:00'", "TIMESTAMP '2024-02-02 00:00:00'"
    q["ingest_report"] = with_ctes(
        [USERS_RAW, TRANSACTIONS_RAW, LOGS_RAW],
        f"""SELECT 'users' AS dataset_name, 'customer' AS source_type, '{d1}' AS "partition", 1::BIGINT AS ingests,
          count(*)::BIGINT AS "rows", 8::BIGINT AS n_columns, true AS stamped, {t1} AS first_ingest, {t1} AS last_ingest FROM users_raw
        UNION ALL SELECT 'users', 'customer', '{d2}', 1, count(*), 8, true, {t2}, {t2} FROM users_raw
        UNION ALL SELECT 'transactions', 'orders', '{d1}', 1, count(*), 10, true, {t1}, {t1} FROM transactions_raw
        UNION ALL SELECT 'logs', 'events', '{d1}', 1, count(*), 6, true, {t1}, {t1} FROM logs_raw""",
    )
    q["completeness"] = with_ctes(
        [USERS_RAW, TRANSACTIONS_RAW, LOGS_RAW],
        """SELECT 'users' AS dataset, count(*) > 0 AS present FROM users_raw
        UNION ALL SELECT 'transactions', count(*) > 0 FROM transactions_raw
        UNION ALL SELECT 'logs', count(*) > 0 FROM logs_raw
        UNION ALL SELECT 'weather_api', false""",
    )
    q["warehouse_table_info"] = with_ctes(
        USERS_CHAIN + TX_CHAIN + LOGS_CHAIN,
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, count(*) >= 0 AS has_bytes, true AS size_fits FROM {source}"
            for t, source in (("users", "users_processed"), ("transactions", "transactions_processed"), ("logs", "logs_processed"),
                              ("user_analytics", "users_processed"), ("transaction_summary", "transactions_processed"),
                              ("dim_users", "users_processed"), ("fact_transactions", "transactions_processed"))
        ),
    )
    q["warehouse_user_analytics"] = q["user_analytics"]
    q["warehouse_transaction_summary"] = q["transaction_summary"]
    q["warehouse_dq_summary"] = q["dq_summary"]
    q["merchant_minute_stream"] = q["merchant_minute"]
    q["merchant_minute_updates"] = q["merchant_minute"]
    q["merchant_minute_watermarked"] = with_ctes(
        [STREAM_TX, STREAM_PARSED],
        """SELECT * FROM (
          SELECT time_bucket(INTERVAL '1 minute', "timestamp") AS window_start,
            time_bucket(INTERVAL '1 minute', "timestamp") + INTERVAL '1 minute' AS window_end,
            merchant, count(transaction_id) AS transaction_count, avg(amount) AS avg_amount
          FROM stream_parsed WHERE status = 'completed' GROUP BY ALL) w
        WHERE window_end <= (SELECT max("timestamp") FROM stream_parsed WHERE status = 'completed')
          - INTERVAL '10 minutes'""",
    )
    q["raw_ingest"] = with_ctes([TRANSACTIONS_RAW], "SELECT * FROM transactions_raw")
    q["file_batch_csv"] = "SELECT * FROM events"
    q["api_landing"] = "SELECT *, 'https://example.invalid/events' AS _source_url FROM events"
    q["document_extract"] = "SELECT *, CAST(event_id AS VARCHAR) AS _id FROM events"
    q["document_find"] = "SELECT *, lpad(lower(to_hex(event_id)), 24, '0') AS _id FROM events WHERE event_type = 'error'"
    q["wide_column_extract"] = "SELECT CAST(event_id AS VARCHAR) AS id, ts, value FROM events"
    users_as_text = """
  users_text AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, name, email, CASE WHEN user_id % 19 = 3 THEN NULL ELSE age END AS age,
    country, CAST(registration_date AS VARCHAR) AS registration_date FROM users_raw)"""
    q["clean_users_text"] = with_ctes(
        [USERS_RAW, users_as_text],
        f"""SELECT user_id, trim(name) AS name, lower(trim(email)) AS email, age, country, registration_date
        FROM users_text WHERE {' AND '.join(USERS_RULE_SQL)}""",
    )
    tx_as_text = f"""
  transactions_text AS (SELECT * FROM (
    SELECT transaction_id, CAST(user_id AS VARCHAR) AS user_id,
      CASE WHEN CAST(transaction_id AS BIGINT) % 97 = 5 THEN NULL ELSE amount END AS amount, currency,
      CAST(CAST(transaction_date AS DATE) AS VARCHAR) AS transaction_date, merchant, category, status
    FROM (SELECT DISTINCT * FROM transactions_raw)) WHERE {' AND '.join(TX_RULE_SQL)})"""
    q["clean_transactions_text"] = with_ctes([TRANSACTIONS_RAW, tx_as_text], "SELECT * FROM transactions_text")
    q["agg_transactions_text"] = with_ctes(
        [TRANSACTIONS_RAW, tx_as_text],
        f"""SELECT user_id, count(transaction_id) AS total_transactions,
          {money_sum('amount')} AS total_amount, {money_avg('amount')} AS avg_amount,
          max(amount) AS max_amount, min(amount) AS min_amount,
          max(CAST(transaction_date AS DATE)) AS last_transaction_date, count(DISTINCT merchant) AS unique_merchants
        FROM transactions_text GROUP BY user_id""",
    )
    # plain sums of doubles, as the original has them: no fixed point on this side
    q["agg_raw_amounts"] = """
      SELECT user_id, count(*) AS total_transactions, round(fsum(amount), 5) AS total_amount, round(fsum(amount) / count(amount), 5) AS avg_amount
      FROM (SELECT o_custkey AS user_id, CASE WHEN o_orderkey % 997 = 3 THEN 'NaN'::DOUBLE ELSE o_totalprice * 0.31830988618379067::DOUBLE END AS amount FROM orders)
      GROUP BY user_id"""
    q["agg_passthrough"] = q["enrich_users"]
    q["raw_one_day"] = with_ctes(
        [USERS_RAW], f"SELECT * REPLACE ({t2} AS _ingestion_timestamp) FROM users_raw"
    )
    q["processed_table"] = q["enrich_transactions"]
    q["kafka_pull"] = with_ctes([STREAM_TX, STREAM_PARSED], "SELECT * EXCLUDE (kafka_timestamp) FROM stream_parsed")
    q["curated_replace_new_schema"] = q["clean_users"]
    q["curated_append_by_name"] = with_ctes(
        [TRANSACTIONS_RAW, TX_CLEAN], "SELECT * FROM transactions_clean UNION ALL SELECT * FROM transactions_clean"
    )
    q["view_refresh"] = with_ctes(
        [TRANSACTIONS_RAW, TX_CLEAN], "SELECT user_id, 2 * count(*) AS n, max(amount) AS top FROM transactions_clean GROUP BY user_id"
    )
    both = """
  both_raw AS (
    SELECT CAST(user_id AS VARCHAR) AS user_id, name, email, CASE WHEN user_id % 19 = 3 THEN NULL ELSE age END AS age, country,
      CAST(registration_date AS VARCHAR) AS registration_date, 1 AS day_no FROM users_raw
    UNION ALL SELECT CAST(user_id AS VARCHAR), name, email, age, country, CAST(registration_date AS VARCHAR), 2 FROM users_raw)"""
    q["raw_type_drift"] = with_ctes(
        [USERS_RAW, both],
        f"""SELECT user_id, trim(name) AS name, lower(trim(email)) AS email, age, country, registration_date
        FROM (SELECT DISTINCT * FROM both_raw) WHERE {' AND '.join(USERS_RULE_SQL)}""",
    )
    q["empty_replay"] = with_ctes(
        [USERS_RAW],
        f"""SELECT 'users' AS dataset_name, 'customer' AS source_type, '{d1}' AS "partition", 2::BIGINT AS ingests,
          count(*)::BIGINT AS "rows", 8::BIGINT AS n_columns, true AS stamped, {t1} AS first_ingest, {t1} AS last_ingest,
          count(*)::BIGINT AS rows_read FROM users_raw""",
    )
    q["incremental_equals_full"] = q["enrich_transactions"]
    q["incremental_retry"] = q["enrich_transactions"]
    q["merchant_minute_late"] = with_ctes(
        [STREAM_TX, STREAM_PARSED, """
  span AS (SELECT epoch_us(min(ts)) AS a, epoch_us(max(ts)) AS b FROM events),
  sent AS (SELECT p.*, CAST(floor((epoch_us(e.ts) - a) * 8 / (b - a + 1)::DOUBLE) AS INTEGER) + CASE WHEN e.event_id % 10 = 7 THEN 1 ELSE 0 END AS batch,
      time_bucket(INTERVAL '1 minute', p."timestamp") AS window_start
    FROM stream_parsed p JOIN events e ON p.transaction_id = CAST(e.event_id AS VARCHAR), span WHERE p.status = 'completed'),
  newest AS (SELECT batch, max(max("timestamp")) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) AS t FROM sent GROUP BY batch),
  marked AS (SELECT s.*, coalesce(window_start + INTERVAL '1 minute' <= n.t - INTERVAL '10 minutes', false) AS late FROM sent s LEFT JOIN newest n ON n.batch = s.batch - 1)"""],
        """SELECT 'window' AS kind, window_start, merchant, count(transaction_id) AS transaction_count, avg(amount) AS avg_amount, CAST(NULL AS VARCHAR) AS transaction_id
        FROM marked WHERE NOT late AND window_start + INTERVAL '1 minute' <= (SELECT max("timestamp") FROM marked WHERE NOT late) - INTERVAL '10 minutes' GROUP BY ALL
        UNION ALL SELECT 'late', window_start, merchant, NULL, NULL, transaction_id FROM marked WHERE late""",
    )
    q["dq_alerts_stream"] = "SELECT * FROM (" + q["dq_alerts"] + ") WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"
    q["kafka_pull_bounded"] = with_ctes(
        [STREAM_TX, STREAM_PARSED], "SELECT * EXCLUDE (kafka_timestamp) FROM stream_parsed WHERE CAST(transaction_id AS BIGINT) % 3 < 2"
    )
    q["view_refresh_incremental"] = q["transaction_summary"]
    q["view_refresh_incremental_users"] = q["user_analytics"]
    q["index_files_read"] = with_ctes(
        USERS_CHAIN + TX_CHAIN + LOGS_CHAIN,
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows_found, true AS under_half FROM {t}_processed WHERE {c} = "
            f"(SELECT arg_min({c}, k) FROM (SELECT {c}, CAST({key} AS BIGINT) AS k FROM {t}_processed) "
            f"WHERE k >= (SELECT (min(CAST({key} AS BIGINT)) + max(CAST({key} AS BIGINT))) // 2 FROM {t}_processed))"
            for t, key, columns in (("users", "user_id", ("country", "email", "user_id")),
                                    ("transactions", "transaction_id", ("category", "transaction_date", "user_id")),
                                    ("logs", "log_id", ("source", "level", "log_date")))
            for c in columns
        ),
    )
    analytics = q["user_analytics"].replace("SELECT u.user_id, u.name", "SELECT count(*) FROM (SELECT u.user_id, u.name") + ")"
    counted = [("users", "users_processed"), ("transactions", "transactions_processed"), ("logs", "logs_processed"),
               ("dim_users", "users_processed"), ("fact_transactions", "transactions_processed")]
    q["warehouse_table_files"] = with_ctes(
        USERS_CHAIN + TX_CHAIN + LOGS_CHAIN,
        "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, true AS bytes_as_listed FROM {source}" for t, source in counted)
        + f"\nUNION ALL SELECT 'user_analytics', ({analytics}), true"
        + "\nUNION ALL SELECT 'transaction_summary', count(*), true FROM (SELECT DISTINCT transaction_year, transaction_month, category, status FROM transactions_processed)",
    )
    q["curated_colocated"] = q["user_analytics"]
    q["curated_colocated_relationship"] = q["dq_relationships"]
    # unit k is shown while bytes, rounded half up to half units, stay below 20480 of them
    q["pretty_sizes"] = """
      SELECT o_orderkey, CASE WHEN b < 10240 THEN b || ' bytes'
        WHEN (b >> 9) < 20480 THEN (((b >> 9) + 1) >> 1) || ' kB'
        WHEN (b >> 19) < 20480 THEN (((b >> 19) + 1) >> 1) || ' MB'
        WHEN (b >> 29) < 20480 THEN (((b >> 29) + 1) >> 1) || ' GB'
        WHEN (b >> 39) < 20480 THEN (((b >> 39) + 1) >> 1) || ' TB'
        ELSE (((b >> 49) + 1) >> 1) || ' PB' END AS size
      FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * CAST(pow(8, o_orderkey % 13) AS BIGINT) AS b FROM orders)"""
    return q


DIM_USERS = f"""
  dim_users AS (
    SELECT user_id, name, email, age_group, TIMESTAMP '{AS_OF}' AS loaded_at FROM users_processed)"""

FACT_TX = f"""
  fact_transactions AS (
    SELECT transaction_id, user_id, amount, currency, transaction_date, TIMESTAMP '{AS_OF}' AS loaded_at
    FROM transactions_processed)"""

STREAM_PARSED = """
  stream_parsed AS (
    SELECT transaction_id, user_id, CAST(amount AS FLOAT) AS amount, currency,
      date_trunc('millisecond', "timestamp") AS "timestamp", merchant, status, "timestamp" AS kafka_timestamp
    FROM stream_tx)"""


def _test_row(test: str, model: str, column: str, failures_sql: str) -> str:
    return (f"SELECT '{test}' AS test_name, '{model}' AS model, '{column}' AS column_name, "
            f"CAST(({failures_sql}) AS BIGINT) AS failures, ({failures_sql}) = 0 AS passed")


def _unique_tests() -> str:
    rows = [
        _test_row("unique", m, c,
                  f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
        for m, c, t in fixed.MODEL_TESTS if t == "unique"
    ]
    return "\nUNION ALL\n".join(rows)


def _not_null_tests() -> str:
    rows = [
        _test_row("not_null", m, c, f"SELECT count(*) FROM {m} WHERE {c} IS NULL")
        for m, c, t in fixed.MODEL_TESTS if t == "not_null"
    ]
    return "\nUNION ALL\n".join(rows)


def _relationship_tests() -> str:
    pm, pc = fixed.RELATIONSHIP_TARGET
    rows = [
        _test_row("relationships", m, c,
                  f"SELECT count(*) FROM {m} ch WHERE ch.{c} IS NOT NULL "
                  f"AND NOT EXISTS (SELECT 1 FROM {pm} p WHERE p.{pc} = ch.{c})")
        for m, c, t in fixed.MODEL_TESTS if t == "relationships"
    ]
    return "\nUNION ALL\n".join(rows)


def _error_rate_alert() -> str:
    ok = " AND ".join(f"coalesce({p}, false)" for p in LOGS_RULE_SQL)
    hold = fixed.ERROR_RATE_HOLD_MINUTES
    return f"""errs AS (
      SELECT "timestamp" AS event_time FROM (SELECT DISTINCT * FROM logs_raw)
      WHERE NOT ({ok}) AND "timestamp" IS NOT NULL),
    buckets AS ({" UNION ALL ".join(
        f"SELECT date_trunc('minute', event_time) - INTERVAL '{k} minutes' AS window_start FROM errs"
        for k in range(5))}),
    rates AS (
      SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, count(*) AS errors,
        count(*) / {float(fixed.ERROR_RATE_RANGE_SECONDS)}::DOUBLE AS rate
      FROM buckets GROUP BY window_start),
    pend AS (SELECT *, rate > {fixed.ERROR_RATE_THRESHOLD}::DOUBLE AS pending FROM rates),
    held AS (
      SELECT window_end, count(*) AS n FROM ({" UNION ALL ".join(
        f"SELECT window_end + INTERVAL '{k} minutes' AS window_end FROM pend WHERE pending"
        for k in range(hold + 1))}) GROUP BY window_end HAVING count(*) = {hold + 1})
    SELECT 'HighDataValidationErrors' AS alert, p.window_start, p.window_end, p.errors, p.rate, p.pending,
      coalesce(h.n IS NOT NULL, false) AS firing
    FROM pend p LEFT JOIN held h ON p.window_end = h.window_end"""
