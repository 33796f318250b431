"""Aggregations (A1-A5, V1, V2).

Every aggregate here is decomposable (count, exact decimal sum, min, max,
count distinct), so Spark runs a map-side partial aggregate before the
shuffle: a key that holds a third of all rows is reduced to one row per
task before it moves.  Money sums go through fixed-point decimals so the
result does not depend on how rows are partitioned.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import expressions as X


def transactions_per_user(df: DataFrame) -> DataFrame:
    """A1: per user counts, money totals, last date, distinct merchants."""
    return df.groupBy("user_id").agg(
        F.count("transaction_id").alias("total_transactions"),
        X.money_sum("amount").alias("total_amount"),
        X.money_avg("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
        F.max("transaction_date").alias("last_transaction_date"),
        F.countDistinct("merchant").alias("unique_merchants"),
    )


def logs_per_source(df: DataFrame, ordered: bool = True) -> DataFrame:
    """A2: log_count per (source, level, log_date); O1 ordering."""
    out = df.groupBy("source", "level", "log_date").agg(F.count("log_id").alias("log_count"))
    return out.orderBy("log_date", "source", "level") if ordered else out


def aggregate_data(df: DataFrame, dataset_type: str = "transactions") -> DataFrame:
    """A1 / A2 by type; any other type passes through unchanged (A3)."""
    if dataset_type == "transactions":
        return transactions_per_user(df)
    if dataset_type == "logs":
        return logs_per_source(df)
    return df


USER_GROUP = ("user_id", "name", "email", "age", "age_group", "country", "registration_date")


def user_analytics(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """V1: users LEFT JOIN transactions ON user_id, grouped by the user columns.

    Same result as the literal ``LEFT JOIN ... GROUP BY`` but planned so that
    no key can skew it:

    * transactions are reduced to one row per user first (partial aggregation
      absorbs hot users; the distinct count is split by (user, transaction));
    * user rows are collapsed per group first, remembering how many copies
      there were (``copies``);
    * the join is then one-to-one-ish on user_id.  A SUM over the literal
      join counts every transaction once per user copy, so the total is
      multiplied by ``copies``; COUNT DISTINCT, AVG and MAX are unaffected.

    Both join sides grow with the data, so nothing is broadcast by hand: the
    planner's size check (and AQE at runtime) may still pick a broadcast when
    a side turns out small.
    """
    per_user = transactions.groupBy("user_id").agg(F.countDistinct("transaction_id").alias("distinct_ids"), *_user_sums())
    return _analytics(user_groups(users), per_user)


def user_groups(users: DataFrame) -> DataFrame:
    """Users per group of V1, with the number of equal rows."""
    return users.groupBy(*USER_GROUP).agg(F.count(F.lit(1)).alias("copies"))


def _user_sums() -> list[Column]:
    return [*X.money_state("amount"), F.max(F.col("transaction_date").cast("date")).alias("last")]


def user_sums(transactions: DataFrame) -> DataFrame:
    """Mergeable part of V1 per user, but for the distinct ids (0 here: they are counted over all parts)."""
    return transactions.groupBy("user_id").agg(F.lit(0).cast("bigint").alias("distinct_ids"), *_user_sums())


def user_analytics_of(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """V1 from parts: ``user_groups`` and ``user_sums`` of any number of inputs, each united."""
    users = groups.groupBy(*USER_GROUP).agg(F.sum("copies").alias("copies"))
    per_user = parts.groupBy("user_id").agg(F.sum("distinct_ids").alias("distinct_ids"), *X.merged_money(), F.max("last").alias("last"))
    return _analytics(users, per_user)


def _analytics(groups: DataFrame, per_user: DataFrame) -> DataFrame:
    joined = groups.join(per_user, "user_id", "left")
    return joined.select(
        "user_id",
        "name",
        "email",
        "age",
        "age_group",
        "country",
        F.coalesce("distinct_ids", F.lit(0)).cast("bigint").alias("total_transactions"),
        F.coalesce(X.money_total(F.col("copies")), F.lit(0.0)).alias("total_spent"),
        F.coalesce(F.try_divide(X.money_total(), F.col("amounts")), F.lit(0.0)).alias("avg_transaction_amount"),
        F.coalesce(F.col("last"), F.col("registration_date").cast("date")).alias("last_transaction_date"),
    )


SUMMARY_GROUP = ("transaction_year", "transaction_month", "category", "status")


def summary_state(df: DataFrame) -> DataFrame:
    """Mergeable part of V2."""
    return df.groupBy(*SUMMARY_GROUP).agg(
        F.count(F.lit(1)).alias("n"), *X.money_state("amount"), F.min("amount").alias("low"), F.max("amount").alias("high")
    )


def transaction_summary_of(parts: DataFrame) -> DataFrame:
    """V2 from ``summary_state`` of any number of inputs, united."""
    merged = parts.groupBy(*SUMMARY_GROUP).agg(F.sum("n").alias("n"), *X.merged_money(), F.min("low").alias("low"), F.max("high").alias("high"))
    total = X.money_total()
    return merged.select(
        *SUMMARY_GROUP, F.col("n").alias("transaction_count"), total.alias("total_amount"), F.try_divide(total, F.col("amounts")).alias("avg_amount"),
        F.col("low").alias("min_amount"), F.col("high").alias("max_amount"),
    )


def transaction_summary(df: DataFrame, ordered: bool = True) -> DataFrame:
    """V2: by year, month, category, status; O2 newest first."""
    out = df.groupBy("transaction_year", "transaction_month", "category", "status").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        X.money_sum("amount").alias("total_amount"),
        X.money_avg("amount").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )
    return out.orderBy(F.desc("transaction_year"), F.desc("transaction_month")) if ordered else out


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A4: (table_name, row_count) for each table, as one union of counts."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def freshness(df: DataFrame, column: str, as_of: dt.datetime | str | None, dataset: str) -> DataFrame:
    """A5: minutes between ``as_of`` (default now) and the newest ``column``.

    Both ends are wall-clock (no time zone) values, so the difference does
    not depend on the session time zone or its daylight-saving shifts.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else X.timestamp_literal(as_of)
    newest = F.max(F.col(column)).cast("timestamp_ntz")
    minutes = F.timestamp_diff("SECOND", newest, now) / F.lit(60.0)
    return df.agg(minutes.alias("minutes")).select(F.lit(dataset).alias("dataset"), "minutes")
