"""Enrichment (E1-E9): derived columns per dataset type.

Projections only: no shuffle, fused into the scan's codegen stage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import expressions as X


def _type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def enrich_users(df: DataFrame) -> DataFrame:
    """E1 age_group, E2 email_domain."""
    return df.withColumns({"age_group": X.age_group("age"), "email_domain": X.email_domain("email")})


def enrich_transactions(df: DataFrame, rates: Mapping[str, float] | None = None) -> DataFrame:
    """E3 amount_eur, E4 amount_category, E5 date parts (date replaces the column).

    One projection; the date parts are taken from the converted date, so a
    malformed date yields NULL parts rather than a parse error.
    """
    date = X.safe_to_date("transaction_date", _type_of(df, "transaction_date"))
    return df.withColumns(
        {
            "amount_eur": X.amount_eur("amount", "currency", rates),
            "amount_category": X.amount_category("amount"),
            "transaction_date": date,
            "transaction_year": F.year(date),
            "transaction_month": F.month(date),
            "transaction_day": F.dayofmonth(date),
        }
    )


def enrich_logs(df: DataFrame) -> DataFrame:
    """E6 log_date, log_hour; E7 severity_level."""
    ts = F.col("timestamp")
    if _type_of(df, "timestamp") == "string":
        ts = F.try_to_timestamp(ts)
    return df.withColumns(
        {"log_date": ts.cast("date"), "log_hour": F.hour(ts), "severity_level": X.severity_level("level")}
    )


def enrich_data(
    df: DataFrame,
    dataset_type: str = "generic",
    as_of: dt.datetime | str | None = None,
    rates: Mapping[str, float] | None = None,
) -> DataFrame:
    """Type-specific columns, then E8 ``_processed_timestamp`` for every type."""
    if dataset_type == "users":
        df = enrich_users(df)
    elif dataset_type == "transactions":
        df = enrich_transactions(df, rates)
    elif dataset_type == "logs":
        df = enrich_logs(df)
    return df.withColumn("_processed_timestamp", X.processed_timestamp(as_of))
