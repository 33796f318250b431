"""Star-schema models (E10) built from PROCESSED tables, and their
materialisation (T7).

The original models read two literal rows each; here they read the
processed users and transactions, which is what those literals stand for.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions.expressions import processed_timestamp


def dim_users(users_processed: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """dim_users: user_id, name, email, age_group, loaded_at."""
    return users_processed.select(
        "user_id", "name", "email", "age_group", processed_timestamp(as_of).alias("loaded_at")
    )


def fact_transactions(transactions_processed: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    """fact_transactions: transaction_id, user_id, amount, currency, transaction_date, loaded_at."""
    return transactions_processed.select(
        "transaction_id",
        "user_id",
        "amount",
        "currency",
        F.col("transaction_date"),
        processed_timestamp(as_of).alias("loaded_at"),
    )
