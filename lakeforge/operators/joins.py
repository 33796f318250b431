"""Joins (J1, J2).

J1 (users LEFT JOIN transactions) is planned inside
``aggregate.user_analytics``; this module holds the referential check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys with no parent, with the number of child rows for each.

    Both sides are reduced to distinct keys before the anti join (a hot
    child key becomes one row with its count), so the join moves one row per
    key, never a hot key's rows.  NULL child keys are not checked, matching
    the usual relationships test.
    """
    child_keys = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    parent_keys = parent.select(F.col(parent_key).alias("_key")).distinct()
    return child_keys.join(parent_keys, "_key", "left_anti").withColumnRenamed("_key", child_key)
