"""Set operations (U1, U2) and limits (O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position (no shuffle, no de-dup)."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionAll(df)
    return out


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column missing from a frame is NULL."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def head(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """O3: first ``n`` rows; ordered by ``order_by`` for a deterministic pick.

    ``orderBy(...).limit(n)`` is planned as a per-partition top-n followed by
    a merge of n rows per partition, never a global sort.
    """
    if order_by:
        df = df.orderBy(*[F.col(c) for c in order_by])
    return df.limit(n)
