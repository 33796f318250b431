"""What the vector searches (operators 11 and 13) share: integer vectors, best lists and a grid of blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import materialise

SCALE = 256  # a component x counts as floor(SCALE * x)
LARGEST = 2.0**62  # beyond it a scaled component is no 64-bit integer: the row takes no part
SLACK = 1e-9  # of the product of two lengths: more than rounding can move a bound
EXACT = 2.0**53  # sums of products below it are exact in doubles


def integers(x, dim: int) -> np.ndarray | None:
    """The scaled components, zeros up to ``dim``; None if the vector takes no part."""
    if x is None:
        return None
    scaled = np.floor(np.asarray(x, np.float64) * SCALE)
    if not (np.abs(scaled) < LARGEST).all():  # false for NaN too
        return None
    out = np.zeros(dim, np.int64)
    out[: len(scaled)] = scaled
    return out


def _prepare(dim: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [integers(x, dim) for x in pdf.pop("embedding")]
            there = np.array([v is not None for v in made], bool)
            pdf = pdf[there].copy()
            made = [v for v in made if v is not None]
            pdf["v"] = [v.tobytes() for v in made]
            pdf["norm"] = [float(np.sqrt((v.astype(np.float64) ** 2).sum())) for v in made]
            yield pdf

    return run


def prepared(embeddings: DataFrame, label: Column | None = None) -> tuple[DataFrame, int]:
    """(rid, id, no_id, label, v, norm) of the rows that take part, written once, and the common length.

    ``rid`` names the row (ids may repeat); a null vec_id has ``no_id`` and
    counts as larger than any; ``label`` is 0 unless given, and rows whose
    label is null take no part.  Shorter vectors count as filled up with zeros.
    """
    dim = embeddings.agg(F.max(F.size("embedding"))).first()[0] or 0
    dim = max(int(dim), 1)
    rows = embeddings.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.col("vec_id").isNull().alias("no_id"),
        (F.lit(0) if label is None else label).cast("long").alias("label"), "embedding",
    ).where("label is not null and embedding is not null")
    made = rows.mapInPandas(_prepare(dim), "id long, no_id boolean, label long, v binary, norm double")
    # the row's name is fixed by writing it: a recomputed task could number its rows anew
    return materialise(made.withColumn("rid", F.monotonically_increasing_id()), "vectors"), dim


def matrix(vectors: Sequence[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.int64).reshape(-1, dim)


def pair_scores(a: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray, most: int = 1 << 16) -> np.ndarray:
    """Exact inner products of the pairs (a[i], c[j]), some pairs at a time."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), most):
        part = slice(at, at + most)
        out[part] = np.einsum("ij,ij->i", a[i[part]], c[j[part]])
    return out


def block_scores(a: np.ndarray, c: np.ndarray, a_norm: np.ndarray, c_norm: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two blocks (doubles, where they hold them exactly)."""
    if len(a) and len(c) and a_norm.max() * c_norm.max() < EXACT / 4:
        return (a.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return a @ c.T


class Best:
    """The k best (score, candidate) of each row; ``floor``: what a score must reach to come in."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.astype(np.float64)
        self.row, self.score, self.at = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, row: np.ndarray, score: np.ndarray, at: np.ndarray) -> None:
        """``at``: candidates, numbered in the order that breaks ties."""
        row, score, at = (np.concatenate(x) for x in ((self.row, row), (self.score, score), (self.at, at)))
        order = np.lexsort((at, -score, row))
        row, score, at = row[order], score[order], at[order]
        start = np.r_[0, np.flatnonzero(np.diff(row)) + 1] if len(row) else np.zeros(0, np.int64)
        rank = np.arange(len(row)) - np.repeat(start, np.diff(np.r_[start, len(row)]))
        full = rank == self.k - 1
        self.floor[row[full]] = np.maximum(self.floor[row[full]], score[full])
        self.row, self.score, self.at = (x[rank < self.k] for x in (row, score, at))


def steps(n: int, first: int = 64, most: int = 2048) -> Iterator[slice]:
    """0..n in growing steps: a few rows set the floors before many are compared."""
    at, size = 0, first
    while at < n:
        yield slice(at, min(n, at + size))
        at, size = at + size, min(most, 2 * size)


def ranked(found: DataFrame, key: Sequence[str], k: int, rank: str = "rank") -> DataFrame:
    """The k best rows of each key: score downwards, then id (nulls last), then the row's name."""
    from pyspark.sql import Window

    order = Window.partitionBy(*key).orderBy(F.desc("score"), "no_id", "id", "rid")
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def whole_id() -> Column:
    return F.when(~F.col("no_id"), F.col("id"))
