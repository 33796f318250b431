"""Operator 13: exact top-k search by inner product over norm-sorted vectors.

1. A rotation (right singular vectors of a bounded sample) moves what the vectors
   vary in to the leading places.  It only steers the pruning.
2. Vectors are dealt into blocks by descending length.  Each query first meets the
   longest vectors; its k-th score there is its floor, and floor / length is the
   reach: shorter vectors cannot score enough.  Queries are dealt into blocks by reach,
   and a query block meets only the blocks of vectors that some reach allows.
3. In a pair of blocks candidates go by descending length in growing steps, until
   the product of lengths is below every floor.  The rotated inner product is summed
   part by part; after each part the lengths of what remains bound the rest
   (Cauchy-Schwarz), and queries and candidates without a hopeful pair drop out.
   What is left is scored exactly, in integers, and raises the floors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import materialise
from lakeforge.llm.vectors import SLACK, Best, block_scores, matrix, pair_scores, prepared, ranked, steps, whole_id

K, EVERY = 5, 50  # results of a query; queries are the rows whose vec_id it divides
SAMPLE, HEAD = 16_384, 4_096  # rows that the rotation is fitted on; longest rows that set the first floors
QUERIES, ROWS = 2_048, 4_096  # of a block, about
LEVELS = 64  # of length, and of reach: what the driver holds, whatever the input


def basis_of(x: np.ndarray, dim: int) -> np.ndarray:
    """Orthonormal columns, those of most weight first."""
    if not len(x):
        return np.eye(dim)
    weight, vectors = np.linalg.eigh(x.T @ x)  # the right singular vectors of x
    return vectors[:, np.argsort(-weight, kind="stable")]


def _fit(dim: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted(v for pdf in batches for v in pdf["v"])
        x = matrix(rows, dim).astype(np.float64)
        size = np.abs(x).max() if len(x) else 0.0
        yield pd.DataFrame({"basis": [basis_of(x / size if size else x, dim).tobytes()]})

    return run


def rotation(rows: DataFrame, n: int, dim: int) -> np.ndarray:
    some = rows.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(n, 1)) * (1 << 30)))
    row = some.select("v").repartition(1).mapInPandas(_fit(dim), "basis binary").first()
    return np.frombuffer(row["basis"]).reshape(dim, dim) if row else np.eye(dim)


def _floors(head, dim: int, k: int) -> Callable:
    """Each query's k-th best score among the longest vectors, its own row left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rids, vs = head.value
        c = matrix(vs, dim)
        c_norm = np.sqrt((c.astype(np.float64) ** 2).sum(1))
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                p = pdf.iloc[at : at + 256].copy()
                s = block_scores(matrix(list(p["v"]), dim), c, p["norm"].to_numpy(), c_norm).astype(np.float64)
                s[p["rid"].to_numpy()[:, None] == rids[None, :]] = -np.inf
                floor = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(p), -np.inf)
                norm = p["norm"].to_numpy()
                p["floor"] = floor
                # a floor of 0 or less is in reach of any length
                p["reach"] = np.where((floor > 0) & (norm > 0), floor * (1 - SLACK) / np.maximum(norm, 1e-300), 0.0)
                yield p

    return run


def _search(dim: int, k: int, rotate) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf["side"].to_numpy()
        q = pdf[side == 0]
        c = pdf[side == 1].sort_values(["no_id", "id", "rid"])
        if not len(q) or not len(c):
            return _rows(q, c, Best(np.zeros(0), k))
        tie = np.arange(len(c))
        order = np.argsort(-c["norm"].to_numpy(), kind="stable")
        c, tie = c.iloc[order], tie[order]
        a, b = matrix(list(q["v"]), dim), matrix(list(c["v"]), dim)
        ra, rb = a @ rotate.value, b @ rotate.value
        a_norm, b_norm = q["norm"].to_numpy(), c["norm"].to_numpy()
        a_rid, b_rid = q["rid"].to_numpy(), c["rid"].to_numpy()
        parts = sorted({max(1, dim // 4), max(1, dim // 2), dim})
        # lengths of what is behind each part
        rest = [(np.sqrt((ra[:, h:] ** 2).sum(1)), np.sqrt((rb[:, h:] ** 2).sum(1))) for h in parts]
        best = Best(q["floor"].to_numpy(), k)
        back = np.empty(len(c), np.int64)
        back[tie] = np.arange(len(c))
        for step in steps(len(c)):
            live = np.flatnonzero(a_norm * b_norm[step].max() * (1 + SLACK) >= best.floor)
            if not len(live):
                break  # the remaining vectors are shorter still
            cols, done = np.arange(step.start, step.stop), 0
            part = np.zeros((len(live), len(cols)))
            for h, (ar, br) in zip(parts, rest):
                part += ra[live, done:h] @ rb[cols, done:h].T
                done = h
                slack = SLACK * np.outer(a_norm[live], b_norm[cols])
                hope = part + np.outer(ar[live], br[cols]) + slack >= best.floor[live][:, None]
                rows, some = hope.any(1), hope.any(0)
                if not rows.all() or not some.all():
                    live, cols, part, hope = live[rows], cols[some], part[np.ix_(rows, some)], hope[np.ix_(rows, some)]
                if not len(live):
                    break
            if not len(live):
                continue
            i, j = np.nonzero(hope)
            i, j = live[i], cols[j]
            other = a_rid[i] != b_rid[j]
            i, j = i[other], j[other]
            s = pair_scores(a, b, i, j)
            in_ = s >= best.floor[i]
            best.add(i[in_], s[in_], tie[j[in_]])
        best.at = back[best.at]
        return _rows(q, c, best)

    return run


def _rows(q: pd.DataFrame, c: pd.DataFrame, best: Best) -> pd.DataFrame:
    return pd.DataFrame({
        "query_rid": q["rid"].to_numpy()[best.row], "query_id": q["id"].to_numpy()[best.row], "score": best.score,
        "id": c["id"].to_numpy()[best.at], "no_id": c["no_id"].to_numpy()[best.at], "rid": c["rid"].to_numpy()[best.at],
    })


def _level(value: Column, cuts: list[float]) -> Column:
    """0 for values above every cut, one more for each cut that is not below."""
    return F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x >= value)) if cuts else F.lit(0)


def _levels(rows: DataFrame, col: str, ends: Column, n: int, size: int, sign: int) -> tuple[DataFrame, list[tuple[int, int, float]]]:
    """Rows with the block they are dealt to, and (first block, blocks, end) of each level, in order.

    Levels are quantile ranges of ``sign * col``, downwards, up to LEVELS; a level of many
    rows (a value may be held by a third of all) is dealt by hash into as many
    blocks as its rows need.
    """
    parts = min(LEVELS, -(-n // size))
    cuts = (rows.agg(F.percentile_approx(sign * F.col(col), [i / parts for i in range(1, parts)], 10_000)).first()[0] or []) if parts > 1 else []
    leveled = rows.withColumn("level", _level(sign * F.col(col), sorted(set(cuts), reverse=True)))
    counted = {r["level"]: r for r in leveled.groupBy("level").agg(F.count("*").alias("n"), ends.alias("end")).collect()}
    table, at = [], 0
    for level in range(max(counted, default=-1) + 1):
        r = counted.get(level)
        blocks = -(-r["n"] // size) if r else 0
        table.append((at, blocks, r["end"] if r else 0.0))
        at += blocks
    place = lambda i: F.element_at(F.array(*[F.lit(t[i]) for t in table]), F.col("level") + 1)
    if not table:
        return leveled.withColumn("block", F.lit(0)), table
    return leveled.withColumn("block", place(0) + F.pmod(F.xxhash64("rid"), F.greatest(place(1), F.lit(1))).cast("int")), table


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with other rows.

    Queries are the rows whose vec_id ``every`` divides; candidates are all rows
    but the query's own; ties go to the smaller vec_id, null ids last.  Components
    count as floor(256 x).  Vectors that are null or hold null or non-finite
    components take no part; shorter vectors count as filled up with zeros, so
    an empty one scores 0.  Repeated rows are rows of their own: a copy of the
    query's row is a candidate.  An empty table gives an empty result.
    """
    rows, dim = prepared(embeddings)
    n = rows.count()
    sc = rows.sparkSession.sparkContext
    rotate = sc.broadcast(rotation(rows, n, dim))
    longest = rows.orderBy(F.desc("norm"), "rid").limit(HEAD).select("rid", "v").collect()  # sets floors only; HEAD vectors whatever the input
    head = sc.broadcast((np.array([r["rid"] for r in longest], np.int64), [bytes(r["v"]) for r in longest]))
    queries = rows.where((F.col("id") % every == 0) & ~F.col("no_id")).select("rid", "id", "v", "norm")
    queries = materialise(queries.mapInPandas(_floors(head, dim, k), "rid long, id long, v binary, norm double, floor double, reach double"), "top_k_queries")
    queries, wanted = _levels(queries, "reach", F.min("reach"), queries.count(), QUERIES, -1)
    rows, there = _levels(rows.select("rid", "id", "no_id", "v", "norm"), "norm", F.max("norm"), n, ROWS, 1)
    # blocks of both sides are in order, so what meets is always a leading range
    meets = lambda reach, norm: reach <= norm * (1 + SLACK)
    upto_rows = [sum(b for _, b, norm in there if meets(reach, norm)) for _, _, reach in wanted] or [0]
    upto_queries = [sum(b for _, b, reach in wanted if meets(reach, norm)) for _, _, norm in there] or [0]
    of = lambda counts: F.element_at(F.array(*[F.lit(x) for x in counts]), F.col("level") + 1)
    spread = lambda counts: F.explode(F.when(of(counts) > 0, F.sequence(F.lit(0), of(counts) - 1)))
    left = queries.select(F.col("block").alias("qb"), spread(upto_rows).alias("cb"), F.lit(0).alias("side"), "rid", "id", F.lit(False).alias("no_id"), "v", "norm", "floor")
    right = rows.select(spread(upto_queries).alias("qb"), F.col("block").alias("cb"), F.lit(1).alias("side"), "rid", "id", "no_id", "v", "norm", F.lit(0.0).alias("floor"))
    found = left.unionByName(right).groupBy("qb", "cb").applyInPandas(
        _search(dim, k, rotate), "query_rid long, query_id long, score long, id long, no_id boolean, rid long"
    )
    return ranked(found, ["query_rid"], k).select("query_id", F.col("rank").cast("int").alias("rank"), whole_id().alias("vec_id"), "score")


ORACLE = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
           FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.r AS qr, q.vec_id AS query_id, c.r, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)]) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.r <> c.r)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST, r) AS k FROM s) WHERE k <= 5
"""
