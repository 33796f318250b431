"""Operator 11: hard-negative mining with segment summaries.

Every vector is stored with summaries: cut into 1, 4, 16, ... segments, the mean
and the deviation of each.  Over a segment of length L the inner product of two
vectors lies within L (mean * mean' +- deviation * deviation'), so the sums over
segments bound the score from both sides.  Anchors and rows are dealt into blocks;
in a pair of blocks all scores are bounded by the coarsest summaries first, and
only rows and columns with a pair that the bounds cannot settle go on to finer
segments and, at last, to exact integer scores.

Two passes over one grid: the best rows of the anchor's own label are its
positives; then each positive's window of scores (30 to 90 % of its own) is
searched for the best rows of other labels.  Within a pair of blocks the lower
end of a window rises as better negatives are found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import materialise
from lakeforge.llm.vectors import SLACK, Best, block_scores, matrix, pair_scores, prepared, ranked, steps, whole_id

EVERY, POSITIVES, NEGATIVES = 100, 5, 10  # anchors are the rows whose vec_id EVERY divides
LOW, HIGH = 30, 90  # percent of the positive's score
ANCHORS, ROWS = 1_024, 4_096  # of a block, about
TRIED, SETTLED = 4, 0.05  # a summary that settles less than this share in so many tries is passed over in a block pair


def segment_counts(dim: int) -> list[int]:
    """1, 4, 16, ... segments, while a segment has two components or more."""
    out = [1]
    while out[-1] * 8 <= dim:
        out.append(out[-1] * 4)
    return out


def summary(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the rows' segments, each times the root of the segment's length."""
    edges = np.linspace(0, v.shape[1], segments + 1).astype(int)
    size = np.diff(edges)
    x = v.astype(np.float64)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / size
    off = x - np.repeat(mean, size, axis=1)
    return mean * np.sqrt(size), np.sqrt(np.add.reduceat(off**2, edges[:-1], axis=1))


def _summaries(dim: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                made = [part for s in segment_counts(dim) for part in summary(matrix(list(pdf["v"]), dim), s)]
                yield pdf.assign(summary=[row.tobytes() for row in np.concatenate(made, axis=1)])

    return run


class Side:
    """One block: its rows, integer vectors, lengths and summaries by level."""

    def __init__(self, pdf: pd.DataFrame, dim: int):
        self.pdf, self.n = pdf, len(pdf)
        self.v, self.norm = matrix(list(pdf["v"]), dim), pdf["norm"].to_numpy()
        self.rid, self.label = pdf["rid"].to_numpy(), pdf["label"].to_numpy()
        flat = np.frombuffer(b"".join(pdf["summary"]), np.float64).reshape(self.n, -1)
        self.levels, at = [], 0
        for s in segment_counts(dim):
            self.levels.append((flat[:, at : at + s], flat[:, at + s : at + 2 * s]))
            at += 2 * s


class Filter:
    """Bounds by ever finer segments; a level that settles next to nothing is passed over."""

    def __init__(self, a: Side, c: Side):
        self.a, self.c = a, c
        self.seen = np.zeros((len(a.levels), 2))
        self.tries = np.zeros(len(a.levels), int)

    def pairs(self, i: np.ndarray, j: np.ndarray, allowed: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, columns, exact scores) of the allowed pairs of i x j that may score from least[row] to most[row]."""
        a, c = self.a, self.c
        for level, ((am, ad), (cm, cd)) in enumerate(zip(a.levels, c.levels)):
            if not allowed.any():
                break
            if self.tries[level] >= TRIED and self.seen[level, 1] > (1 - SETTLED) * self.seen[level, 0]:
                continue
            mean = am[i] @ cm[j].T
            off = ad[i] @ cd[j].T + SLACK * np.outer(a.norm[i], c.norm[j])
            before = allowed.sum()
            allowed = allowed & (mean + off >= least[i][:, None]) & (mean - off <= most[i][:, None])
            self.seen[level] += before, allowed.sum()
            self.tries[level] += 1
            rows, cols = allowed.any(1), allowed.any(0)
            if not rows.all() or not cols.all():
                i, j, allowed = i[rows], j[cols], allowed[np.ix_(rows, cols)]
        if not len(i) or not len(j):
            return (np.zeros(0, np.int64),) * 3
        x, y = np.nonzero(allowed)
        if 8 * len(x) > allowed.size:  # most are left: all at once
            return i[x], j[y], block_scores(a.v[i], c.v[j], a.norm[i], c.norm[j])[x, y]
        return i[x], j[y], pair_scores(a.v, c.v, i[x], j[y])


def _sides(pdf: pd.DataFrame, dim: int) -> tuple[Side, Side] | None:
    side = pdf["side"].to_numpy()
    a, c = pdf[side == 0], pdf[side == 1].sort_values(["no_id", "id", "rid"])  # candidates in the order that breaks ties
    return (Side(a, dim), Side(c, dim)) if len(a) and len(c) else None


def _found(a: Side, c: Side, rows: np.ndarray, best: Best) -> dict:
    return {
        "anchor": a.rid[rows], "anchor_id": a.pdf["id"].to_numpy()[rows], "score": best.score,
        "id": c.pdf["id"].to_numpy()[best.at], "no_id": c.pdf["no_id"].to_numpy()[best.at], "rid": c.rid[best.at],
    }


def _positives(dim: int, k: int) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = _sides(pdf, dim)
        if sides is None:
            return pd.DataFrame({x: [] for x in ("anchor", "anchor_id", "score", "id", "no_id", "rid")})
        a, c = sides
        best, bounds = Best(np.full(a.n, -np.inf), k), Filter(a, c)
        no_end = np.full(a.n, np.inf)
        for label in np.unique(a.label):
            i, there = np.flatnonzero(a.label == label), np.flatnonzero(c.label == label)
            for step in steps(len(there)):
                j = there[step]
                x, y, s = bounds.pairs(i, j, a.rid[i][:, None] != c.rid[j][None, :], best.floor, no_end)
                in_ = s >= best.floor[x]
                best.add(x[in_], s[in_], y[in_])
        return pd.DataFrame(_found(a, c, best.row, best))

    return run


def _negatives(dim: int, positives: int, k: int, low: int, high: int) -> Callable:
    columns = ("anchor", "anchor_id", "score", "id", "no_id", "rid", "place", "positive_score")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = _sides(pdf, dim)
        if sides is None:
            return pd.DataFrame({x: [] for x in columns})
        a, c = sides
        own = np.zeros((a.n, positives), np.int64)
        least, most = np.full((a.n, positives), np.inf), np.full((a.n, positives), -np.inf)
        for r, scores in enumerate(a.pdf["scores"]):
            scores = np.asarray(scores, np.int64)
            own[r, : len(scores)] = scores
            # low * p <= 100 * s <= high * p, in integers
            least[r, : len(scores)] = -((-low * scores) // 100)
            most[r, : len(scores)] = (high * scores) // 100
        best, bounds = Best(least.ravel(), k), Filter(a, c)
        i = np.arange(a.n)
        for step in steps(c.n):
            j = np.arange(step.start, step.stop)
            now = best.floor.reshape(a.n, positives)
            open_ = now <= most
            floor, top = np.where(open_, now, np.inf).min(1), np.where(open_, most, -np.inf).max(1)
            x, y, s = bounds.pairs(i, j, a.label[i][:, None] != c.label[j][None, :], floor, top)
            for p in range(positives):
                in_ = (s >= best.floor[x * positives + p]) & (s <= most[x, p])
                best.add(x[in_] * positives + p, s[in_], y[in_])
        rows, place = best.row // positives, best.row % positives
        return pd.DataFrame({**_found(a, c, rows, best), "place": place, "positive_score": own[rows, place]})

    return run


def _blocks(rows: DataFrame, anchors: DataFrame, n: int, n_anchors: int) -> DataFrame:
    """Both sides of every pair of blocks; rows are dealt by a hash of their name, so no label makes a block large."""
    a_blocks, c_blocks = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n // ROWS))
    mine = lambda blocks: F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    scores = lambda df: F.col("scores") if "scores" in df.columns else F.lit(None).cast("array<long>")
    cols = ["rid", "id", "no_id", "label", "v", "norm", "summary"]
    left = anchors.select(mine(a_blocks).alias("ab"), each(c_blocks).alias("cb"), F.lit(0).alias("side"), *cols, scores(anchors).alias("scores"))
    right = rows.select(each(a_blocks).alias("ab"), mine(c_blocks).alias("cb"), F.lit(1).alias("side"), *cols, F.lit(None).cast("array<long>").alias("scores"))
    return left.unionByName(right)


def changed_label(vec_id: Column, label: Column) -> Column:
    """The label that mining goes by: one in seven is moved on by one."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def mine(embeddings: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``every`` divides; their positives the
    best other rows of the same label, and for each positive the best rows of
    other labels whose score s satisfies low * p <= 100 * s <= high * p (none for a
    negative p).  Ties go to the smaller vec_id, null ids last.  Rows with a null
    label, a null vector or null or non-finite components take no part; shorter
    vectors count as filled up with zeros.  Repeated rows are rows of their own,
    so a copy of the anchor may be its positive.  An empty table gives an empty result.
    """
    rows, dim = prepared(embeddings, changed_label(F.col("vec_id"), F.col("label").cast("long")))
    schema = "id long, no_id boolean, label long, v binary, norm double, rid long, summary binary"
    rows = materialise(rows.mapInPandas(_summaries(dim), schema), "negatives_rows")
    anchors = rows.where((F.col("id") % every == 0) & ~F.col("no_id"))
    n, n_anchors = rows.count(), anchors.count()
    found = "anchor long, anchor_id long, score long, id long, no_id boolean, rid long"
    near = _blocks(rows, anchors, n, n_anchors).groupBy("ab", "cb").applyInPandas(_positives(dim, positives), found)
    near = materialise(ranked(near, ["anchor"], positives), "negatives_positives")
    windows = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))  # at most ``positives`` each
    targets = materialise(anchors.join(windows, anchors["rid"] == windows["anchor"]).select(*anchors.columns, F.col("p.score").alias("scores")), "negatives_anchors")
    far = _blocks(rows, targets, n, n_anchors).groupBy("ab", "cb").applyInPandas(
        _negatives(dim, positives, negatives, low, high), f"{found}, place int, positive_score long"
    )
    far = ranked(far, ["anchor", "place"], negatives, "order")
    far = far.select("anchor", "anchor_id", (F.col("place") + 1).alias("rank"), F.col("order").cast("int").alias("order"), whole_id().alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    named = near.select("anchor", "rank", whole_id().alias("positive_id"))
    return far.join(named, ["anchor", "rank"]).select(
        "anchor_id", "positive_id", F.col("order").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


ORACLE = """
WITH e AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same,
             CAST(list_sum([z[1] * z[2] FOR z IN list_zip(a.v, c.v)]) AS BIGINT) AS score
      FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.r <> c.r),
p AS (SELECT ar, anchor_id, k AS place, vec_id AS positive_id, score AS positive_score
      FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, r) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ar, place ORDER BY s.score DESC, s.vec_id NULLS LAST, s.r) AS k
      FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10
"""
