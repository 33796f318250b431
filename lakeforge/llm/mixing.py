"""Operator 5: mix sources to target weights by hash-threshold histograms.

Every document has a fixed position: a 60-bit hash of its id and text.  Sizes
are summed by source and hash bucket; the running sum finds the bucket in which
a source's budget ends, and only that boundary bucket is split further.  The
result is one hash threshold per source, applied as a filter: documents are
never sorted, and thresholds of growing budgets are nested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import ROW, WORD, materialise, text_of, wrap

LEVELS, BITS = 5, 12  # 5 x 12 bits of the 60-bit position


def position(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The document's fixed place in [0, 2^60): a hash of id and text."""
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), text_of(text)).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Weights go to the sources in code point order, null last, and repeat.
    ``budget`` times all sizes is shared by weight; no target passes ``cap``
    times its source's size.  Resharing the excess by weight until none is
    above ends at target = min(cap * size, weight * level), where the level is
    the largest of those that fill sources in the order in which they reach
    their cap.  One row per source: the windows run over sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    by_cap = Window.orderBy("reach", F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("weight", weight)
        .withColumn("reach", F.lit(cap) * F.col("source_size") / F.col("weight"))
        .withColumn("level", (F.lit(budget) * F.sum("source_size").over(every) - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(after))
        .withColumn("level", F.max("level").over(every))
        .select("source", "source_size", F.least(F.lit(cap) * F.col("source_size"), F.col("weight") * F.col("level")).alias("target"))
    )


def thresholds(base: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, source_size, target, repeats, threshold): a document is taken
    ``repeats`` times, and once more if its position is below the threshold.

    Documents of one position (repeated rows) are taken together or not at all.
    The threshold is where the taken words come nearest to the target.
    """
    goal = goal.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("repeats"),
    ).withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size"))
    edge = goal.select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        e = edge.select(F.col("source").alias("e_source"), "rest", "prefix", "below")
        inside = base.join(e, F.col("source").eqNullSafe(F.col("e_source")) & (F.shiftright("position", shift + BITS) == F.col("prefix")))
        buckets = inside.groupBy("source", "rest", "below", F.shiftright("position", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("position").alias("low"), F.max("position").alias("high")
        )
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 2^BITS rows
        edge = materialise(  # one row per source
            buckets.withColumn("below", F.col("below") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
            .where((F.col("below") <= F.col("rest")) & (F.col("rest") < F.col("below") + F.col("words")))
            .select("source", "rest", F.col("bucket").alias("prefix"), "below", "words", "low", "high"),
            "mix_edge", files=1,
        )
        if edge.where("low < high").isEmpty():  # every boundary bucket is down to one position
            break
    take = F.col("below") + F.col("words") / 2 <= F.col("rest")
    last = edge.select(F.col("source").alias("e_source"), (F.col("low") + take.cast("long")).alias("threshold"))
    return (
        goal.join(last, F.col("source").eqNullSafe(F.col("e_source")), "left")
        .select("source", "source_size", "target", "repeats", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    )


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Per row: the caller's columns (one struct), size, source_size, target,
    copies (0, 1 or 2) and taken = size * copies.

    Null or empty text: size 0, taken 0.  Null source: a source of its own,
    last.  Repeated rows share a position and so a decision.  Empty table:
    empty result.
    """
    rows = wrap(docs, "doc_id", "source", "text").select(
        ROW, F.col("source").cast("string").alias("source"), F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"), position().alias("position"),
    )
    # the sizes are read several times: histogram levels must not parse texts again
    base = materialise(rows.select("source", "size", "position"), "mix_sizes")
    goal = materialise(targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, cap), "mix_targets", files=1)
    plan = materialise(thresholds(base, goal), "mix_thresholds", files=1)  # one row per source; its file size decides the join
    plan = plan.withColumnRenamed("source", "p_source")
    copies = F.col("repeats") + (F.col("position") < F.col("threshold")).cast("long")
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
        .withColumn("copies", copies)
        .select(ROW, "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    )


ORACLE = """
WITH b AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS position
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
      FROM b GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size / weight AS reach FROM s),
l AS (SELECT *, (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
                 - 2.0::DOUBLE * CAST(coalesce(sum(source_size) OVER (ORDER BY reach, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
                / sum(weight) OVER (ORDER BY reach, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS repeats FROM t),
o AS (SELECT b.*, g.source_size, g.target, g.repeats, g.target - g.repeats * g.source_size AS rest,
             coalesce(sum(size) OVER (PARTITION BY b.source ORDER BY position RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
             sum(size) OVER (PARTITION BY b.source, position) AS words
      FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (repeats + CASE WHEN below + words / 2 <= rest AND rest > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""
