"""Cleaning (C1-C6): de-duplication, validation rules, metadata removal.

Order of steps is part of the contract:

1. exact de-duplication over *all* columns, while the ingest metadata columns
   are still present (so two ingests of the same row both survive);
2. contract columns that arrive as text get their types; text that is not a
   number becomes NULL (and so fails its rule) instead of ending the job;
   then the dataset's validation rules, each a filter (a NULL predicate drops
   the row, like SQL ``WHERE``);
3. standardisation (users only; emails are validated *before* trimming);
4. every column whose name starts with ``_`` is dropped.

All steps are lazily composed DataFrame operators, so Catalyst pushes the
rule predicates through the de-duplication down to the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeforge.functions import fixed
from lakeforge.functions.expressions import passes, try_number

DATASET_TYPES = ("users", "transactions", "logs", "generic")


def rules(dataset_type: str) -> list[tuple[str, Column]]:
    """Validation rules of a dataset type, in the order they are applied."""
    if dataset_type == "users":
        return [
            ("email_not_null", F.col("email").isNotNull()),
            ("email_format", F.col("email").rlike(fixed.EMAIL_PATTERN)),
            ("age_range", F.col("age").between(fixed.AGE_MIN, fixed.AGE_MAX)),
        ]
    if dataset_type == "transactions":
        return [
            ("amount_not_null", F.col("amount").isNotNull()),
            ("amount_positive", F.col("amount") > 0),
            ("transaction_id_not_null", F.col("transaction_id").isNotNull()),
            ("status_valid", F.col("status").isin(*fixed.VALID_STATUSES)),
        ]
    if dataset_type == "logs":
        return [
            ("timestamp_not_null", F.col("timestamp").isNotNull()),
            ("level_valid", F.col("level").isin(*fixed.VALID_LEVELS)),
        ]
    if dataset_type == "generic":
        return []
    raise ValueError(f"unknown dataset type {dataset_type!r}; expected one of {DATASET_TYPES}")


#: Contract columns that the rules and enrichments compute with, and their types.
NUMBERS = {"users": {"age": "int"}, "transactions": {"amount": "double"}}


def typed(df: DataFrame, dataset_type: str) -> DataFrame:
    """Contract columns that arrived as text (CSV, untyped JSON) as numbers; other types stay."""
    kinds = dict(df.dtypes)
    text = {c: t for c, t in NUMBERS.get(dataset_type, {}).items() if kinds.get(c) == "string"}
    return df.withColumns({c: try_number(c, t) for c, t in text.items()}) if text else df


def metadata_columns(df: DataFrame, keep: Iterable[str] = ()) -> list[str]:
    keep = set(keep)
    return [c for c in df.columns if c.startswith("_") and c not in keep]


def drop_metadata(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop every ``_``-prefixed column (``keep`` spares e.g. ``_id``)."""
    return df.drop(*metadata_columns(df, keep))


def deduplicate(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    latest_by: Sequence[str] = ("_ingestion_timestamp",),
) -> DataFrame:
    """Exact de-duplication, or keyed de-duplication with ``subset``.

    Exact: ``dropDuplicates()``; Spark plans a hash aggregate with a map-side
    partial step, so even a row copied into a third of the input collapses
    before the shuffle.

    Keyed: per key keep the row that is greatest by ``latest_by`` (then by
    all remaining columns, so ties resolve deterministically).  Written as
    ``max(struct(...))`` per key instead of ``row_number()`` over a window:
    the aggregate is partial-aggregated map-side, so a hot key never gathers
    all of its rows in one task.
    """
    if subset is None:
        return df.dropDuplicates()
    subset = list(subset)
    order = [c for c in latest_by if c in df.columns and c not in subset]
    rest = [c for c in df.columns if c not in subset and c not in order]
    if not order and not rest:
        return df.dropDuplicates(subset)
    best = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_best")
    return df.groupBy(*subset).agg(best).select(*subset, "_best.*").select(*df.columns)


def standardize(df: DataFrame, dataset_type: str) -> DataFrame:
    if dataset_type == "users":
        return df.withColumn("email", F.lower(F.trim(F.col("email")))).withColumn("name", F.trim(F.col("name")))
    return df


def apply_rules(df: DataFrame, dataset_type: str) -> DataFrame:
    for _, predicate in rules(dataset_type):
        df = df.filter(predicate)
    return df


def clean_data(
    df: DataFrame,
    dataset_type: str = "generic",
    subset: Sequence[str] | None = None,
    keep_metadata: Iterable[str] = (),
) -> DataFrame:
    """C1-C5 in the contract order (see module docstring)."""
    rules(dataset_type)  # validates the type name
    return validated(deduplicate(df, subset), dataset_type, keep_metadata)


def validated(df: DataFrame, dataset_type: str, keep_metadata: Iterable[str] = ()) -> DataFrame:
    """Everything after the de-duplication."""
    df = apply_rules(typed(df, dataset_type), dataset_type)
    df = standardize(df, dataset_type)
    return drop_metadata(df, keep_metadata)


def clean_observed(
    df: DataFrame, dataset_type: str = "generic", subset: Sequence[str] | None = None
) -> tuple[DataFrame, Observation, Observation, Observation]:
    """C6 opt-in: row counts before de-dup, after de-dup and at the end.

    The counts are collected by the one job that consumes the result, instead
    of three extra ``count()`` jobs.  They are readable (``obs.get``) only
    after that action.  An observation between the scan and the filters stops
    the filters from being pushed into the scan, hence opt-in.
    """
    initial, distinct, final = Observation("initial"), Observation("distinct"), Observation("final")
    rows = F.count(F.lit(1)).alias("rows")
    unique = deduplicate(df.observe(initial, rows), subset).observe(distinct, rows)
    return validated(unique, dataset_type).observe(final, rows), initial, distinct, final


def rejects_by_rule(df: DataFrame, dataset_type: str, dataset_name: str | None = None) -> DataFrame:
    """Q6: rows removed by each cleaning step, in one aggregation.

    ``step 0 duplicates`` counts rows removed by the exact de-dup; step k
    counts rows that passed rules 1..k-1 and fail rule k (a NULL predicate
    fails).  Shape: (dataset, step, rule, rejected).
    """
    dataset_name = dataset_name or dataset_type
    # One shuffle: collapse exact copies (keeping their multiplicity), then a
    # single global aggregate evaluates every rule on the distinct rows.
    distinct = typed(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")), dataset_type)
    aggs = [F.sum("_copies").alias("initial"), F.count(F.lit(1)).alias("distinct_rows")]
    names = []
    survived = F.lit(True)
    for i, (name, predicate) in enumerate(rules(dataset_type), start=1):
        ok = passes(predicate)
        aggs.append(F.count_if(survived & ~ok).alias(f"r{i}"))
        names.append(name)
        survived = survived & ok
    totals = distinct.agg(*aggs)
    pairs = [F.struct(F.lit(0).alias("step"), F.lit("duplicates").alias("rule"),
                      (F.col("initial") - F.col("distinct_rows")).alias("rejected"))]
    pairs += [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("rule"), F.col(f"r{i}").cast("bigint").alias("rejected"))
        for i, name in enumerate(names, start=1)
    ]
    return totals.select(F.lit(dataset_name).alias("dataset"), F.explode(F.array(*pairs)).alias("r")).select(
        "dataset", "r.step", "r.rule", "r.rejected"
    )


def clean_report(df: DataFrame, dataset_type: str, dataset_name: str | None = None) -> DataFrame:
    """C6 as a table: (dataset, initial_count, duplicates_removed, final_count)."""
    dataset_name = dataset_name or dataset_type
    distinct = typed(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")), dataset_type)
    survived = F.lit(True)
    for _, predicate in rules(dataset_type):
        survived = survived & passes(predicate)
    return distinct.agg(
        F.sum("_copies").alias("initial_count"),
        (F.sum("_copies") - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(survived).cast("bigint").alias("final_count"),
    ).select(F.lit(dataset_name).alias("dataset"), "initial_count", "duplicates_removed", "final_count")
