"""Data-quality tests and alerts (Q1-Q5), row counts and completeness (M2).

Test results share one shape: (test_name, model, column_name, failures,
passed).  ``failures`` counts what the test's failing query would return:

* unique: distinct non-null values seen more than once;
* not_null: rows whose value is NULL;
* relationships: child rows (non-null key) whose key has no parent row.

Every test is a grouped aggregate with a map-side partial step (or a
single global aggregate), so hot keys are reduced before any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import fixed
from lakeforge.functions.expressions import passes
from lakeforge.operators.clean import deduplicate, rules, typed
from lakeforge.operators.joins import orphans

RESULT_COLUMNS = ("test_name", "model", "column_name", "failures", "passed")


def _result(df: DataFrame, test: str, model: str, column: str) -> DataFrame:
    return df.select(
        F.lit(test).alias("test_name"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"),
        (F.col("failures") == 0).alias("passed"),
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def unique_test(df: DataFrame, column: str, model: str) -> DataFrame:
    """Q1: number of non-null values of ``column`` that occur more than once."""
    dup_values = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )
    return _result(dup_values.agg(F.count(F.lit(1)).alias("failures")), "unique", model, column)


def not_null_tests(df: DataFrame, columns: Sequence[str], model: str) -> DataFrame:
    """Q2: NULL counts of several columns in one scan of the model."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    return _union(
        [_result(counts.select(F.col(f"n{i}").alias("failures")), "not_null", model, c) for i, c in enumerate(columns)]
    )


def relationships_test(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, model: str
) -> DataFrame:
    """Q3: child rows whose non-null key is missing from the parent."""
    missing = orphans(child, child_key, parent, parent_key)
    failures = missing.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("failures"))
    return _result(failures, "relationships", model, child_key)


def _keyed_pass(df: DataFrame, key: str, not_null: Sequence[str], model: str) -> DataFrame:
    """unique(key) plus not_null(...) of the same model in one grouped pass.

    Group by the key with the NULL count of every not_null column; then one
    global aggregate reads the failures off the (much smaller) grouped rows.
    The group-by is partial-aggregated map-side, so a hot key costs one row
    per task before the shuffle.
    """
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(not_null)],
    )
    failures = [F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("f_unique")]
    failures += [F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"f_null_{i}") for i in range(len(not_null))]
    totals = per_key.agg(*failures)
    results = [F.struct(F.lit("unique").alias("test_name"), F.lit(key).alias("column_name"),
                        F.col("f_unique").cast("bigint").alias("failures"))]
    results += [
        F.struct(F.lit("not_null").alias("test_name"), F.lit(c).alias("column_name"),
                 F.col(f"f_null_{i}").cast("bigint").alias("failures"))
        for i, c in enumerate(not_null)
    ]
    return totals.select(F.explode(F.array(*results)).alias("r")).select(
        F.col("r.test_name").alias("test_name"),
        F.lit(model).alias("model"),
        F.col("r.column_name").alias("column_name"),
        F.col("r.failures").alias("failures"),
        (F.col("r.failures") == 0).alias("passed"),
    )


def model_tests(models: Mapping[str, DataFrame], tests: Iterable[tuple[str, str, str]] = fixed.MODEL_TESTS) -> DataFrame:
    """Q4: run the declared tests; one result row per test.

    Per model: the first unique test carries all of the model's not_null
    tests in the same grouped pass; further unique tests get their own pass;
    not_null tests of a model without unique tests share one global
    aggregate; each relationships test is one anti join of distinct keys.
    """
    tests = list(tests)
    parts: list[DataFrame] = []
    for model in dict.fromkeys(m for m, _, _ in tests):
        df = models[model]
        uniques = [c for m, c, t in tests if m == model and t == "unique"]
        not_null = [c for m, c, t in tests if m == model and t == "not_null"]
        for t in {t for m, _, t in tests if m == model} - {"unique", "not_null", "relationships"}:
            raise ValueError(f"unknown test {t!r}")
        if uniques:
            parts.append(_keyed_pass(df, uniques[0], not_null, model))
            parts += [unique_test(df, c, model) for c in uniques[1:]]
        elif not_null:
            parts.append(not_null_tests(df, not_null, model))
        for m, column, t in tests:
            if m == model and t == "relationships":
                target_model, target_col = fixed.RELATIONSHIP_TARGET
                parts.append(relationships_test(df, column, models[target_model], target_col, model))
    return _union(parts)


def failing_tests(results: DataFrame) -> DataFrame:
    """The failing-test gauge: number of tests that did not pass."""
    return results.agg(F.count_if(~F.col("passed")).cast("bigint").alias("failing_tests"))


def test_failure_alert(
    results: DataFrame, time_col: str | None = None, hold_minutes: int = fixed.TEST_FAILURE_HOLD_MINUTES
) -> DataFrame:
    """Firing when the failing-test gauge stays above its threshold.

    ``results`` of one evaluation: the gauge and whether it is above the
    threshold now.  With ``time_col`` (results of many evaluations, at most
    one a minute): per evaluation time the gauge, ``pending`` (above) and
    ``firing`` (above at this evaluation and through the ``hold_minutes``
    before it).
    """
    if time_col is None:
        return failing_tests(results).select(
            F.lit("DataTestFailure").alias("alert"),
            "failing_tests",
            (F.col("failing_tests") > fixed.TEST_FAILURE_THRESHOLD).alias("firing"),
        )
    gauge = (
        results.groupBy(F.window(time_col, "1 minute").alias("w"))
        .agg(F.count_if(~F.col("passed")).cast("bigint").alias("failing_tests"))
        .select(F.col("w.start").alias("evaluated_at"), "failing_tests")
        .withColumn("pending", F.col("failing_tests") > fixed.TEST_FAILURE_THRESHOLD)
    )
    held = _held(gauge, "evaluated_at", ["failing_tests", "pending"], 1, hold_minutes)
    return held.select(F.lit("DataTestFailure").alias("alert"), "evaluated_at", "failing_tests", "pending", "firing")


def validation_errors(df: DataFrame, dataset_type: str, time_col: str) -> DataFrame:
    """Rows rejected by a dataset's cleaning rules, with their event time.

    Same de-dup as cleaning; rows without a time cannot be placed on the
    time axis and are left out.
    """
    ok = F.lit(True)
    for _, predicate in rules(dataset_type):
        ok = ok & passes(predicate)
    return (
        typed(deduplicate(df), dataset_type)
        .filter(~ok & F.col(time_col).isNotNull())
        .select(F.col(time_col).alias("event_time"))
    )


def error_rate_alert(
    errors: DataFrame,
    time_col: str = "event_time",
    range_: str = fixed.ERROR_RATE_RANGE,
    range_seconds: int = fixed.ERROR_RATE_RANGE_SECONDS,
    step: str = fixed.ERROR_RATE_EVAL,
    threshold: float = fixed.ERROR_RATE_THRESHOLD,
    hold_steps: int = fixed.ERROR_RATE_HOLD_MINUTES,
    alert: str = "HighDataValidationErrors",
) -> DataFrame:
    """Error rate over a sliding range, evaluated every ``step``.

    For each evaluation window (start, end) with at least one error:
    ``rate = errors / range_seconds``, ``pending = rate > threshold`` and
    ``firing`` when pending held at this and the previous ``hold_steps``
    evaluations.

    Both stages are grouped aggregates on time buckets (``window`` expands a
    row into range/step buckets, a fixed factor), so no global ordering or
    single-partition window is needed; "held for N steps" is a count of
    pending evaluations landing on an evaluation time from its N+1 latest
    steps.
    """
    return held_alerts(error_rates(errors, time_col, range_, range_seconds, step, threshold), step, hold_steps, alert)


def error_rates(
    errors: DataFrame,
    time_col: str = "event_time",
    range_: str = fixed.ERROR_RATE_RANGE,
    range_seconds: int = fixed.ERROR_RATE_RANGE_SECONDS,
    step: str = fixed.ERROR_RATE_EVAL,
    threshold: float = fixed.ERROR_RATE_THRESHOLD,
) -> DataFrame:
    """The evaluations of Q5b: window_start, window_end, errors, rate, pending; for a batch or a stream."""
    # counted per step first: the sliding range then expands one row per step, not every error
    per_step = errors.groupBy(F.window(time_col, step).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    # a stream's second window goes by the time of the first; both are at its start for a batch
    ranges = per_step.groupBy(F.window(F.window_time("s") if errors.isStreaming else F.col("s.start"), range_, step).alias("w"))
    return ranges.agg(F.sum("n").alias("errors")).select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "errors",
        (F.col("errors") / F.lit(float(range_seconds))).alias("rate"),
    ).withColumn("pending", F.col("rate") > F.lit(threshold))


def held_alerts(
    rates: DataFrame, step: str = fixed.ERROR_RATE_EVAL, hold_steps: int = fixed.ERROR_RATE_HOLD_MINUTES, alert: str = "HighDataValidationErrors"
) -> DataFrame:
    """Evaluations with ``firing``: pending at this and the ``hold_steps`` evaluations before it."""
    held = _held(rates, "window_end", ["window_start", "errors", "rate", "pending"], _minutes(step), hold_steps)
    return held.select(F.lit(alert).alias("alert"), "window_start", "window_end", "errors", "rate", "pending", "firing")


def _held(evaluations: DataFrame, time: str, fields: Sequence[str], step_minutes: int, hold_steps: int) -> DataFrame:
    """``time``, ``fields`` and ``firing``: pending at this and the ``hold_steps`` evaluations before it.

    Each evaluation row emits itself and, when pending, one marker at each
    of the next hold_steps + 1 evaluation times (itself included).  An
    evaluation fires when hold_steps + 1 markers land on it.  One explode
    (fixed factor) and one grouped aggregate: no self-join, no recompute.
    """
    own = F.struct(F.col(time).alias("t"), F.lit(True).alias("is_row"), *[F.col(c).alias(c) for c in fields])
    markers = [
        F.when(
            F.col("pending"),
            F.struct(
                (F.col(time) + F.expr(f"INTERVAL {k * step_minutes} MINUTES")).alias("t"),
                F.lit(False).alias("is_row"),
                *[F.lit(None).cast(evaluations.schema[c].dataType).alias(c) for c in fields],
            ),
        )
        for k in range(hold_steps + 1)
    ]
    items = evaluations.select(F.explode(F.filter(F.array(own, *markers), lambda x: x.isNotNull())).alias("i"))
    # exactly one item per time is the evaluation row: per-field max reads it
    # (primitive maxima keep this a hash aggregate)
    per_time = items.groupBy(F.col("i.t").alias(time)).agg(
        F.count_if(F.col("i.is_row")).alias("is_row"),
        *[F.max(F.col(f"i.{c}")).alias(c) for c in fields],
        F.count_if(~F.col("i.is_row")).alias("held"),
    )
    return per_time.filter(F.col("is_row") > 0).select(time, *fields, (F.col("held") == hold_steps + 1).alias("firing"))


def _minutes(text: str) -> int:
    amount, unit = text.split()
    if not unit.startswith("minute"):
        raise ValueError(f"evaluation step must be given in minutes, got {text!r}")
    return int(amount)


def completeness(present: DataFrame, expected: Sequence[str], name_col: str = "dataset_name") -> DataFrame:
    """M2: (dataset, present) for every expected dataset.

    ``present`` is any frame listing the datasets that arrived (e.g. the
    ingest manifest).  The expected list is tiny and fixed by the caller, so
    it is joined against the distinct arrived names.
    """
    spark = present.sparkSession
    wanted = spark.createDataFrame([(d,) for d in expected], f"{name_col} string")
    arrived = present.select(name_col).distinct().withColumn("_present", F.lit(True))
    return wanted.join(arrived, name_col, "left").select(
        F.col(name_col).alias("dataset"), F.coalesce("_present", F.lit(False)).alias("present")
    )


def assert_complete(report: DataFrame) -> None:
    """M2 gate: raise when any expected dataset is missing."""
    missing = [r["dataset"] for r in report.filter(~F.col("present")).collect()]
    if missing:
        raise RuntimeError(f"missing datasets: {', '.join(sorted(missing))}")
