"""Column expressions shared by batch, stream and quality code.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen; there is no Python on the row path.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeforge.functions import fixed

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def banded(c: ColumnOrName, bounds: Sequence[tuple[float, object]], other: object) -> Column:
    """``CASE WHEN c < b1 THEN v1 WHEN c < b2 THEN v2 ... ELSE other END``."""
    c = _col(c)
    expr = None
    for bound, value in bounds:
        expr = F.when(c < bound, F.lit(value)) if expr is None else expr.when(c < bound, F.lit(value))
    return F.lit(other) if expr is None else expr.otherwise(F.lit(other))


def age_group(c: ColumnOrName = "age") -> Column:
    """Young / adult / senior (null age falls to senior)."""
    return banded(c, fixed.AGE_GROUP_BOUNDS, fixed.AGE_GROUP_OTHER)


def email_domain(c: ColumnOrName = "email") -> Column:
    """Text after ``@``; ``''`` when there is no match."""
    return F.regexp_extract(_col(c), fixed.EMAIL_DOMAIN_PATTERN, 1)


def amount_eur(
    amount: ColumnOrName = "amount",
    currency: ColumnOrName = "currency",
    rates: Mapping[str, float] | None = None,
) -> Column:
    """Convert with a rate map; unknown or null currency passes unchanged."""
    amount, currency = _col(amount), _col(currency)
    rates = fixed.EUR_RATES if rates is None else rates
    expr = None
    for code, rate in rates.items():
        term = amount * F.lit(float(rate))
        expr = F.when(currency == code, term) if expr is None else expr.when(currency == code, term)
    return amount if expr is None else expr.otherwise(amount)


def amount_category(c: ColumnOrName = "amount") -> Column:
    """Small / medium / large on the raw amount."""
    return banded(c, fixed.AMOUNT_CATEGORY_BOUNDS, fixed.AMOUNT_CATEGORY_OTHER)


def severity_level(c: ColumnOrName = "level") -> Column:
    """ERROR 3, WARNING 2, else 1."""
    c = _col(c)
    expr = None
    for level, value in fixed.SEVERITY_LEVELS:
        expr = F.when(c == level, F.lit(value)) if expr is None else expr.when(c == level, F.lit(value))
    return expr.otherwise(F.lit(fixed.SEVERITY_OTHER))


def safe_to_date(c: ColumnOrName, data_type: str | None = None) -> Column:
    """``to_date`` that yields NULL on malformed text instead of failing.

    Spark 4 runs with ANSI mode on, where ``to_date('garbage')`` raises; the
    pipeline's contract is NULL for unparsable dates.  Timestamp and date
    inputs are cast directly (no parsing involved).
    """
    c = _col(c)
    if data_type is not None and data_type != "string":
        return c.cast("date")
    return F.try_to_date(c)


def try_number(c: ColumnOrName, kind: str) -> Column:
    """Text as a number of ``kind``, NULL where it is none (whole numbers drop a fraction)."""
    number = _col(c).try_cast("double")
    return number if kind == "double" else number.try_cast(kind)


def processed_timestamp(as_of: dt.datetime | str | None = None) -> Column:
    """Transformation time; an injected ``as_of`` makes runs reproducible."""
    return F.current_timestamp() if as_of is None else timestamp_literal(as_of)


def timestamp_literal(value: dt.datetime | str) -> Column:
    """A wall-clock timestamp literal without a time zone."""
    if isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


UNIT = 100_000  # a money sum's parts count hundred-thousandths, its rest hundred-thousandths of these
#: Digits behind the point that a double of less than so much surely has: amounts are rounded to them.
DIGITS = ((524288.0, 10), (1e7, 8), (1e9, 6), (1e11, 4))
MONEY_STATE = ("units", "parts", "rest", "fitting", "plain", "amounts")


def _money_sums(c: ColumnOrName) -> dict[str, Column]:
    """The aggregates that a money sum is made of.

    A double ``sum`` depends on the order partial sums are combined in, which
    changes with partitioning.  Here whole units and two levels of fractions are
    summed as 64-bit integers, which costs little more.  ``fitting`` counts the amounts
    that these sums hold (not NaN, infinite or 1e11 and more); ``plain`` is the double sum.
    """
    x = _col(c).cast("double")
    whole, size = F.floor(x), F.abs(x)
    fits = size < F.lit(DIGITS[-1][0])  # NaN compares as larger than any number
    fraction = None  # in units of UNIT^-2
    for below, digits in DIGITS:
        rounded = F.floor((x - whole) * F.lit(10.0**digits) + F.lit(0.5)) * F.lit(UNIT**2 // 10**digits)
        fraction = F.when(size < F.lit(below), rounded) if fraction is None else fraction.when(size < F.lit(below), rounded)
    return {
        "units": F.try_sum(F.when(fits, whole)), "parts": F.sum((fraction / F.lit(float(UNIT))).cast("bigint")), "rest": F.sum(fraction % F.lit(UNIT)),
        "fitting": F.count(F.when(fits, 1)), "plain": F.sum(x), "amounts": F.count(_col(c)),
    }


def _money_total(s: dict[str, Column], times: Column | None = None) -> Column:
    fraction = s["parts"].cast("decimal(19,0)") * F.lit(UNIT) + s["rest"]
    exact = s["units"].cast("decimal(20,0)") + (fraction * F.lit("0.0000000001").cast("decimal(10,10)")).cast("decimal(31,10)")
    total, plain = exact.cast("double"), s["plain"]
    if times is not None:
        total, plain = F.when(times == 1, total).otherwise((exact * times).cast("double")), plain * times
    # the sum of units is NULL when it overflows, which takes some 10^8 rows of the largest amounts in one group
    fits = (s["fitting"] == s["amounts"]) & s["units"].isNotNull()
    return F.when(fits, total).when(s["amounts"] > 0, plain)


def money_sum(c: ColumnOrName) -> Column:
    """Sum of amounts as a double, free of row order: the same on 8 threads and on 1000 executors.

    Exact for amounts of up to 10 decimals (from half a million on 8, from ten million on 6,
    from a billion on 4: as many as doubles of that size have).  Groups with NaN, infinite or larger amounts
    than 1e11 get the plain sum, so NaN stays NaN.
    """
    return _money_total(_money_sums(c))


def money_avg(c: ColumnOrName) -> Column:
    """``money_sum / count``; NULL when no amount is set
    (``try_divide``: ANSI mode would otherwise fail on a zero count)."""
    return F.try_divide(money_sum(c), F.count(_col(c)))


def money_state(c: ColumnOrName) -> list[Column]:
    """The parts of a money sum as columns that merge (``merged_money``)."""
    return [agg.alias(name) for name, agg in _money_sums(c).items()]


def merged_money() -> list[Column]:
    """The same columns over rows of ``money_state``."""
    return [(F.try_sum if name == "units" else F.sum)(name).alias(name) for name in MONEY_STATE]


def money_total(times: Column | None = None) -> Column:
    """The sum that ``money_state`` columns hold (``times`` over); NULL without amounts."""
    return _money_total({name: F.col(name) for name in MONEY_STATE}, times)


def pretty_size(bytes_col: ColumnOrName) -> Column:
    """Human readable size with the usual database convention.

    Below 10240 bytes: bytes.  Otherwise the size is shifted to half-units
    (integer shifts, so no floating point) and shown in the first of kB, MB,
    GB, TB, PB whose half-unit count is below 20480, rounded half up.
    """
    size = _col(bytes_col).cast("bigint")
    expr = F.when(size < 10 * 1024, F.concat(size.cast("string"), F.lit(" bytes")))
    half = F.shiftright(size, 9)
    units = ("kB", "MB", "GB", "TB", "PB")
    for i, unit in enumerate(units):
        shown = F.concat(F.shiftright(half + 1, 1).cast("string"), F.lit(" " + unit))
        if i == len(units) - 1:
            return expr.otherwise(shown)
        expr = expr.when(half < 20 * 1024, shown)
        half = F.shiftright(half, 10)
    return expr


def passes(predicate: Column) -> Column:
    """A filter keeps a row only when its predicate is TRUE (not NULL)."""
    return F.coalesce(predicate, F.lit(False))
