"""T5: indexes as data layout, for filters on any of the listed columns.

Rows are ordered along a Morton curve: each column's values become ranks between
quantiles of a bounded sample, and the ranks' bits are interleaved.  Neighbours
on the curve are close in every column, so a file holds a narrow range of each,
and the file and row-group bounds in the footers let a filter on any one column
skip most of them.  (Sorting by the columns in turn would serve the first only.)
Bloom filters of the columns let an equality skip row groups within whose bounds
the value merely falls.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

SAMPLE = 20_000  # rows that the quantiles are taken from: what the driver holds, whatever the input
BITS = 6  # of a column's rank: up to 64 ranges


def cuts(values: Sequence, bits: int = BITS) -> list:
    """Up to 2^bits - 1 distinct values that part the sorted ``values`` into ranges of like size."""
    ordered, parts = sorted(values), 1 << bits
    found = [ordered[len(ordered) * k // parts] for k in range(1, parts)] if ordered else []
    return [v for v in dict.fromkeys(found) if v != ordered[0]]


def rank(column: str, edges: Sequence, bits: int = BITS) -> Column:
    """How many edges a value reaches, spread over 0 .. 2^bits - 1; NULL counts as smallest."""
    def between(lo: int, hi: int) -> Column:  # by halves: ``bits`` comparisons a row
        if lo == hi:
            return F.lit((lo << bits) // (len(edges) + 1))
        mid = (lo + hi) // 2
        return F.when(F.col(f"`{column}`") >= F.lit(edges[mid]), between(mid + 1, hi)).otherwise(between(lo, mid))

    return between(0, len(edges))


def morton(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The ranks' bits interleaved, the highest of each first."""
    out = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for r in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")))
    return out


def place(ranks: Sequence[int], bits: int = BITS) -> int:
    """``morton`` of one row's ranks."""
    out = 0
    for bit in reversed(range(bits)):
        for r in ranks:
            out = out << 1 | r >> bit & 1
    return out


def smallest(df: DataFrame, columns: Sequence[str], tie: Column, size: int) -> list[Row]:
    """The ``size`` rows of the smallest hashes ``tie`` (all, if fewer), by hash: their ``columns``.

    A top-n sends n rows of every task to the driver.  Here only rows under a bound leave the tasks, one that
    about twice ``size`` rows fall under, and equal rows leave as one, with their number.  Should many copies have
    left too few rows under the bound, it is raised.
    """
    hashed, share = df.select(*[F.col(f"`{c}`") for c in columns], tie.alias("_tie")), 2 * size / max(df.count(), 1)
    while True:
        low = hashed if share >= 1 else hashed.where(F.col("_tie") < F.lit(int(share * 2**64) - 2**63))
        found = low.groupBy(*[F.col(f"`{c}`") for c in columns], "_tie").agg(F.count(F.lit(1)).alias("_rows")).collect()
        if share >= 1 or sum(r["_rows"] for r in found) >= size:
            break
        share *= 8
    out: list[Row] = []
    for r in sorted(found, key=lambda r: r["_tie"]):
        out += [r] * min(r["_rows"], size - len(out))
    return out


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows in partitions that are stretches of the curve, sorted within.

    ``files``: about how many (default: the session's shuffle width), brought to a power of two, so that
    every stretch is a whole cell: one that crossed a cell's edge would be wide in some column.  A cell that holds
    many rows (a third of all may have one value) is dealt by a row hash into as many
    partitions as its share needs.  The sample is the rows of the smallest hashes, so a rerun lays out alike.
    """
    columns = list(columns)
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deep = min((files - 1).bit_length(), BITS * len(columns))
    cells, shift = 1 << deep, BITS * len(columns) - deep
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sample = smallest(df, columns, tie, SAMPLE)
    edges = [cuts([r[c] for r in sample if r[c] is not None]) for c in columns]
    there = Counter(
        place([(0 if r[c] is None else bisect_right(e, r[c])) * (1 << BITS) // (len(e) + 1) for c, e in zip(columns, edges)]) >> shift for r in sample
    )
    # cells that the sample shows to hold several times their share
    large = {cell: -(-n * cells // len(sample)) for cell, n in there.items() if n >= 20 and n * cells > 3 * len(sample)}
    curve = morton([rank(c, e) for c, e in zip(columns, edges)])
    cell = F.shiftright("_place", shift)
    parts = F.coalesce(F.create_map(*[F.lit(x) for kv in large.items() for x in kv])[cell.cast("int")], F.lit(1)) if large else F.lit(1)
    placed = df.withColumns({"_place": curve, "_tie": tie}).withColumns({"_cell": cell, "_part": F.pmod("_tie", parts)})
    # range bounds fall between distinct keys: with more partitions than cells each key has its own, and the rest are empty
    placed = placed.repartitionByRange(4 * (cells + sum(large.values())), "_cell", "_part")
    return placed.sortWithinPartitions("_place", *columns).drop("_place", "_tie", "_cell", "_part")


def bloom_options(columns: Sequence[str]) -> dict[str, str]:
    """Parquet writer options: a Bloom filter of each column in every row group, as large as its values need."""
    on = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**on, "parquet.bloom.filter.adaptive.enabled": "true"} if on else {}


def file_bounds(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(file_path, rows, <column>_min, <column>_max ...) of each file that holds rows."""
    ends = [f(F.col(f"`{c}`")).alias(f"{c}_{f.__name__}") for c in columns for f in (F.min, F.max)]
    return table.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def lookup_files(bounds: DataFrame, column: str, value) -> tuple[int, int]:
    """(files, files within whose bounds the value falls)."""
    hit = F.lit(value).between(F.col(f"`{column}_min`"), F.col(f"`{column}_max`"))
    row = bounds.agg(F.count(F.lit(1)), F.count_if(hit)).first()
    return row[0], row[1]
