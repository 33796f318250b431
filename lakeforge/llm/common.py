"""Shared helpers of the training-data operators."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.session import remove_folder, shared_dir

#: ASCII white space (space, tab .. carriage return) as characters of a regex class.
WS = " \t-\r"
#: A word: a run of anything but ASCII white space.
WORD = f"[^{WS}]+"

ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wrap(df: DataFrame, *cols: str, keep: Sequence[str] | None = None) -> DataFrame:
    """The caller's columns (all, or those in ``keep``) in one struct, beside the named ones.

    Operators add working columns next to the struct, so a caller's column of
    the same name cannot clash; ``unwrap`` restores the caller's columns.  Only
    what is kept travels through an operator's joins.
    """
    kept = df.columns if keep is None else keep
    return df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias(ROW), *[F.col(f"`{c}`") for c in cols])


def unwrap(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def text_of(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_key(col: Column) -> Column:
    """16-byte content key: equal texts share it, so exact copies are worked on once."""
    return F.unhex(F.md5(col.cast("binary")))


def let(var: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once per row and names it in ``body``."""
    return f"transform(array({value}), {var} -> {body})[0]"


#: Whether the shuffle files of a classic (not Connect) execution go when it ends, not when the driver collects garbage;
#: rows that a task hands to Python at once.
CLEANUP, BATCH = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """What is run in the block leaves no shuffle files and hands whole texts to Python 1,000 rows at a time.

    Nothing may be run in it whose plan is run again later.
    """
    had = {k: spark.conf.get(k, v) for k, v in ((CLEANUP, "false"), (BATCH, "10000"))}
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(BATCH, str(min(int(had[BATCH]), 1000) if int(had[BATCH]) > 0 else 1000))
    try:
        yield
    finally:
        for k, v in had.items():
            spark.conf.set(k, v)


def materialise(df: DataFrame, name: str, files: int = 0) -> DataFrame:
    """Write a table to the shared folder and read it back (cuts the lineage).

    The shuffle files of the write go with it: the written table replaces them.
    ``files``: for tables known to be small, how many files (0: one per partition).
    """
    path = shared_dir(df.sparkSession, "llm", name, unique=True)
    with lean(df.sparkSession):
        (df.repartition(files) if files else df).write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    if _open.blocks:
        _open.blocks[-1].append((made, path))
    return made


class _Open(threading.local):
    """Tables made in the blocks that are open in this thread, innermost last."""

    def __init__(self):
        self.blocks: list[list[tuple[DataFrame, str]]] = []


_open = _Open()


@contextmanager
def temporary() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that are written in the block go at its end, but for those given to the function it yields.

    Whatever leaves the block must read kept tables alone.  Kept ones belong to
    the block around, if there is one.
    """
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    _open.blocks.append([])
    try:
        yield keep
    finally:
        for df, path in _open.blocks.pop():
            if not any(df is k for k in kept):
                remove_folder(df.sparkSession, path)
            elif _open.blocks:
                _open.blocks[-1].append((df, path))


def key_mask(keys: DataFrame, key: Column, bits: int = 22) -> DataFrame:
    """A one-hash Bloom filter as a table: at most 2^(bits-6) rows of 16 bytes.

    The bound depends on ``bits`` alone (1 MB at 22), never on the data: more
    keys only let more rows through to the exact join behind it.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    return (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("mask_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mask_bits"))
    )


def masked(df: DataFrame, key: Column, mask: DataFrame, bits: int = 22, inside: bool = True) -> DataFrame:
    """Rows whose key may be (``inside``) or surely is not among the mask's keys."""
    slot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    hit = (F.shiftright(slot, 6) == F.col("mask_word")) & (F.getbit("mask_bits", slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return df.join(F.broadcast(mask), hit, "left_semi" if inside else "left_anti")
