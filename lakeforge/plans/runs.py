"""PROCESSED kept by run: replay-safe incremental writes and de-duplication across runs.

Layout::

    <lake>/processed/<dataset>/                       what the last full run wrote, if there was one
    <lake>/processed_runs/<dataset>/_run_id=<id>/     what each incremental run since has added
    <lake>/state/<dataset>/digests-<buckets>/_run_id=<id>/   digests of their rows, bucketed by digest
    <lake>/state/<dataset>/runs/_run_id=<id>/         the run's schema
    <lake>/state/<dataset>/covered/                   the ingests that the full run has read

* A run replaces its own folder as a whole, so the same run twice leaves its
  rows once, whatever partitions they fall into.
* Every row carries the digest of its raw values.  A row is new if no other
  run has its digest: the run's digests meet those of all other runs in a left
  anti join.  That table is bucketed by digest, so only the run's own rows are
  shuffled, and a Bloom filter of the run's digests (of bounded size) thins it out before the join.
* Digests are taken from the rows that a run has written, after it has: a run
  that stops in between is repaired by running it again.  Those of a full run are
  made from the ingests that it has read, when the first incremental run needs them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.operators.filters import bloom, may_hold
from lakeforge.session import list_paths, make_folder, remove_folder
from lakeforge.sources import drift
from lakeforge.sources.raw import escaped

RUN, DIGEST = "_run_id", "_digest"


def digest(df: DataFrame) -> Column:
    """128 bits over a row's values: by column name, as text, without NULLs, so that a column
    that other ingests lack, or have in another type, does not change it."""
    nested = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))}
    values = [(F.to_json(f"`{c}`") if c in nested else F.col(f"`{c}`").cast("string")).alias(c) for c in sorted(df.columns)]
    return F.unhex(F.md5(F.to_json(F.struct(*values))))


def run_folder(run_id: str) -> str:
    return f"{RUN}={escaped(run_id)}"


def _beside(path: str, root: str) -> str:
    """<lake>/<root>/<dataset> of <lake>/processed/<dataset>."""
    lake, _, dataset = path.rstrip("/").rsplit("/", 2)
    return f"{lake}/{root}/{dataset}"


def runs_path(path: str) -> str:
    return _beside(path, "processed_runs")


def _state(path: str) -> str:
    return _beside(path, "state")


def run_folders(spark: SparkSession, path: str) -> list[str]:
    return list_paths(spark, f"{runs_path(path)}/{RUN}=*")


def start_over(spark: SparkSession, path: str, covered: Sequence[str]) -> None:
    """After a full run: it has taken the place of all runs; what it has read is noted."""
    remove_folder(spark, runs_path(path))
    remove_folder(spark, _state(path))
    names = spark.createDataFrame([(name,) for name in covered], "folder string")
    names.coalesce(1).write.mode("overwrite").text(f"{_state(path)}/covered")


def covered(spark: SparkSession, path: str) -> list[str]:
    """Ingest folders that the last full run has read."""
    if not list_paths(spark, f"{_state(path)}/covered"):
        return []
    return sorted(r[0] for r in spark.read.text(f"{_state(path)}/covered").collect())


class Digests:
    """Digests of the rows that each run has written, in a table bucketed by digest."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, base: str | None = None):
        """``buckets`` of a new table (default: the session's shuffle width; one that exists keeps its
        number); ``base``: folder of the table, if it is not that of the dataset at ``path``."""
        self.spark = spark
        base = base or _state(path)
        there = list_paths(spark, f"{base}/digests-*")
        self.buckets = int(there[0].rsplit("-", 1)[1]) if there else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = f"{base}/digests-{self.buckets}"
        self.name = f"digests_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"  # one table per folder
        make_folder(spark, self.path)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({DIGEST} BINARY, {RUN} STRING) USING PARQUET PARTITIONED BY ({RUN}) "
            f"CLUSTERED BY ({DIGEST}) SORTED BY ({DIGEST}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        if there:  # written by another session
            spark.catalog.recoverPartitions(self.name)

    def runs(self) -> list[str]:
        return list_paths(self.spark, f"{self.path}/{RUN}=*")

    def run_ids(self) -> list[str]:
        return [unquote(folder.rsplit(f"/{RUN}=", 1)[1]) for folder in self.runs()]

    def of(self, run_id: str) -> DataFrame:
        return self.spark.table(self.name).where(F.col(RUN) == run_id).select(DIGEST)

    def clear(self) -> None:
        """Forget the digests of all runs."""
        for folder in self.runs():
            remove_folder(self.spark, folder)
        self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")

    def of_others(self, run_id: str) -> DataFrame:
        return self.spark.table(self.name).where(F.col(RUN) != run_id).select(DIGEST)

    def replace(self, run_id: str, rows: DataFrame) -> None:
        rows.select(DIGEST).repartition(self.buckets, DIGEST).createOrReplaceTempView(f"new_{self.name}")
        text = run_id.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({RUN} = '{text}') SELECT {DIGEST} FROM new_{self.name}")
        self.spark.catalog.dropTempView(f"new_{self.name}")


def new_rows(raw: DataFrame, digests: Digests, run_id: str) -> DataFrame:
    """C1 across runs: the distinct rows that no other run has written, with their digest."""
    return not_of_others(raw.withColumn(DIGEST, digest(raw)), digests, run_id)


def not_of_others(rows: DataFrame, digests: Digests, run_id: str) -> DataFrame:
    """One row for each digest (column ``_digest``) that no other run has."""
    others = digests.of_others(run_id)
    if not digests.runs():
        return rows.dropDuplicates([DIGEST])
    others = may_hold(others, F.col(DIGEST), *bloom(rows, F.col(DIGEST)))
    # the de-dup and the join go by one shuffle, as wide as the table has buckets
    return rows.repartition(digests.buckets, DIGEST).dropDuplicates([DIGEST]).join(others, DIGEST, "left_anti")


def write_run(df: DataFrame, path: str, run_id: str, partition_by: Sequence[str] = ()) -> str:
    """K2: the run's rows in place of whatever an earlier attempt of it has written."""
    folder = f"{runs_path(path)}/{run_folder(run_id)}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    record = df.sparkSession.createDataFrame([(df.schema.json(), list(partition_by))], "schema string, partition_by array<string>")
    record.coalesce(1).write.mode("overwrite").json(f"{_state(path)}/runs/{run_folder(run_id)}")
    return folder


def recorded_runs(spark: SparkSession, path: str) -> list[tuple[str, T.StructType, list[str]]]:
    """(folder, schema, partition columns) of every run, as recorded with it, or else from its files."""
    records = {}
    try:
        base = f"{_state(path)}/runs"
        for r in spark.read.option("basePath", base).schema(f"schema string, partition_by array<string>, {RUN} string").json(base).collect():
            records[run_folder(r[RUN])] = (T.StructType.fromJson(json.loads(r["schema"])), r["partition_by"] or [])
    except AnalysisException:
        pass  # no record yet
    found = []
    for folder in run_folders(spark, path):
        known = records.get(folder.rsplit("/", 1)[1])
        found.append((folder, *(known or (spark.read.option("mergeSchema", "true").parquet(folder).schema, []))))
    return found


def full_run_rows(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame | None:
    """Rows of the last full run, if there was one."""
    if not list_paths(spark, f"{path.rstrip('/')}/*"):
        return None
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_runs(
    spark: SparkSession, path: str, run_ids: Sequence[str] | None = None, merge_schema: bool = True, folders: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the full run and of all incremental runs since (``run_ids``, or names of run ``folders``: of
    these alone), by column name and common type, without the run columns.

    Incremental runs are read by the schema recorded with them: no footers are merged.
    """
    if run_ids is not None:
        folders = [run_folder(r) for r in run_ids]
    wanted = None if folders is None else set(folders)
    runs = [r for r in recorded_runs(spark, path) if wanted is None or r[0].rsplit("/", 1)[1] in wanted]
    parts = {RUN: "string"}
    for _, schema, partition_by in runs:
        parts.update({c: schema[c].dataType.simpleString() for c in partition_by})
    types = ", ".join(f"`{c}` {t}" for c, t in parts.items())
    root = runs_path(path)
    frames = [drift.read(spark.read.option("basePath", root), [r[:2] for r in runs], types, [root] if wanted is None else None).drop(RUN, DIGEST)] if runs else []
    base = full_run_rows(spark, path, merge_schema) if wanted is None else None
    if base is not None:
        frames.insert(0, base)
    if not frames:
        raise FileNotFoundError(f"PROCESSED dataset not found or empty: {path}")
    return drift.union(frames)


def register_runs(spark: SparkSession, name: str, path: str) -> None:
    """T2 for a dataset of incremental runs: a view that unites the full run and the runs since.

    Runs that agree in their types are one table, whose partitions are listed
    anew; each that does not is a part of its own, brought to the common types.
    """
    runs = recorded_runs(spark, path)
    base = list_paths(spark, f"{path.rstrip('/')}/*")
    sources: list[tuple[str, T.StructType]] = []
    if base:
        sources.append((f"parquet.`{path}`", spark.read.parquet(path).schema))
    whole = drift.merged([schema for _, schema, _ in runs])
    if all(drift.agree(whole, schema) for _, schema, _ in runs):
        parts = list(dict.fromkeys([RUN, *[c for r in runs for c in r[2]]]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.fields)
        spark.sql(f"DROP TABLE IF EXISTS {name}_runs")
        spark.sql(f"CREATE TABLE {name}_runs ({columns}, {RUN} STRING) USING PARQUET PARTITIONED BY ({', '.join(parts)}) LOCATION '{runs_path(path)}'")
        spark.catalog.recoverPartitions(f"{name}_runs")
        sources.append((f"{name}_runs", whole))
    else:
        sources += [(f"parquet.`{folder}`", schema) for folder, schema, _ in runs]
    shown = [f for f in drift.merged([schema for _, schema in sources]).fields if f.name not in (RUN, DIGEST)]
    selects = []
    for source, schema in sources:
        have = {f.name for f in schema.fields}
        cols = [f"try_cast({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in shown]
        selects.append(f"SELECT {', '.join(cols)} FROM {source}")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # of a full run
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(selects)}")
