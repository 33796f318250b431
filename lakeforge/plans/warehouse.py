"""CURATED layer: schemas, loads, snapshot views, layout, table info.

The curated store is a set of parquet tables in the session catalog, each
at an explicit location under the warehouse root (T1, K4, T7).  Snapshot
("materialized") views store their defining query in table properties and
are refreshed by writing the new result to a fresh version folder and then
re-pointing the table (T3, T4): readers never see a half-written table and
we never overwrite files that the refresh itself is reading.

When a JDBC URL is configured, ``load_from_processed`` writes the same
DataFrame through Spark's JDBC sink in batches instead (no pandas hop).
"""

from __future__ import annotations

import importlib
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions import fixed
from lakeforge.functions.expressions import pretty_size
from lakeforge.operators import aggregate as A
from lakeforge.plans.layout import bloom_options, clustered
from lakeforge.plans.parallel import concurrently
from lakeforge.plans.runs import read_runs, run_folders
from lakeforge.session import list_paths, remove_folder

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
QUERY_PROP = "lakeforge.view_query"
BUILDER_PROP = "lakeforge.view_builder"
LAYOUT_PROP = "lakeforge.view_layout"
SPEC_PROP = "lakeforge.buckets"

ViewQuery = str | Callable[[SparkSession, str], DataFrame]  # a builder gets the warehouse's schema


def read_processed(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Every parquet file of a PROCESSED dataset, by column name.

    A directory scan keeps the partition columns (transaction_year, log_date
    ...); a per-file read would lose them.  Missing folder or no data files
    is an error, not an empty table.  ``merge_schema`` (a distributed footer
    read) is only needed when appends may have changed the columns.  A dataset
    of incremental runs is read by the schemas recorded with them.
    """
    if run_folders(spark, path):
        return read_runs(spark, path, merge_schema=merge_schema)
    try:
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"PROCESSED dataset not found or empty: {path}") from exc


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """(re)register ``name`` as an external parquet table over ``path``.

    A partitioned table created over existing files lists no partitions
    until they are recovered, so they are recovered right away.
    """
    drop_relation(spark, name)
    spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{path}'")
    if partitioned:
        spark.catalog.recoverPartitions(name)


def drop_relation(spark: SparkSession, name: str) -> None:
    """Drop a table or a view, if there is one of this name; files of external tables stay."""
    if spark.catalog.tableExists(name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {name}")


class Warehouse:
    """Curated tables under ``root``, registered in database ``schema``.

    A table's newest version and the ``keep_versions - 1`` before it stay on
    disk, so that readers of the last one can finish; older ones are removed.
    A new version of the same columns takes the table's place in one step.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: str = "curated", jdbc: dict | None = None, keep_versions: int = 2
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.jdbc = jdbc
        self.keep_versions = max(1, keep_versions)

    # -- T1 ---------------------------------------------------------------
    def create_schema(self, name: str | None = None) -> None:
        name = name or self.schema
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{self.root}/{name}'")

    def qualified(self, table: str, schema: str | None = None) -> str:
        return f"{schema or self.schema}.{table}"

    def table_path(self, table: str, schema: str | None = None) -> str:
        return f"{self.root}/{schema or self.schema}/{table}"

    def location(self, table: str, schema: str | None = None) -> str:
        """Folder of the table's present version."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(table, schema)}").where("col_name = 'Location'")
        return rows.first()["data_type"]

    def exists(self, table: str, schema: str | None = None) -> bool:
        return self.spark.catalog.tableExists(self.qualified(table, schema))

    # -- K4 / T7 ----------------------------------------------------------
    def write_table(
        self, df: DataFrame, table: str, schema: str | None = None, if_exists: str = "replace",
        bloom: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int | None = None,
    ) -> int:
        """Write ``df`` as ``schema.table``; replace / append / fail. Returns rows written.

        ``bloom``: columns that get Bloom filters.  ``bucket_by``: rows are dealt into ``buckets``
        (default: the session's shuffle width) by these columns and sorted by them, so
        that joins and groupings on them, between tables of as many buckets, need no shuffle.
        """
        if if_exists not in MODES:
            raise ValueError(f"if_exists must be one of {sorted(MODES)}")
        schema = schema or self.schema
        self.create_schema(schema)
        obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        if self.jdbc:
            (
                observed.write.format("jdbc")
                .options(**self.jdbc)
                .option("dbtable", f"{schema}.{table}")
                .option("batchsize", fixed.JDBC_BATCH_SIZE)
                .mode(MODES[if_exists])
                .save()
            )
        else:
            name = self.qualified(table, schema)
            exists = self.exists(table, schema)
            if exists and if_exists == "fail":
                raise ValueError(f"table {name} already exists")
            if not exists or if_exists == "replace":
                # Write aside, then swap: the new data may be derived from the old.
                self._swap(name, observed, self.table_path(table, schema), bloom, bucket_by, buckets)
            else:
                # by name: the order of the frame's columns does not matter, unknown ones are an error
                have = self.spark.table(name).columns
                unknown = [c for c in observed.columns if c not in have]
                if unknown:
                    raise ValueError(f"columns {unknown} are not in {name}")
                missing = [F.lit(None).alias(c) for c in have if c not in observed.columns]
                observed.select("*", *missing).select(*have).write.insertInto(name)
        return int(obs.get.get("rows", 0))

    def load_from_processed(
        self,
        processed_path: str,
        table: str,
        schema: str | None = None,
        if_exists: str = "replace",
        cluster_by: Sequence[str] | None = None,
        merge_schema: bool = True,
        bucket_by: Sequence[str] = (),
        buckets: int | None = None,
    ) -> int:
        """K4: PROCESSED dataset -> curated table; returns the row count.

        ``cluster_by`` applies the index layout (T5) in the same write, so the
        table is written once instead of loaded and then rewritten; with ``bucket_by``
        (see ``write_table``) the columns get Bloom filters, and rows are placed by bucket.
        """
        df = read_processed(self.spark, processed_path, merge_schema)
        if cluster_by and not bucket_by:
            df = clustered(df, cluster_by)
        return self.write_table(df, table, schema, if_exists, cluster_by or (), bucket_by, buckets)

    # -- S10 --------------------------------------------------------------
    def execute_query(self, sql: str) -> DataFrame:
        if self.jdbc:  # runs in the database
            return self.spark.read.format("jdbc").options(**self.jdbc).option("query", sql).load()
        return self.spark.sql(sql)

    # -- T5 ---------------------------------------------------------------
    def create_indexes(self, table: str, columns: Sequence[str], schema: str | None = None, files: int | None = None) -> None:
        """Index re-aimed as data layout (``plans/layout.py``): rows ordered along a
        Morton curve over the columns, with Bloom filters, so that a filter on any
        of them skips whole files and row groups."""
        self._catalog_only()
        name = self.qualified(table, schema)
        self._swap(name, clustered(self.spark.table(name), columns, files), self.table_path(table, schema), columns)

    # -- T3 / T4 ------------------------------------------------------------
    def create_materialized_view(
        self, view: str, query: ViewQuery, schema: str | None = None, cluster_by: Sequence[str] = ()
    ) -> None:
        """T3, with an optional index layout (T5) that refreshes keep."""
        name = self.qualified(view, schema)
        self.create_schema(schema or self.schema)
        if not isinstance(query, str) and getattr(importlib.import_module(query.__module__), query.__qualname__, None) is not query:
            raise ValueError("a view's builder must be a module-level function, or refresh cannot find it again; or give SQL")
        key, value = (QUERY_PROP, query) if isinstance(query, str) else (
            BUILDER_PROP, f"{query.__module__}:{query.__qualname__}")
        self._write_view(view, schema, query, {key: value, LAYOUT_PROP: ",".join(cluster_by)})

    def refresh_materialized_view(self, view: str, schema: str | None = None) -> None:
        name = self.qualified(view, schema)
        props = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if QUERY_PROP in props:
            query: ViewQuery = props[QUERY_PROP]
        elif BUILDER_PROP in props:
            module, fn = props[BUILDER_PROP].split(":")
            query = getattr(importlib.import_module(module), fn)
        else:
            raise ValueError(f"{name} is not a materialized view")
        self._write_view(view, schema, query, {k: props[k] for k in (QUERY_PROP, BUILDER_PROP, LAYOUT_PROP) if k in props})

    def _write_view(self, view: str, schema: str | None, query: ViewQuery, props: dict[str, str]) -> None:
        """Written first, swapped after: a query that fails leaves the old view as it was."""
        name = self.qualified(view, schema)
        df = self._run_view_query(query)
        layout = [c for c in props.get(LAYOUT_PROP, "").split(",") if c]
        base = self.table_path(view, schema)
        if layout:  # the layout reads its input more than once: the query is run once
            rows = f"{base}/plain_{uuid.uuid4().hex[:8]}"
            df.write.parquet(rows)
            self._swap(name, clustered(self.spark.read.schema(df.schema).parquet(rows), layout), base, layout)
            remove_folder(self.spark, rows)
        else:
            self._swap(name, df, base)
        pairs = ", ".join(f"'{k}' = '{_quote(v)}'" for k, v in props.items())
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")

    # -- T6 -----------------------------------------------------------------
    def get_table_info(self, schema: str | None = None) -> DataFrame:
        """(table_name, size_bytes, size) per table of the schema, by name.

        Sizes are those of the files that the table's rows are in, as the scan's
        hidden file metadata has them: no column is read, and the files of older
        versions do not count.
        """
        self._catalog_only()
        schema = schema or self.schema
        names = sorted(t.name for t in self.spark.catalog.listTables(schema) if not t.isTemporary)
        info = self.spark.createDataFrame([(t,) for t in names], "table_name string")
        if names:
            files = reduce(DataFrame.unionByName, [self.table_files(t, schema) for t in names])
            sizes = files.groupBy("table_name").agg(F.sum("bytes").alias("size_bytes"))
            info = info.join(sizes, "table_name", "left")
        else:
            info = info.withColumn("size_bytes", F.lit(None).cast("bigint"))
        info = info.withColumn("size_bytes", F.coalesce("size_bytes", F.lit(0)).cast("bigint"))
        return info.withColumn("size", pretty_size("size_bytes")).orderBy("table_name")

    def table_files(self, table: str, schema: str | None = None) -> DataFrame:
        """(table_name, file_path, bytes, rows) of each file that holds rows of the table."""
        where = self.spark.table(self.qualified(table, schema)).select("_metadata.file_path", "_metadata.file_size")
        by_file = where.groupBy("file_path").agg(F.max("file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        return by_file.select(F.lit(table).alias("table_name"), "file_path", "bytes", "rows")

    # -- helpers --------------------------------------------------------------
    def _run_view_query(self, query: ViewQuery) -> DataFrame:
        self._catalog_only()
        if isinstance(query, str):
            return self.spark.sql(query)
        return query(self.spark, self.schema)

    def _catalog_only(self) -> None:
        if self.jdbc:
            raise NotImplementedError("views, layout and table info work on catalog tables; a JDBC warehouse takes loads and SQL")

    @staticmethod
    def _new_version(base: str) -> str:
        return f"{base}/v_{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"

    def _swap(
        self, name: str, df: DataFrame, base: str, bloom: Sequence[str] = (), bucket_by: Sequence[str] = (), buckets: int | None = None
    ) -> None:
        """Write a new version aside, then point the (external) table to it.

        A table of the same columns only changes its location, in one step;
        one of other columns is dropped and defined anew.
        """
        path = self._new_version(base)
        writer = df.write
        spec = ""
        if bucket_by:
            buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            keys = ", ".join(f"`{c}`" for c in bucket_by)
            spec = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
            # one task for each bucket, so one file
            writer = df.repartition(buckets, *[F.col(f"`{c}`") for c in bucket_by]).write.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
        writer = writer.mode("errorifexists").options(**bloom_options(bloom))
        if bucket_by:
            aside = f"{name}_{uuid.uuid4().hex[:8]}"  # only a catalog table can be written in buckets
            writer.option("path", path).saveAsTable(aside)
            self.spark.sql(f"DROP TABLE {aside}")
        else:
            writer.parquet(path)
        if self.spark.catalog.tableExists(name) and self._definition(name) == (self._columns(df), spec):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.sql(f"CREATE TABLE {name} ({self._columns(df)}) USING PARQUET{spec} LOCATION '{path}' TBLPROPERTIES ('{SPEC_PROP}' = '{_quote(spec)}')")
        self.spark.catalog.refreshTable(name)
        for old in list_paths(self.spark, f"{base}/v_*_*")[: -self.keep_versions]:
            remove_folder(self.spark, old)

    @staticmethod
    def _columns(df: DataFrame) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def _definition(self, name: str) -> tuple[str, str | None]:
        props = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        return self._columns(self.spark.table(name)), props.get(SPEC_PROP)


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


# --- V1 / V2 builders over the curated tables --------------------------------

def user_analytics_view(spark: SparkSession, schema: str = "curated") -> DataFrame:
    """V1 over the users and transactions tables of a warehouse."""
    return A.user_analytics(spark.table(f"{schema}.users"), spark.table(f"{schema}.transactions"))


def transaction_summary_view(spark: SparkSession, schema: str = "curated") -> DataFrame:
    """V2 over the transactions table of a warehouse."""
    return A.transaction_summary(spark.table(f"{schema}.transactions"), ordered=False)


def build_warehouse(
    wh: Warehouse,
    processed: dict[str, str],
    indexes: dict[str, Sequence[str]] | None = None,
    fresh: bool = False,
    bucket_by: dict[str, Sequence[str]] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Schemas, loads with layout, analytic views; returns the table info.

    ``bucket_by`` (curated table name -> columns, see ``write_table``) keeps tables
    that are joined on the same columns together: V1 and Q3 then shuffle nothing.

    ``processed`` maps curated table name -> PROCESSED path; ``fresh`` says
    each was just written by a single overwrite (one schema, so the footer
    merge of the scan is skipped).  Failures propagate (a half-built
    warehouse is an error, not a warning).
    """
    for name in fixed.WAREHOUSE_SCHEMAS:
        wh.create_schema(name)
    indexes, bucket_by = indexes or {}, bucket_by or {}
    # independent loads run as concurrent jobs; the index layout is applied
    # in each load's single write
    concurrently([
        (lambda t=t, p=p: wh.load_from_processed(p, t, cluster_by=indexes.get(t), merge_schema=not fresh, bucket_by=bucket_by.get(t, ()), buckets=buckets))
        for t, p in processed.items()
    ])
    concurrently([
        lambda: wh.create_materialized_view("user_analytics", user_analytics_view, cluster_by=indexes.get("user_analytics", ())),
        lambda: wh.create_materialized_view("transaction_summary", transaction_summary_view),
    ])
    return wh.get_table_info()
