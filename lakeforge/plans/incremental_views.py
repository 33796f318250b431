"""T4, incrementally: V1 and V2 from stored partial states, one for each run of PROCESSED.

A refresh computes states only for runs that have none yet, or whose files
have changed since (a repeated run), and then merges all states: counts, exact
sums, minima and maxima merge as they are.  V1's distinct transaction ids are
made mergeable by giving every (user, transaction) pair to one run: pairs that
another run has counted are taken out by an anti join on their digests
(``runs.Digests``), so a state holds plain counts.

States are read by one scan; they hold a row for each group and run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.operators import aggregate as A
from lakeforge.plans.runs import DIGEST, RUN, Digests, digest, full_run_rows, not_of_others, read_runs, run_folder, run_folders
from lakeforge.plans.warehouse import Warehouse
from lakeforge.session import folder_signature, list_paths, remove_folder

FULL_RUN = "full run"
SIGNED = "_signature"


def _sources(spark: SparkSession, path: str) -> dict[str, tuple[str, Callable[[], DataFrame]]]:
    """Folder name of each run -> (signature of its files, reader of its rows)."""
    found = {}
    if list_paths(spark, f"{path.rstrip('/')}/*"):
        found[run_folder(FULL_RUN)] = (folder_signature(spark, path), lambda: full_run_rows(spark, path))
    for folder in run_folders(spark, path):
        name = folder.rsplit("/", 1)[1]
        found[name] = (folder_signature(spark, folder), lambda name=name: read_runs(spark, path, folders=[name]))
    return found


def _changed(spark: SparkSession, states: str, sources: dict) -> tuple[list[str], list[str]]:
    """(runs without a state of their present files, folders of states that no longer count)."""
    there = {tuple(p.split("/")[-2:]): p for p in list_paths(spark, f"{states}/{RUN}=*/{SIGNED}=*")}
    now = {(name, f"{SIGNED}={signature}") for name, (signature, _) in sources.items()}
    return [name for name, signed in now if (name, signed) not in there], [folder for key, folder in there.items() if key not in now]


def update_states(spark: SparkSession, path: str, states: str, make: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, list[str]]:
    """(all states, the runs that were read): ``make(rows, run)`` is the state of a run's rows."""
    sources = _sources(spark, path)
    if not sources:
        raise FileNotFoundError(f"PROCESSED dataset not found or empty: {path}")
    changed, old = _changed(spark, states, sources)
    for folder in old:
        remove_folder(spark, folder)
    for name in sorted(changed):
        signature, rows = sources[name]
        make(rows(), name).write.mode("overwrite").parquet(f"{states}/{name}/{SIGNED}={signature}")
    return spark.read.option("basePath", states).option("mergeSchema", "true").parquet(states).drop(RUN, SIGNED), changed


def refresh_transaction_summary(wh: Warehouse, transactions: str, view: str = "transaction_summary") -> list[str]:
    """V2 of the runs of a PROCESSED dataset; returns the runs that were read."""
    states, read = update_states(wh.spark, transactions, _states(wh, view), lambda rows, run: A.summary_state(rows))
    wh.write_table(A.transaction_summary_of(states), view)
    return read


def refresh_user_analytics(wh: Warehouse, users: str, transactions: str, view: str = "user_analytics") -> list[str]:
    """V1 of the runs of two PROCESSED datasets; returns the runs that were read.

    If a run is gone, or was repeated and has lost (user, transaction) pairs that
    other runs left to it, all transactions are counted anew.
    """
    spark, base = wh.spark, _states(wh, view)
    digests = Digests(spark, transactions, base=f"{base}/pairs")

    def pairs(rows: DataFrame) -> DataFrame:
        some = rows.where("transaction_id is not null").select("user_id", "transaction_id")
        return some.withColumn(DIGEST, digest(some))

    def per_user(rows: DataFrame, run: str) -> DataFrame:
        # the pairs that are counted here; written aside, as the digests come from a query on their own table
        not_of_others(pairs(rows), digests, run).write.mode("overwrite").parquet(f"{base}/mine")
        mine = spark.read.parquet(f"{base}/mine")
        digests.replace(run, mine)
        counted = mine.groupBy("user_id").agg(F.count("*").alias("distinct_ids"))
        state = A.user_sums(rows).drop("distinct_ids").join(counted, "user_id", "left")
        return state.withColumn("distinct_ids", F.coalesce("distinct_ids", F.lit(0)).cast("bigint"))

    sources = _sources(spark, transactions)
    changed, _ = _changed(spark, f"{base}/transactions", sources)
    for run in digests.run_ids():
        lost = run not in sources
        if not lost and run in changed:
            lost = not digests.of(run).join(pairs(sources[run][1]()), DIGEST, "left_anti").isEmpty()
        if lost:
            remove_folder(spark, f"{base}/transactions")
            digests.clear()
            break
    parts, read = update_states(spark, transactions, f"{base}/transactions", per_user)
    groups, more = update_states(spark, users, f"{base}/users", lambda rows, run: A.user_groups(rows))
    wh.write_table(A.user_analytics_of(groups, parts), view)
    return read + more


def _states(wh: Warehouse, view: str) -> str:
    return f"{wh.root}/{wh.schema}/{view}__states"
