"""Session construction and the shared working folder.

The cluster decides where durable scratch data lives: ``spark.checkpoint.dir``
names a folder every executor can reach.  We read it from the session and only
pick our own when it is unset (local runs and tests).
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings we want on every session.  Shuffle partitions are left to the
# caller / cluster: AQE coalesces small partitions at runtime, so a high
# static number is safe at scale and cheap locally.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def sized_conf(input_bytes: int, bytes_per_shuffle_partition: int = 2 << 30, least: int = 200, most: int = 200_000) -> dict[str, str]:
    """Shuffle and scan sizing for an input volume (spill-aware defaults).

    The widest shuffle here is the exact de-dup of the input, so the static
    partition count gives each reducer about ``bytes_per_shuffle_partition``
    of it (bounded to ``least``..``most``: more reducers multiply shuffle blocks);
    AQE then coalesces to ~256 MB partitions after partial aggregation has
    shrunk the data, and splits skewed ones.  Scan splits stay at 256 MB.
    """
    parts = max(least, min(most, -(-input_bytes // bytes_per_shuffle_partition)))
    return {
        # partitions of the advisory size, not as many as there are cores (of small inputs the cores make more)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
    }


def build_session(
    master: str | None = None,
    app_name: str = "lakeforge",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline's defaults.

    ``input_bytes`` sizes shuffles for the expected input (``sized_conf``);
    an explicit ``shuffle_partitions`` wins over it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if input_bytes:
        settings.update(sized_conf(input_bytes))
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path, as Spark itself sees it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, by name.  Only names are listed; no data and no footer is read."""
    fs, where = _hadoop(spark, pattern)
    return sorted(f.getPath().toString() for f in fs.globStatus(where) or ())


def list_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Name and bytes of the files of one folder (hidden ones aside), from the listing."""
    fs, where = _hadoop(spark, path)
    found = {f.getPath().getName(): f.getLen() for f in fs.listStatus(where) if f.isFile()}
    return {name: size for name, size in found.items() if name[0] not in "._"}


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.mkdirs(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def folder_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Total size of the files under ``paths`` (missing ones: 0), from the listing."""
    total = 0
    for path in paths:
        fs, where = _hadoop(spark, path)
        total += fs.getContentSummary(where).getLength() if fs.exists(where) else 0
    return total


def folder_signature(spark: SparkSession, path: str) -> str:
    """A digest of the names and sizes of all files under ``path``: it changes when they are written anew."""
    fs, where = _hadoop(spark, path)
    files, found = fs.listFiles(where, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()}")
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


@contextmanager
def sized_shuffle(
    spark: SparkSession, paths: Sequence[str], bytes_per_shuffle_partition: int = 512 << 20, most: int = 200_000
) -> Iterator[int]:
    """Widen the session's shuffles for the files under ``paths`` while the block runs.

    Compressed files unpack to about four times their size, so 512 MB of files
    per reducer is what ``sized_conf`` gives it.  A wider setting stays.
    """
    key = "spark.sql.shuffle.partitions"
    have = int(spark.conf.get(key))
    need = max(have, min(most, -(-folder_bytes(spark, paths) // bytes_per_shuffle_partition)))
    spark.conf.set(key, str(need))
    try:
        yield need
    finally:
        spark.conf.set(key, str(have))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; set one only when unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    # Unset: a machine-local folder is only right where everything runs on this machine.
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="lakeforge-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder.

    ``unique=True`` appends a fresh id so concurrent or repeated runs never
    write into each other's output.
    """
    root = checkpoint_root(spark)
    pieces = ["lakeforge", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return os.path.join(root, *pieces) if "://" not in root else "/".join([root.rstrip("/"), *pieces])
