"""Spark session settings and the shared work folder.

Nothing in the library opens a server: the UI stays off, AQE re-plans at run
time (partition coalescing, skew-join splitting, broadcast conversion once the
real size of a join side is known) and the session time zone is pinned so that
dates and timestamps mean the same thing on every executor.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings that matter at any scale. Shuffle partitions are only a starting
# point: AQE coalesces small ones and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.maxMetadataStringLength": "2000",      # plans show a scan's filters whole
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster passes its own conf)."""
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEM", "16g"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    only read here; without it nothing can be shared, which is an error. Only a
    local master (tests) gets a fresh local folder in its place.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
    target = conf_dir or tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """Folder for tables that outlive the driver: the one ``spark.checkpoint.dir``
    names. (Spark's own checkpoint folder below it is made anew by each driver.)"""
    own = ensure_checkpoint_dir(spark)
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or own).rstrip("/")


_SWEPT: set[str] = set()


def _sweep(jvm, conf, folder: str) -> None:
    """Remove a driver's work folder; nothing is left to do if its JVM is gone."""
    try:
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(conf).delete(p, True)
    except Exception:      # noqa: BLE001 - the driver is ending
        pass


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the driver's checkpoint folder for written tables. They live as
    long as the driver, which removes them when it ends."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables"
    if folder not in _SWEPT:
        _SWEPT.add(folder)
        atexit.register(_sweep, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), folder)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def output_path(spark: SparkSession, name: str) -> str:
    """A fresh path for results that stay after the driver has ended."""
    return f"{shared_root(spark)}/ledgerlake-output/{name}-{uuid.uuid4().hex[:12]}"


def path_complete(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its ``_SUCCESS`` marker at ``path``
    (so a half-written table from a killed job is never read as complete)."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(marker))


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table at ``path``; with ``schema``, the one it was written with, no job reads it from the files."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs hold, now that their table is stored: Spark drops their
    broadcasts and shuffle files only once the driver's garbage is collected, and every stage
    leaves blocks of 4 MB there. A driver that builds a dozen tables in a row otherwise fills its
    heap with them, whatever the input's size."""
    spark.sparkContext._jvm.System.gc()


def listed_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time) of every file of an input, by the store's own listing
    (a file or a folder on any Hadoop file system). Empty when there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        out.append((str(f.getPath()), int(f.getLen()), int(f.getModificationTime())))
    return sorted(out)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as the store's listing writes it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return str(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p))


def input_state(spark: SparkSession, path: str) -> list[str]:
    """Path, length and time of every file of an input."""
    return [f"{name}:{size}:{time}" for name, size, time in listed_files(spark, path)]


def input_bytes(spark: SparkSession, path: str) -> int:
    return sum(size for _, size, _ in listed_files(spark, path))


def adopt(spark: SparkSession, made: str, path: str) -> None:
    """Rename the finished table at ``made`` to ``path``. If another driver was
    first, its equal table stays and this one is removed; a half-written folder
    left at ``path`` by a killed job is replaced."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x) for x in (made, path))
    fs = dst.getFileSystem(conf)
    if fs.exists(dst) and not path_complete(spark, path):
        fs.delete(dst, True)
    if fs.exists(dst) or not fs.rename(src, dst):
        fs.delete(src, True)
    if not path_complete(spark, path):
        raise RuntimeError(f"could not publish {path}")
