"""The raw layer: model tables derived once from the driver tables and stored.

In the original warehouse every layer is a stored table: sources are imported
into raw tables, transforms read raw tables, marts read transform tables.
Here the raw layer is the set of stand-in model tables (``standins.py``),
derived by Spark from the driver parquet files and written as parquet under
the shared checkpoint folder (``spark.checkpoint.dir``). Every job then reads
compact, typed model tables:

* lines and headers are partitioned by ``archived`` and by the entry's year, both
  of them: a line carries no year, so it gets its header's when it is stored
  (``entry_year``, NULL for a line without a header). A job that reads one archive
  bucket or the last years opens only their folders on both sides. Inside, both
  are bucketed and sorted by (tenant, entry) alike (``operators/colocated.py``), so
  their join needs no shuffle;
* the store is keyed by the path, size and modification time of every input
  file (the store's own listing, so object stores work too) and a declared
  version of the rules, so a changed input is re-derived, and a table is
  derived only when a job first needs it;
* a table is written under a name of its own and
  moved into place whole once it is complete, so two drivers that build the
  same table at once never overwrite each other's files;
* a written table is durable: a lost executor re-reads it instead of
  recomputing the derivation, and so does the next driver.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.colocated import buckets_for, open_colocated, write_colocated
from ..session import adopt, input_bytes, input_state, path_complete, read_parquet, release, shared_root
from .standins import IN_MEMORY, TABLES, Standins

_LOCK = threading.RLock()          # guards the registries below
_MODELS: dict[tuple[int, str], "Model"] = {}
_BUILD_THREADS = 4                 # tables built side by side (Spark runs concurrent jobs)

# table -> sort columns inside its files
LAYOUT = {
    "accounts": ["client_code", "account"],
    "cloud_ledger": ["company_id", "day"],
    "timesheet": ["address_id", "day"],
}
# tables that are joined to each other -> (bucket keys, partition columns)
COLOCATED = {
    "headers": (["client_code", "entry_id"], ["archived", "year"]),
    "lines": (["client_code", "entry_id"], ["archived", "entry_year"]),
}
STORED = ["headers", "lines", "accounts", "journals", "address", "staff", "practice_fiscal_years",
          "timesheet", "missions", "contacts", "contact_links", "internal_ledger", "tenant_catalog",
          "sync_marks", "company", "company_identification", "cloud_ledger", "cloud_fiscal_years"]


#: Version of the stored layout and rules: raise it when a derivation changes.
VERSION = "5"


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the inputs: version, folder, and every input file's path, length and time."""
    h = hashlib.sha1(f"{VERSION}:{sf_dir}".encode())
    for t in TABLES:
        for state in input_state(spark, f"{sf_dir}/{t}.parquet"):
            h.update(f"{t}:{state}\n".encode())
    return h.hexdigest()[:16]


class Model(Standins):
    """Stand-in model tables served from the stored raw layer."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.state = _fingerprint(spark, self.sf_dir)
        self.root = f"{shared_root(spark)}/ledgerlake-model/{self.state}"
        self._frames: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.RLock] = {}

    def _lock(self, key: str) -> threading.RLock:
        """One lock per table: independent tables build concurrently, a table
        is built once. Layer dependencies are acyclic, so no deadlock."""
        with _LOCK:
            return self._locks.setdefault(key, threading.RLock())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stored(self, name: str) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        with self._lock(name):
            if name not in self._frames:
                self._frames[name] = self._load_or_build(name)
        return self._frames[name]

    def _derived(self, name: str, keys: list[str], buckets: int) -> DataFrame:
        """What is stored for ``name``, dealt to its buckets: its stand-in, headers with the
        day they were entered on, lines with the year of their header.

        Lines are shuffled once: their join to the stored headers is on the bucket keys,
        with the archive bucket as a further condition, and leaves them where they are.
        Only the headers of one bucket are held in memory for it, and no line is sorted."""
        df = getattr(Standins, name)(self).repartition(buckets, *keys)
        if name == "headers":
            return df.withColumn("entered_on", F.to_date("entered_at"))
        year = self.headers().select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("archived").alias("_archived"),
                                     F.col("year").alias("entry_year"))
        on = (F.col("archived") & F.col("_archived")) | (~F.col("archived") & ~F.col("_archived"))
        for k in keys:
            on = on & (F.col(k) == F.col(f"_{k}"))
        return df.join(year.hint("shuffle_hash"), on, "left").select(*df.columns, "entry_year")

    def _buckets(self) -> int:
        """One number for lines and headers: their join is between equal buckets. A
        bucket is sorted by one task, so what counts is the rows' size in memory."""
        size = sum(input_bytes(self.spark, f"{self.sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
        return buckets_for(size * IN_MEMORY, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def _load_or_build(self, name: str) -> DataFrame:
        if name in COLOCATED:
            return self._load_or_build_colocated(name)
        path, schema = self.path(name), None
        if not path_complete(self.spark, path):
            df = getattr(Standins, name)(self)
            schema = df.schema
            if name in LAYOUT:
                df = df.sortWithinPartitions(*LAYOUT[name])
            mine = f"{path}-{uuid.uuid4().hex[:12]}"
            df.write.mode("errorifexists").option("partitionOverwriteMode", "static").parquet(mine)
            adopt(self.spark, mine, path)
            release(self.spark)
        return read_parquet(self.spark, path, schema)

    def _load_or_build_colocated(self, name: str) -> DataFrame:
        keys, parts = COLOCATED[name]
        buckets = self._buckets()
        path = self.path(f"{name}-{buckets}-buckets")
        df = self._derived(name, keys, buckets)
        if not path_complete(self.spark, path):
            mine = f"{path}-{uuid.uuid4().hex[:12]}"
            write_colocated(df, mine, keys, buckets, parts, dealt=True)
            adopt(self.spark, mine, path)
            release(self.spark)
        return open_colocated(self.spark, path, df.schema, keys, buckets, parts)

    def lines(self) -> DataFrame:
        """All lines, as the source has them."""
        return self.stored("lines").drop("entry_year")

    def headers(self) -> DataFrame:
        """All headers, as the source has them."""
        return self.stored("headers").drop("entered_on")

    def booked_lines(self, archived: bool) -> DataFrame:
        """The lines of one archive bucket with the year of their header."""
        return self.stored("lines").filter(F.col("archived") == archived).drop("archived")

    def layer(self, name: str, build) -> DataFrame:
        """A built table of a later layer (clients, balances, master ...):
        computed by ``build()`` once, written, and read back by every job
        downstream of it, like the stored tables of the original layers."""
        key = f"layer:{name}"
        if key in self._frames:
            return self._frames[key]
        with self._lock(key):
            if key not in self._frames:
                path, schema = self.path(f"layers/{name}"), None
                if not path_complete(self.spark, path):
                    mine = f"{path}-{uuid.uuid4().hex[:12]}"
                    df = build()
                    df.write.mode("errorifexists").parquet(mine)
                    adopt(self.spark, mine, path)
                    release(self.spark)
                    schema = df.schema
                self._frames[key] = read_parquet(self.spark, path, schema)
        return self._frames[key]

    def build_all(self) -> None:
        """Derive every model table now (the ingest step of a pipeline run)."""
        run_concurrently([lambda n=name: self.stored(n) for name in STORED])


def run_concurrently(tasks, threads: int = _BUILD_THREADS) -> None:
    """Submit independent Spark jobs from a few driver threads, so small jobs
    share the executors instead of running one after another."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()


def _stored_method(name: str):
    def method(self: Model) -> DataFrame:
        return self.stored(name)
    method.__name__ = name
    method.__doc__ = getattr(Standins, name).__doc__
    return method


for _name in STORED:
    if _name not in COLOCATED:
        setattr(Model, _name, _stored_method(_name))


def model(spark: SparkSession, sf_dir: str) -> Model:
    """The (per session and input directory) shared model store."""
    key = (id(spark._jsparkSession), sf_dir.rstrip("/"))
    with _LOCK:
        known = _MODELS.get(key)
        if known is None or known.state != _fingerprint(spark, known.sf_dir):   # new, or the input has changed
            _MODELS[key] = Model(spark, sf_dir)
        return _MODELS[key]
