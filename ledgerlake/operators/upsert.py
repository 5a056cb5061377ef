"""Keyed writes without an ACID table format.

Open-source Spark on plain parquet has no MERGE. Each write mode is expressed
as a set operation that yields the *new table*:

* replace (W4):  base LEFT ANTI delta-keys  UNION ALL  latest delta row per key
* merge   (W5):  base FULL OUTER JOIN latest-delta on the key, chosen columns
                 updated, "keep if new is NULL" columns coalesced
* changes (W6):  latest change per key by sequence; deleted keys dropped
* insert-if-absent (W7): base UNION ALL (delta LEFT ANTI base)

"Latest row per key" is a grouped ``max_by`` over a struct ordering (the
order columns, then every column as a total tie-break), i.e. an aggregation
with a map-side partial step: a key that holds a third of the delta is
reduced per input partition before the shuffle, never sorted in one task.
Refreshes on storage (W1-W3, W22, W23) are versions of a sliced table
(``operators/slices.py``): nothing is overwritten in place, so a table may be
refreshed from itself and a failed job never leaves a half table.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import slices


def _extreme_per_key(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    """One row per key: the ``pick`` (max or min) of a struct that starts with the
    order columns and holds every other column once, so a row is carried once
    and ties are broken on all columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.dropDuplicates(keys)
    carried = [c for c in dict.fromkeys(order) if c not in keys] + rest
    row = F.struct(*[F.col(c) for c in carried])
    return df.groupBy(*keys).agg(pick(row).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken on all columns."""
    return _extreme_per_key(df, keys, order, F.max)


def upsert_replace(base: DataFrame, delta: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``delta`` replace whole base rows with the same key."""
    d = latest_per_key(delta.select(*base.columns), keys, order)
    return base.join(d.select(*keys), keys, "left_anti").unionByName(d)


def upsert_merge(base: DataFrame, delta: DataFrame, keys: list[str], order: list[str],
                 update_cols: list[str], keep_if_null: tuple[str, ...] = ()) -> DataFrame:
    """W5 (ON DUPLICATE KEY UPDATE): matched keys get ``update_cols`` from the
    delta, except that a column in ``keep_if_null`` keeps the old value when
    the new one is NULL; new keys are inserted whole; other rows are kept."""
    d = latest_per_key(delta.select(*base.columns), keys, order)
    b = base.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in base.columns if c not in keys],
                    F.lit(True).alias("_in_base"))
    n = d.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in base.columns if c not in keys],
                 F.lit(True).alias("_in_delta"))
    j = b.join(n, keys, "full_outer")
    in_base = F.coalesce(F.col("_in_base"), F.lit(False))
    in_delta = F.coalesce(F.col("_in_delta"), F.lit(False))
    cols = []
    for c in base.columns:
        if c in keys:
            cols.append(F.col(c))
            continue
        old, new = F.col(f"_b_{c}"), F.col(f"_n_{c}")
        if c in update_cols:
            upd = F.coalesce(new, old) if c in keep_if_null else new
            v = F.when(in_delta & in_base, upd).when(in_delta, new).otherwise(old)
        else:
            v = F.when(in_base, old).otherwise(new)
        cols.append(v.alias(c))
    return j.select(*cols)


def apply_changes(base: DataFrame, feed: DataFrame, keys: list[str], seq: str,
                  deleted: str = "deleted_at") -> DataFrame:
    """Apply a change feed; the latest change per key wins; a change with
    ``deleted`` set removes the key."""
    latest = latest_per_key(feed, keys, [seq])
    live = latest.filter(F.col(deleted).isNull()).select(*base.columns)
    return base.join(latest.select(*keys), keys, "left_anti").unionByName(live)


def insert_absent(base: DataFrame, delta: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W7 (INSERT IGNORE): only keys not yet in ``base`` are added; among
    duplicate new keys the first by ``order`` wins."""
    d = delta.select(*base.columns)
    first = _first_per_key(d, keys, order)
    return base.unionByName(first.join(base.select(*keys), keys, "left_anti"))


def _first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _extreme_per_key(df, keys, order, F.min)


def upsert_audit(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """How many delta keys would insert and how many would update.
    ``audit_row`` adds the run's status and duration."""
    d = delta.select(*keys).distinct()
    hit = d.join(base.select(*keys).distinct().withColumn("_hit", F.lit(1)), keys, "left")
    return hit.agg(F.sum(F.when(F.col("_hit").isNull(), 1).otherwise(0)).alias("inserted"),
                   F.sum(F.when(F.col("_hit").isNotNull(), 1).otherwise(0)).alias("updated"),
                   F.count(F.lit(1)).alias("delta_keys"))


def audit_row(audit: DataFrame, *, step: str, started: dt.datetime, ended: dt.datetime, error: str | None = None) -> DataFrame:
    """The audit of one step with its status and duration in seconds."""
    return audit.select(F.lit(step).alias("step"), "*", F.lit("SUCCESS" if error is None else "FAILED").alias("status"),
                        F.lit(error).cast("string").alias("error"),
                        F.lit(int((ended - started).total_seconds())).cast("long").alias("duration_s"))


def tenant_refresh(base: DataFrame, delta: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Every slice (tenant, source, company) present in ``delta`` is
    replaced whole, the slice without a value (NULL) like any other. A hot slice
    of ``base`` is split by AQE where the names of the slices aren't broadcast."""
    named = delta.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(slice_cols)]).distinct()
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(slice_cols)])
    kept = base.join(named, same, "left_anti")
    return kept.select(*base.columns).unionByName(delta.select(*base.columns))


# ------------------------------------------------------------------------- writers
def full_refresh(df: DataFrame, root: str, slice_cols: list[str] | None = None) -> DataFrame:
    """The table at ``root`` becomes ``df``, as a new version; slices that
    ``df`` doesn't have are gone. ``df`` may read the table it replaces. Returns it read back."""
    return slices.replace_all(df, root, slice_cols)


def slice_refresh(df: DataFrame, root: str, slice_cols: list[str], touched: DataFrame | None = None) -> DataFrame:
    """W2/W3/W23 on storage: the slices of ``df`` (or of ``touched``, where some may
    have no rows any more) replaced whole in the table at ``root``. Returns the table."""
    v = slices.replace_slices(df, root, slice_cols, touched=touched)
    return slices.read(df.sparkSession, root, df.schema, slice_cols, version=v)


def write_by_slice(df: DataFrame, path: str, slice_cols: list[str]) -> None:
    """A dataset laid out as ``path/<column>=<value>/`` (I1), the whole of it. The
    rebalance hint gives a small slice one file and a hot one as many tasks as its bytes need."""
    (df.hint("rebalance", *slice_cols).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*slice_cols).parquet(path))


def staged_write(spark: SparkSession, df: DataFrame, root: str) -> DataFrame:
    """Write ``df`` as a new version of the table at ``root``, then publish
    it. Readers see the old version or the new one, never a half-written one."""
    return slices.replace_all(df, root)
