"""Continuous ingest of a keyed table with Structured Streaming (W8-W15 re-aimed).

The original system reloads tenants on a schedule with sync marks. Here new
source files are picked up by a Structured Streaming file source; each
micro-batch is merged into the target table by ``foreachBatch``:

* the target is a table of slices (tenants) with versions
  (``operators/slices.py``). A batch reads only the slices it touches and
  publishes a version in which they are replaced. Nothing is overwritten in
  place: a crash at any point leaves the version before, with all its rows, and
  a reader that opened that one reads on; what a killed batch has written is
  swept later;
* the merge keeps, per key, the greatest row by the order columns over old and
  new rows together. That is commutative and idempotent: a late row older
  than the stored one changes nothing, and a batch replayed after a failure
  (foreachBatch is at-least-once) yields the same table;

The stream's own progress lives in ``checkpoint_location``; with
``Trigger.AvailableNow`` a run processes every file present and stops, which
is how a scheduled incremental load is expressed in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import slices
from ..operators.upsert import latest_per_key

ATTEMPTS = 3          # a batch is merged anew when another writer changed its slices meanwhile


def read_slices(spark: SparkSession, target: str, schema: StructType, part_col: str, only: DataFrame | None = None) -> DataFrame:
    """The table, or the slices whose values are in ``only``: just their folders are listed and read."""
    return slices.read(spark, target, schema, [part_col], only=only)


def merge_slices(spark: SparkSession, batch: DataFrame, target: str, schema: StructType,
                 keys: list[str], order: list[str], part_col: str) -> None:
    """Merge one batch into the sliced table at ``target``.

    Old and new rows are shuffled once: dealt by tenant, large tenants in parts by
    key, they are merged and written where they are. Where the tenant is no part of the
    key, the rows of a key may lie in several, and merging and writing each shuffle them."""
    batch = batch.select(*schema.fieldNames())
    if batch.isEmpty():
        return
    new = batch.groupBy(part_col).agg(F.count(F.lit(1)).alias("rows"))
    touched = new.select(part_col)
    for attempt in range(ATTEMPTS):
        base = slices.current(spark, target)
        old = slices.read(spark, target, schema, [part_col], only=touched, version=base)
        try:
            rows, dealt = old.unionByName(batch), part_col in keys
            if dealt:
                stored = slices.manifest(spark, target, schema, [part_col], base).select(F.col("key_0").alias(part_col), "rows")
                rows = slices.by_slice_parts(rows, new.unionByName(stored), [part_col], keys, "_part")
            latest = latest_per_key(rows, [*keys, "_part"] if dealt else keys, order).select(*schema.fieldNames())
            slices.replace_slices(latest, target, [part_col], base=base, dealt=dealt)
            return
        except slices.WriteConflict:
            if attempt == ATTEMPTS - 1:
                raise


def stream_ingest(spark: SparkSession, source_path: str, schema: StructType, target_path: str,
                  checkpoint_location: str, *, keys: list[str], order: list[str], part_col: str,
                  files_per_batch: int | None = None) -> DataFrame:
    """Ingest every file under ``source_path`` now, then return the target table."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_path)

    def apply(batch_df: DataFrame, batch_id: int) -> None:
        merge_slices(spark, batch_df, target_path, schema, keys, order, part_col)

    query = (stream.writeStream.foreachBatch(apply)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return read_slices(spark, target_path, schema, part_col)
