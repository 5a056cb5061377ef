"""Tables stored in buckets, so that joins on the bucket keys need no shuffle.

Two tables with the same number of buckets on the same keys hold equal keys in
equal buckets. Spark plans their join without an exchange on either side,
whatever their size, and still prunes by the partition columns (year, archive
bucket) and by the columns read. That pays wherever lines meet their headers:
every balance, report, purge and check joins them on (client, entry).

* Rows are dealt to the writers by the same hash as the buckets, so a table has
  one file per bucket and partition.
* The keys hold the entry, so a client with a third of the lines is spread over
  all buckets.
* Spark keeps bucketing in its catalog only. The files stay ordinary Parquet at a
  path of their own; ``open_colocated`` enters the table in the session's catalog
  when a new driver first reads it. The number of buckets is part of the path,
  so that a reader can't take it for another.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BUCKET_BYTES = 256 << 20          # input that one bucket of a table is made for


def buckets_for(input_bytes: int, least: int) -> int:
    """Buckets of a table made from so many bytes: the input decides, and a small
    table still has ``least``, one for each task that runs at a time."""
    return max(least, -(-input_bytes // BUCKET_BYTES))


def _quoted(*names: str) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write_colocated(df: DataFrame, path: str, keys: list[str], buckets: int, partition_by: list[str] = (), *,
                    dealt: bool = False) -> None:
    """Write ``df`` to the fresh ``path`` in ``buckets`` buckets on ``keys``, sorted
    by them, one folder per value of ``partition_by``. ``dealt`` says that the rows
    are in ``repartition(buckets, *keys)`` already and needn't be shuffled again."""
    spark = df.sparkSession
    name = f"writing_{uuid.uuid4().hex}"
    w = ((df if dealt else df.repartition(buckets, *keys)).write.mode("errorifexists").format("parquet")
         .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).option("partitionOverwriteMode", "static"))
    try:
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")      # an external table: its files stay


def open_colocated(spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int,
                   partition_by: list[str] = ()) -> DataFrame:
    """The table that ``write_colocated`` left at ``path``, with columns as in ``schema``."""
    name = "colocated_" + hashlib.sha1(f"{path}:{buckets}".encode()).hexdigest()[:20]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f"PARTITIONED BY ({_quoted(*partition_by)})" if partition_by else ""
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} "
                  f"CLUSTERED BY ({_quoted(*keys)}) SORTED BY ({_quoted(*keys)}) INTO {buckets} BUCKETS LOCATION '{place}'")
        if partition_by:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).select(*schema.fieldNames())
