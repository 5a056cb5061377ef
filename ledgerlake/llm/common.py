"""Helpers shared by the operators: stored intermediates, row keys, sampling.

Intermediate tables that are read more than once are written as Parquet under
the shared folder in ``spark.checkpoint.dir`` and read back. That cuts the
lineage, and a lost executor re-reads files instead of repeating the text pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_path

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared path and return the table read back."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{name}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the evaluation fold: crc32 of the id as text, modulo 4, is 2.
    A null id belongs to no fold and counts as not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def row_hash(cols: Iterable[str]) -> Column:
    """64 bits over a row's columns that tell repeated ids with other contents apart."""
    return F.xxhash64(*[F.col(c) for c in cols])


def drop_rows(docs: DataFrame, bad: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``docs`` without the rows whose key columns occur in ``bad``.

    ``keys`` maps a column of ``bad`` to the expression over ``docs`` it equals.
    Nulls are equal to nulls. Extra columns of ``docs`` pass through whatever
    they are called.
    """
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        *[e.alias(f"_k_{k}") for k, e in keys.items()])
    right = bad.select(*[F.col(k).alias(f"_b_{k}") for k in keys]).distinct()
    on = None
    for k in keys:
        c = F.col(f"_k_{k}").eqNullSafe(F.col(f"_b_{k}"))
        on = c if on is None else on & c
    return keyed.join(right, on, "left_anti").select("_row.*")


def slices(batch: pa.RecordBatch, column: str, chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with about ``chars`` bytes of text each, so that
    working arrays stay small however large an Arrow batch is. A single longer
    text is a range of its own."""
    sizes = [0 if v is None else len(v) for v in batch.column(column).cast(pa.large_binary()).to_pylist()]
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > chars:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def sample_per_class(rows: DataFrame, label: str, key: str, per_class: int) -> DataFrame:
    """At most ``per_class`` keys of every label, by the smallest hash of the key.

    The rank is cut on the map side (window group limit), so a label with a
    third of all rows sends only its first ``per_class`` rows.
    """
    from pyspark.sql import Window as W

    h = F.xxhash64(F.col(key).cast("string"))
    w = W.partitionBy(label).orderBy(h, F.col(key))
    return (rows.select(key, label).filter(F.col(label).isNotNull() & F.col(key).isNotNull()).distinct()
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_class).drop("_rn"))
