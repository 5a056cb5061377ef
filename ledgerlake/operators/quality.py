"""Data-quality checks (Q1-Q4): each is one distributed pass that returns a report.

All checks aggregate before anything reaches the driver; a report is a
DataFrame a job may write or show.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q1: keys that occur more than once, with their count (HAVING count > 1)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def orphan_rows(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Q2: child rows whose key has no parent row (LEFT ANTI)."""
    return child.join(parent.select(*keys), keys, "left_anti")


def domain_check(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q3: one pass of conditional counts; a row per rule with its violations.

    ``rules`` maps a rule name to a predicate that is TRUE for a *violation*
    (NULL counts as no violation).
    """
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.sum(F.when(pred, 1).otherwise(0)).alias(name) for name, pred in rules.items()])
    agg = agg.select(F.col("_rows").alias("checked_rows"),
                     *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in rules])
    return agg.unpivot(["checked_rows"], list(rules), "rule", "violations").select(
        "rule", "violations", "checked_rows")


def reconcile_counts(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Q4: row counts per key on both sides (full outer join of two aggregates)."""
    s = source.groupBy(key).agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.groupBy(key).agg(F.count(F.lit(1)).alias("target_rows"))
    out = s.join(t, key, "full_outer")
    src = F.coalesce(F.col("source_rows"), F.lit(0))
    tgt = F.coalesce(F.col("target_rows"), F.lit(0))
    status = (F.when(F.col("target_rows").isNull(), F.lit("missing in target"))
              .when(F.col("source_rows").isNull(), F.lit("missing in source"))
              .when(src == tgt, F.lit("match")).otherwise(F.lit("mismatch")))
    return out.select(key, src.alias("source_rows"), tgt.alias("target_rows"),
                      (src - tgt).alias("difference"), status.alias("status"))
