"""Joins on a tenant code, where one tenant may hold a third of the rows.

The small side (one row per tenant) is repeated once per salt and the large
side is dealt over (tenant, salt), so a hot tenant is spread over as many tasks
as the session has shuffle partitions, ``SALTS`` at least, even where neither side
is small enough to broadcast and whatever AQE decides.

Spark judges the repeated side by the size it has before it is repeated. Left to
itself it would broadcast that many copies of a side that is just small enough, so
they are joined by shuffle unless the caller says how many ``salts`` there are, for
a side whose copies any driver holds. Sides that grow with the input (clients,
accounts, years) aren't repeated at all: a plain join broadcasts them by their true
size or splits the hot partitions (AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salts_of(df: DataFrame) -> int:
    """Parts that a hot key is split into: the session's shuffle partitions."""
    return max(SALTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def salted_join(df: DataFrame, small: DataFrame, keys: list[str], how: str, spread_on: list[str], salts: int | None = None, *,
                null_safe: bool = False) -> DataFrame:
    """``df`` joined to ``small`` (unique on ``keys``); ``how`` is inner, left,
    left_semi or left_anti. ``spread_on`` are columns that vary within a tenant.
    With ``null_safe`` a NULL key meets a NULL key."""
    by_shuffle = salts is None
    salts = salts or salts_of(df)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread_on]), F.lit(salts)).cast("int")
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if by_shuffle:
        right = right.hint("merge")
    if not null_safe:
        return df.withColumn("_salt", salt).join(right, [*keys, "_salt"], how).drop("_salt")
    names = {k: f"_r{i}" for i, k in enumerate([*keys, "_salt"])}
    right = right.withColumnsRenamed(names)
    on = F.col("_salt") == F.col(names["_salt"])
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(names[k]))
    return df.withColumn("_salt", salt).join(right, on, how).drop("_salt", *names.values())
