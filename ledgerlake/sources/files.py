"""Delimited-file sources and sinks.

Schemas are always given (no inference pass over the data). NULL is written
as a token the reader maps back, so text NULLs survive a round trip. Bulk files come
in dated folders, of which the newest complete one is read.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import listed_files, qualified

NULL_TOKEN = "NULL"


def write_csv(df: DataFrame, path: str, *, sep: str = ",", null_token: str = NULL_TOKEN) -> None:
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
     .option("quote", '"').option("escape", '"').option("nullValue", null_token)
     .option("emptyValue", '""').csv(path))


def read_csv(spark: SparkSession, path: str, schema: StructType, *, sep: str = ",",
             null_token: str = NULL_TOKEN) -> DataFrame:
    """Header line skipped, optional quotes, a NULL token, named columns."""
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("quote", '"').option("escape", '"').option("nullValue", null_token)
            .option("emptyValue", "").option("mode", "FAILFAST").csv(path))


def _fields(lines: DataFrame, columns: list[str], null_token: str, others: list[str] = ()) -> DataFrame:
    parts = lines.select(F.col("value").alias("_line"), F.split("value", "\t", -1).alias("_parts"), *others)
    value = lambda i: F.get("_parts", F.lit(i))
    return parts.select(*[F.when(value(i) != null_token, value(i)).alias(c) for i, c in enumerate(columns)],
                        *others, F.size("_parts").alias("_fields"), "_line")


def read_tsv_text(spark: SparkSession, path: str, columns: list[str], *, null_token: str = "\\N") -> DataFrame:
    """Tab-separated text, every column read as text (cleaning is separate).

    ``_fields`` is the number of fields of the line and ``_line`` its text, so
    that lines with missing or extra fields can be told apart and kept.
    """
    return _fields(spark.read.text(path), columns, null_token)


def clean_ledger_tsv(raw: DataFrame, *, amount_cols: list[str], default_cols: dict[str, str],
                     required: list[str], casts: dict[str, str], carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejects with their line and the reason). ``carry`` are
    columns that are no fields of the line, such as its file.

    Blank text is NULL for amounts, optional codes get their defaults, casts
    are typed. A line with a wrong number of fields, without a required id, or
    with text where a number belongs is a reject: nothing is cut off or lost,
    and no bad value stops the load.
    """
    names = [c for c in raw.columns if c not in ("_fields", "_line", *carry)]
    types = {**{c: "decimal(18,2)" for c in amount_cols}, **casts}
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    typed = {c: F.expr(f"try_cast(nullif(`{c}`, '') as {t})") for c, t in types.items()}
    reason = F.when(F.col("_fields") != len(names), F.lit("wrong number of fields"))
    for c in required:
        reason = reason.when(blank(c).isNull(), F.lit(f"no {c}"))
    for c in types:
        reason = reason.when(blank(c).isNotNull() & typed[c].isNull(), F.lit(f"bad {c}"))
    values = {c: F.coalesce(blank(c), F.lit(d)) for c, d in default_cols.items()} | typed
    judged = raw.select(*[values.get(c, F.col(c)).alias(c) for c in names], *carry, F.col("_line"), reason.alias("_reason"))
    return (judged.filter(F.col("_reason").isNull()).select(*names, *carry),
            judged.filter(F.col("_reason").isNotNull()).select(F.col("_line").alias("line"), F.col("_reason").alias("reason"), *carry))


# ------------------------------------------------------------------- dated folders
def dated_folders(spark: SparkSession, root: str, *, complete: str = "_SUCCESS") -> list[tuple[dt.date, str, bool]]:
    """(date, path, whether complete) of the deliveries under ``root``, ascending.

    A delivery is a folder whose name holds a date (``2024-01-31`` or ``20240131``); it
    is complete once its marker file ``complete`` is there. Names that hold no valid
    date are no deliveries. One listing of the store; two folders of one date stay
    in the order of their names.
    """
    base = root.rstrip("/")
    inside = f"{qualified(spark, base)}/"
    found: dict[str, bool] = {}
    for path, _, _ in listed_files(spark, base):
        folder, _, rest = path.removeprefix(inside).partition("/")
        if rest:
            found[folder] = found.get(folder, False) or rest == complete
    out = []
    for name, ok in found.items():
        m = re.search(r"(?<!\d)(\d{4})-?(\d{2})-?(\d{2})(?!\d)", name)
        try:
            out.append((dt.date(*map(int, m.groups())), f"{base}/{name}", ok) if m else None)
        except ValueError:
            continue
    return sorted(x for x in out if x)


def newest_delivery(spark: SparkSession, root: str, *, as_of: dt.date | None = None, complete: str = "_SUCCESS") -> tuple[dt.date, str]:
    """Date and path of the newest complete delivery (dated ``as_of`` or before).
    A newer one that is still being written doesn't count; none at all is an error."""
    good = [(day, path) for day, path, ok in dated_folders(spark, root, complete=complete) if ok and (as_of is None or day <= as_of)]
    if not good:
        raise FileNotFoundError(f"no complete delivery under {root}")
    return good[-1]


def read_delivery(spark: SparkSession, root: str, columns: list[str], *, as_of: dt.date | None = None, null_token: str = "\\N",
                  complete: str = "_SUCCESS") -> DataFrame:
    """The newest complete delivery's tab-separated lines (see ``read_tsv_text``)
    with the name of the ``file`` each one is from and the ``delivered`` date."""
    day, path = newest_delivery(spark, root, as_of=as_of, complete=complete)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    return _fields(lines, columns, null_token, ["file"]).withColumn("delivered", F.lit(day))
