"""Incremental loads, sync marks and purges.

Marks are small per-tenant tables; they are joined (never collected), so an
incremental read is one plan: the filter on the header date reaches the
parquet scan's row groups, and the lines follow their headers by a semi join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import slices
from .upsert import upsert_merge

DEFAULT_MARK = dt.datetime(2000, 1, 1)


def ntz(value: dt.datetime) -> F.Column:
    """A wall-clock timestamp literal (TIMESTAMP_NTZ), independent of the
    session time zone, to compare with the sources' wall-clock times."""
    return F.to_timestamp_ntz(F.lit(value.strftime("%Y-%m-%d %H:%M:%S")))


def least_mark(marks: DataFrame, default: dt.datetime, tenants: DataFrame | None = None, kind: str = "timestamp_ntz") -> F.Column:
    """The earliest time from which any tenant's rows may be new, as a scalar
    subquery of type ``kind``: the least mark, or ``default`` where that is earlier and
    a tenant may have no mark. ``tenants`` says which there are; without it one may
    lack a mark. All is done inside the subquery, so what a scan gets is a plain value."""
    known = marks.select("client_code", F.col("last_sync").alias("_mark"))
    if tenants is None:
        return known.agg(F.least(F.min("_mark"), ntz(default)).cast(kind)).scalar()
    each = tenants.select("client_code").distinct().join(known, "client_code", "left")
    return each.agg(F.min(F.coalesce("_mark", ntz(default))).cast(kind)).scalar()


def incremental_headers(headers: DataFrame, marks: DataFrame, *, col: str = "entered_at",
                        table: str = "header", default: dt.datetime = DEFAULT_MARK,
                        text_format: str | None = None, tenants: DataFrame | None = None, day: str | None = None) -> DataFrame:
    """Headers entered at or after their tenant's mark (no mark: ``default``).

    The bound is inclusive: the mark is the start of the last run, and a header
    stamped in that very second may have been committed after it was read. The
    keyed upsert makes the overlap harmless. The least mark of all is a filter
    before the join, so only what may be new is shuffled to the marks. Parquet's
    readers skip row groups by the statistics of dates but not of wall-clock times,
    so a stored table should have the day of ``col`` in a DATE column: with ``day``
    naming it, old files and row groups aren't read. With ``text_format`` the column is
    text and parsed; a header whose text is no date comes in every time, as it
    can't be told whether it is new.
    """
    m = marks.filter(F.col("table") == table)
    when = F.col(col) if text_format is None else F.expr(f"try_to_timestamp({col}, '{text_format}')").cast("timestamp_ntz")
    if day is not None:      # alone: Spark would make one struct of two subqueries, which scans don't take
        some = headers.filter(F.col(day) >= least_mark(m, default, tenants, "date"))
    else:
        late = when >= least_mark(m, default, tenants, "timestamp_ntz" if text_format else headers.schema[col].dataType.simpleString())
        some = headers.filter(late if text_format is None else F.coalesce(late, F.lit(True)))
    h = some.join(m.select("client_code", F.col("last_sync").alias("_mark")), "client_code", "left")
    new = when >= F.coalesce(F.col("_mark"), ntz(default))
    return h.filter(new if text_format is None else F.coalesce(new, F.lit(True))).drop("_mark").select(*headers.columns)


def incremental_lines(lines: DataFrame, new_headers: DataFrame,
                      keys: tuple[str, ...] = ("client_code", "entry_id")) -> DataFrame:
    """Lines whose header is in the new-header set (LEFT SEMI, J11)."""
    return lines.join(new_headers.select(*keys), list(keys), "left_semi")


def incremental_since(df: DataFrame, col: str, marks: DataFrame, mark_col: str = "last_sync", *,
                      table: str | None = None, default: dt.datetime = DEFAULT_MARK) -> DataFrame:
    """Rows changed at or after the newest mark (inclusive ``>=``) of
    ``table`` (all marks if None). Before the first run there is no mark, and
    ``default`` stands for it: everything since then comes in.

    The mark is an uncorrelated scalar subquery: computed once, never
    collected to the driver by hand.
    """
    own = marks if table is None else marks.filter(F.col("table") == table)
    return df.filter(F.col(col) >= F.coalesce(own.agg(F.max(mark_col)).scalar(), ntz(default).cast(marks.schema[mark_col].dataType)))


def parse_since(text: str) -> F.Column:
    """Explicit since-date given as 'dd/MM/yyyy HH:mm:ss'."""
    return F.to_timestamp_ntz(F.lit(text), F.lit("dd/MM/yyyy HH:mm:ss"))


def run_marks(new_rows: DataFrame, *, table: str, run_start: dt.datetime,
              key: str = "client_code", kind: str = "incremental", tenants: DataFrame | None = None,
              run_end: dt.datetime | None = None, failed: DataFrame | None = None) -> DataFrame:
    """Tracking rows of one run: the mark is the run *start* (W14), so a row
    committed at the source while the run was reading is picked up next time
    (the keyed upsert makes the overlap harmless).

    Every tenant of ``tenants`` gets a row, one without new rows too (0 rows),
    so a quiet tenant is known from its first run on. A tenant in ``failed``
    is FAILED and gets no new mark: its next run starts where the last good one
    did. ``duration_s`` (S12) is the run's length, known once it has ended.
    """
    counts = new_rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    if tenants is not None:
        counts = tenants.select(key).distinct().join(counts, key, "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    bad = F.lit(False)
    if failed is not None:
        counts = counts.join(failed.select(key).distinct().withColumn("_bad", F.lit(True)), key, "left")
        bad = F.coalesce("_bad", F.lit(False))
    seconds = F.lit(None if run_end is None else int((run_end - run_start).total_seconds())).cast("long")
    return counts.select(F.lit(table).alias("table"), key, F.when(~bad, ntz(run_start)).alias("last_sync"),
                         F.lit(kind).alias("type"), F.when(bad, "FAILED").otherwise("SUCCESS").alias("status"),
                         "rows", seconds.alias("duration_s"))


def tracking_upsert(marks: DataFrame, run: DataFrame) -> DataFrame:
    """Merge a run's tracking rows into the marks on (table, tenant)."""
    r = run.select(*[F.col(c) if c in run.columns else F.lit(None).cast(marks.schema[c].dataType).alias(c)
                     for c in marks.columns])
    return upsert_merge(marks, r, ["table", "client_code"], ["last_sync"],
                        ["last_sync", "type", "status", "rows", "duration_s"],
                        keep_if_null=("last_sync", "type", "status", "duration_s"))


def reset_tracking(marks: DataFrame, table: str | None = None) -> DataFrame:
    """The marks after ``table`` (all tables if None) has been emptied:
    none are left for it, so its next run reads it from the start."""
    return marks.limit(0) if table is None else marks.filter(~F.col("table").eqNullSafe(table))


def empty_tables(tables: dict[str, DataFrame], marks: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every table without its rows, and the tracking reset for them."""
    left = marks
    for name in tables:
        left = reset_tracking(left, name)
    return {name: df.limit(0) for name, df in tables.items()}, left


def new_tenants(tenants: DataFrame, marks: DataFrame, key: str = "client_code") -> DataFrame:
    """Tenants with no mark yet (LEFT ANTI)."""
    return tenants.join(marks.select(key).distinct(), key, "left_anti")


def known_tenants(tenants: DataFrame, marks: DataFrame, key: str = "client_code") -> DataFrame:
    """Tenants already tracked (LEFT SEMI)."""
    return tenants.join(marks.select(key).distinct(), key, "left_semi")


def purge_tenant(df: DataFrame, code: str, key: str = "client_code") -> DataFrame:
    """The table without one tenant (rows without a code are nobody's and stay)."""
    return df.filter(~F.col(key).eqNullSafe(code))


def purge_year(lines: DataFrame, headers: DataFrame, year: int,
               keys: tuple[str, ...] = ("client_code", "entry_id")) -> tuple[DataFrame, DataFrame]:
    """Drop one year; lines go with their header (they carry no year)."""
    gone = headers.filter(F.col("year") == year).select(*keys)
    return (lines.join(gone, list(keys), "left_anti"),
            headers.filter(~F.col("year").eqNullSafe(F.lit(year))))


def purge_before(lines: DataFrame, headers: DataFrame, day: dt.date, col: str = "entered_at",
                 keys: tuple[str, ...] = ("client_code", "entry_id")) -> tuple[DataFrame, DataFrame]:
    """Drop entries entered before ``day`` and their lines."""
    old = F.col(col) < F.lit(day)
    gone = headers.filter(old).select(*keys)
    return (lines.join(gone, list(keys), "left_anti"), headers.filter(~old | F.col(col).isNull()))


def purge_slices(spark, roots: dict[str, StructType], slice_cols: list[str], gone: F.Column) -> dict[str, int]:
    """W16, W17, W19 on storage: every table of ``roots`` (root -> schema) loses the
    slices that ``gone`` holds for, such as a tenant or a year. No row is read.
    Returns the new version per table; the old one stays readable."""
    return {root: slices.drop_slices(spark, root, schema, slice_cols, gone) for root, schema in roots.items()}


def purge_before_stored(spark, lines: tuple[str, StructType, list[str]], headers: tuple[str, StructType, list[str]], day: dt.date, *,
                        col: str = "entered_at", keys: tuple[str, ...] = ("client_code", "entry_id")) -> tuple[DataFrame, DataFrame]:
    """W18 on storage: entries entered before ``day`` and their lines.

    Both tables are (root, schema, slice columns), sliced alike (by year). Only the
    slices that hold such an entry are read and written anew; a slice left without
    rows is gone. The lines go first: after a crash in between their headers are
    still there, and a second run finishes the purge. Returns both tables."""
    (lines_root, lines_schema, line_cols), (root, schema, cols) = lines, headers
    at, lines_at = slices.current(spark, root), slices.current(spark, lines_root)
    all_headers = slices.read(spark, root, schema, cols, version=at)
    old = F.col(col) < F.lit(day)
    touched = all_headers.filter(old).select(*cols).distinct()
    mine = touched.select(*[F.col(c).alias(n) for c, n in zip(cols, line_cols)])
    gone = all_headers.filter(old).select(*keys)
    some = slices.read(spark, lines_root, lines_schema, line_cols, only=mine, version=lines_at)
    slices.replace_slices(some.join(gone, list(keys), "left_anti").select(*lines_schema.fieldNames()), lines_root, line_cols,
                          touched=mine, base=lines_at)
    rest = slices.read(spark, root, schema, cols, only=touched, version=at).filter(~old | F.col(col).isNull())
    slices.replace_slices(rest, root, cols, touched=touched, base=at)
    return (slices.read(spark, lines_root, lines_schema, line_cols), slices.read(spark, root, schema, cols))


def incremental_plan(tables: dict[str, str | None], mode: str) -> dict[str, str]:
    """What each table does in a run. ``tables`` maps a table to its
    change-date column (None when it has none). In an incremental run a table
    without a date cannot be filtered and is skipped (it is reloaded by the
    next full run); in a full run every table is reloaded whole."""
    if mode not in ("full", "incremental"):
        raise ValueError("mode is 'full' or 'incremental'")
    if mode == "full":
        return {t: "full" for t in tables}
    return {t: ("incremental" if col else "skipped") for t, col in tables.items()}
