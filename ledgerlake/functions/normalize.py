"""Column expressions shared by every job.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Source text is compared case-insensitively (the source databases used a
case-insensitive collation), which is why prefixes are tested on ``upper``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
HOURS = "decimal(10,2)"

# Account-class rule of the legacy tool and counterparty map.
LEGACY_CUSTOMER_PREFIX = "C"
LEGACY_SUPPLIER_PREFIX = "F"
LEGACY_CUSTOMER_CLASS = "4110"
LEGACY_SUPPLIER_CLASS = "4100"
CUSTOMER_ACCOUNT = "411"
SUPPLIER_ACCOUNT = "401"
UNKNOWN_JOURNAL = "UNKNOWN"
COMPANY_NO_LENGTH = 9


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """NULL or empty text."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def blank_to_null(c) -> Column:
    """Empty text becomes NULL (F16's NULLIF)."""
    return F.nullif(_c(c), F.lit(""))


# The sources compare codes without regard to case, accents and trailing blanks.
KEY_COLLATION = "UNICODE_CI_AI_RTRIM"


def key_of(c) -> Column:
    """Key form of a code: the code under the sources' collation. Grouping and
    joining on it treats ``411a`` and ``411A`` as one account, as the sources do;
    the code itself is kept and shown as written. Spark joins such columns by
    hash of their collation key but sorts to group them, so large tables are summed
    by the written code first (``sums_by_code``)."""
    return F.collate(_c(c), KEY_COLLATION)


def starts_with_ci(c, prefix: str) -> Column:
    """Case-insensitive prefix test (LIKE 'x%' under a _ci collation)."""
    return F.upper(_c(c)).startswith(prefix.upper())


def starts_with_any_case(c, prefix: str) -> Column:
    """The same test as ``starts_with_ci`` for an ASCII prefix, written as
    plain ``startswith`` on each case variant so parquet can push it down
    (``StringStartsWith``); ``upper()`` would block the pushdown."""
    c = _c(c)
    variants = {prefix, prefix.upper(), prefix.lower()}
    out = None
    for v in sorted(variants):
        t = c.startswith(v)
        out = t if out is None else (out | t)
    return out


def legacy_account_class(account) -> Column:
    """C* -> 4110, F* -> 4100, otherwise the first four characters."""
    a = _c(account)
    return (F.when(starts_with_ci(a, LEGACY_CUSTOMER_PREFIX), F.lit(LEGACY_CUSTOMER_CLASS))
            .when(starts_with_ci(a, LEGACY_SUPPLIER_PREFIX), F.lit(LEGACY_SUPPLIER_CLASS))
            .otherwise(F.left(a, F.lit(4))))


def cloud_account_class(account) -> Column:
    """The cloud tool always keeps the first four characters."""
    return F.left(_c(account), F.lit(4))


def legacy_counterparty_kind(account) -> Column:
    """customer for C*, supplier for F*, NULL otherwise (P5)."""
    a = _c(account)
    return (F.when(starts_with_ci(a, LEGACY_CUSTOMER_PREFIX), F.lit("customer"))
            .when(starts_with_ci(a, LEGACY_SUPPLIER_PREFIX), F.lit("supplier")))


def legacy_counterparty_account(account) -> Column:
    a = _c(account)
    return (F.when(starts_with_ci(a, LEGACY_CUSTOMER_PREFIX), F.lit(CUSTOMER_ACCOUNT))
            .when(starts_with_ci(a, LEGACY_SUPPLIER_PREFIX), F.lit(SUPPLIER_ACCOUNT)))


def cloud_counterparty_kind(account) -> Column:
    a = _c(account)
    return (F.when(a.startswith(CUSTOMER_ACCOUNT), F.lit("customer"))
            .when(a.startswith(SUPPLIER_ACCOUNT), F.lit("supplier")))


def cloud_counterparty_account(account) -> Column:
    a = _c(account)
    return (F.when(a.startswith(CUSTOMER_ACCOUNT), F.lit(CUSTOMER_ACCOUNT))
            .when(a.startswith(SUPPLIER_ACCOUNT), F.lit(SUPPLIER_ACCOUNT)))


def company_no_of(site_no) -> Column:
    """Company number = first nine characters of the site number."""
    return F.left(_c(site_no), F.lit(COMPANY_NO_LENGTH))


def valid_company_no(c) -> Column:
    """Not NULL, not empty, exactly nine characters; NULL-safe (never NULL)."""
    c = _c(c)
    return F.coalesce(F.length(c) == COMPANY_NO_LENGTH, F.lit(False))


def by_shuffle(side: DataFrame, how: str = "merge") -> DataFrame:
    """A side of a join that grows with the input (headers, account labels, clients),
    joined by shuffle or where it is stored. A plan made before the run takes a table's
    size from its Parquet files, and rows that compress well take many times that
    once they are broadcast, through the driver. On collated codes ``how`` is
    shuffle_hash: a sort would make the collation keys anew for each comparison."""
    return side.hint(how)


def left_join_valid(df: DataFrame, right: DataFrame, key: str, right_key: str, valid: Column) -> DataFrame:
    """LEFT JOIN on ``df[key] = right[right_key]`` where only rows with a
    ``valid`` key take part. The others (NULL, blank or malformed numbers, often
    a large share) get NULLs without being shuffled to one task. ``right`` is
    unique on its key and never broadcast; its key column is dropped."""
    ok = F.coalesce(valid, F.lit(False))
    joined = df.filter(ok).join(by_shuffle(right), F.col(key) == F.col(right_key), "left").drop(right_key)
    return joined.unionByName(df.filter(~ok), allowMissingColumns=True)


def parse_ymd(c) -> Column:
    """'yyyyMMdd' text to DATE; blank or bad text gives NULL (STR_TO_DATE)."""
    return F.try_to_date(blank_to_null(_c(c)), "yyyyMMdd")


def period_start(year, month) -> Column:
    """First day of (year, month); NULL where either is missing or out of range
    (a month of 13 or 127 is no month, whatever its first two digits say)."""
    y, m = _c(year).cast("int"), _c(month).cast("int")
    return F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def month_start(day) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(F.to_date(_c(day)), "MM")


def money(c) -> Column:
    return _c(c).cast(MONEY)


def money_sum(c) -> Column:
    """Sum of amounts, NULL amounts as 0 and an empty group as 0 (A2, A3)."""
    return F.coalesce(F.round(F.sum(F.coalesce(_c(c), F.lit(0).cast(MONEY))), 2),
                      F.lit(0).cast(MONEY)).cast(MONEY)


def lenient_year(c) -> Column:
    """Leading four characters of trimmed text as a number, NULL if not one."""
    return F.expr("try_cast(left(trim({0}), 4) as int)".format(_col_sql(c)))


def _col_sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("lenient_year takes a column name")


def no_test_name(name) -> Column:
    """NOT LIKE '%Test%' AND NOT LIKE '%Sandbox%'; a NULL name drops out."""
    n = F.lower(_c(name))
    return ~n.contains("test") & ~n.contains("sandbox")


def digits_only_phone(c) -> Column:
    return F.replace(_c(c), F.lit(" "), F.lit(""))
