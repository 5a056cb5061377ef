"""Transform layer: source tables -> normalised ledger tables.

Each job is a pure function of DataFrames. Joins to label and client
dimensions are placed *after* the aggregation wherever the label is a function
of the group key, so the big shuffle carries only keys and amounts and the
dimension join touches one row per group instead of one per ledger line.
No job forces a broadcast of a data-derived table. Sides that grow with the
lines or the clients are joined by shuffle (``normalize.by_shuffle``), as Spark would
judge them by their compressed files; small dimensions are left to Spark and AQE.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize as N

LEGACY = "legacy"
CLOUD = "cloud"
ACTIVE_CLIENT_KIND = "CLIENT"


# ------------------------------------------------------------------ P1 / P2
def active_clients(address: DataFrame) -> DataFrame:
    """Accounting clients whose exit date is blank."""
    return address.filter((F.col("kind") == ACTIVE_CLIENT_KIND) & N.is_blank("exit_date"))


def with_labels(df: DataFrame, *lookups: tuple[str, DataFrame, str, str]) -> DataFrame:
    """``df`` with one label column per lookup (code column, dimension, label
    column, name of the result). Each is a left join on the dimension's unique
    ``code`` (J3, J4: one dimension may serve several code columns)."""
    for code, dimension, label, name in lookups:
        right = dimension.select(F.col("code").alias(f"_{name}_code"), F.col(label).alias(name))
        df = df.join(right, df[code] == right[f"_{name}_code"], "left").drop(f"_{name}_code")
    return df


# source column -> column of the client table
CLIENT_COLUMNS = {
    "id": "address_id", "code": "client_code", "name": "name", "company_no": "company_no", "site_no": "site_no",
    "title": "title", "legal_form": "legal_form", "tax_type": "tax_category", "tax_regime": "tax_regime", "city": "city",
    "postal_code": "postal_code", "activity_code": "activity_code", "activity_label": "activity_label", "email": "email",
    "phone": "phone", "director": "director", "manager": "manager", "accountant": "accountant", "office": "office",
    "region": "region", "internal_account": "internal_account", "entry_date": "entry_date",
}


def client_star(address: DataFrame, legal_forms: DataFrame, staff: DataFrame,
                activities: DataFrame, regions: DataFrame, offices: DataFrame,
                titles: DataFrame) -> DataFrame:
    """Legacy clients with eight dimension labels (staff three times)."""
    roles = [(f"staff{k}", N.by_shuffle(staff), "email", role) for k, role in enumerate(("director", "manager", "accountant"), 1)]
    places = [("title_code", titles, "label", "title"), ("legal_code", legal_forms, "label", "legal_form"),
              ("activity_code", activities, "label", "activity_label"), ("region_code", regions, "label", "region"),
              ("office_code", offices, "label", "office")]
    labelled = (with_labels(active_clients(address), *places, *roles)
                .withColumn("company_no", N.company_no_of("site_no"))
                .withColumn("phone", N.digits_only_phone("phone")))
    return labelled.select(*[F.col(c).alias(name) for c, name in CLIENT_COLUMNS.items()])


def cloud_clients(company: DataFrame, identification: DataFrame) -> DataFrame:
    """Cloud companies with their identification; test/sandbox names dropped."""
    ident = identification.select(
        "company_id", "external_id",
        F.col("supervisor_email").alias("director"),
        F.col("manager_email").alias("manager"),
        F.col("accountant_email").alias("accountant"))
    return (company.filter(N.no_test_name("name"))
            .join(N.by_shuffle(ident), "company_id", "left")
            .select("company_id", "name",
                    N.company_no_of("registration_no").alias("company_no"),
                    "external_id", "firm", "trade_name", "legal_form",
                    "tax_category", "tax_regime", "city", "postal_code",
                    "activity_code", "sector", "director", "manager", "accountant",
                    F.col("firm").alias("office"), "created", "updated"))


# ------------------------------------------------------------------ P3 / P5
def ledger_rows(archived_lines: DataFrame, archived_headers: DataFrame,
                current_lines: DataFrame, current_headers: DataFrame,
                *, from_year: int | None = None, line_filter=None) -> DataFrame:
    """Lines joined to their header, archived UNION ALL current.

    ``from_year`` is applied to the headers before the join, and
    ``line_filter`` to the lines, so both reach the parquet scans. Lines that
    carry the year of their header (``entry_year``) are cut to those years too.
    """
    def branch(lines, headers):
        h = headers.select("client_code", "entry_id", "year", "month", "journal", "entered_at")
        ln = lines
        if from_year is not None:
            h = h.filter(F.col("year") >= from_year)
            if "entry_year" in lines.columns:
                ln = ln.filter(F.col("entry_year") >= from_year)
        ln = ln.select("client_code", "entry_id", "account", "debit", "credit")
        if line_filter is not None:
            ln = ln.filter(line_filter)
        return ln.join(N.by_shuffle(h), ["client_code", "entry_id"], "inner")

    return branch(archived_lines, archived_headers).unionByName(
        branch(current_lines, current_headers))


def _with_period(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("month_start", N.period_start("year", "month"))
            .withColumn("journal", F.coalesce(F.col("journal"), F.lit(N.UNKNOWN_JOURNAL))))


def sums_by_code(rows: DataFrame, keys: list[str], codes: list[str], latest: str, labels: tuple[str, ...] = ()) -> DataFrame:
    """Debits, credits, number of lines and newest ``latest`` per ``keys`` and
    ``codes``, codes that differ in case, accents or trailing blanks only being one.

    Two steps: the rows are summed by the codes as written, which Spark does by
    hash and partly before the shuffle; the sums, a small part of the rows, are
    put together under the sources' collation. Of several spellings the least is
    shown, of several labels the greatest; ``_<code>`` is the code's key form.
    """
    written = rows.groupBy(*keys, *codes, *labels).agg(
        N.money_sum("debit").alias("debits"), N.money_sum("credit").alias("credits"),
        F.count(F.lit(1)).alias("lines"), F.max(latest).alias("last_entered"))
    return written.groupBy(*keys, *[N.key_of(c).alias(f"_{c}") for c in codes]).agg(
        *[F.min(c).alias(c) for c in codes], *[F.max(c).alias(c) for c in labels],
        *[F.sum(c).cast(N.MONEY).alias(c) for c in ("debits", "credits")],
        F.sum("lines").alias("lines"), F.max("last_entered").alias("last_entered"))


def labels_by_code(table: DataFrame, code: str, label: str) -> DataFrame:
    """(client_code, _<code>, <code>_label): one row per client and code, whatever its spellings."""
    return (table.groupBy("client_code", N.key_of(code).alias(f"_{code}"))
            .agg(F.max(label).alias(f"{code}_label")))


def period_rejects(rows: DataFrame) -> DataFrame:
    """Ledger rows whose (year, month) gives no period (kept aside, not lost)."""
    return _with_period(rows).filter(F.col("month_start").isNull())


def monthly_balance(archived_lines: DataFrame, archived_headers: DataFrame,
                    current_lines: DataFrame, current_headers: DataFrame,
                    accounts: DataFrame, journals: DataFrame, clients: DataFrame,
                    *, as_of: dt.date) -> DataFrame:
    """Legacy monthly balance per (client, month, account, journal).

    The four-year window is pushed into both union branches; the group key is
    the table's unique key (labels are functions of it and are joined after
    the aggregation); codes are compared under the sources' collation (J6); rows
    without a valid period go to ``period_rejects``.
    """
    rows = _with_period(ledger_rows(archived_lines, archived_headers, current_lines,
                                    current_headers, from_year=as_of.year - 3))
    rows = rows.filter(F.col("month_start").isNotNull()).drop("month").withColumnRenamed("month_start", "month")
    agg = sums_by_code(rows, ["client_code", "month"], ["account", "journal"], "entered_at")
    out = (agg.join(N.by_shuffle(labels_by_code(accounts, "account", "label"), "shuffle_hash"), ["client_code", "_account"], "left")
           .join(labels_by_code(journals, "journal", "label"), ["client_code", "_journal"], "left"))
    # the practice's client list is another source: its codes meet the ledger's under the collation
    cli = clients.groupBy(N.key_of("client_code").alias("_client")).agg(F.min_by("company_no", "client_code").alias("company_no"))
    out = out.withColumn("_client", N.key_of("client_code")).join(N.by_shuffle(cli, "shuffle_hash"), "_client", "left")
    return out.select(
        F.lit(LEGACY).alias("source"), "client_code", "month", "account", "journal",
        "company_no", N.legacy_account_class("account").alias("account_class"),
        "account_label", "journal_label", "debits", "credits",
        (F.col("debits") - F.col("credits")).cast(N.MONEY).alias("balance"),
        "lines", "last_entered")


def counterparty_legacy(balance: DataFrame) -> DataFrame:
    """P5: customer (C*) and supplier (F*) accounts kept in detail, mapped 411/401.

    These are the rows of the stored monthly balance (P3) on such accounts:
    the same window, keys and sums, so nothing is joined or summed again.
    """
    is_cp = (N.starts_with_any_case("account", N.LEGACY_CUSTOMER_PREFIX)
             | N.starts_with_any_case("account", N.LEGACY_SUPPLIER_PREFIX))
    out = balance.filter((F.col("source") == LEGACY) & is_cp).withColumnRenamed("account", "account_original")
    return out.select(
        "source", "client_code", "month", "account_original", "journal",
        "company_no", N.legacy_counterparty_kind("account_original").alias("kind"),
        N.legacy_counterparty_account("account_original").alias("account_mapped"),
        "account_label", "journal_label", "debits", "credits", "balance", "lines", "last_entered")


# ------------------------------------------------------------------ P4 / P6
def _cloud_rows(ledger: DataFrame) -> DataFrame:
    """Ledger rows with their month; no journal is the journal ''."""
    return (ledger.withColumn("month", N.month_start("day"))
            .withColumn("journal", F.coalesce(F.col("journal"), F.lit(""))))


def monthly_balance_cloud(ledger: DataFrame, clients: DataFrame) -> DataFrame:
    """Cloud ledger by company, month, account and journal (NULL journal -> '').

    The client code is the company id as text; no date window.
    """
    agg = sums_by_code(_cloud_rows(ledger), ["company_id", "month"], ["account", "journal"], "updated",
                       ("account_label", "journal_label"))
    cli = clients.select("company_id", "company_no")
    out = agg.join(N.by_shuffle(cli), "company_id", "left")
    return out.select(
        F.lit(CLOUD).alias("source"), F.col("company_id").cast("string").alias("client_code"),
        "month", "account", "journal", "company_no",
        N.cloud_account_class("account").alias("account_class"),
        "account_label", "journal_label", "debits", "credits",
        (F.col("debits") - F.col("credits")).cast(N.MONEY).alias("balance"),
        "lines", "last_entered")


def counterparty_cloud(ledger: DataFrame, company: DataFrame, *, as_of: dt.date) -> DataFrame:
    """Cloud 411*/401* accounts of the last three years (by day).

    Keyed by company id (the reference keyed by name; decision in README).
    """
    since = F.add_months(F.lit(as_of), -36)
    rows = ledger.filter((F.col("day") >= since)
                         & (F.col("account").startswith(N.CUSTOMER_ACCOUNT)
                            | F.col("account").startswith(N.SUPPLIER_ACCOUNT)))
    rows = _cloud_rows(rows).withColumnRenamed("account", "account_original")
    agg = sums_by_code(rows, ["company_id", "month"], ["account_original", "journal"], "updated",
                       ("account_label", "journal_label"))
    comp = company.select("company_id", N.company_no_of("registration_no").alias("company_no"))
    out = agg.join(N.by_shuffle(comp), "company_id", "left")
    return out.select(
        F.lit(CLOUD).alias("source"), F.col("company_id").cast("string").alias("client_code"),
        "month", "account_original", "journal", "company_no",
        N.cloud_counterparty_kind("account_original").alias("kind"),
        N.cloud_counterparty_account("account_original").alias("account_mapped"),
        "account_label", "journal_label", "debits", "credits",
        (F.col("debits") - F.col("credits")).cast(N.MONEY).alias("balance"),
        "lines", "last_entered")


# ------------------------------------------------------------------ P7 / P8
def fiscal_years(practice_years: DataFrame, address: DataFrame,
                 cloud_years: DataFrame, company: DataFrame) -> DataFrame:
    """Legacy fiscal years of active clients UNION cloud fiscal years.

    The left join to the address followed by a filter on address columns is
    an inner join (J9); Catalyst rewrites it.
    """
    a = active_clients(address).select(F.col("id").alias("address_id"),
                                       F.col("code").alias("client_code"),
                                       N.company_no_of("site_no").alias("company_no"))
    legacy = (practice_years.join(N.by_shuffle(a), "address_id", "inner")
              .select(F.lit(LEGACY).alias("source"), "client_code",
                      N.parse_ymd("start").alias("start"),
                      F.col("id").alias("origin_id"), "company_no", "code",
                      N.parse_ymd("end").alias("end"),
                      F.when(F.col("closed") != "", N.parse_ymd("closed")).alias("closed")))
    comp = company.select("company_id", N.company_no_of("registration_no").alias("company_no"))
    cloud = (cloud_years.join(N.by_shuffle(comp), "company_id", "left")
             .select(F.lit(CLOUD).alias("source"),
                     F.col("company_id").cast("string").alias("client_code"),
                     "start", F.lit(None).cast("long").alias("origin_id"), "company_no",
                     F.col("start_year").cast("string").alias("code"), "end", "closed"))
    return legacy.unionByName(cloud)


def timesheets(time: DataFrame, missions: DataFrame, staff: DataFrame, offices: DataFrame,
               services: DataFrame, functions: DataFrame, tasks: DataFrame,
               address: DataFrame, *, as_of: dt.date) -> DataFrame:
    """Time entries with seven dimensions; recent year codes; staff not gone.

    The staff table is labelled first (it is the small side), so the entries
    are joined to four tables, not seven. An entry whose staff code is unknown
    is kept: its exit date is NULL, which counts as not gone.
    """
    people = with_labels(staff, ("office_code", offices, "label", "office"), ("service_code", services, "label", "service"),
                         ("function_code", functions, "label", "function"))
    people = people.select(F.col("code").alias("staff_code"), "last_name", "first_name", "office", "service", "function",
                           F.col("exit_date").alias("_left"))
    work = missions.select(F.col("id").alias("mission_id"), F.col("label").alias("mission"),
                           N.parse_ymd("start").alias("mission_start"), N.parse_ymd("end").alias("mission_end"))
    client = address.select(F.col("id").alias("address_id"), F.col("code").alias("client_code"),
                            N.company_no_of("site_no").alias("company_no"))
    entries = with_labels(time.filter(N.lenient_year("year_code") > as_of.year - 2).withColumnRenamed("id", "time_id"),
                          ("task_code", tasks, "label", "task"))
    for side, key in ((N.by_shuffle(people), "staff_code"), (work, "mission_id"), (N.by_shuffle(client), "address_id")):
        entries = entries.join(side, key, "left")
    return entries.filter(N.is_blank("_left")).select(
        "time_id", "client_code", "company_no", "last_name", "first_name", "office", "service", "function",
        "mission", "task", "memo", "hours", "day", "entered", "mission_start", "mission_end", "year_code")


# ------------------------------------------------------------------ P10-P12
def _references(legacy: DataFrame, ledger: DataFrame, code: str) -> DataFrame:
    """(source, client_code, code, label) of both tools; codes that only differ in
    case, accents or trailing blanks are one, shown by their least spelling."""
    rows = [legacy.select(F.lit(LEGACY).alias("source"), "client_code", F.col(code).alias("code"), "label")]
    cloud = ledger.groupBy(F.col("company_id").cast("string").alias("client_code"),
                           (F.coalesce(code, F.lit("")) if code == "journal" else F.col(code)).alias("code"),
                           F.col(f"{code}_label").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows.append(cloud.select(F.lit(CLOUD).alias("source"), "client_code", "code", "label"))
    return (rows[0].unionByName(rows[1]).groupBy("source", "client_code", N.key_of("code").alias("_code"))
            .agg(F.min("code").alias("code"), F.max("label").alias("label")).drop("_code"))


def account_reference(legacy_accounts: DataFrame, ledger: DataFrame) -> DataFrame:
    """P10: distinct (source, client, account) with label and class."""
    classed = F.when(F.col("source") == LEGACY, N.legacy_account_class("code")).otherwise(N.cloud_account_class("code"))
    return _references(legacy_accounts, ledger, "account").withColumn("account_class", classed)


def journal_reference(legacy_journals: DataFrame, ledger: DataFrame) -> DataFrame:
    """Distinct (source, client, journal) with label."""
    return _references(legacy_journals, ledger, "journal")


def unified_lines(archived_lines: DataFrame, current_lines: DataFrame) -> DataFrame:
    """P12 (doc): one line table over both buckets, tagged with its bucket."""
    return (archived_lines.withColumn("archived", F.lit(True))
            .unionByName(current_lines.withColumn("archived", F.lit(False))))
