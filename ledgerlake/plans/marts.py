"""Reporting marts (V1-V14, X2): steering, controlling and client deliverables.

Every mart is a function of built tables; none broadcasts a table that grows with
the clients or lines: master, client and year tables are joined by shuffle
(``normalize.by_shuffle``), and a hot key is split by AQE.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N

CLOSED, OPEN = "closed", "open"


def _flag(c: str):
    return F.coalesce(F.col(c), F.lit(False))


def _pct(count_col: str):
    """round(count * 100 / total, 2) over the whole (already aggregated) result."""
    total = F.sum(F.col(count_col)).over(Window.partitionBy())
    return F.round(F.col(count_col).cast("double") * 100.0 / total.cast("double"), 2)


# ---------------------------------------------------------------- steering (V1-V5)
def service_matrix(master: DataFrame) -> DataFrame:
    """V1: active clients x services; each service family counts once."""
    books = F.col("has_books_legacy") | F.col("has_books_cloud") | F.col("has_books_other")
    payroll = F.col("has_payroll") | F.col("has_payroll_alt")
    n = ((_flag("has_books_legacy").cast("int") + _flag("has_books_cloud").cast("int")
          + _flag("has_books_other").cast("int") > 0).cast("int")
         + (_flag("has_payroll").cast("int") + _flag("has_payroll_alt").cast("int") > 0).cast("int")
         + _flag("has_legal").cast("int") + _flag("has_audit").cast("int"))
    return master.filter(F.col("active")).select(
        "company_no", "client_code", "name", "office", "director", "manager", "accountant", "active",
        "has_books_legacy", "has_books_cloud", "has_books_other", books.alias("has_books"),
        "has_payroll", "has_payroll_alt", payroll.alias("has_any_payroll"),
        "has_legal", "has_audit", n.alias("services"))


def service_penetration(matrix: DataFrame) -> DataFrame:
    """V2: clients and share of clients by number of services (X1 on few rows)."""
    g = matrix.groupBy("services").agg(F.count(F.lit(1)).alias("clients"))
    return g.withColumn("pct_clients", _pct("clients"))


def staff_portfolio(master: DataFrame) -> DataFrame:
    """V3: active clients per (director, manager, accountant, office), five counters."""
    def count_if(cond, name):
        return F.sum(F.when(cond, 1).otherwise(0)).alias(name)
    books = F.col("has_books_legacy") | F.col("has_books_cloud") | F.col("has_books_other")
    payroll = F.col("has_payroll") | F.col("has_payroll_alt")
    return (master.filter(F.col("active"))
            .groupBy("director", "manager", "accountant", "office")
            .agg(F.count(F.lit(1)).alias("clients"),
                 count_if(books, "books_clients"), count_if(payroll, "payroll_clients"),
                 count_if(F.col("has_legal"), "legal_clients"), count_if(F.col("has_audit"), "audit_clients")))


def entries_exits(master: DataFrame, *, by_exit_month: bool = False) -> DataFrame:
    """V4: arrivals and departures by *entry* month and office (all clients).

    As in the original view an exit is counted in the client's entry month.
    ``by_exit_month=True`` is the corrected reading: arrivals by entry month,
    departures by exit month (one row per month and office with both counts).
    """
    gone = F.col("exit_date").isNotNull()
    if not by_exit_month:
        return (master.filter(F.col("entry_date").isNotNull())
                .groupBy(F.date_format("entry_date", "yyyy-MM").alias("month"), "office")
                .agg(F.sum(F.when(gone, 0).otherwise(1)).alias("entries"),
                     F.sum(F.when(gone, 1).otherwise(0)).alias("exits"),
                     F.sum(F.when(gone, -1).otherwise(1)).alias("net")))
    events = (master.filter(F.col("entry_date").isNotNull())
              .select(F.date_format("entry_date", "yyyy-MM").alias("month"), "office",
                      F.lit(1).alias("entries"), F.lit(0).alias("exits"))
              .unionByName(master.filter(gone).select(
                  F.date_format("exit_date", "yyyy-MM").alias("month"), "office",
                  F.lit(0).alias("entries"), F.lit(1).alias("exits"))))
    return (events.groupBy("month", "office")
            .agg(F.sum("entries").alias("entries"), F.sum("exits").alias("exits"))
            .withColumn("net", F.col("entries") - F.col("exits")))


def office_split(master: DataFrame) -> DataFrame:
    """V5: active clients by office, per source, and share of the total."""
    g = (master.filter(F.col("active")).groupBy("office")
         .agg(F.count(F.lit(1)).alias("clients"),
              F.sum(F.when(F.col("has_books_legacy"), 1).otherwise(0)).alias("legacy_clients"),
              F.sum(F.when(F.col("has_books_cloud"), 1).otherwise(0)).alias("cloud_clients")))
    return g.withColumn("pct_total", _pct("clients"))


# ---------------------------------------------------------------- controlling
def unified_ledger(balance: DataFrame, master: DataFrame, legacy: DataFrame, cloud: DataFrame,
                   *, after: dt.date) -> DataFrame:
    """V6: monthly balances of both tools with client attributes.

    Attributes come from the master client (by company number), else from the
    client of the row's own tool (J7: the source test sits in the join
    condition). Cloud rows are matched on the company id, which is what the
    balance stores as client code.
    """
    b = balance.filter(F.col("month") > F.lit(after))
    attrs = ["office", "name", "tax_category", "tax_regime", "legal_form", "director", "manager",
             "accountant"]
    m = master.filter(N.valid_company_no("company_no")).select(
        F.col("company_no").alias("m_no"), *[F.col(a).alias(f"m_{a}") for a in attrs])
    own = [legacy.select(F.lit("legacy").alias("source"), F.col("client_code").alias("t_code"), *attrs),
           cloud.select(F.lit("cloud").alias("source"), F.col("company_id").cast("string").alias("t_code"), *attrs)]
    # one row per client of a tool; the ledger's codes meet them under the sources' collation
    tools = (own[0].unionByName(own[1]).groupBy("source", N.key_of("t_code").alias("_client"))
             .agg(F.min(F.struct("t_code", *attrs)).alias("_t"))
             .select("source", "_client", *[F.col(f"_t.{a}").alias(f"t_{a}") for a in attrs]))
    out = N.left_join_valid(b, m, "company_no", "m_no", N.valid_company_no("company_no"))
    out = out.withColumn("_client", N.key_of("client_code")).join(N.by_shuffle(tools, "shuffle_hash"), ["source", "_client"], "left")

    def pick(a):
        return F.coalesce(F.col(f"m_{a}"), F.col(f"t_{a}"))
    return out.select(
        "source", pick("office").alias("office"), "client_code", pick("name").alias("client_name"),
        pick("tax_category").alias("tax_category"), pick("tax_regime").alias("tax_regime"),
        pick("legal_form").alias("legal_form"), pick("director").alias("director"),
        pick("manager").alias("manager"), pick("accountant").alias("accountant"),
        "month", "account", "account_label", "journal", "journal_label", "credits", "debits",
        "balance", "lines", "last_entered")


def dashboard_kpis(master: DataFrame, timesheets: DataFrame, *, as_of: dt.date) -> DataFrame:
    """V7: five KPIs and the current month in one row.

    Each KPI is an uncorrelated scalar subquery, planned once each; no join.
    """
    active = master.filter(F.col("active"))
    this_year = timesheets.filter(F.expr("try_cast(year_code as int)") == as_of.year)
    spark = master.sparkSession
    return spark.range(1).select(
        F.lit(as_of.strftime("%Y-%m")).alias("current_period"),
        active.agg(F.count(F.lit(1))).scalar().alias("active_clients"),
        active.filter(F.col("has_books_legacy")).agg(F.count(F.lit(1))).scalar().alias("legacy_clients"),
        active.filter(F.col("has_books_cloud")).agg(F.count(F.lit(1))).scalar().alias("cloud_clients"),
        this_year.agg(F.sum("hours").cast("decimal(18,2)")).scalar().alias("hours_this_year"),
        this_year.agg(F.countDistinct("client_code")).scalar().alias("clients_with_time"))


def hours_by_client(timesheets: DataFrame, master: DataFrame) -> DataFrame:
    """V8: hours per client, year code and service; distinct staff by name."""
    m = master.filter(~N.is_blank("client_code")).select(
        F.col("client_code").alias("m_code"), F.col("name").alias("client_name"), "office", "director", "manager")
    spent = timesheets.groupBy("client_code", "year_code", "service").agg(
        F.sum("hours").cast("decimal(18,2)").alias("total_hours"),
        F.countDistinct(F.concat("last_name", F.lit("-"), "first_name")).alias("staff"),
        F.count(F.lit(1)).alias("entries"))
    out = N.left_join_valid(spent, m, "client_code", "m_code", ~N.is_blank("client_code"))
    return out.select("client_code", "client_name", "office", "director", "manager", "year_code", "service",
                      "total_hours", "staff", "entries")


def hours_by_staff(timesheets: DataFrame) -> DataFrame:
    """V9: hours per staff member, year code and month; distinct clients."""
    return (timesheets.groupBy("last_name", "first_name", "office", "service", "function", "year_code",
                               F.date_format("day", "yyyy-MM").alias("month"))
            .agg(F.sum("hours").cast("decimal(18,2)").alias("total_hours"),
                 F.countDistinct("client_code").alias("clients")))


def latest_ends(years: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """(no, at, latest_<k>): per company number and date ``at`` on which one of its
    years ends, the latest end per source among years that start by then.

    A sweep over the dates of a number: starts bring their end, ends ask. Starts
    and ends of one date are one row, summed up before they are shuffled, so a
    number has at most a row per calendar day however many years it has.
    """
    ends = [F.max(F.when(F.col("brings") & (F.col("source") == s), F.col("end"))).alias(f"e{k}") for k, s in enumerate(sources)]
    point = lambda at, brings: F.struct(F.col(at).alias("at"), F.lit(brings).alias("brings"))
    dates = (years.select("no", "source", "end", F.explode(F.array(point("start", True), point("end", False))).alias("x"))
             .select("no", "source", "end", "x.at", "x.brings")
             .groupBy("no", "at").agg(*ends, F.max(~F.col("brings")).alias("asked")))
    upto = Window.partitionBy("no").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = dates.select("no", "at", "asked", *[F.max(f"e{k}").over(upto).alias(f"latest_{k}") for k in range(len(sources))])
    return swept.filter("asked").drop("asked")


def fiscal_year_overlap(years: DataFrame, master: DataFrame, sources: tuple[str, ...] = ("legacy", "cloud")) -> DataFrame:
    """Fiscal years with status and a flag for an overlapping year of the
    same company in another tool (J12).

    Another tool's year overlaps if it starts by this one's end and ends on or after
    this one's start; so does some year if and only if the latest end among those
    that start by then does. ``latest_ends`` finds it in one sorted sweep, where a join
    on the number would compare all years of a company with each other. Its rows
    are few per number and are joined back by number and end; a date that holds a
    large part of all years is split by AQE. Years without a company number or without both dates
    overlap nothing and take part in neither step.
    """
    whole = N.valid_company_no("company_no") & F.col("start").isNotNull() & F.col("end").isNotNull()
    keyed = years.filter(whole).withColumn("no", F.col("company_no")).withColumn("at", F.col("end"))
    latest = latest_ends(keyed.select("no", "source", "start", "end"), sources)
    swept = keyed.join(N.by_shuffle(latest), ["no", "at"], "left")
    others = [(F.col("source") != s) & F.coalesce(F.col(f"latest_{k}") >= F.col("start"), F.lit(False)) for k, s in enumerate(sources)]
    flagged = (swept.withColumn("possible_duplicate", F.coalesce(reduce(lambda x, y: x | y, others), F.lit(False)))
               .select(*years.columns, "possible_duplicate")
               .unionByName(years.filter(~whole).withColumn("possible_duplicate", F.lit(False))))
    return _with_master(flagged, master).select(
        "source", "client_code", "client_name", "office", "code", "start", "end", "closed",
        F.when(F.col("closed").isNotNull(), F.lit(CLOSED)).otherwise(F.lit(OPEN)).alias("status"),
        "possible_duplicate")


# ---------------------------------------------------------------- deliverables
def _with_master(df: DataFrame, master: DataFrame) -> DataFrame:
    """Client name and office by company number; only valid numbers are looked up."""
    m = master.filter(N.valid_company_no("company_no")).select(
        F.col("company_no").alias("m_no"), F.col("name").alias("client_name"), "office")
    return N.left_join_valid(df, m, "company_no", "m_no", N.valid_company_no("company_no"))


def counterparty_detail(cp: DataFrame, master: DataFrame) -> DataFrame:
    """V11."""
    return _with_master(cp, master).select(
        "source", "client_code", "client_name", "office", "month", "kind", "account_original",
        "account_mapped", "account_label", "journal", "journal_label", "debits", "credits", "balance",
        "lines")


def counterparty_monthly(cp: DataFrame, master: DataFrame) -> DataFrame:
    """Four sums per client, month, kind and mapped account."""
    sums = cp.groupBy("source", "client_code", "company_no", "month", "kind", "account_mapped").agg(
        *[F.sum(c).cast(N.MONEY).alias(f"total_{c}") for c in ("debits", "credits", "balance")],
        F.sum("lines").alias("total_lines"))
    return _with_master(sums, master).select(
        "source", "client_code", "client_name", "office", "month", "kind", "account_mapped",
        "total_debits", "total_credits", "total_balance", "total_lines")


def revenue_monthly(balance: DataFrame, master: DataFrame) -> DataFrame:
    """Revenue (credits - debits of 7* accounts) per client and month."""
    sums = (balance.filter(F.col("account").startswith("7"))
            .groupBy("source", "client_code", "company_no", "month")
            .agg(F.sum(F.col("credits") - F.col("debits")).cast(N.MONEY).alias("revenue")))
    return _with_master(sums, master).select(
        "source", "client_code", "client_name", "office", "month", "revenue",
        F.year("month").alias("year"), F.month("month").alias("month_no"))


def revenue_yoy(revenue: DataFrame) -> DataFrame:
    """Revenue next to the same month one year before.

    A self left join on month - 12 months: correct on sparse months, unlike
    lag(12), and an equi-join on (source, client, month).
    """
    prev = revenue.select("source", "client_code",
                          F.add_months("month", 12).alias("month"),
                          F.col("revenue").alias("revenue_prev_year"))
    out = revenue.join(N.by_shuffle(prev), ["source", "client_code", "month"], "left")
    return out.select("source", "client_code", "client_name", "office", "month", "year", "month_no",
                      "revenue", "revenue_prev_year",
                      (F.col("revenue") - F.col("revenue_prev_year")).cast(N.MONEY).alias("change"))


def top_counterparties(cp: DataFrame, master: DataFrame, *, as_of: dt.date) -> DataFrame:
    """Counterparties ranked by sum of absolute balances over 12 months."""
    recent = cp.filter(F.col("month") >= F.add_months(F.lit(as_of), -12))
    sums = recent.groupBy("source", "client_code", "company_no", "kind", "account_original", "account_label").agg(
        F.sum(F.abs("balance")).cast(N.MONEY).alias("total_amount"), F.sum("lines").alias("movements"))
    return _with_master(sums, master).select(
        "source", "client_code", "client_name", "office", "kind", "account_original", "account_label",
        "total_amount", "movements")
