"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the driver tables.

A query builds the model tables it needs from the stand-ins and runs one job
of the library on them. Nothing is collected; the caller decides the action.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import incremental as I
from ..operators import quality as Q
from ..operators import slices
from ..operators import upsert as U
from ..operators.pattern_join import like_join
from ..session import work_path
from ..sources import extract as X
from ..sources import files as Fi
from ..sources import tenants as T
from ..streaming import ingest as ST
from . import marts as V
from . import master as M
from . import reports as R
from . import staging as S
from .model import Model, model, run_concurrently
from .standins import ACCOUNT_PREFIXES, CLOUD_AS_OF, LEGACY_AS_OF, literal_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# ----------------------------------------------------------------- job builders
# A builder computes one job's output from its inputs; downstream jobs read the
# stored table of that job (``Model.layer``), as the original layers read each
# other's tables instead of re-running the procedures.
def build_legacy_clients(s: Model) -> DataFrame:
    return S.client_star(s.address(), s.legal_forms(), s.staff(), s.activities(),
                         s.regions(), s.offices(), s.titles())


def build_cloud_clients(s: Model) -> DataFrame:
    return S.cloud_clients(s.company(), s.company_identification())


def build_legacy_balance(s: Model) -> DataFrame:
    return S.monthly_balance(s.booked_lines(True), s.archived_headers(), s.booked_lines(False),
                             s.current_headers(), s.accounts(), s.journals(),
                             legacy_clients(s), as_of=LEGACY_AS_OF)


def build_cloud_balance(s: Model) -> DataFrame:
    return S.monthly_balance_cloud(s.cloud_ledger(), cloud_clients(s))


def build_legacy_counterparty(s: Model) -> DataFrame:
    return S.counterparty_legacy(legacy_balance(s))


def build_cloud_counterparty(s: Model) -> DataFrame:
    return S.counterparty_cloud(s.cloud_ledger(), s.company(), as_of=CLOUD_AS_OF)


def build_fiscal_years(s: Model) -> DataFrame:
    return S.fiscal_years(s.practice_fiscal_years(), s.address(), s.cloud_fiscal_years(), s.company())


def build_timesheets(s: Model) -> DataFrame:
    return S.timesheets(s.timesheet(), s.missions(), s.staff(), s.offices(), s.services(),
                        s.functions(), s.tasks(), s.address(), as_of=CLOUD_AS_OF)


def service_patterns(s: Model) -> DataFrame:
    return literal_table(s.spark, M.SERVICE_PATTERNS, ["pattern", "service"])


def build_master(s: Model, with_services: bool = True) -> DataFrame:
    """P13, and with ``with_services`` the service flags of P14 applied to the
    stored P13 table (entity resolution is not run a second time)."""
    if not with_services:
        return M.master_clients(legacy_clients(s), cloud_clients(s))[0]
    detected = M.detect_services(s.internal_ledger(), service_patterns(s))
    return M.apply_services(master_table(s, False), detected)


# ----------------------------------------------------------------- stored layers
def legacy_clients(s: Model) -> DataFrame:
    return s.layer("clients_legacy", lambda: build_legacy_clients(s))


def cloud_clients(s: Model) -> DataFrame:
    return s.layer("clients_cloud", lambda: build_cloud_clients(s))


def legacy_balance(s: Model) -> DataFrame:
    return s.layer("balance_legacy", lambda: build_legacy_balance(s))


def cloud_balance(s: Model) -> DataFrame:
    return s.layer("balance_cloud", lambda: build_cloud_balance(s))


def all_balances(s: Model) -> DataFrame:
    return legacy_balance(s).unionByName(cloud_balance(s))


def all_counterparties(s: Model) -> DataFrame:
    return (s.layer("cp_legacy", lambda: build_legacy_counterparty(s))
            .unionByName(s.layer("cp_cloud", lambda: build_cloud_counterparty(s))))


def fiscal_year_table(s: Model) -> DataFrame:
    return s.layer("fiscal_years", lambda: build_fiscal_years(s))


def timesheet_table(s: Model) -> DataFrame:
    return s.layer("timesheets", lambda: build_timesheets(s))


def master_table(s: Model, with_services: bool = True) -> DataFrame:
    name = "master_services" if with_services else "master"
    return s.layer(name, lambda: build_master(s, with_services))


# ----------------------------------------------------------------- transform layer
@register("monthly_balance")
def q_monthly_balance(spark, sf_dir):
    return build_legacy_balance(model(spark, sf_dir))


@register("client_star")
def q_client_star(spark, sf_dir):
    return build_legacy_clients(model(spark, sf_dir))


@register("active_clients")
def q_active_clients(spark, sf_dir):
    return S.active_clients(model(spark, sf_dir).address())


@register("cloud_clients")
def q_cloud_clients(spark, sf_dir):
    return build_cloud_clients(model(spark, sf_dir))


@register("monthly_balance_cloud")
def q_monthly_balance_cloud(spark, sf_dir):
    return build_cloud_balance(model(spark, sf_dir))


@register("counterparty_legacy")
def q_counterparty_legacy(spark, sf_dir):
    return build_legacy_counterparty(model(spark, sf_dir))


@register("counterparty_cloud")
def q_counterparty_cloud(spark, sf_dir):
    return build_cloud_counterparty(model(spark, sf_dir))


@register("fiscal_years")
def q_fiscal_years(spark, sf_dir):
    return build_fiscal_years(model(spark, sf_dir))


@register("timesheets")
def q_timesheets(spark, sf_dir):
    return build_timesheets(model(spark, sf_dir))


@register("account_reference")
def q_account_reference(spark, sf_dir):
    s = model(spark, sf_dir)
    return S.account_reference(s.accounts(), s.cloud_ledger())


@register("journal_reference")
def q_journal_reference(spark, sf_dir):
    s = model(spark, sf_dir)
    return S.journal_reference(s.journals(), s.cloud_ledger())


@register("unified_lines")
def q_unified_lines(spark, sf_dir):
    s = model(spark, sf_dir)
    return S.unified_lines(s.archived_lines(), s.current_lines())


@register("period_rejects")
def q_period_rejects(spark, sf_dir):
    s = model(spark, sf_dir)
    return S.period_rejects(_all_rows(s)).select("client_code", "entry_id", "account", "year", "month")


@register("layer_counts")
def q_layer_counts(spark, sf_dir):
    s = model(spark, sf_dir)
    # counted where they are stored; a table not built yet is built and stored first
    tables = [("legacy_clients", legacy_clients(s)), ("cloud_clients", cloud_clients(s)),
              ("monthly_balance", all_balances(s)), ("counterparty", all_counterparties(s)),
              ("fiscal_years", fiscal_year_table(s)), ("timesheets", timesheet_table(s))]
    return R.layer_counts(tables)


# ----------------------------------------------------------------- master-data layer
@register("master_clients")
def q_master_clients(spark, sf_dir):
    return build_master(model(spark, sf_dir), with_services=False)


@register("master_rejects")
def q_master_rejects(spark, sf_dir):
    s = model(spark, sf_dir)
    return M.master_clients(legacy_clients(s), cloud_clients(s))[1]


@register("master_counts")
def q_master_counts(spark, sf_dir):
    return M.master_counts(master_table(model(spark, sf_dir), with_services=False))


@register("detect_services")
def q_detect_services(spark, sf_dir):
    s = model(spark, sf_dir)
    return M.detect_services(s.internal_ledger(), service_patterns(s))


ANY_PATTERNS = ["70_1%", "%00", "%64%", "5____0", "______", "%", "706100", "_0%4_0", "7%", "70\\%%"]


@register("pattern_hits")
def q_pattern_hits(spark, sf_dir):
    """J15 with patterns of every shape: how many distinct accounts of lines and fees each one matches."""
    s = model(spark, sf_dir)
    used = s.lines().select("account").unionByName(s.internal_ledger().select("account")).distinct()
    patterns = literal_table(spark, [(p,) for p in ANY_PATTERNS], ["pattern"])
    hits = like_join(used, patterns, "account", "pattern")
    return hits.groupBy("pattern").agg(F.count(F.lit(1)).alias("accounts"), F.min("account").alias("first"), F.max("account").alias("last"))


@register("staff_reference")
def q_staff_reference(spark, sf_dir):
    s = model(spark, sf_dir)
    return M.staff_reference(s.staff(), s.offices(), s.services(), s.functions())


@register("contacts")
def q_contacts(spark, sf_dir):
    s = model(spark, sf_dir)
    return M.contacts(s.contacts(), s.contact_links(), s.address(), s.functions(),
                      master_table(s, with_services=False))


@register("source_mix")
def q_source_mix(spark, sf_dir):
    return M.source_mix(master_table(model(spark, sf_dir), with_services=False))


# ----------------------------------------------------------------- marts
REPORT_AFTER = dt.date(1999, 12, 31)     # V6 cut-off (the view's fixed date, as a parameter)
PURGE_TENANT = "00042A"
PURGE_YEAR = 1999
PURGE_BEFORE = dt.date(1997, 1, 1)
REFRESHED_TENANT_SUFFIX = "7A"
RUN_START = dt.datetime(2001, 8, 1, 0, 0, 0)


def _matrix(s: Model) -> DataFrame:
    return V.service_matrix(master_table(s))


@register("service_matrix")
def q_service_matrix(spark, sf_dir):
    return _matrix(model(spark, sf_dir))


@register("service_penetration")
def q_service_penetration(spark, sf_dir):
    return V.service_penetration(_matrix(model(spark, sf_dir)))


@register("staff_portfolio")
def q_staff_portfolio(spark, sf_dir):
    return V.staff_portfolio(master_table(model(spark, sf_dir)))


@register("entries_exits")
def q_entries_exits(spark, sf_dir):
    return V.entries_exits(master_table(model(spark, sf_dir)))


@register("office_split")
def q_office_split(spark, sf_dir):
    return V.office_split(master_table(model(spark, sf_dir)))


@register("unified_ledger")
def q_unified_ledger(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.unified_ledger(all_balances(s), master_table(s), legacy_clients(s), cloud_clients(s),
                            after=REPORT_AFTER)


@register("dashboard_kpis")
def q_dashboard_kpis(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.dashboard_kpis(master_table(s), timesheet_table(s), as_of=CLOUD_AS_OF)


@register("hours_by_client")
def q_hours_by_client(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.hours_by_client(timesheet_table(s), master_table(s))


@register("hours_by_staff")
def q_hours_by_staff(spark, sf_dir):
    return V.hours_by_staff(timesheet_table(model(spark, sf_dir)))


@register("fiscal_year_overlap")
def q_fiscal_year_overlap(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.fiscal_year_overlap(fiscal_year_table(s), master_table(s))


@register("counterparty_detail")
def q_counterparty_detail(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.counterparty_detail(all_counterparties(s), master_table(s))


@register("counterparty_monthly")
def q_counterparty_monthly(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.counterparty_monthly(all_counterparties(s), master_table(s))


@register("revenue_monthly")
def q_revenue_monthly(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.revenue_monthly(all_balances(s), master_table(s))


@register("revenue_yoy")
def q_revenue_yoy(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.revenue_yoy(V.revenue_monthly(all_balances(s), master_table(s)))


@register("top_counterparties")
def q_top_counterparties(spark, sf_dir):
    s = model(spark, sf_dir)
    return V.top_counterparties(all_counterparties(s), master_table(s), as_of=LEGACY_AS_OF)


# ----------------------------------------------------------------- documented reports
def _all_rows(s: Model, from_year: int | None = None) -> DataFrame:
    return S.ledger_rows(s.booked_lines(True), s.archived_headers(), s.booked_lines(False), s.current_headers(), from_year=from_year)


@register("client_balance")
def q_client_balance(spark, sf_dir):
    return R.client_balance(_all_rows(model(spark, sf_dir), 1999), from_year=1999)


@register("top_clients_volume")
def q_top_clients_volume(spark, sf_dir):
    return R.top_clients_volume(model(spark, sf_dir).archived_lines(), 10)


@register("lines_per_year")
def q_lines_per_year(spark, sf_dir):
    return R.lines_per_year(_all_rows(model(spark, sf_dir)))


@register("import_state")
def q_import_state(spark, sf_dir):
    return R.import_state(model(spark, sf_dir).sync_marks())


@register("import_alerts")
def q_import_alerts(spark, sf_dir):
    return R.import_alerts(model(spark, sf_dir).sync_marks())


# ----------------------------------------------------------------- data quality
@register("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(model(spark, sf_dir).lines(), ["client_code", "line_id"])


@register("orphan_lines")
def q_orphan_lines(spark, sf_dir):
    s = model(spark, sf_dir)
    return Q.orphan_rows(s.lines(), s.headers(), ["client_code", "entry_id"])


@register("domain_check")
def q_domain_check(spark, sf_dir):
    h = model(spark, sf_dir).headers()
    rules = {
        "month_out_of_range": ~F.col("month").between(1, 12),
        "missing_journal": F.col("journal").isNull(),
        "client_code_too_long": F.length("client_code") > 20,
        "year_after_as_of": F.col("year") > LEGACY_AS_OF.year,
        "journal_too_long": F.length("journal") > 4,
    }
    return Q.domain_check(h, rules)


@register("reconcile_counts")
def q_reconcile_counts(spark, sf_dir):
    s = model(spark, sf_dir)
    return Q.reconcile_counts(s.lines(), _all_rows(s), "client_code")


# ----------------------------------------------------------------- write modes
def _line_base(s: Model) -> DataFrame:
    return U.latest_per_key(s.lines().filter(F.col("posted") < F.lit(dt.date(1999, 1, 1))),
                            ["client_code", "line_id"], ["posted"])


def _line_delta(s: Model) -> DataFrame:
    return (s.lines().filter(F.col("posted") >= F.lit(dt.date(1998, 7, 1)))
            .withColumn("debit", (F.col("debit") + F.lit(1)).cast("decimal(18,2)")))


@register("upsert_replace")
def q_upsert_replace(spark, sf_dir):
    s = model(spark, sf_dir)
    return U.upsert_replace(_line_base(s), _line_delta(s), ["client_code", "line_id"], ["posted"])


@register("upsert_audit")
def q_upsert_audit(spark, sf_dir):
    s = model(spark, sf_dir)
    return U.upsert_audit(_line_base(s), _line_delta(s), ["client_code", "line_id"])


def _account_delta(s: Model) -> DataFrame:
    j = s.parts_used(s.raw("part").filter((F.col("p_partkey") % 5 == 0) | (F.col("p_partkey") % 13 == 0)))
    prefix = F.element_at(F.array(*[F.lit(p) for p in ACCOUNT_PREFIXES]),
                          (F.col("l_partkey") % 10 + 1).cast("int"))
    return j.select("client_code",
                    F.concat(prefix, F.when(F.col("l_partkey") >= 100000, F.col("l_partkey").cast("string"))
                              .otherwise(F.lpad(F.col("l_partkey").cast("string"), 5, "0"))).alias("account"),
                    F.when(F.col("p_partkey") % 10 == 0, F.lit(None).cast("string"))
                     .otherwise(F.upper("p_name")).alias("label"))


@register("upsert_merge")
def q_upsert_merge(spark, sf_dir):
    s = model(spark, sf_dir)
    return U.upsert_merge(s.accounts(), _account_delta(s), ["client_code", "account"], ["label"],
                          ["label"], keep_if_null=("label",))


def _ledger_feed(s: Model) -> DataFrame:
    led = s.cloud_ledger()
    return (led.filter(F.col("day") >= F.lit(dt.date(2024, 1, 15)))
            .withColumn("credit", (F.coalesce(F.col("credit"), F.lit(0)) + F.lit(2)).cast("decimal(18,2)"))
            .withColumn("synchronised_at", F.col("updated") + F.expr("INTERVAL 1 DAY"))
            .withColumn("deleted_at", F.when(F.col("line_id") % 7 == 0, F.col("updated"))))


@register("apply_changes")
def q_apply_changes(spark, sf_dir):
    s = model(spark, sf_dir)
    base = s.cloud_ledger().filter(F.col("day") < F.lit(dt.date(2024, 1, 20)))
    return U.apply_changes(base, _ledger_feed(s), ["line_id"], "synchronised_at")


@register("insert_absent")
def q_insert_absent(spark, sf_dir):
    s = model(spark, sf_dir)
    comp = s.company()
    base = comp.filter(F.col("company_id") % 3 != 0)
    delta = comp.withColumn("name", F.upper("name"))
    return U.insert_absent(base, delta, ["company_id"], ["updated"])


@register("full_refresh")
def q_full_refresh(spark, sf_dir):
    return U.full_refresh(legacy_clients(model(spark, sf_dir)), work_path(spark, "clients"))


def _refreshed_tenants(lines: DataFrame) -> DataFrame:
    """A tenth of the tenants as a fresh extract would bring them."""
    return (lines.filter(F.col("client_code").endswith(REFRESHED_TENANT_SUFFIX))
            .withColumn("credit", (F.col("credit") + F.lit(5)).cast("decimal(18,2)")))


@register("tenant_refresh")
def q_tenant_refresh(spark, sf_dir):
    """The lines as a table sliced by tenant, then the re-extracted tenants replaced
    in a new version, which is made from the table itself."""
    lines = model(spark, sf_dir).lines()
    root = work_path(spark, "lines_by_tenant")
    stored = U.full_refresh(lines, root, ["client_code"])
    return U.slice_refresh(_refreshed_tenants(stored), root, ["client_code"])


@register("tenant_refresh_frame")
def q_tenant_refresh_frame(spark, sf_dir):
    s = model(spark, sf_dir)
    lines = s.lines()
    return U.tenant_refresh(lines, _refreshed_tenants(lines), ["client_code"])


# ----------------------------------------------------------------- incremental
def _new_headers(s: Model) -> DataFrame:
    return I.incremental_headers(s.stored("headers"), s.sync_marks(), day="entered_on").drop("entered_on")


@register("incremental_headers_tracked")
def q_incremental_headers_tracked(spark, sf_dir):
    """W8 where every tenant has a mark, none older than 1999: the scan starts at the
    least of them, not at the default."""
    s = model(spark, sf_dir)
    known = I.known_tenants(s.stored("headers"), s.sync_marks())
    late = s.sync_marks().withColumn("last_sync", F.col("last_sync") + F.expr("INTERVAL 1 YEAR"))
    return I.incremental_headers(known, late, tenants=s.sync_marks(), day="entered_on").drop("entered_on")


@register("incremental_headers")
def q_incremental_headers(spark, sf_dir):
    return _new_headers(model(spark, sf_dir))


@register("incremental_lines")
def q_incremental_lines(spark, sf_dir):
    s = model(spark, sf_dir)
    return I.incremental_lines(s.lines(), _new_headers(s))


@register("incremental_since")
def q_incremental_since(spark, sf_dir):
    led = model(spark, sf_dir).cloud_ledger()
    marks = (led.groupBy("journal")
             .agg((F.max("updated") - F.expr("INTERVAL 10 DAYS")).alias("last_sync")).withColumn("table", F.lit("ledger")))
    other = marks.select("journal", (F.col("last_sync") + F.expr("INTERVAL 9 DAYS")).alias("last_sync"), F.lit("header").alias("table"))
    return I.incremental_since(led, "updated", marks.unionByName(other), table="ledger")


@register("incremental_first_run")
def q_incremental_first_run(spark, sf_dir):
    """W10 before the first run: no mark of the table, so all since the default."""
    s = model(spark, sf_dir)
    return I.incremental_since(s.cloud_ledger(), "updated", s.sync_marks(), table="ledger")


@register("incremental_headers_text")
def q_incremental_headers_text(spark, sf_dir):
    """W8 on a source that stores the entry date as text; every 89th is no date."""
    s = model(spark, sf_dir)
    text = F.when(F.col("entry_id") % 89 == 0, "00/00/0000").otherwise(F.date_format("entered_at", "dd/MM/yyyy HH:mm:ss"))
    return I.incremental_headers(s.headers().withColumn("entered_at", text), s.sync_marks(), text_format="dd/MM/yyyy HH:mm:ss")


@register("known_tenants")
def q_known_tenants(spark, sf_dir):
    s = model(spark, sf_dir)
    return I.known_tenants(s.headers().select("client_code").distinct(), s.sync_marks())


@register("reset_tracking")
def q_reset_tracking(spark, sf_dir):
    """Two tables tracked, one emptied and its marks reset."""
    s = model(spark, sf_dir)
    both = s.sync_marks().unionByName(s.sync_marks().withColumn("table", F.lit("account")))
    return I.empty_tables({"header": s.headers()}, both)[1]


@register("import_listing")
def q_import_listing(spark, sf_dir):
    return R.import_listing(model(spark, sf_dir).sync_marks())


@register("import_sizes")
def q_import_sizes(spark, sf_dir):
    """D5 with sizes: the tracked header table next to the input tables as the store lists them."""
    s = model(spark, sf_dir)
    sizes = R.table_sizes(spark, {"header": f"{s.sf_dir}/orders.parquet", "line": f"{s.sf_dir}/lineitem.parquet"})
    return R.import_listing(s.sync_marks(), sizes).select(
        "table", "tenants", "failed", "rows", "latest_sync", "files", (F.col("bytes") > 0).alias("stored"),
        (F.col("bytes_per_row") > 0).alias("has_mean"))


@register("newest_delivery")
def q_newest_delivery(spark, sf_dir):
    """Three dated deliveries of the lines; the last is still being written, so the
    second is read, with the date it came on, and cleaned."""
    lines = model(spark, sf_dir).lines()
    root = work_path(spark, "deliveries")
    amounts = {"2024-01-31": F.col("debit"), "20240229": F.col("debit") + 1, "2024-03-31": F.col("debit") + 2}
    for day, debit in amounts.items():
        text = F.concat_ws("\t", "client_code", F.col("line_id").cast("string"), F.coalesce(debit.cast("string"), F.lit("\\N")))
        w = lines.select(text.alias("value")).write
        (w.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") if day == "2024-03-31" else w).text(f"{root}/lines_{day}")
    raw = Fi.read_delivery(spark, root, ["client_code", "line_id", "debit"])
    good, _ = Fi.clean_ledger_tsv(raw, amount_cols=["debit"], default_cols={}, required=["line_id"], casts={"line_id": "bigint"},
                                  carry=("file", "delivered"))
    return good.select("client_code", "line_id", "debit", "delivered", F.col("file").endswith(".txt").alias("named"))


@register("entries_exits_by_exit")
def q_entries_exits_by_exit(spark, sf_dir):
    return V.entries_exits(master_table(model(spark, sf_dir)), by_exit_month=True)


@register("purge_year_headers")
def q_purge_year_headers(spark, sf_dir):
    s = model(spark, sf_dir)
    return I.purge_year(s.lines(), s.headers(), PURGE_YEAR)[1]


@register("purge_before_headers")
def q_purge_before_headers(spark, sf_dir):
    s = model(spark, sf_dir)
    return I.purge_before(s.lines(), s.headers(), PURGE_BEFORE)[1]


@register("source_refresh")
def q_source_refresh(spark, sf_dir):
    """The cloud slice of the balances replaced whole, the legacy slice kept."""
    s = model(spark, sf_dir)
    delta = cloud_balance(s).withColumn("lines", F.col("lines") + 1)
    return U.tenant_refresh(all_balances(s), delta, ["source"])


@register("company_refresh")
def q_company_refresh(spark, sf_dir):
    """The ledger of every seventh company replaced by a fresh extract."""
    led = model(spark, sf_dir).cloud_ledger()
    delta = led.filter(F.col("company_id") % 7 == 0).withColumn("account_label", F.upper("account_label"))
    return U.tenant_refresh(led, delta, ["company_id"])


@register("source_refresh_stored")
def q_source_refresh_stored(spark, sf_dir):
    """W3 on storage: the balances sliced by source, the cloud slice replaced."""
    s = model(spark, sf_dir)
    root = work_path(spark, "balances")
    U.full_refresh(all_balances(s), root, ["source"])
    return U.slice_refresh(cloud_balance(s).withColumn("lines", F.col("lines") + 1), root, ["source"])


@register("company_refresh_stored")
def q_company_refresh_stored(spark, sf_dir):
    """W23 on storage: the ledger sliced by company; a fresh extract of every
    seventh company, in which each 21st has no rows any more."""
    led = model(spark, sf_dir).cloud_ledger()
    root = work_path(spark, "ledger")
    U.full_refresh(led, root, ["company_id"])
    asked = led.filter(F.col("company_id") % 7 == 0)
    fresh = asked.filter(F.col("company_id") % 21 != 0).withColumn("account_label", F.upper("account_label"))
    return U.slice_refresh(fresh, root, ["company_id"], touched=asked.select("company_id").distinct())


@register("purge_tenant_stored")
def q_purge_tenant_stored(spark, sf_dir):
    """W16 on storage: one tenant's slices dropped from lines and headers; the lines left."""
    s = model(spark, sf_dir)
    lines, headers = s.lines(), s.headers()
    roots = {work_path(spark, "lines"): lines, work_path(spark, "headers"): headers}
    for root, df in roots.items():
        U.full_refresh(df, root, ["client_code"])
    I.purge_slices(spark, {r: df.schema for r, df in roots.items()}, ["client_code"], F.col("client_code") == PURGE_TENANT)
    return slices.read(spark, next(iter(roots)), lines.schema, ["client_code"])


def _by_year(s: Model) -> tuple[tuple, tuple]:
    """Lines and headers as stored tables sliced by the entry's year: (root, schema, slice columns) of each."""
    out = []
    for df, col in ((s.stored("lines"), "entry_year"), (s.headers(), "year")):
        root = work_path(s.spark, "by_year")
        U.full_refresh(df, root, [col])
        out.append((root, df.schema, [col]))
    return out[0], out[1]


@register("purge_year_stored")
def q_purge_year_stored(spark, sf_dir):
    """W17 on storage: one year's slices dropped; lines left, those without a header too."""
    lines, headers = _by_year(model(spark, sf_dir))
    for root, schema, cols in (lines, headers):
        I.purge_slices(spark, {root: schema}, cols, F.col(cols[0]) == PURGE_YEAR)
    return slices.read(spark, *lines).drop("entry_year")


@register("purge_before_stored")
def q_purge_before_stored(spark, sf_dir):
    """W18 on storage: only the years that hold older entries are written anew."""
    lines, headers = _by_year(model(spark, sf_dir))
    return I.purge_before_stored(spark, lines, headers, PURGE_BEFORE)[0].drop("entry_year")


@register("purge_before_headers_stored")
def q_purge_before_headers_stored(spark, sf_dir):
    lines, headers = _by_year(model(spark, sf_dir))
    return I.purge_before_stored(spark, lines, headers, PURGE_BEFORE)[1]


@register("quality_alerts")
def q_quality_alerts(spark, sf_dir):
    """Q6: duplicate keys, orphans, periods and numbers that were rejected, failed imports."""
    s = model(spark, sf_dir)
    return R.quality_alerts([
        ("duplicate line keys", Q.duplicate_keys(s.lines(), ["client_code", "line_id"])),
        ("lines without a header", Q.orphan_rows(s.lines(), s.headers(), ["client_code", "entry_id"])),
        ("lines without a period", S.period_rejects(_all_rows(s))),
        ("rejected company numbers", M.master_clients(legacy_clients(s), cloud_clients(s))[1]),
        ("failed or slow imports", R.import_alerts(s.sync_marks()))])


@register("audit_row")
def q_audit_row(spark, sf_dir):
    """W24 with status and duration of the step."""
    audit = q_upsert_audit(spark, sf_dir)
    return U.audit_row(audit, step="lines", started=RUN_START, ended=RUN_START + dt.timedelta(seconds=95))


@register("tenant_union_frames")
def q_tenant_union_frames(spark, sf_dir):
    """I1 from one frame per source: the archived and the current bucket as two tenants' tables."""
    s = model(spark, sf_dir)
    return T.tenant_union({"archive": s.archived_lines(), "live": s.current_lines()}, "bucket")


@register("clean_ledger")
def q_clean_ledger(spark, sf_dir):
    return X.clean_ledger_projection(model(spark, sf_dir).cloud_ledger())


@register("copied_tables")
def q_copied_tables(spark, sf_dir):
    """I4: the practice tables copied, those matching an exclusion left out."""
    s = model(spark, sf_dir)
    tables = {"address": s.address(), "staff": s.staff(), "archived_header": s.archived_headers(), "account": s.accounts(),
              "current_header": s.current_headers(), "timesheet": s.timesheet()}
    return T.copy_tables(spark, tables, COPY_EXCLUDE, work_path(spark, "copied"))


@register("account_class")
def q_account_class(spark, sf_dir):
    """each account in use with its class and counterparty."""
    acc = model(spark, sf_dir).lines().select("account").distinct()
    return acc.select("account", S.N.legacy_account_class("account").alias("account_class"),
                      S.N.legacy_counterparty_kind("account").alias("kind"))


@register("company_no_split")
def q_company_no_split(spark, sf_dir):
    """cloud companies by whether their number is valid."""
    no = S.N.company_no_of("registration_no")
    return model(spark, sf_dir).company().select("company_id", no.alias("company_no"), S.N.valid_company_no(no).alias("valid"))


@register("drop_test_names")
def q_drop_test_names(spark, sf_dir):
    """companies that are not trials."""
    return model(spark, sf_dir).company().filter(S.N.no_test_name("name")).select("company_id", "name")


@register("tracking_upsert")
def q_tracking_upsert(spark, sf_dir):
    s = model(spark, sf_dir)
    tenants = s.headers().select("client_code")
    failed = tenants.filter(F.col("client_code").endswith("9A"))
    run = I.run_marks(_new_headers(s), table="header", run_start=RUN_START, run_end=RUN_START + dt.timedelta(minutes=90),
                      tenants=tenants, failed=failed)
    return I.tracking_upsert(s.sync_marks(), run)


@register("new_tenants")
def q_new_tenants(spark, sf_dir):
    s = model(spark, sf_dir)
    return I.new_tenants(s.headers().select("client_code").distinct(), s.sync_marks())


@register("purge_tenant")
def q_purge_tenant(spark, sf_dir):
    return I.purge_tenant(model(spark, sf_dir).lines(), PURGE_TENANT)


@register("purge_year")
def q_purge_year(spark, sf_dir):
    s = model(spark, sf_dir)
    return I.purge_year(s.lines(), s.headers(), PURGE_YEAR)[0]


@register("purge_before")
def q_purge_before(spark, sf_dir):
    s = model(spark, sf_dir)
    return I.purge_before(s.lines(), s.headers(), PURGE_BEFORE)[0]


# ----------------------------------------------------------------- sources
TENANT_PREFIX = "ledger_"
EXCLUDED_TENANTS = ["ledger_00000", "ledger_zz"]
COPY_EXCLUDE = ["^archived_", "_header$"]


@register("tenant_union")
def q_tenant_union(spark, sf_dir):
    lines = model(spark, sf_dir).lines()
    path = work_path(spark, "tenants")
    U.write_by_slice(lines, path, ["client_code"])
    return T.read_tenants(spark, path, lines.schema)


@register("eligible_tenants")
def q_eligible_tenants(spark, sf_dir):
    return T.eligible_tenants(model(spark, sf_dir).tenant_catalog(), prefix=TENANT_PREFIX,
                              excluded=EXCLUDED_TENANTS)


@register("eligible_tenants_unescaped")
def q_eligible_tenants_unescaped(spark, sf_dir):
    return T.eligible_tenants(model(spark, sf_dir).tenant_catalog(), prefix=TENANT_PREFIX,
                              excluded=EXCLUDED_TENANTS, escaped=False)


@register("tenant_code_check")
def q_tenant_code_check(spark, sf_dir):
    tenants = T.eligible_tenants(model(spark, sf_dir).tenant_catalog(), prefix=TENANT_PREFIX,
                                 excluded=EXCLUDED_TENANTS)
    return T.tenant_code_check(tenants, prefix=TENANT_PREFIX)


@register("copy_selection")
def q_copy_selection(spark, sf_dir):
    return T.copy_selection(model(spark, sf_dir).tenant_catalog(), COPY_EXCLUDE)


@register("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    clients = legacy_clients(model(spark, sf_dir))
    path = work_path(spark, "clients_csv")
    Fi.write_csv(clients, path)
    return Fi.read_csv(spark, path, clients.schema)


TSV_COLUMNS = ["client_code", "line_id", "entry_id", "account", "credit", "debit", "match_code"]


def _tsv(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Lines written as tab-separated text, with blank amounts, missing ids,
    bad amounts and lines of too many fields among them, read and cleaned."""
    lines = model(spark, sf_dir).lines()
    k = F.col("line_id")
    text = F.concat_ws("\t", "client_code", k.cast("string"),
                       F.when(k % 13 == 0, F.lit("")).otherwise(F.col("entry_id").cast("string")), "account",
                       F.when(k % 11 == 0, F.lit("")).when(k % 101 == 1, F.lit("12,x")).otherwise(F.col("credit").cast("string")),
                       F.when(k % 11 == 5, F.lit("")).otherwise(F.col("debit").cast("string")), "match_code",
                       F.when(k % 103 == 2, F.lit("one field more")))
    path = work_path(spark, "lines_tsv")
    lines.select(text.alias("value")).write.text(path)
    raw = Fi.read_tsv_text(spark, path, TSV_COLUMNS)
    return Fi.clean_ledger_tsv(raw, amount_cols=["credit", "debit"], default_cols={"match_code": "NONE"},
                               required=["entry_id"], casts={"line_id": "bigint", "entry_id": "bigint"})


@register("tsv_clean")
def q_tsv_clean(spark, sf_dir):
    return _tsv(spark, sf_dir)[0]


@register("tsv_rejects")
def q_tsv_rejects(spark, sf_dir):
    """Lines the load could not take, by reason."""
    rejects = _tsv(spark, sf_dir)[1]
    return rejects.select(F.split("line", "\t")[1].cast("long").alias("line_id"), "reason")


@register("paged_extract")
def q_paged_extract(spark, sf_dir):
    led = model(spark, sf_dir).cloud_ledger().select("line_id", "company_id", "day", "account",
                                                        "debit", "credit")
    # ranges and groups of a size that leaves several of each at any scale of the test data
    return X.extract_pages(led, "line_id", 1000, work_path(spark, "pages"), rows_per_range=50_000, ranges_per_group=4)


@register("clean_projection")
def q_clean_projection(spark, sf_dir):
    return X.clean_projection(model(spark, sf_dir).company())


# ----------------------------------------------------------------- streaming
@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Lines arrive as several source files in no particular order; a streaming
    run merges them two files per batch into a tenant-partitioned table
    (greatest row per key by posting date, whatever the arrival order)."""
    lines = model(spark, sf_dir).lines()
    source = work_path(spark, "stream_source")
    lines.coalesce(8).write.mode("overwrite").parquet(source)
    return ST.stream_ingest(spark, source, lines.schema, work_path(spark, "stream_target"),
                            work_path(spark, "stream_ckpt"), keys=["client_code", "line_id"],
                            order=["posted"], part_col="client_code", files_per_batch=2)


def build_layers(s: Model) -> None:
    """Write every stored layer (transform, then master data) for this input."""
    run_concurrently([lambda f=f: f(s) for f in (
        legacy_clients, cloud_clients, legacy_balance, cloud_balance, all_counterparties,
        fiscal_year_table, timesheet_table, lambda m: master_table(m, True),
        lambda m: master_table(m, False))])


@register("top_clients_lines")
def q_top_clients_lines(spark, sf_dir):
    """D3: the 20 clients with the most lines (both buckets)."""
    return R.top_clients_volume(model(spark, sf_dir).lines(), 20)


@register("incremental_since_date")
def q_incremental_since_date(spark, sf_dir):
    """Cloud rows changed since an explicit 'dd/MM/yyyy HH:mm:ss' date."""
    led = model(spark, sf_dir).cloud_ledger()
    return led.filter(F.col("updated") >= I.parse_since(SINCE_TEXT))


@register("staged_write")
def q_staged_write(spark, sf_dir):
    """The new master table written to a fresh versioned path, read back."""
    root = work_path(spark, "master")
    s = model(spark, sf_dir)
    U.staged_write(spark, build_master(s, with_services=False).limit(0), root)     # the version before
    return U.staged_write(spark, build_master(s, with_services=False), root)


SINCE_TEXT = "15/01/2024 12:00:00"
