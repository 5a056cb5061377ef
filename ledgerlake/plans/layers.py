"""Running the layers in order (W20, W21), and going on after a crash.

Each layer names the layers it reads. The run order is the topological order
of that graph (a cycle is an error). A layer is refused when one of the
tables it reads is empty, as the original shell steps refused to run on an
empty upstream, and any layer can be skipped by flag. Each table's row count
is recorded as the run report. The report is a handful of rows, one per
table with its duration; the tables themselves stay in storage.

With a ``ledger`` path every finished table is entered there, under the state of
the inputs (their files' paths, sizes and times). A run that is started again
on the same inputs takes finished tables from the ledger and goes on with the
first that is missing or failed; on other inputs it starts anew. Entries are only
ever added, one small file each, so a crash can't spoil those before.
"""

from __future__ import annotations

import datetime as dt
import time
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import latest_per_key
from ..session import input_state
from . import catalog as C
from .model import STORED, model

# layer -> layers it reads
DEPENDS = {
    "raw": [],
    "transform": ["raw"],
    "master": ["raw", "transform"],
    "mart": ["transform", "master"],
}

REPORT_SCHEMA = "layer string, table_name string, row_count long, status string, duration_s double"

# V1-V14 and the year-on-year revenue
MARTS = ["service_matrix", "service_penetration", "staff_portfolio", "entries_exits", "office_split", "unified_ledger",
         "dashboard_kpis", "hours_by_client", "hours_by_staff", "fiscal_year_overlap", "counterparty_detail",
         "counterparty_monthly", "revenue_monthly", "revenue_yoy", "top_counterparties"]


def run_order(depends: dict[str, list[str]] = DEPENDS) -> list[str]:
    try:
        return list(TopologicalSorter(depends).static_order())
    except CycleError as e:  # pragma: no cover - configuration error
        raise ValueError(f"layer dependencies form a cycle: {e.args[1]}") from e


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, callable]]:
    m = model(spark, sf_dir)
    return {
        "raw": {name: (lambda n=name: m.stored(n)) for name in STORED},
        "transform": {
            "clients_legacy": lambda: C.legacy_clients(m), "clients_cloud": lambda: C.cloud_clients(m),
            "balance_legacy": lambda: C.legacy_balance(m), "balance_cloud": lambda: C.cloud_balance(m),
            "counterparties": lambda: C.all_counterparties(m), "fiscal_years": lambda: C.fiscal_year_table(m),
            "timesheets": lambda: C.timesheet_table(m)},
        "master": {"master": lambda: C.master_table(m, False),
                   "master_services": lambda: C.master_table(m, True)},
        "mart": {name: (lambda n=name: C.QUERIES[n](spark, sf_dir)) for name in MARTS},
    }


LEDGER_SCHEMA = "state string, layer string, table_name string, row_count long, status string, duration_s double, entered timestamp, error string"


def enter(spark: SparkSession, ledger: str, state: str, row: tuple, error: str | None = None) -> None:
    """Add one table's outcome to the ledger."""
    entry = spark.createDataFrame([(state, *row, dt.datetime.now(), error)], LEDGER_SCHEMA)
    entry.coalesce(1).write.mode("append").parquet(ledger)


def ledger_rows(spark: SparkSession, ledger: str, state: str | None = None) -> DataFrame:
    """The latest entry of every (state, layer, table)."""
    if not input_state(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    return latest_per_key(rows if state is None else rows.filter(F.col("state") == state), ["state", "layer", "table_name"], ["entered"])


def run_layers(spark: SparkSession, sf_dir: str, skip: tuple[str, ...] = (),
               depends: dict[str, list[str]] = DEPENDS, ledger: str | None = None) -> DataFrame:
    """Build every layer in dependency order; return the run report. With ``ledger``
    tables that it has finished for these inputs are not built again (status ``kept``);
    a table that fails is entered as failed and the run ends with its error."""
    tables = _tables(spark, sf_dir)
    inputs = model(spark, sf_dir).state
    finished = {}
    if ledger:
        done = ledger_rows(spark, ledger, inputs).filter("status <> 'failed'")
        finished = {(r.layer, r.table_name): r.row_count for r in done.collect()}          # one row per table
    report: list[tuple] = []
    status: dict[str, str] = {}
    empty_tables: dict[str, bool] = {}
    for layer in run_order(depends):
        if layer in skip:
            status[layer] = "skipped"
            report.append((layer, None, None, "skipped by flag", None))
            continue
        # a skipped layer is not run again; its stored tables, from an earlier run or
        # built when first read, are what this layer works on
        blocked = [d for d in depends.get(layer, []) if status.get(d) not in ("done", "skipped")
                   or any(empty_tables.get((d, t)) for t in tables[d])]
        if blocked:
            status[layer] = "refused"
            report.append((layer, None, None, f"refused: upstream {', '.join(blocked)} empty or not run", None))
            continue
        for name, build in tables[layer].items():
            if (layer, name) in finished:
                n = finished[layer, name]
                empty_tables[(layer, name)] = n == 0
                report.append((layer, name, n, "kept", 0.0))
                continue
            began = time.monotonic()
            try:
                n = build().count()
            except Exception as e:
                if ledger:
                    enter(spark, ledger, inputs, (layer, name, None, "failed", round(time.monotonic() - began, 3)), str(e)[:500])
                raise
            empty_tables[(layer, name)] = n == 0
            row = (layer, name, n, "ok" if n else "empty", round(time.monotonic() - began, 3))
            report.append(row)
            if ledger:
                enter(spark, ledger, inputs, row)
        status[layer] = "done"
    return spark.createDataFrame(report, REPORT_SCHEMA)
