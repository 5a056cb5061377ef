"""Write the formatted physical plans of the headline queries to docs/plans/.

Usage: python scripts/dump_plans.py [sf_dir]   (default sf0.01; results are collected)
Broadcast joins are off, as on tables too large for them: the plans show the
shuffles a hundred times the data would have.
"""
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.plans.catalog import QUERIES  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

KEYS = ["monthly_balance", "counterparty_legacy", "master_clients", "unified_ledger", "fiscal_year_overlap",
        "detect_services", "upsert_replace", "incremental_lines", "orphan_lines", "monthly_balance_cloud", "account_reference"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    os.makedirs(out, exist_ok=True)
    spark = build_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    for k in KEYS:
        df = QUERIES[k](spark, sf)
        df.collect()  # executes this DataFrame's own plan, so AQE shows its final plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        with open(os.path.join(out, f"{k}.txt"), "w") as fh:
            fh.write(buf.getvalue())
        print(k, "ok")
    spark.stop()


if __name__ == "__main__":
    main()
