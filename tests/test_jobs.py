"""Jobs on small fixtures: brute-force checks, invariants, reference defects."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.plans import marts as V
from ledgerlake.plans import master as M
from ledgerlake.plans import staging as S
from ledgerlake.sources import extract as X
from ledgerlake.sources import tenants as T

from .conftest import SMOKE


def rows(df):
    return sorted(tuple(r) for r in df.collect())


CLIENT_COLS = ("client_code string, name string, company_no string, site_no string, title string, "
               "legal_form string, tax_category string, tax_regime string, city string, postal_code string, "
               "activity_code string, activity_label string, email string, phone string, director string, "
               "manager string, accountant string, office string, region string, internal_account string, "
               "entry_date string")
CLOUD_COLS = ("company_id long, name string, company_no string, external_id string, legal_form string, "
              "tax_category string, tax_regime string, city string, postal_code string, activity_code string, "
              "director string, manager string, accountant string, office string")


def legacy(spark, data):
    full = [(c, n, no) + (None,) * 3 + ("",) + (None,) * 13 + ("20200101",) for c, n, no in data]
    return spark.createDataFrame(full, CLIENT_COLS)


def cloud(spark, data):
    full = [(i, n, no, f"E{i}", "SAS", "IS", "RN") + (None,) * 7 for i, n, no in data]
    return spark.createDataFrame(full, CLOUD_COLS)


def test_master_clients_decisions(spark):
    lg = legacy(spark, [("00001", "a", "111111111"), ("00002", "b", "111111111"),
                        ("00003", "c", ""), ("00004", "d", "222222222")])
    cl = cloud(spark, [(10, "x", "222222222"), (11, "y", "222222222"), (12, "z", "333333333"),
                       (13, "w", None)])
    master, rejects = M.master_clients(lg, cl)
    got = {(r.client_code, r.company_no, r.company_id, r.has_books_legacy, r.has_books_cloud, r.tax_category)
           for r in master.collect()}
    assert got == {
        ("00001", "111111111", None, True, False, ""),        # smallest code wins the duplicate number
        ("00003", None, None, True, False, ""),               # invalid number becomes NULL
        ("00004", "222222222", 10, True, True, "IS"),         # smallest cloud id fills the blanks
        (None, "333333333", 12, False, True, "IS"),           # cloud-only valid number added
        (None, None, 13, False, True, "IS"),                  # invalid cloud number always added
    }
    assert rows(rejects.select("source", "row_key")) == [("cloud", "11"), ("legacy", "00002")]
    # no valid number lost or duplicated
    nos = [r.company_no for r in master.collect() if r.company_no]
    assert len(nos) == len(set(nos)) == 3


def test_fiscal_year_overlap_matches_brute_force(spark):
    d = dt.date
    years = spark.createDataFrame([
        ("legacy", "A", "111111111", "2020", d(2020, 1, 1), d(2020, 12, 31), None),
        ("cloud", "A", "111111111", "2020", d(2020, 7, 1), d(2021, 6, 30), d(2021, 9, 1)),
        ("legacy", "B", "222222222", "2019", d(2019, 1, 1), d(2019, 12, 31), None),
        ("cloud", "B", "222222222", "2020", d(2020, 1, 1), d(2020, 12, 31), None),
        ("legacy", "C", None, "2020", d(2020, 1, 1), d(2020, 12, 31), None),
        ("cloud", "C", "", "2020", d(2020, 1, 1), d(2020, 12, 31), None),
    ], "source string, client_code string, company_no string, code string, start date, end date, closed date")
    master = spark.createDataFrame([("111111111", "Acme", "North")], "company_no string, name string, office string")
    fast = {(r.source, r.client_code, r.possible_duplicate, r.status)
            for r in V.fiscal_year_overlap(years, master).collect()}
    brute = set()
    rs = years.collect()
    for a in rs:
        hit = any(b.company_no == a.company_no and b.company_no and b.source != a.source
                  and b.start <= a.end and b.end >= a.start for b in rs)
        brute.add((a.source, a.client_code, hit, "closed" if a.closed else "open"))
    assert fast == brute


def test_pages_match_row_number(spark, tmp_path):
    df = spark.range(0, 2500, 3).withColumnRenamed("id", "k").repartition(5)
    got = rows(X.extract_pages(df, "k", 100, f"{tmp_path}/p", rows_per_range=60, ranges_per_group=4).select("k", "row_no", "page"))
    keys = sorted(r[0] for r in df.collect())
    assert got == [(k, i + 1, i // 100) for i, k in enumerate(keys)]


def test_balance_totals_equal_line_totals(spark):
    s = __import__("ledgerlake.plans.standins", fromlist=["Standins"]).Standins(spark, SMOKE)
    from ledgerlake.plans import catalog as C
    m = C.model(spark, SMOKE)
    bal = C.build_legacy_balance(m)
    rows_ = S.ledger_rows(s.archived_lines(), s.archived_headers(), s.current_lines(), s.current_headers(),
                          from_year=1998)
    rows_ = rows_.filter(S.N.period_start("year", "month").isNotNull())
    a = bal.agg(F.sum("debits"), F.sum("credits"), F.sum("lines")).first()
    b = rows_.agg(F.sum("debit"), F.sum("credit"), F.count(F.lit(1))).first()
    assert (a[0], a[1], a[2]) == (b[0], b[1], b[2])


def test_eligibility_and_code_check(spark):
    cat = spark.createDataFrame(
        [("ledger_a", t) for t in T.REQUIRED_TABLES]
        + [("ledger_b", t) for t in T.REQUIRED_TABLES[:5]]
        + [("ledgerxc", t) for t in T.REQUIRED_TABLES]
        + [("ledger_" + "x" * 22, t) for t in T.REQUIRED_TABLES],
        "schema_name string, table_name string")
    strict = {r[0] for r in T.eligible_tenants(cat, prefix="ledger_", excluded=[]).collect()}
    loose = {r[0] for r in T.eligible_tenants(cat, prefix="ledger_", excluded=[], escaped=False).collect()}
    assert strict == {"ledger_a", "ledger_" + "x" * 22}      # b owns 5 tables only
    assert loose == strict | {"ledgerxc"}                     # unescaped '_' matches any char
    chk = {r.client_code: r.accepted for r in
           T.tenant_code_check(T.eligible_tenants(cat, prefix="ledger_", excluded=[]), prefix="ledger_").collect()}
    assert chk == {"A": True, "X" * 22: False}                # a 22-character code is rejected


def test_revenue_yoy_is_gap_safe(spark):
    d = dt.date
    rev = spark.createDataFrame([
        ("legacy", "A", None, None, d(2020, 1, 1), 2020, 1, 10),
        ("legacy", "A", None, None, d(2021, 1, 1), 2021, 1, 15),
        ("legacy", "A", None, None, d(2021, 3, 1), 2021, 3, 7),
    ], "source string, client_code string, client_name string, office string, month date, year int, "
       "month_no int, revenue int").withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    got = {(r.month, r.revenue_prev_year) for r in V.revenue_yoy(rev).collect()}
    assert got == {(d(2020, 1, 1), None), (d(2021, 1, 1), 10), (d(2021, 3, 1), None)}
