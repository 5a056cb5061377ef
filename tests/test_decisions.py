"""One test per decision taken on a defect of the original."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import normalize as N
from ledgerlake.operators import incremental as I
from ledgerlake.plans import marts as V
from ledgerlake.plans import staging as S
from ledgerlake.session import work_path
from ledgerlake.sources import files as Fi


def test_all_null_amounts_sum_to_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "k string, v decimal(18,2)")
    got = df.groupBy("k").agg(N.money_sum("v").alias("s")).first()["s"]
    assert got == 0


def test_exits_are_counted_in_their_entry_month(spark):
    d = dt.date
    master = spark.createDataFrame([(d(2020, 1, 5), None, "X"), (d(2020, 1, 9), d(2023, 6, 1), "X")],
                                   "entry_date date, exit_date date, office string")
    got = {tuple(r) for r in V.entries_exits(master).collect()}
    assert got == {("2020-01", "X", 1, 1, 0)}


def test_purge_year_goes_through_the_header(spark):
    headers = spark.createDataFrame([("A", 1, 1999), ("A", 2, 2000)], "client_code string, entry_id int, year int")
    lines = spark.createDataFrame([("A", 1, 10), ("A", 1, 11), ("A", 2, 12)],
                                  "client_code string, entry_id int, line_id int")
    kept_lines, kept_headers = I.purge_year(lines, headers, 1999)
    assert sorted(r.line_id for r in kept_lines.collect()) == [12]
    assert [r.entry_id for r in kept_headers.collect()] == [2]


def test_cloud_counterparties_keyed_by_company_id(spark):
    d = dt.date
    ledger = spark.createDataFrame(
        [(1, 7, "Same name", d(2024, 1, 2), "411001", "c", None, "j", 5, 0, dt.datetime(2024, 1, 2)),
         (2, 8, "Same name", d(2024, 1, 3), "411001", "c", None, "j", 6, 0, dt.datetime(2024, 1, 3))],
        "line_id long, company_id long, company_name string, day date, account string, account_label string, "
        "journal string, journal_label string, debit int, credit int, updated timestamp_ntz"
    ).withColumn("debit", F.col("debit").cast("decimal(18,2)")).withColumn("credit", F.col("credit").cast("decimal(18,2)"))
    company = spark.createDataFrame([(7, "000000140"), (8, "000000160")], "company_id long, registration_no string")
    got = {(r.client_code, r.company_no) for r in
           S.counterparty_cloud(ledger, company, as_of=d(2024, 2, 1)).collect()}
    assert got == {("7", "000000140"), ("8", "000000160")}   # two companies, not merged by name


def test_csv_keeps_real_nulls(spark):
    df = spark.createDataFrame([("a", None, ""), ("b", "x", "y")], "k string, v string, w string")
    path = work_path(spark, "t_csv")
    Fi.write_csv(df, path)
    back = {tuple(r) for r in Fi.read_csv(spark, path, df.schema).collect()}
    assert back == {("a", None, ""), ("b", "x", "y")}   # NULL stays NULL, '' stays ''


def test_bad_period_rows_go_to_rejects_not_lost(spark):
    rows = spark.createDataFrame([("A", 1, "C1", 2000, 13), ("A", 2, "C1", 2000, 2)],
                                 "client_code string, entry_id int, account string, year int, month int"
                                 ).withColumn("journal", F.lit(None).cast("string"))
    rej = S.period_rejects(rows)
    assert [r.entry_id for r in rej.collect()] == [1]


def test_exit_month_variant(spark):
    d = dt.date
    master = spark.createDataFrame([(d(2020, 1, 5), None, "X"), (d(2020, 1, 9), d(2023, 6, 1), "X")],
                                   "entry_date date, exit_date date, office string")
    got = {tuple(r) for r in V.entries_exits(master, by_exit_month=True).collect()}
    assert got == {("2020-01", "X", 2, 0, 2), ("2023-06", "X", 0, 1, -1)}
