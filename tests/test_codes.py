"""Codes under the sources' collation: case, accents and trailing blanks don't make two of one."""

import datetime as dt
from decimal import Decimal

from ledgerlake.plans import marts as V
from ledgerlake.plans import master as M
from ledgerlake.plans import staging as S

from .conftest import SMOKE


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cloud_accounts_and_journals_in_two_spellings(spark):
    ledger = spark.createDataFrame([
        (1, dt.date(2024, 1, 3), "411a", "x", "VÉ", "v", Decimal(5), None, dt.datetime(2024, 1, 3)),
        (1, dt.date(2024, 1, 9), "411A ", "y", "ve", "w", Decimal(7), Decimal(1), dt.datetime(2024, 1, 4)),
        (1, dt.date(2024, 1, 9), "411B", "z", None, None, Decimal(1), Decimal(1), dt.datetime(2024, 1, 4)),
    ], "company_id long, day date, account string, account_label string, journal string, journal_label string, debit decimal(18,2), "
       "credit decimal(18,2), updated timestamp_ntz")
    clients = spark.createDataFrame([(1, "123456789")], "company_id long, company_no string")
    got = S.monthly_balance_cloud(ledger, clients).select("account", "journal", "account_label", "debits", "credits", "lines")
    assert rows(got) == [("411A ", "VÉ", "y", Decimal(12), Decimal(1), 2), ("411B", "", "z", Decimal(1), Decimal(1), 1)]
    accounts = spark.createDataFrame([("t", "c1", "one"), ("t", "C1", "two"), ("t", "C2", None)], "client_code string, account string, label string")
    got = S.account_reference(accounts, ledger).select("source", "code", "label", "account_class")
    assert rows(got) == [("cloud", "411A ", "y", "411A"), ("cloud", "411B", "z", "411B"),
                         ("legacy", "C1", "two", "4110"), ("legacy", "C2", None, "4110")]
    journals = spark.createDataFrame([("t", "od", "a"), ("t", "OD ", "b"), ("t", "Od", None)], "client_code string, journal string, label string")
    got = S.journal_reference(journals, ledger).select("source", "code", "label")
    assert rows(got) == [("cloud", "", None), ("cloud", "VÉ", "w"), ("legacy", "OD ", "b")]


def test_client_codes_meet_across_tools(spark):
    attrs = "office string, name string, tax_category string, tax_regime string, legal_form string, director string, manager string, accountant string"
    legacy = spark.createDataFrame([("00éa1", *"abcdefgh")], "client_code string, " + attrs)
    cloud = spark.createDataFrame([], "company_id long, " + attrs)
    master = spark.createDataFrame([], "company_no string, " + attrs)
    balance = spark.createDataFrame([("legacy", "00EA1 ", dt.date(2024, 1, 1), "x", "j", None), ("cloud", "00EA1", dt.date(2024, 1, 1), "x", "j", None)],
                                    "source string, client_code string, month date, account string, journal string, company_no string")
    for c in ("account_label", "journal_label", "credits", "debits", "balance", "lines", "last_entered"):
        balance = balance.withColumn(c, V.F.lit(None).cast("string"))
    got = V.unified_ledger(balance, master, legacy, cloud, after=dt.date(2020, 1, 1)).select("source", "client_code", "client_name")
    assert rows(got) == [("cloud", "00EA1", None), ("legacy", "00EA1 ", "b")]


def test_services_skip_clients_without_a_code(spark):
    from ledgerlake.plans import catalog as C
    from ledgerlake.plans.model import model
    s = model(spark, SMOKE)
    master = C.master_table(s, False)
    detected = M.detect_services(s.internal_ledger(), C.service_patterns(s))
    got = M.apply_services(master, detected)
    assert got.count() == master.count()
    lower = got.filter("client_code like '%a' and has_payroll").count()
    assert lower > 0                                          # written in lower case by the practice, in upper case in the ledger
