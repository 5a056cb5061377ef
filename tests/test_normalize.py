"""Golden rows from the source documentation and F-operators."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import normalize as N


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def test_legacy_account_class_golden(spark):
    cases = {"C00123": "4110", "CDUPONT": "4110", "F99456": "4100", "512000": "5120",
             "c00017": "4110", "f1": "4100", "70": "70"}
    for acc, cls in cases.items():
        assert one(spark, N.legacy_account_class, acc) == cls, acc


def test_cloud_account_class_golden(spark):
    for acc, cls in {"411123": "4111", "401456": "4014", "512000": "5120"}.items():
        assert one(spark, N.cloud_account_class, acc) == cls


def test_counterparty_map(spark):
    assert one(spark, N.legacy_counterparty_kind, "C001") == "customer"
    assert one(spark, N.legacy_counterparty_account, "F001") == "401"
    assert one(spark, N.legacy_counterparty_kind, "512") is None
    assert one(spark, N.cloud_counterparty_kind, "401456") == "supplier"
    assert one(spark, N.cloud_counterparty_account, "411123") == "411"


def test_company_no_validity(spark):
    assert one(spark, N.valid_company_no, "123456789") is True
    assert one(spark, N.valid_company_no, "") is False
    assert one(spark, N.valid_company_no, None) is False
    assert one(spark, N.valid_company_no, "1234567") is False


def test_blank_and_dates(spark):
    assert one(spark, N.is_blank, "") is True
    assert one(spark, N.is_blank, None) is True
    assert one(spark, N.parse_ymd, "20240131") == dt.date(2024, 1, 31)
    assert one(spark, N.parse_ymd, "") is None
    assert one(spark, N.parse_ymd, "2024XX31") is None


def test_bad_month_gives_no_period(spark):
    df = spark.createDataFrame([(2024, 13), (2024, None), (2024, 2)], "y int, m int")
    got = [r[0] for r in df.select(N.period_start("y", "m")).collect()]
    assert got == [None, None, dt.date(2024, 2, 1)]


def test_lenient_year_code(spark):
    df = spark.createDataFrame([(" 2025X",), ("abc",), ("2024",)], "year_code string")
    got = [r[0] for r in df.select(N.lenient_year("year_code")).collect()]
    assert got == [2025, None, 2024]
    # kept with as-of 2026: 2025 > 2026 - 2
    assert got[0] > 2026 - 2


def test_test_names_dropped(spark):
    df = spark.createDataFrame([("Acme",), ("Test Co",), ("my sandbox",), (None,)], "name string")
    assert [r[0] for r in df.filter(N.no_test_name("name")).collect()] == ["Acme"]


def test_pushable_prefix_equals_case_insensitive_prefix(spark):
    vals = ["C001", "c001", "F9", "f", "", "411", "Cc", None, "xC"]
    df = spark.createDataFrame([(v,) for v in vals], "a string")
    got = df.select(N.starts_with_any_case("a", "C").alias("x"), N.starts_with_ci("a", "C").alias("y")).collect()
    assert all(r.x == r.y for r in got)
