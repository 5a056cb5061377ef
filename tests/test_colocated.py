"""Bucketed lines and headers: joins without a shuffle, years pruned on both sides, also from a new session."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.colocated import buckets_for, open_colocated, write_colocated
from ledgerlake.operators.quality import orphan_rows
from ledgerlake.plans import catalog as C
from ledgerlake.plans.model import model

from .conftest import SMOKE


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_header_join_has_no_exchange_and_prunes_years(spark, no_broadcast):
    s = model(spark, SMOKE)
    rows = C._all_rows(s, 1999)
    text = plan(rows)
    assert "Exchange" not in text and text.count("SortMergeJoin") == 2
    for column in ("entry_year", "year"):
        assert len(re.findall(rf"PartitionFilters: [^\n]*\({column}#\d+ >= 1999", text)) == 2
    all_rows = C.S.ledger_rows(s.archived_lines(), s.archived_headers(), s.current_lines(), s.current_headers())
    want = all_rows.filter("year >= 1999")
    assert rows.count() == want.count() > 0 and rows.exceptAll(want).isEmpty()


def test_orphans_and_purges_don_t_shuffle_lines(spark, no_broadcast):
    s = model(spark, SMOKE)
    orphans = orphan_rows(s.lines(), s.headers(), ["client_code", "entry_id"])
    assert "Exchange" not in plan(orphans)
    assert s.stored("lines").filter("entry_year is null").count() == orphans.count() > 0


def test_balance_sums_lines_by_hash(spark):
    """Every line is summed by hash; only the sums are sorted to meet under the collation."""
    lines = plan(C.build_legacy_balance(model(spark, SMOKE))).split("\n")
    above = lines[:next(k for k, line in enumerate(lines) if "Union" in line)][::-1]
    aggregates = [line.split("(key")[0].strip(" :+-") for line in above if "Aggregate" in line]
    assert aggregates[:2] == ["HashAggregate", "HashAggregate"]


def test_reopened_by_another_session(spark):
    path = tempfile.mkdtemp(prefix="ledgerlake-colocated-") + "/t"
    df = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("n"),
                                 F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("int").alias("p"))
    write_colocated(df, path, ["k", "n"], 5, ["p"])
    for session in (spark, spark.newSession()):
        back = open_colocated(session, path, df.schema, ["k", "n"], 5, ["p"])
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert spark.read.parquet(path).count() == 500            # plain Parquet to any other reader


def test_buckets_follow_the_input():
    assert buckets_for(0, 8) == 8 and buckets_for(100 << 40, 8) == (100 << 40) // (256 << 20)
