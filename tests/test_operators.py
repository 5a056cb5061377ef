"""Upsert, incremental and quality operators: golden cases and properties."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.operators import incremental as I
from ledgerlake.operators import quality as Q
from ledgerlake.operators import upsert as U
from ledgerlake.operators.pattern_join import like_join

SCHEMA = "k int, v int, ts int"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replace_last_wins(spark):
    base = spark.createDataFrame([(1, 10, 1), (2, 20, 1)], SCHEMA)
    delta = spark.createDataFrame([(2, 21, 2), (2, 22, 3), (3, 30, 1)], SCHEMA)
    assert rows(U.upsert_replace(base, delta, ["k"], ["ts"])) == [(1, 10, 1), (2, 22, 3), (3, 30, 1)]


key_rows = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 3)), max_size=12)


@settings(max_examples=15, deadline=None)
@given(base=key_rows, delta=key_rows)
def test_upsert_idempotent(spark, base, delta):
    b = U.latest_per_key(spark.createDataFrame(base, SCHEMA), ["k"], ["ts"])
    d = spark.createDataFrame(delta, SCHEMA)
    once = U.upsert_replace(b, d, ["k"], ["ts"])
    twice = U.upsert_replace(once, d, ["k"], ["ts"])
    assert rows(once) == rows(twice)
    assert len({r[0] for r in rows(once)}) == len(rows(once))


def test_upsert_merge_keeps_label_when_new_is_null(spark):
    s = "k int, label string, amount int"
    base = spark.createDataFrame([(1, "old", 1), (2, "keep", 2)], s)
    delta = spark.createDataFrame([(1, None, 5), (3, "new", 7)], s)
    out = U.upsert_merge(base, delta, ["k"], ["amount"], ["label", "amount"], keep_if_null=("label",))
    assert rows(out) == [(1, "old", 5), (2, "keep", 2), (3, "new", 7)]


def test_apply_changes_soft_delete(spark):
    base = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    feed = spark.createDataFrame([(1, 11, 5, None), (2, 21, 5, 5), (2, 22, 4, None)],
                                 "k int, v int, seq int, deleted_at int")
    assert rows(U.apply_changes(base, feed, ["k"], "seq")) == [(1, 11)]


def test_insert_absent(spark):
    base = spark.createDataFrame([(1, 10, 0)], SCHEMA)
    delta = spark.createDataFrame([(1, 99, 0), (2, 20, 2), (2, 21, 1)], SCHEMA)
    assert rows(U.insert_absent(base, delta, ["k"], ["ts"])) == [(1, 10, 0), (2, 21, 1)]


def test_incremental_no_row_lost_between_runs(spark):
    """Golden case: a run starting 10:30 misses a row committed at 10:35 with an
    earlier business time; the start-time mark plus >= brings it in once."""
    ts = dt.datetime
    lines = spark.createDataFrame([
        (1, "401000", "1000.00", ts(2025, 11, 23, 12, 0)),
        (2, "411000", "500.00", ts(2025, 11, 23, 12, 0)),
    ], "id int, account string, amount string, updated timestamp")
    run1_start = ts(2025, 11, 24, 10, 30)
    marks0 = spark.createDataFrame([("ledger", ts(2025, 11, 1))], "table string, last_sync timestamp")
    batch1 = I.incremental_since(lines, "updated", marks0)
    target = U.upsert_replace(batch1.limit(0), batch1, ["id"], ["updated"])
    # line 999 arrives after run 1 started, stamped before the mark would be if taken at end
    late = spark.createDataFrame([(999, "512000", "2000.00", ts(2025, 11, 24, 10, 35))],
                                 "id int, account string, amount string, updated timestamp")
    source = lines.unionByName(late)
    marks1 = spark.createDataFrame([("ledger", run1_start)], "table string, last_sync timestamp")
    batch2 = I.incremental_since(source, "updated", marks1)
    target = U.upsert_replace(target, batch2, ["id"], ["updated"])
    got = rows(target.select("id"))
    assert got == [(1,), (2,), (999,)]


def test_incremental_headers_inclusive_and_default_mark(spark):
    ts = dt.datetime
    headers = spark.createDataFrame([("A", 1, ts(2001, 1, 1)), ("A", 2, ts(1999, 1, 1)),
                                     ("B", 3, ts(1999, 6, 1)), ("B", 4, ts(2000, 1, 1))],
                                    "client_code string, entry_id int, entered_at timestamp")
    marks = spark.createDataFrame([("header", "A", ts(2000, 1, 1))],
                                  "table string, client_code string, last_sync timestamp")
    got = rows(I.incremental_headers(headers, marks).select("entry_id"))
    assert got == [(1,), (4,)]   # B has no mark: default 2000-01-01, inclusive: entry 4 comes in


def test_duplicates_orphans_domain_reconcile(spark):
    child = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (9, "z")], "k int, v string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(Q.duplicate_keys(child, ["k", "v"])) == [(1, "a", 2)]
    assert rows(Q.orphan_rows(child, parent, ["k"])) == [(9, "z")]
    rep = {r["rule"]: r["violations"] for r in
           Q.domain_check(child, {"big_k": F.col("k") > 5, "v_is_a": F.col("v") == "a"}).collect()}
    assert rep == {"big_k": 1, "v_is_a": 2}
    rec = rows(Q.reconcile_counts(child, parent, "k"))
    assert rec == [(1, 2, 1, 1, "mismatch"), (2, 1, 1, 0, "match"), (9, 1, 0, 1, "missing in target")]


VALUES = ["706100", "7061001", "706210", "70620", "512", "", "a%b", "a_b", "axb", "a\\b", "Été", "70\n1", "00", "1700", "aaa", None]
PATTERNS = ["706100%", "7062%", "70_1%", "%00", "%61%0", "_______", "___%", "%", "%%", "_", "", "512", "a\\%b", "a\\_b", "a_b", "a\\\\b", "%\\\\%",
            "_t_", "%é", "É%", "70%1", "%a%a%", "%aa%", "_%0", "x%y%z", None]


def test_like_join_equals_like(spark):
    vals = spark.createDataFrame([(v, i) for i, v in enumerate(VALUES)], "a string, n int")
    pats = spark.createDataFrame([(p, f"s{i}") for i, p in enumerate(PATTERNS)], "pattern string, s string")
    fast = like_join(vals, pats, "a", "pattern")
    assert fast.columns == ["a", "n", "pattern", "s"]
    brute = vals.crossJoin(pats).filter(F.expr("a LIKE pattern"))                  # the definition, on a few rows
    assert sorted(map(str, fast.collect())) == sorted(map(str, brute.collect())) and fast.count() > 60
    text = fast._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert like_join(vals, pats.limit(0), "a", "pattern").collect() == []


def test_least_mark_reaches_the_scan(spark, tmp_path):
    """Row groups that end before the least mark aren't read, whatever tenant they are of."""
    path = f"{tmp_path}/h"
    days = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("client_code"), F.col("id").alias("entry_id"),
                                      F.expr("timestamp_ntz'2000-01-01' + make_interval(0, 0, 0, int(id / 20))").alias("entered_at"))
    days = days.withColumn("entered_on", F.to_date("entered_at"))
    days.repartitionByRange(40, "entered_at").write.parquet(path)
    headers = spark.read.parquet(path)
    marks = spark.createDataFrame([("header", "a", dt.datetime(2005, 1, 1)), ("header", "b", dt.datetime(2004, 7, 1)), ("line", "a", dt.datetime(2001, 1, 1))],
                                  "table string, client_code string, last_sync timestamp_ntz")
    want = headers.join(marks.filter("table = 'header'"), "client_code").filter("entered_at >= last_sync").select(*headers.columns)
    for tenants in (None, headers.select("client_code").distinct()):
        got = I.incremental_headers(headers, marks, tenants=tenants, day="entered_on", default=dt.datetime(2004, 1, 1) if tenants is None else I.DEFAULT_MARK)
        assert rows(got) == rows(want) and want.count() > 5000
        read = [n for n, files in _scans(got._jdf.queryExecution().executedPlan()) if "entry_id" in files]
        assert read and max(read) < 12_000, read                                  # of 40,000 rows
    assert rows(I.incremental_headers(headers, marks, default=dt.datetime(2004, 1, 1))) == rows(want)
    one = I.incremental_headers(headers, marks.limit(0), day="entered_on", default=dt.datetime(2005, 6, 1))
    assert rows(one) == rows(headers.filter("entered_at >= timestamp_ntz'2005-06-01'"))


def _scans(node):
    """(rows read, files' text) of the scans of an executed plan."""
    out = []
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _scans(node.plan())
    if name == "FileSourceScanExec":
        out.append((node.metrics().apply("numOutputRows").value(), node.toString()))
    children = node.children()
    for i in range(children.size()):
        out += _scans(children.apply(i))
    return out


def test_incremental_plan_skips_dateless_tables():
    tables = {"header": "entered_at", "line": None, "account": None}
    assert I.incremental_plan(tables, "incremental") == {"header": "incremental", "line": "skipped",
                                                          "account": "skipped"}
    assert set(I.incremental_plan(tables, "full").values()) == {"full"}
