"""What a query holds in one place must not grow faster than its input."""
import datetime as dt
import time
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.operators import slices
from ledgerlake.operators import upsert as U
from ledgerlake.operators.colocated import buckets_for
from ledgerlake.operators.skew import salted_join
from ledgerlake.plans import catalog as C
from ledgerlake.plans import marts as V
from ledgerlake.plans import master as M
from ledgerlake.plans import staging as S
from ledgerlake.plans.model import Model, model
from ledgerlake.plans.standins import Standins
from ledgerlake.session import input_bytes, release
from ledgerlake.streaming import ingest as ST

from .conftest import SMOKE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_client_joins_repeat_no_side(spark):
    """Copies of the client list per shuffle partition were broadcast: the driver's memory was out on 0.1 GB."""
    lines = spark.createDataFrame([("00001A", 1, "C01", Decimal(1), Decimal(2))], "client_code string, entry_id long, account string, debit decimal(18,2), credit decimal(18,2)")
    headers = spark.createDataFrame([("00001A", 1, 2000, 5, "AC", dt.datetime(2000, 5, 2))],
                                    "client_code string, entry_id long, year short, month byte, journal string, entered_at timestamp_ntz")
    codes = [spark.createDataFrame([], f"client_code string, {c} string, label string") for c in ("account", "journal")]
    clients = spark.createDataFrame([("00001a", "123456789")], "client_code string, company_no string")
    balance = S.monthly_balance(lines, headers, lines.limit(0), headers.limit(0), *codes, clients, as_of=dt.date(2001, 8, 1))
    assert [(r.client_code, r.company_no, r.lines) for r in balance.collect()] == [("00001A", "123456789", 1)]
    years = spark.createDataFrame([(s, s, "123456789", dt.date(2000, 1, 1), dt.date(2000, 12, 31), None, "2000") for s in ("legacy", "cloud")],
                                  "source string, client_code string, company_no string, start date, end date, closed date, code string")
    master = spark.createDataFrame([("123456789", "n", "o")], "company_no string, name string, office string")
    overlap = V.fiscal_year_overlap(years, master)
    assert [r.possible_duplicate for r in overlap.collect()] == [True, True]
    refreshed = U.tenant_refresh(lines, lines.filter("credit > 5"), ["client_code"])
    for df in (balance, overlap, refreshed):
        assert "explode(sequence" not in plan(df) and "_salt" not in plan(df)


def test_copies_of_a_salted_side_are_not_broadcast(spark):
    big = spark.range(1000).select(F.col("id").alias("e"), (F.col("id") % 7).alias("k"))
    out = salted_join(big, big.groupBy("k").count(), ["k"], "left", ["e"])
    assert "BroadcastExchange" not in plan(out) and out.filter("count is null").count() == 0 and out.count() == 1000


def test_stored_lines_are_shuffled_once(spark):
    """The join to the headers finds the lines in their buckets and leaves them there; a bucket is a task's share of a sort."""
    s = model(spark, SMOKE)
    size = sum(input_bytes(spark, f"{SMOKE}/{t}.parquet") for t in ("lineitem", "orders"))
    assert s._buckets() == buckets_for(16 * size, 8)
    text = plan(s._derived("lines", ["client_code", "entry_id"], 5))
    assert text.count("Exchange") == text.count("Exchange hashpartitioning") == 1 and "Sort " not in text and "BroadcastExchange" not in text
    lines = Standins(spark, SMOKE).lines()
    year = Standins(spark, SMOKE).headers().select("client_code", "entry_id", "archived", F.col("year").alias("entry_year"))
    want = lines.join(year, ["client_code", "entry_id", "archived"], "left").select(*lines.columns, "entry_year")
    got = s.stored("lines").select(*want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_a_stream_batch_is_shuffled_once(spark, tmp_path, monkeypatch):
    """A batch's rows and those stored are merged and written by one shuffle; large tenants go in parts."""
    monkeypatch.setattr(slices, "PART_ROWS", 40)
    frame = lambda lo, hi, v: spark.range(lo, hi).select(
        F.when(F.col("id") % 5 > 1, "HOT").when(F.col("id") % 5 == 1, "B").alias("t"), (F.col("id") % 200).alias("k"), F.lit(v).alias("v"))
    target, seen = str(tmp_path / "t"), []
    stage = slices._stage
    monkeypatch.setattr(slices, "_stage", lambda df, *a: seen.append(plan(df)) or stage(df, *a))
    schema = frame(0, 1, 1).schema
    for batch in (frame(0, 300, 1), frame(100, 300, 5), frame(0, 50, 3)):
        ST.merge_slices(spark, batch, target, schema, ["t", "k"], ["v"], "t")
    got = {(r.t, r.k): r.v for r in ST.read_slices(spark, target, schema, "t").collect()}
    want = {}
    for lo, hi, v in ((0, 300, 1), (100, 300, 5), (0, 50, 3)):
        for n in range(lo, hi):
            t = "HOT" if n % 5 > 1 else "B" if n % 5 == 1 else None
            want[t, n % 200] = max(v, want.get((t, n % 200), 0))
    assert got == want and len(list((tmp_path / "t").glob("data/*/_slice=x484F54/part-*"))) > 3
    for text in seen:
        assert "REPARTITION_BY_NUM" in text.split("Exchange")[1]        # nothing is shuffled above it


def test_whole_rows_are_not_sorted_before_they_are_dealt(spark):
    """The client list may be one file: its rows are dealt over the tasks before they are sorted by number."""
    rows = spark.createDataFrame([("1", "123456789", "a"), ("0", "123456789", "b"), ("2", None, "c"), ("3", None, "d")],
                                 "client_code string, company_no string, name string").coalesce(1)
    got = M._by_number(rows, "client_code")
    assert sorted(r.name for r in got.collect()) == ["b", "c", "d"]
    assert "REPARTITION_BY_COL" in plan(got).split("partial_min")[1]


def test_accounts_in_use_are_dealt_by_the_input(spark):
    """Tasks don't grow with the input: AQE can't put the pairs of many shuffle partitions into one."""
    s = Standins(spark, SMOKE)
    used = s.parts_used(s.raw("part"))
    text = plan(used)
    assert text.count("REPARTITION_BY_NUM") == 3 and "ENSURE_REQUIREMENTS" not in text.replace("BroadcastExchange", "")
    li = s.raw("lineitem")
    want = li.select(F.col("l_orderkey") % 100, "l_partkey").distinct().join(s.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
    assert used.count() == want.count() > 0 and used.agg(F.sum("n")).first()[0] <= li.count()


def test_headers_labels_and_clients_are_not_broadcast(spark):
    """Their compressed files pass as small: on 0.1 GB headers and account labels went through the driver and its memory was out."""
    s = model(spark, SMOKE)
    text = plan(C.build_legacy_balance(s))
    assert text.count("SortMergeJoin") == text.count("ShuffledHashJoin") == 2 and text.count("BroadcastHashJoin") == 1          # the journals of the tenants
    want = S.ledger_rows(s.archived_lines(), s.archived_headers(), s.current_lines(), s.current_headers()).filter("year >= 1998")
    kept = S._with_period(want).filter("month_start is not null")
    assert C.legacy_balance(s).agg(F.sum("lines")).first()[0] == kept.count() > 0
    for name in ("unified_ledger", "counterparty_monthly", "revenue_monthly", "top_counterparties"):
        assert "BroadcastHashJoin" not in plan(C.QUERIES[name](spark, SMOKE)), name


def test_year_ends_are_not_broadcast(spark):
    """Nor are the clients that the years of the practice are joined to."""
    s = model(spark, SMOKE)
    assert plan(S.fiscal_years(s.practice_fiscal_years(), s.address(), s.cloud_fiscal_years(), s.company())).count("BroadcastHashJoin") <= 1   # companies
    assert "BroadcastHashJoin" not in plan(C.QUERIES["fiscal_year_overlap"](spark, SMOKE))


def test_parts_staff_and_companies_are_not_broadcast(spark):
    """Every balance and mart builds on these: parts, staff, companies and their numbers grow with the input too."""
    s = model(spark, SMOKE)
    part = s.raw("part")
    assert "ShuffledHashJoin" in plan(s.parts_used(part)) and "BroadcastHashJoin" not in plan(s.parts_used(part))
    address = spark.createDataFrame([("CLIENT", "", k, f"S{k % 2}", "S0", None, "T0", "L0", "A0", "R0", "O0", "00020000000001", "03 20")
                                     for k in range(4)],
                                    "kind string, exit_date string, id long, staff1 string, staff2 string, staff3 string, title_code string, legal_code string, "
                                    "activity_code string, region_code string, office_code string, site_no string, phone string")
    rest = [c for c in S.CLIENT_COLUMNS if c not in (*address.columns, "company_no", "title", "legal_form", "activity_label", "region", "office", "director", "manager", "accountant")]
    address = address.withColumns({c: F.lit(c) for c in rest})
    labels = s.titles()
    staff = spark.createDataFrame([("S0", "a@x"), ("S1", "b@x")], "code string, email string")
    star = S.client_star(address, labels, staff, labels, labels, labels, labels)
    assert plan(star).count("BroadcastHashJoin") == 5 and plan(star).count("SortMergeJoin") == 3       # fixed lists; staff in three roles
    assert sorted((r.address_id, r.director, r.manager, r.accountant) for r in star.collect()) == [(k, "b@x" if k % 2 else "a@x", "a@x", None) for k in range(4)]
    for df in (C.build_cloud_clients(s), C.build_cloud_balance(s), C.build_cloud_counterparty(s), C.build_fiscal_years(s), C.QUERIES["revenue_yoy"](spark, SMOKE)):
        assert "BroadcastHashJoin" not in plan(df).replace("n_nationkey", "")
    assert plan(C.build_timesheets(s)).count("SortMergeJoin") == 2


def test_stored_layers_let_go_of_their_shuffles(spark, tmp_path):
    """Spark drops finished jobs' shuffles and broadcasts with the driver's garbage: a dozen layers in a row filled its memory."""
    kept = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses
    s = Model(spark, str(tmp_path))
    release(spark)
    time.sleep(3)
    before = kept().size()
    for k in range(2, 7):
        rows = s.layer(f"t{uuid.uuid4().hex}", lambda k=k: spark.range(1000).groupBy((F.col("id") % k).alias("k")).count())
        assert rows.count() == k and rows.agg(F.sum("count")).first()[0] == 1000
    until = time.monotonic() + 20
    while kept().size() > before + 7 and time.monotonic() < until:
        time.sleep(0.2)
    assert kept().size() <= before + 7          # of the 15 made: what the last jobs did is still referred to


def test_schemas_are_looked_up_once(spark, tmp_path):
    """Each look is a job of the driver's; a table that was just written needs none."""
    sc = spark.sparkContext

    def jobs(group, build):
        sc.setJobGroup(group, group)
        try:
            return build(), len(sc.statusTracker().getJobIdsForGroup(group))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    s = Standins(spark, SMOKE)
    first, n = jobs("schema-first", lambda: s.raw("orders"))
    again, m = jobs("schema-again", lambda: s.raw("orders"))
    assert (n, m) == (1, 0) and first.schema == again.schema and first.exceptAll(again).isEmpty()
    t = Model(spark, str(tmp_path))
    name = f"t{uuid.uuid4().hex}"
    rows, n = jobs("schema-layer", lambda: t.layer(name, lambda: spark.range(3).select("id", F.lit("x").alias("c"))))
    assert n == 1 and rows.schema == Model(spark, str(tmp_path)).layer(name, lambda: None).schema


def test_journal_codes_are_not_lowered_in_the_driver(spark):
    """Lowering a literal loaded the collations' tables there: 5.6 GB of arrays that are garbage at once."""
    s = Standins(spark, SMOKE)
    for df in (s.headers(), s.journals()):
        assert "lower(" not in df._jdf.queryExecution().analyzed().toString()
    codes = {r.journal for r in s.headers().filter("entry_id % 3 = 0").select("journal").distinct().collect()}
    assert codes == {"ac", "vé", "od", "bq", None}
