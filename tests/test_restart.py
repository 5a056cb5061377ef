"""What goes on after a crash: paged extracts, layer runs; dated deliveries, sizes; the sweep over fiscal years."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import layers as L
from ledgerlake.plans import marts as V
from ledgerlake.plans import reports as R
from ledgerlake.sources import extract as X
from ledgerlake.sources import files as Fi

from .conftest import SMOKE


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def ledger(spark):
    return spark.range(0, 9000, 3).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).unionByName(
        spark.createDataFrame([(None, 1)], "k long, v long")).repartition(6)


OPTIONS = {"rows_per_range": 200, "ranges_per_group": 3}


def test_a_killed_extract_goes_on_where_it_stopped(spark, ledger, tmp_path, monkeypatch):
    path, real, ran = f"{tmp_path}/x", X._extract, []

    def dies_at_third(df, key, p, plan, group):
        if len(ran) == 2:
            raise KeyboardInterrupt                                              # the run is killed
        ran.append(group)
        real(df, key, p, plan, group)

    monkeypatch.setattr(X, "_extract", dies_at_third)
    with pytest.raises(KeyboardInterrupt):
        X.extract_pages(ledger, "k", 70, path, **OPTIONS)
    state = X.page_state(spark, path)
    assert rows(state.select("group", "done").distinct()) == [(0, True), (1, True), (2, False), (3, False), (4, False)]
    assert state.filter("done").agg(F.sum("rows")).first()[0] == spark.read.parquet(f"{path}/pages").count()
    again = []
    monkeypatch.setattr(X, "_extract", lambda df, key, p, plan, group: (again.append(group), real(df, key, p, plan, group)))
    got = X.extract_pages(ledger, "k", 70, path, **OPTIONS)
    assert ran == [0, 1] and again == [2, 3, 4]                                   # only the rest is read
    keys = list(range(0, 9000, 3))
    assert rows(got.select("row_no", "page", "k")) == sorted([(i + 1, i // 70, k) for i, k in enumerate(keys)], key=str)


def test_a_failing_group_is_tried_twice_and_named(spark, ledger, tmp_path, monkeypatch):
    path, real, tries = f"{tmp_path}/x", X._extract, []

    def flaky(df, key, p, plan, group):
        tries.append(group)
        if group == 1 or (group == 2 and tries.count(2) == 1):
            raise OSError("source gone")
        real(df, key, p, plan, group)

    monkeypatch.setattr(X, "_extract", flaky)
    with pytest.raises(X.ExtractFailed, match=r"groups \[1\]"):
        X.extract_pages(ledger, "k", 70, path, **OPTIONS)
    assert tries == [0, 1, 1, 2, 2, 3, 4]
    monkeypatch.undo()
    assert X.extract_pages(ledger, "k", 70, path, **OPTIONS).count() == 3000


def test_extract_reads_a_range_and_checkpoints_nothing(spark, tmp_path):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    df.repartitionByRange(20, "k").write.parquet(f"{tmp_path}/src")
    src = spark.read.parquet(f"{tmp_path}/src")
    plan = X.plan_pages(src, "k", f"{tmp_path}/x", rows_per_range=500, ranges_per_group=4)
    assert plan.select("group").distinct().count() == 5
    empty = X.extract_pages(src.limit(0), "k", 10, f"{tmp_path}/e")
    assert empty.collect() == [] and empty.columns == ["k", "row_no", "page"]


def test_a_layer_run_goes_on_after_a_failure_in_master(spark, tmp_path, monkeypatch):
    book, tables, built = f"{tmp_path}/book", L._tables, []

    def spied(broken):
        def make(sp, sf):
            t = tables(sp, sf)
            def one(layer, name, build):
                def run():
                    if broken and (layer, name) == ("master", "master_services"):
                        raise RuntimeError("lost the driver")
                    built.append((layer, name))
                    return build()
                return run
            return {layer: {n: one(layer, n, b) for n, b in of.items()} for layer, of in t.items()}
        return make

    monkeypatch.setattr(L, "_tables", spied(True))
    with pytest.raises(RuntimeError, match="lost the driver"):
        L.run_layers(spark, SMOKE, ledger=book)
    first = list(built)
    assert ("master", "master") in first and not any(layer == "mart" for layer, _ in first)
    failed = L.ledger_rows(spark, book).filter("status = 'failed'").collect()
    assert [(r.table_name, r.error) for r in failed] == [("master_services", "lost the driver")]
    built.clear()
    monkeypatch.setattr(L, "_tables", spied(False))
    report = {(r.layer, r.table_name): r for r in L.run_layers(spark, SMOKE, ledger=book).collect()}
    assert not set(built) & set(first) and built[0] == ("master", "master_services")     # goes on where it stopped
    assert report["raw", "lines"].status == "kept" and report["raw", "lines"].row_count > 0
    assert report["mart", "unified_ledger"].status == "ok"
    built.clear()
    assert {r.status for r in L.run_layers(spark, SMOKE, ledger=book).collect()} <= {"kept"} and not built


def test_the_newest_complete_delivery_is_read(spark, tmp_path):
    root = f"{tmp_path}/in"
    for name, text in (("2024-01-31", "a\t1"), ("bulk_20240229", "b\t2"), ("2024-03-31", "c\t3"), ("2024-13-01", "d\t4"), ("notes", "e\t5")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/{name}")
    (tmp_path / "in" / "2024-03-31" / "_SUCCESS").unlink()                        # still being written
    assert [(str(d), ok) for d, _, ok in Fi.dated_folders(spark, root)] == [("2024-01-31", True), ("2024-02-29", True), ("2024-03-31", False)]
    got = Fi.read_delivery(spark, root, ["x", "n"]).collect()
    assert [(r.x, r.n, r.delivered, r.file.endswith(".txt")) for r in got] == [("b", "2", dt.date(2024, 2, 29), True)]
    assert [r.x for r in Fi.read_delivery(spark, root + "/", ["x", "n"], as_of=dt.date(2024, 2, 1)).collect()] == ["a"]
    with pytest.raises(FileNotFoundError):
        Fi.newest_delivery(spark, root, as_of=dt.date(2023, 1, 1))


def test_sizes_come_from_the_listing(spark, tmp_path):
    spark.range(100).coalesce(2).write.parquet(f"{tmp_path}/t")
    got = {r.table: r for r in R.table_sizes(spark, {"t": f"{tmp_path}/t", "gone": f"{tmp_path}/gone"}).collect()}
    files = [p for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet"]
    assert (got["t"].files, got["t"].bytes) == (len(files), sum(p.stat().st_size for p in files)) and got["gone"].files == 0
    marks = spark.createDataFrame([("t", "c", "SUCCESS", 100, None)], "table string, client_code string, status string, rows long, last_sync timestamp_ntz")
    listed = {r.table: r for r in R.import_listing(marks, R.table_sizes(spark, {"t": f"{tmp_path}/t", "other": f"{tmp_path}/t"})).collect()}
    assert listed["t"].bytes_per_row == round(got["t"].bytes / 100, 1) and listed["other"].rows is None


# ------------------------------------------------------------------- the sweep
YEARS = "source string, client_code string, code string, company_no string, start date, end date, closed date"


def flagged(spark, years):
    master = spark.createDataFrame([], "company_no string, name string, office string")
    got = V.fiscal_year_overlap(spark.createDataFrame(years, YEARS), master).select("client_code", "possible_duplicate")
    return rows(got)


def brute(years):
    out = []
    for s, c, _, no, a, b, _ in years:
        hit = any(s != t and no == m and no is not None and len(no) == 9 and None not in (a, b, x, y) and x <= b and y >= a
                  for t, _, _, m, x, y, _ in years)
        out.append((c, hit))
    return sorted(out, key=str)


def test_overlaps_equal_all_pairs(spark):
    rng = random.Random(7)
    day = lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(120))
    years = []
    for i in range(600):
        a, b = (day() if rng.random() < 0.95 else None for _ in "ab")
        if a and b and rng.random() < 0.9:
            a, b = min(a, b), min(max(a, b), min(a, b) + dt.timedelta(days=rng.randrange(6)))
        years.append((rng.choice(["legacy", "cloud"]), f"c{i}", "x", rng.choice([None, "", "12", *[f"{k:09d}" for k in range(40)]]), a, b, None))
    want = brute(years)
    assert flagged(spark, years) == want and {h for _, h in want} == {True, False}
    assert flagged(spark, [years[0]] * 3) == [(years[0][1], False)] * 3


def test_a_number_with_100_000_years_finishes(spark):
    days = spark.range(100_000).select(
        F.when(F.col("id") % 10 == 0, "cloud").otherwise("legacy").alias("source"), F.col("id").cast("string").alias("client_code"), F.lit("y").alias("code"),
        F.lit("123456789").alias("company_no"), F.expr("date_add(date'1900-01-01', int(id))").alias("start"),
        F.expr("date_add(date'1900-01-01', int(id))").alias("end"), F.lit(None).cast("date").alias("closed"))
    both = days.unionByName(days.filter("id % 1000 = 5".replace("id", "cast(client_code as long)")).withColumn("source", F.lit("cloud")))
    master = spark.createDataFrame([], "company_no string, name string, office string")
    got = V.fiscal_year_overlap(both, master)
    assert got.filter("possible_duplicate").count() == 200 and got.count() == 100_100
