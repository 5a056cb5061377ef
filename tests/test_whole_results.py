"""Nothing is cut, dropped or left behind: caps, refreshes, versions, crashes, changed inputs."""
import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerlake import session
from ledgerlake.functions import normalize as N
from ledgerlake.operators import incremental as I
from ledgerlake.operators import upsert as U
from ledgerlake.operators.pattern_join import like_join
from ledgerlake.plans import master as M
from ledgerlake.plans import reports as R
from ledgerlake.sources import files as Fi
from ledgerlake.streaming import ingest as ST

ROWS = "k long, t string, v long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_patterns_of_any_shape(spark):
    values = spark.createDataFrame([("706100",), ("7066",), ("70x1",), ("1700",)], "a string")
    hits = like_join(values, spark.createDataFrame([("7066%",), ("706100%",), ("7%",), ("70_1%",), ("%00",)], "p string"), "a", "p")
    assert rows(hits.select("a", "p")) == sorted([
        tuple(r) for r in values.crossJoin(spark.createDataFrame([("7066%",), ("706100%",), ("7%",), ("70_1%",), ("%00",)], "p string"))
        .filter(F.expr("a LIKE p")).collect()], key=str)


def test_months_out_of_range_have_no_period(spark):
    df = spark.createDataFrame([(2000, 1), (2000, 13), (2000, 100), (2000, 127), (12000, 1), (0, 1), (2000, None), (None, 3)], "y int, m int")
    assert [r[0] for r in df.select(N.period_start("y", "m")).collect()] == [dt.date(2000, 1, 1)] + [None] * 7


def test_tsv_lines_are_cleaned_or_rejected(spark, tmp_path):
    lines = ["1\t2\t3.50", "1\t2\t", "1\t\t3", "1\t2\tx", "1\t2", "1\t2\t3\t4", "1\t2\t\\N", ""]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_path}/t")
    raw = Fi.read_tsv_text(spark, f"{tmp_path}/t", ["a", "b", "c"])
    good, bad = Fi.clean_ledger_tsv(raw, amount_cols=["c"], default_cols={}, required=["b"], casts={"b": "bigint"})
    assert sorted(str(r.c) for r in good.collect()) == ["3.50", "None", "None"]
    assert rows(bad) == sorted([("", "wrong number of fields"), ("1\t\t3", "no b"), ("1\t2", "wrong number of fields"), ("1\t2\t3\t4", "wrong number of fields"), ("1\t2\tx", "bad c")], key=str)


def test_full_refresh_leaves_no_stale_slice(spark, tmp_path):
    root, path = f"{tmp_path}/t", f"{tmp_path}/p"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")       # whatever the session says
    try:
        both = spark.createDataFrame([(1, "A", 1), (2, "B", 2)], ROWS)
        for df in (both, both.filter("t = 'A'")):
            got = U.full_refresh(df, root, ["t"])
            U.write_by_slice(df, path, ["t"])
        assert [r.t for r in got.collect()] == [r.t for r in spark.read.parquet(path).collect()] == ["A"]
        assert sorted(r.t for r in U.slice_refresh(both.filter("t = 'B'"), root, ["t"]).collect()) == ["A", "B"]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_no_local_folder_on_a_cluster(monkeypatch):
    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://head:7077", setCheckpointDir=lambda p: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_a_changed_input_is_derived_again(spark, tmp_path):
    import os
    import shutil

    from ledgerlake.plans.model import model

    from .conftest import SMOKE
    for name in os.listdir(SMOKE):
        shutil.copy(f"{SMOKE}/{name}", tmp_path / name)
    before = model(spark, str(tmp_path)).company().count()
    few = spark.read.parquet(f"{SMOKE}/supplier.parquet").limit(3).toPandas()
    os.chmod(tmp_path / "supplier.parquet", 0o644)
    few.to_parquet(tmp_path / "supplier.parquet")
    assert before > 3 and model(spark, str(tmp_path)).company().count() == 3


def test_company_numbers_are_kept_once(spark):
    legacy = spark.createDataFrame([], "company_no string, client_code string, entry_date string, " + ", ".join(
        f"{c} string" for c in {*M.OWN_ONLY, *M.OWN_FIRST, *M.FILLED} - {"client_code"}))
    cloud = spark.createDataFrame([(i, no) for i, no in enumerate(["123", "123", "", "", None, None, "123456789"])], "company_id long, company_no string")
    for c in ("external_id", *M.OWN_FIRST, *M.FILLED):
        cloud = cloud.withColumn(c, F.lit("x"))
    master, rejects = M.master_clients(legacy, cloud)
    assert sorted(str(r.company_no) for r in master.collect()) == ["", "123", "123456789", "None", "None"]
    assert sorted(r.row_key for r in rejects.collect()) == ["1", "3"]


def test_first_run_reads_all_and_other_tables_marks_do_not_count(spark):
    when = dt.datetime
    df = spark.createDataFrame([(1, when(1999, 1, 1)), (2, when(2020, 1, 1))], "id int, updated timestamp_ntz")
    marks = spark.createDataFrame([("header", when(2024, 1, 1))], "table string, last_sync timestamp_ntz")
    assert [r.id for r in I.incremental_since(df, "updated", marks, table="ledger").collect()] == [2]
    assert [r.id for r in I.incremental_since(df, "updated", marks.limit(0)).collect()] == [2]
    assert I.incremental_since(df, "updated", marks).collect() == []


def test_no_header_lost_between_runs(spark):
    """Nine steps on headers and lines: full run, late commit in the very second of the mark, rerun, replay."""
    when = dt.datetime
    schema = "client_code string, entry_id int, entered_at timestamp_ntz"
    source = [("A", 1, when(2025, 11, 23, 12)), ("A", 2, when(2025, 11, 24, 9))]
    lines = [("A", 1, 10), ("A", 2, 20), ("A", 3, 999)]
    marks = spark.createDataFrame([], "table string, client_code string, last_sync timestamp_ntz, type string, status string, rows long, duration_s long")
    target = spark.createDataFrame([], schema)
    got_lines = spark.createDataFrame([], "client_code string, entry_id int, line_id int")
    line_df = spark.createDataFrame(lines, got_lines.schema)
    for start, late in ((when(2025, 11, 24, 10, 30), ("A", 3, when(2025, 11, 24, 10, 30))), (when(2025, 11, 24, 11), None), (when(2025, 11, 24, 12), None)):
        headers = spark.createDataFrame(source, schema)
        new = I.incremental_headers(headers, marks)
        target = U.upsert_replace(target, new, ["client_code", "entry_id"], ["entered_at"])
        got_lines = U.upsert_replace(got_lines, I.incremental_lines(line_df, new), ["client_code", "line_id"], ["entry_id"])
        run = I.run_marks(new, table="header", run_start=start, tenants=spark.createDataFrame([("A",), ("quiet",)], "client_code string"), run_end=start + dt.timedelta(seconds=7))
        marks = I.tracking_upsert(marks, run).checkpoint()
        target, got_lines = target.checkpoint(), got_lines.checkpoint()
        source += [late] if late else []          # committed after the read, stamped at the mark
    assert sorted(r.entry_id for r in target.collect()) == [1, 2, 3]
    assert sorted(r.line_id for r in got_lines.collect()) == [10, 20, 999]
    assert {(r.client_code, r.duration_s) for r in marks.collect()} == {("A", 7), ("quiet", 7)}
    assert I.new_tenants(spark.createDataFrame([("quiet",)], "client_code string"), marks).collect() == []


def test_failed_runs_keep_their_mark_and_raise_alerts(spark):
    when = dt.datetime
    marks = spark.createDataFrame([("header", "A", when(2020, 1, 1), "full", "SUCCESS", 5, 9)],
                                  "table string, client_code string, last_sync timestamp_ntz, type string, status string, rows long, duration_s long")
    a = spark.createDataFrame([("A",)], "client_code string")
    out = I.tracking_upsert(marks, I.run_marks(a.limit(0), table="header", run_start=when(2021, 1, 1), tenants=a, failed=a)).first()
    assert (out.last_sync, out.status, out.rows) == (when(2020, 1, 1), "FAILED", 0)
    none = marks.withColumn("status", F.lit(None).cast("string"))
    assert [r.alert for r in R.import_alerts(none).collect()] == ["failed"]


def test_purges_keep_rows_without_code_or_year(spark):
    headers = spark.createDataFrame([("A", 1, 1999), ("A", 2, None), (None, 3, 2000)], "client_code string, entry_id int, year int")
    lines = headers.select("client_code", "entry_id")
    kept_lines, kept = I.purge_year(lines, headers, 1999)
    assert sorted(r.entry_id for r in kept.collect()) == [2, 3] == sorted(r.entry_id for r in kept_lines.collect())
    assert [r.entry_id for r in I.purge_tenant(headers, "A").collect()] == [3]
