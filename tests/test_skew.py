"""Skewed input: one tenant / one key holds a third of the rows. Results must
stay whole and equal a plain-Python brute force."""
import collections
import datetime as dt
import decimal

from ledgerlake.operators.upsert import latest_per_key
from ledgerlake.plans import staging as S


def _fixture(spark, n=900):
    headers, lines = [], []
    for e in range(n // 3):
        tenant = "HOT" if e % 3 == 0 else f"T{e % 7}"
        headers.append((tenant, e, dt.datetime(2000, 1 + e % 12, 1), 2000, 1 + e % 12, "1"))
        for j in range(3):
            lines.append((tenant, e, "C01" if j == 0 else "70" + str(j), decimal.Decimal(f"{j + 1}.25"),
                          decimal.Decimal("0.00")))
    h = spark.createDataFrame(headers, "client_code string, entry_id long, entered_at timestamp_ntz, "
                                       "year short, month byte, journal string")
    ln = spark.createDataFrame(lines, "client_code string, entry_id long, account string, "
                                      "debit decimal(18,2), credit decimal(18,2)")
    return h, ln, headers, lines


def test_monthly_balance_with_a_hot_tenant(spark):
    h, ln, headers, lines = _fixture(spark)
    empty_h, empty_l = h.limit(0), ln.limit(0)
    acc = spark.createDataFrame([], "client_code string, account string, label string")
    jnl = spark.createDataFrame([], "client_code string, journal string, label string")
    cli = spark.createDataFrame([], "client_code string, company_no string")
    got = S.monthly_balance(ln, h, empty_l, empty_h, acc, jnl, cli, as_of=dt.date(2001, 8, 1))
    got = {(r.client_code, r.month, r.account): (r.debits, r.lines) for r in got.collect()}
    month = {(t, e): dt.date(y, m, 1) for t, e, _, y, m, _ in headers}
    want = collections.defaultdict(lambda: [decimal.Decimal("0.00"), 0])
    for t, e, a, d, _ in lines:
        k = (t, month[(t, e)], a)
        want[k][0] += d
        want[k][1] += 1
    assert got == {k: (v[0], v[1]) for k, v in want.items()}
    hot = sum(v[1] for k, v in want.items() if k[0] == "HOT")
    assert hot * 3 == len(lines)          # the hot tenant really holds a third


def test_latest_per_key_with_a_hot_key(spark):
    rows = [(0 if i % 3 == 0 else i, i, i % 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int, ts int").repartition(8)
    got = {r.k: (r.v, r.ts) for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    best = {}
    for k, v, ts in rows:
        if k not in best or (ts, v) > (best[k][1], best[k][0]):
            best[k] = (v, ts)
    assert got == best


def test_a_hot_tenant_is_spread_by_the_salted_join(spark):
    """With broadcast off, a tenant with a third of 60,000 rows is worked on by many tasks."""
    from pyspark.sql import functions as F

    from ledgerlake.operators.skew import salted_join
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        big = spark.range(60_000).select(F.col("id").alias("entry_id"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 90)).alias("client_code"))
        small = big.select("client_code").distinct().withColumn("mark", F.length("client_code"))
        out = salted_join(big, small, ["client_code"], "left", ["entry_id"])
        hot = out.filter("client_code = 'HOT'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in hot) == 20_000 and out.filter("mark is null").count() == 0
        assert len(hot) >= 8 and max(r["count"] for r in hot) < 20_000 / 4
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
