"""Targets, bounds and rounding of the mix."""
import random
from collections import defaultdict

from ledgerlake.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, taken string"


def corpus(n=900):
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        src = rnd.choices(["a", "b", "B", "c", None], [50, 20, 8, 4, 3])[0]
        size = rnd.choice([0, 5, 5, 5, 17, rnd.randrange(1, 400)])
        rows.append((i, " ".join("w" for _ in range(size)), src, "x"))
    rows += [(5000, None, "a", "x"), (5001, "w " * 20_000, "B", "x"), (None, "w w w", "c", None), (3, rows[3][1], rows[3][2], "x"), (6000, "", "empty", "x")]
    return rows


def wanted(rows):
    size = defaultdict(int)
    for _, t, s, _ in rows:
        size[s] += len((t or "").split())
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(names)}
    free, out, left = set(names), {}, sum(size.values())
    while free:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) >= 3 * size[s]]
        if not over:
            return size, out | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        for s in over:
            out[s] = 3 * size[s]
            free.discard(s)
        left = sum(size.values()) - sum(out.values())
    return size, out


def test_query(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = M.mixed(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()
    assert len(got) == len(rows)
    size, target = wanted(rows)
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert r.rate <= 3
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1.01 * longest[s], (s, taken[s], t)
    again = M.op2_entropy_mix(spark, str(tmp_path)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken, r.rate)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_rates_are_the_dual_solution(spark):
    """w = min(3, exp(lambda z)) with one lambda a source, and the constraint holds."""
    import math

    rows = corpus()
    by = defaultdict(list)
    for r in M.mixed(spark.createDataFrame(rows, SCHEMA)).collect():
        by[r.source].append(r)
    for s, rs in by.items():
        if not rs[0].source_size:
            continue
        assert abs(sum(r.rate * r.size for r in rs) - rs[0].target) < 1e-6 * rs[0].target
        tilt = {round(math.log(r.rate) / r.size, 12) for r in rs if r.size and 1e-12 < r.rate < 3 - 1e-9}
        assert not tilt or max(tilt) - min(tilt) < 1e-9


def test_documents_are_repeated_whole(spark):
    rows = corpus(300)
    df = spark.createDataFrame(rows, SCHEMA)
    out = M.mix_documents(df)
    assert out.columns == df.columns
    plan = M.mixed(df).collect()
    assert out.count() == sum(r.copies for r in plan)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in plan if r.copies}


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert M.op2_entropy_mix(spark, str(tmp_path)).collect() == []
