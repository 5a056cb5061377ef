"""Property tests (hypothesis, small rows) from the test strategy."""
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.operators.upsert import latest_per_key
from ledgerlake.plans import master as M

from .test_jobs import cloud, legacy

SCHEMA = "k int, v int, ts int"
rows_st = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(0, 5)), max_size=14)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=12, deadline=None)
@given(b1=rows_st, b2=rows_st)
def test_batches_then_equal_one_full_load(spark, b1, b2):
    """Merging batch after batch (greatest row per key by order, the stream
    merge) gives the same table as one load of everything, in either order."""
    d1, d2 = spark.createDataFrame(b1, SCHEMA), spark.createDataFrame(b2, SCHEMA)
    full = latest_per_key(d1.unionByName(d2), ["k"], ["ts"])
    step = latest_per_key(latest_per_key(d1, ["k"], ["ts"]).unionByName(d2), ["k"], ["ts"])
    back = latest_per_key(latest_per_key(d2, ["k"], ["ts"]).unionByName(d1), ["k"], ["ts"])
    assert rows(step) == rows(full) == rows(back)


numbers = st.sampled_from(["111111111", "222222222", "333333333", "", None, "12345"])


@settings(max_examples=10, deadline=None)
@given(lg=st.lists(numbers, max_size=6), cl=st.lists(numbers, max_size=6))
def test_master_keeps_each_valid_number_once(spark, lg, cl):
    legacy_rows = [(f"{i:05d}", f"n{i}", no) for i, no in enumerate(lg)]
    cloud_rows = [(100 + i, f"c{i}", no) for i, no in enumerate(cl)]
    master, rejects = M.master_clients(legacy(spark, legacy_rows), cloud(spark, cloud_rows))
    nos = [r.company_no for r in master.collect() if r.company_no and len(r.company_no) == 9]
    valid_in = {no for no in lg + cl if no and len(no) == 9}
    assert sorted(nos) == sorted(valid_in)          # none lost, none duplicated
    # every row with a valid number is a master row, a match merged into one, or a reject
    n_valid_rows = sum(1 for no in lg + cl if no and len(no) == 9)
    merged = sum(1 for r in master.collect() if r.has_books_legacy and r.has_books_cloud)
    lost = [r.company_no for r in rejects.collect()]
    assert len(nos) + merged + sum(len(no) == 9 for no in lost) == n_valid_rows
    # any other cloud number is kept once as well; rows without a number are all kept
    odd = [no for no in cl if no is not None and len(no) != 9]
    kept = [r.company_no for r in master.collect() if r.company_no is not None and len(r.company_no) != 9]
    assert sorted(kept) == sorted(set(odd)) and len(odd) - len(set(odd)) == sum(len(no) != 9 for no in lost)
    assert sum(r.company_no is None for r in master.collect()) == sum(no is None or len(no) != 9 for no in lg) + cl.count(None)
