"""Property test: the range-partitioned numbering equals a brute-force
per-group enumeration for random keys, orders and hot-key shares."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartwise.functions.skew import sequence_number

rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(-1000, 1000)),
    min_size=1, max_size=120)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, hot_share=st.integers(0, 3), parts=st.integers(1, 7))
def test_sequence_number_equals_brute_force(spark, rows, hot_share, parts):
    # make key 3 hot: replace every (hot_share+1)-th key
    data = [((3 if hot_share and i % (hot_share + 1) == 0 else k), v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, v int, id int")
    got = {r.id: r.seq for r in sequence_number(df, "k", ["v", "id"], "seq", partitions=parts).collect()}

    want = {}
    groups = {}
    for k, v, i in data:
        groups.setdefault(k, []).append((v, i))
    for members in groups.values():
        for n, (_, i) in enumerate(sorted(members), start=1):
            want[i] = n
    assert got == want
