"""Property tests (hypothesis) for the two custom compositions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadence.operators.asof import asof_join
from cadence.operators.upsert import upsert

BASE = dt.date(2020, 1, 1)
SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture,
                                       HealthCheck.too_slow])

days = st.integers(min_value=-40, max_value=900).map(lambda n: BASE + dt.timedelta(n))
keys = st.sampled_from(["a", "b", "c"])
values = st.one_of(st.none(), st.integers(-50, 50).map(float))


@settings(**SETTINGS)
@given(left=st.lists(st.tuples(keys, days), max_size=25, unique=True),
       right=st.lists(st.tuples(keys, days, values), max_size=25, unique_by=lambda r: r[:2]),
       bucket=st.sampled_from(["year", "month", "week", None]),
       backfill=st.booleans())
def test_asof_equals_brute_force(spark, left, right, bucket, backfill):
    want = {}
    for k, d in left:
        earlier = sorted((rd, v) for rk, rd, v in right if rk == k and rd <= d)
        v = earlier[-1][1] if earlier else None
        if v is None and backfill:
            every = sorted((rd, v2) for rk, rd, v2 in right if rk == k)
            v = every[0][1] if every else None
        want[(k, d)] = v
    l_df = spark.createDataFrame(left, "k string, d date")
    r_df = spark.createDataFrame(right, "k string, d date, v double")
    got = {(r.k, r.d): r.v for r in
           asof_join(l_df, r_df, "d", ["k"], ["v"], backfill=backfill, bucket=bucket).collect()}
    assert got == want


@settings(**SETTINGS)
@given(target=st.lists(st.tuples(keys, st.integers(0, 5), st.integers(0, 99)), max_size=15,
                       unique_by=lambda r: r[:2]),
       batch=st.lists(st.tuples(keys, st.integers(0, 5), st.integers(100, 199)), max_size=15))
def test_upsert_matches_model_and_is_idempotent(spark, target, batch):
    model = {(k, n): v for k, n, v in target}
    for k, n, v in batch:            # later batch rows win
        model[(k, n)] = v
    t_df = spark.createDataFrame(target, "k string, n int, v int")
    b_df = spark.createDataFrame([(k, n, v, i) for i, (k, n, v) in enumerate(batch)],
                                 "k string, n int, v int, seq int")
    once = upsert(t_df, b_df, ["k", "n"], ["seq"], ["k", "n", "v"])
    got = {(r.k, r.n): r.v for r in once.collect()}
    assert got == model
    twice = upsert(once, b_df, ["k", "n"], ["seq"], ["k", "n", "v"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


@settings(**SETTINGS)
@given(right=st.lists(st.tuples(days, st.integers(0, 9).map(float)), min_size=1, max_size=20,
                      unique_by=lambda r: r[0]))
def test_asof_never_looks_ahead(spark, right):
    left = sorted({d for d, _ in right} | {BASE + dt.timedelta(500)})
    l_df = spark.createDataFrame([(d,) for d in left], "d date")
    r_df = spark.createDataFrame([(d, d.toordinal()) for d, _ in right], "d date, src long")
    for r in asof_join(l_df, r_df, "d", [], ["src"], bucket="month").collect():
        if r.src is not None:
            assert r.src <= r.d.toordinal()


@settings(**SETTINGS)
@given(series=st.dictionaries(keys, st.lists(st.integers(0, 800), min_size=1, max_size=40,
                                             unique=True), min_size=1),
       bucket=st.sampled_from(["year", "month"]))
def test_bucketed_series_windows_equal_per_series(spark, series, bucket):
    import decimal
    from cadence.plans.consolidate import market_metrics
    rows = [(k, BASE + dt.timedelta(d), decimal.Decimal(100 + (d * 37) % 900), None, None)
            for k, days_ in series.items() for d in days_]
    m = spark.createDataFrame(rows, "coin_id string, reference_date date, "
                                    "price_usd decimal(20,8), market_cap_usd decimal(30,2), "
                                    "volume_24h_usd decimal(30,2)")
    a = sorted(map(tuple, market_metrics(m, None).collect()))
    b = sorted(map(tuple, market_metrics(m, bucket).collect()))
    assert a == b
