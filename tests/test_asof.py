import datetime as dt
import random

import pytest

from cadence.operators.asof import asof_join

D = dt.date


def brute(left, right, backfill):
    """left: [(key, day)], right: [(key, day, v)] -> {(key, day): v}"""
    out = {}
    for k, d in left:
        cands = [(rd, v) for rk, rd, v in right if rk == k and rd <= d]
        if cands:
            v = max(cands)[1]
        else:
            v = None
        if v is None and backfill:
            allk = [(rd, v2) for rk, rd, v2 in right if rk == k]
            v = min(allk)[1] if allk else None
        out[(k, d)] = v
    return out


def run(spark, left, right, backfill=True, bucket="year"):
    l_df = spark.createDataFrame(left, "k string, d date")
    r_df = spark.createDataFrame(right, "k string, d date, v double")
    res = asof_join(l_df, r_df, on="d", by=["k"], values=["v"], backfill=backfill, bucket=bucket)
    return {(r.k, r.d): r.v for r in res.collect()}


def test_exact_before_between_after(spark):
    right = [("dolar", D(2026, 1, 5), 5.0), ("dolar", D(2026, 1, 10), 5.5)]
    left = [("dolar", D(2026, 1, 5)), ("dolar", D(2026, 1, 1)), ("dolar", D(2026, 1, 7)),
            ("dolar", D(2026, 2, 1)), ("ipca", D(2026, 1, 7))]
    got = run(spark, left, right, backfill=True)
    assert got[("dolar", D(2026, 1, 5))] == 5.0          # exactly on: inclusive
    assert got[("dolar", D(2026, 1, 1))] == 5.0          # before all: earliest fallback
    assert got[("dolar", D(2026, 1, 7))] == 5.0          # between
    assert got[("dolar", D(2026, 2, 1))] == 5.5          # after all: forward fill
    assert got[("ipca", D(2026, 1, 7))] is None          # indicator without rows
    no_fb = run(spark, left, right, backfill=False)
    assert no_fb[("dolar", D(2026, 1, 1))] is None


def test_carry_across_empty_buckets(spark):
    right = [("k", D(2020, 3, 1), 1.0), ("k", D(2023, 6, 1), 2.0)]
    left = [("k", D(2021, 1, 1)), ("k", D(2022, 12, 31)), ("k", D(2023, 5, 31)),
            ("k", D(2023, 6, 1)), ("k", D(2019, 1, 1))]
    for bucket in ("year", "month", None):
        got = run(spark, left, right, bucket=bucket)
        assert got == {("k", D(2021, 1, 1)): 1.0, ("k", D(2022, 12, 31)): 1.0,
                       ("k", D(2023, 5, 31)): 1.0, ("k", D(2023, 6, 1)): 2.0,
                       ("k", D(2019, 1, 1)): 1.0}


def test_null_as_of_value_falls_back_to_earliest(spark):
    right = [("k", D(2020, 1, 1), 1.0), ("k", D(2020, 1, 5), None)]
    got = run(spark, [("k", D(2020, 1, 6))], right)
    assert got[("k", D(2020, 1, 6))] == 1.0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = D(2019, 1, 1)
    right = []
    for k in ("a", "b", "c"):
        days = rnd.sample(range(0, 1500), rnd.randint(0, 40))
        right += [(k, base + dt.timedelta(x), float(rnd.randint(1, 999))) for x in days]
    left = [(rnd.choice("abcd"), base + dt.timedelta(rnd.randint(-30, 1600))) for _ in range(300)]
    left = list(set(left))
    want = brute(left, right, backfill=True)
    for bucket in ("year", "month", "week", None):
        assert run(spark, left, right, bucket=bucket) == want


def test_left_columns_are_kept_and_values_never_look_ahead(spark):
    l_df = spark.createDataFrame([("k", D(2020, 1, 3), "x")], "k string, d date, tag string")
    r_df = spark.createDataFrame([("k", D(2020, 1, 2), 1.0), ("k", D(2020, 1, 4), 2.0)],
                                 "k string, d date, v double")
    row = asof_join(l_df, r_df, "d", ["k"], ["v"]).collect()[0]
    assert (row.k, row.d, row.tag, row.v) == ("k", D(2020, 1, 3), "x", 1.0)


def test_numeric_on_with_width_bucket(spark):
    l_df = spark.createDataFrame([("k", 15), ("k", 250), ("k", 5)], "k string, t long")
    r_df = spark.createDataFrame([("k", 10, 1.0), ("k", 120, 2.0)], "k string, t long, v double")
    got = {r.t: r.v for r in asof_join(l_df, r_df, "t", ["k"], ["v"], bucket=50).collect()}
    assert got == {15: 1.0, 250: 2.0, 5: None}


def test_null_keys_never_match(spark):
    l_df = spark.createDataFrame([(None, D(2020, 1, 5)), ("k", D(2020, 1, 5))], "k string, d date")
    r_df = spark.createDataFrame([(None, D(2020, 1, 1), 1.0), ("k", D(2020, 1, 2), 2.0)],
                                 "k string, d date, v double")
    got = {r.k: r.v for r in asof_join(l_df, r_df, "d", ["k"], ["v"], backfill=True).collect()}
    assert got == {None: None, "k": 2.0}
