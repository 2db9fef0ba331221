"""Prefix scans and the as-of forms built on them, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cadence.operators.asof import asof_by_day, asof_join
from cadence.operators.prefix import last_known, row_numbers, running_sum

D0 = dt.date(2026, 1, 1)


def rows(n=300, seed=4):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot", "hot", "a", None]), rng.randrange(20),
             rng.choice([None, 1, 2, 5])) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, k string, t int, v long").repartition(6)


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_running_sum_per_key(spark, parts):
    data = rows()
    got = {r.id: r.running for r in
           running_sum(frame(spark, data), "v", ["t", "id"], ["k"], parts=parts).collect()}
    total, want = {}, {}
    for i, k, _, v in sorted(data, key=lambda r: (r[2], r[0])):
        total[k] = total.get(k, 0) + (v or 0)
        want[i] = total[k]
    assert got == want


def test_row_numbers(spark):
    data = rows()
    got = {r.id: r.row_number for r in
           row_numbers(frame(spark, data), ["t", "id"], parts=5).collect()}
    order = sorted(data, key=lambda r: (r[2], r[0]))
    assert got == {r[0]: n + 1 for n, r in enumerate(order)}
    assert row_numbers(frame(spark, []), ["t", "id"]).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_last_known_is_carried_over_parts(spark, parts):
    """With 50 parts for 60 rows most parts hold no value."""
    data = [(i, None, i, i if i % 23 == 7 else None) for i in range(60)]
    got = {r.id: r.known for r in
           last_known(frame(spark, data), "v", ["t", "id"], "known", parts).collect()}
    last, want = None, {}
    for i, _, _, v in data:
        last = v if v is not None else last
        want[i] = last
    assert got == want


def test_prefix_scan_has_no_window_over_all_rows(spark):
    plan = running_sum(frame(spark, rows()), "v", ["t", "id"], ["k"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan and "CartesianProduct" not in plan


def test_asof_of_one_long_series(spark):
    rng = random.Random(8)
    right = sorted(rng.sample(range(0, 4000), 300))
    left = [(n, rng.choice([None, rng.randrange(-50, 4100)])) for n in range(1500)]
    out = asof_join(spark.createDataFrame(left, "n int, t int").repartition(5),
                    spark.createDataFrame([(t, f"v{t}") for t in right], "t int, value string"),
                    "t", values=["value"], backfill=True)
    want = {n: f"v{max((r for r in right if t is not None and r <= t), default=right[0])}"
            for n, t in left}
    assert {r.n: r.value for r in out.collect()} == want


def day(n):
    return None if n is None else D0 + dt.timedelta(n)


@pytest.mark.parametrize("backfill", [True, False])
def test_asof_by_day_equals_brute_force(spark, backfill):
    rng = random.Random(6)
    right = {k: sorted(rng.sample(range(0, 400), n)) for k, n in (("a", 40), ("b", 1), ("c", 9))}
    macro = spark.createDataFrame([(k, day(t), None if t % 7 == 0 else float(t))
                                   for k, ts in right.items() for t in ts]
                                  + [(None, day(3), 1.0), ("a", None, 2.0)],
                                  "k string, day date, value double")
    left = [(n, rng.choice(["a", "b", "c", "none", None]),
             rng.choice([None] + [rng.randrange(-30, 450)] * 9)) for n in range(600)]
    facts = spark.createDataFrame([(n, k, day(t)) for n, k, t in left], "n int, k string, day date")
    out = asof_by_day(facts, macro, "day", ["k"], ["value"], backfill=backfill)

    def value(t):
        return None if t % 7 == 0 else float(t)

    def want(k, t):
        ts = right.get(k, [])
        past = [r for r in ts if t is not None and r <= t]
        found = value(past[-1]) if past else None
        return value(ts[0]) if found is None and backfill and ts else found

    assert {r.n: r.value for r in out.collect()} == {n: want(k, t) for n, k, t in left}


def test_asof_by_day_puts_no_window_over_the_facts(spark):
    facts = spark.range(1000).select(F.lit("a").alias("k"), F.expr(
        "date_add(DATE'2026-01-01', CAST(id AS INT))").alias("day"))
    macro = spark.createDataFrame([("a", D0, 1.0)], "k string, day date, value double")
    plan = asof_by_day(facts, macro, "day", ["k"], ["value"])._jdf.queryExecution() \
        .optimizedPlan().toString()
    window = [line for line in plan.splitlines() if "Window" in line]
    below = plan.split("Window", 1)[1]
    assert len(window) == 1 and "Range (0, 1000" not in below
    with pytest.raises(ValueError):
        asof_by_day(facts, macro, "day", [], ["value"])
