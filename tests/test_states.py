"""Monthly states against full scans; one-pass staging; extraction in loads."""

import datetime as dt
import os
import random
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from cadence.operators.quality import DataQualityError, gap_counts
from cadence.operators.upsert import merge_staged, read_table, stage_batch, upsert_table
from cadence.plans import jobs, reports, states
from cadence.plans.jobs import Paths
from cadence.schemas import CONSOLIDATED, KEYS, MACRO, MARKET
from tests.test_jobs import landed_macro, landed_market, paths


def facts(spark, months=5, seed=1, price=None):
    rng = random.Random(seed)

    def num(scale, digits, chance=0.1):
        return None if rng.random() < chance else Dec(str(round(rng.uniform(0.5, scale), digits)))

    rows = []
    for coin in ("a", "b", "c"):
        for n in range(28 * months):
            if rng.random() < 0.2:
                continue
            fx = Dec("5.000000") if coin == "c" else num(9, 6)
            rows.append((dt.date(2025, 1, 1) + dt.timedelta(n), coin, num(9e5, 8), num(9e5, 8),
                         num(9e9, 2), num(9e9, 2), num(40, 4), num(40, 4), fx, num(1, 8),
                         num(20, 6), num(5, 4), dt.datetime(2026, 1, 1)))
    df = spark.createDataFrame(rows, CONSOLIDATED)
    return df if price is None else df.withColumn(
        "price_brl", F.lit(price).cast("decimal(20,8)"))


def same(a, b):
    left, right = ([tuple(r) for r in df.collect()] for df in (a, b.select(*a.columns)))
    for x, y in zip(sorted(left, key=str), sorted(right, key=str), strict=True):
        assert [None if v is None else pytest.approx(float(v), rel=1e-9, abs=1e-9)
                if isinstance(v, (float, Dec)) else v for v in x] == [
            float(v) if isinstance(v, Dec) else v for v in y]


def check_reports(full, state):
    same(reports.asset_summary(full), states.asset_summary(state))
    for coin in ("a", "c", "missing"):
        same(reports.kpi_panel(full, coin), states.kpi_panel(state, coin))
    same(reports.corr_matrix(full), states.corr_matrix(state))
    same(reports.period_return(full), states.period_return(state))


def test_reports_finish_from_states(spark):
    df = facts(spark)
    check_reports(df, states.monthly_states(df))


def test_constant_sides_have_no_correlation(spark):
    df = facts(spark, price="123.4")
    rows = states.corr_matrix(states.monthly_states(df)).collect()
    assert all(v is None for r in rows for v in r[1:])


def test_empty_states(spark):
    df = facts(spark).where("false")
    check_reports(df, states.monthly_states(df))


def test_refresh_computes_touched_months_only(spark, tmp_dir):
    p = Paths(*(os.path.join(tmp_dir, n) for n in ("m", "k", "facts", "log", "states")))
    touched = jobs.store_facts(spark, p, facts(spark))
    states.refresh(spark, p.states, p.consolidated, touched)
    before = {d: sorted(os.listdir(os.path.join(p.states, d)))
              for d in os.listdir(p.states) if d.startswith("ref_month")}
    assert len(before) == 5
    again = jobs.store_facts(spark, p, facts(spark, seed=9).where(
        "reference_date BETWEEN DATE'2025-02-10' AND DATE'2025-02-20' "
        "OR reference_date > DATE'2025-05-10'"))
    assert again == ["2025-02", "2025-05"]
    states.refresh(spark, p.states, p.consolidated, again)
    after = {d: sorted(os.listdir(os.path.join(p.states, d))) for d in before}
    assert {d for d in before if before[d] != after[d]} == {"ref_month=2025-02", "ref_month=2025-05"}
    check_reports(read_table(spark, p.consolidated, CONSOLIDATED),
                  states.read_states(spark, p.states))
    states.refresh(spark, p.states, p.consolidated, [])


# ------------------------------------------------------------- one-pass loads
def macro_rows(spark, n=50):
    return spark.createDataFrame(
        [("dolar", dt.date(2025, 1 + i % 2 * 8, 1 + i % 20), Dec(i)) for i in range(n)],
        "indicator string, reference_date date, valor decimal(15,8)")


def test_staging_observes_the_batch(spark, tmp_dir):
    flags = {"big": F.col("valor") > 40, "none": F.col("valor").isNull()}
    staged = stage_batch(spark, os.path.join(tmp_dir, "t"), macro_rows(spark),
                         KEYS["bcb_indicators"], flags=flags)
    assert (staged.count, staged.repeated, staged.months) == (50, 30, ["2025-01", "2025-09"])
    assert staged.counts == {"big": 9, "none": 0}
    assert staged.rows.count() == 20 and staged.rows.columns == ["indicator", "reference_date",
                                                                 "valor"]
    staged.drop()
    assert os.listdir(tmp_dir) == []


def test_staging_an_empty_batch(spark, tmp_dir):
    staged = stage_batch(spark, os.path.join(tmp_dir, "t"), macro_rows(spark).where("valor < 0"),
                         KEYS["bcb_indicators"], flags={"x": F.lit(True)})
    assert (staged.count, staged.repeated, staged.months, staged.counts) == (0, 0, [], {"x": 0})


def test_load_scans_its_batch_once(spark, tmp_dir):
    """A row-counting column of the batch runs once per row for the whole
    load: staging, rules, months and merge share one scan."""
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(len(batch))
            yield batch

    landed = landed_macro(spark, 30)
    counted = landed.mapInPandas(count, landed.schema)
    p = paths(tmp_dir)
    assert jobs.load_macro(spark, counted, p) == 61
    assert seen.value == 61
    assert jobs.load_macro(spark, counted, p) == 61      # merge into a known table
    assert seen.value == 122


def test_merge_reads_two_distant_months(spark, tmp_dir):
    path = os.path.join(tmp_dir, "macro")
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    months = spark.createDataFrame([("dolar", dt.date(2015 + m // 12, 1 + m % 12, 5), Dec(m))
                                    for m in range(120)],
                                   "indicator string, reference_date date, valor decimal(15,8)")
    upsert_table(spark, path, months.withColumn("ingested_at", stamp), KEYS["bcb_indicators"], MACRO)
    batch = months.where("reference_date IN (DATE'2015-01-05', DATE'2024-12-05')")
    staged = stage_batch(spark, path, batch.withColumn("ingested_at", stamp),
                         KEYS["bcb_indicators"])
    from cadence.operators import upsert as U
    plans, plain = [], U.upsert
    U.upsert = lambda current, *a: (plans.append(current), plain(current, *a))[1]
    try:
        merge_staged(spark, path, staged.rows, staged.months, KEYS["bcb_indicators"], MACRO)
    finally:
        U.upsert = plain
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "IN (2015-01,2024-12)]" in plan.split("PartitionFilters")[1]
    assert read_table(spark, path, MACRO).count() == 120


def test_window_and_allow_list_in_the_loads(spark, tmp_dir):
    p = paths(tmp_dir)
    assert jobs.load_market(spark, landed_market(spark), p, assets=["bitcoin"],
                            as_of="2026-01-04") == 4
    got = read_table(spark, p.market, MARKET)
    assert {r.coin_id for r in got.collect()} == {"bitcoin"}
    assert jobs.load_macro(spark, landed_macro(spark), p, indicators=["selic"],
                           as_of=dt.date(2027, 1, 5)) == 7
    assert read_table(spark, p.macro, MACRO).agg(F.min("reference_date")).first()[0] == \
        dt.date(2026, 1, 5)


def test_failed_load_leaves_no_staging(spark, tmp_dir):
    p = paths(tmp_dir)
    twice = landed_market(spark).unionByName(landed_market(spark))
    with pytest.raises(DataQualityError, match="20 linhas duplicadas"):
        jobs.load_market(spark, twice, p)
    assert os.listdir(tmp_dir) == ["log"]


def test_gap_counts(spark):
    days = {"a": [0, 7, 15, 15, 40], "b": [3], "hot": list(range(0, 900, 8)), "c": [0, 1, 7, 14]}
    df = spark.createDataFrame([(k, dt.date(2025, 1, 1) + dt.timedelta(d)) for k, ds in days.items()
                                for d in ds] + [("a", None)], "k string, day date").repartition(4)
    got = {r.k: r.gaps for r in gap_counts(df, "k", "day").collect()}
    assert got == {"a": 2, "b": 0, "hot": 112, "c": 0}
