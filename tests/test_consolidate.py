import datetime as dt
import decimal
import statistics

import pytest

from cadence.plans.consolidate import consolidate, market_metrics

D = dt.date
Dec = decimal.Decimal

PRICES = [45000, 45500, 45200, 46000, 45900, 46500, 47000, 46800, 47500, 47200]


def market_df(spark, series, start=D(2026, 1, 1)):
    rows = []
    for coin, prices in series.items():
        for i, p in enumerate(prices):
            rows.append((coin, start + dt.timedelta(days=i), Dec(str(p)), Dec("1000000000.00"),
                         Dec("20000000.00")))
    return spark.createDataFrame(
        rows, "coin_id string, reference_date date, price_usd decimal(20,8), "
              "market_cap_usd decimal(30,2), volume_24h_usd decimal(30,2)")


def macro_df(spark, rows):
    return spark.createDataFrame(
        [(i, d, Dec(v)) for i, d, v in rows],
        "indicator string, reference_date date, valor decimal(15,8)")


MACRO = [("dolar", D(2026, 1, 2), "5.12345678"), ("dolar", D(2026, 1, 6), "5.20000050"),
         ("selic", D(2026, 1, 3), "0.043739"), ("ipca", D(2026, 1, 1), "0.45"),
         ("ipca", D(2026, 2, 1), "0.52")]


def half_up(x, digits):
    return Dec(x).quantize(Dec(1).scaleb(-digits), rounding=decimal.ROUND_HALF_UP)


def test_consolidation_values_by_hand(spark):
    out = consolidate(market_df(spark, {"bitcoin": PRICES}), macro_df(spark, MACRO),
                      created_at="2026-01-01 00:00:00")
    rows = {r.reference_date: r for r in out.collect()}
    assert len(rows) == 10
    d1, d2, d3 = rows[D(2026, 1, 1)], rows[D(2026, 1, 2)], rows[D(2026, 1, 3)]
    # pct: previous row, rounded 4, half away from zero
    assert d1.pct_change_1d is None
    assert d2.pct_change_1d == Dec("1.1111")
    assert d3.pct_change_1d == Dec("-0.6593")
    # volatility over the rounded changes; one value -> NULL
    assert d2.volatility_7d is None
    assert d3.volatility_7d == half_up(statistics.stdev([1.1111, -0.6593]), 4)
    # day 1 is before the first FX row: earliest value fallback
    assert d1.dolar_brl == Dec("5.123457")
    # price_brl uses the 8-digit FX, stored at 8 digits
    assert d1.price_brl == half_up(Dec("45000") * Dec("5.12345678"), 8)
    # forward fill between macro days; the policy rate falls back before 01/03
    assert rows[D(2026, 1, 5)].dolar_brl == Dec("5.123457")
    assert rows[D(2026, 1, 6)].dolar_brl == Dec("5.200001")   # 5.2000005 rounds up
    assert d1.selic_daily_rate == Dec("0.04373900")
    assert d1.selic_annual_rate == Dec("11.649932")
    assert rows[D(2026, 1, 10)].ipca_monthly == Dec("0.4500")


def test_volatility_window_is_seven_rows(spark):
    out = consolidate(market_df(spark, {"bitcoin": PRICES}), macro_df(spark, MACRO))
    rows = sorted(out.collect(), key=lambda r: r.reference_date)
    pct = [None if r.pct_change_1d is None else float(r.pct_change_1d) for r in rows]
    for i, r in enumerate(rows):
        window = [x for x in pct[max(0, i - 6): i + 1] if x is not None]
        want = half_up(statistics.stdev(window), 4) if len(window) > 1 else None
        assert r.volatility_7d == want


def test_row_count_equals_market_and_partition_invariance(spark):
    m = market_df(spark, {"bitcoin": PRICES, "ethereum": [2500, 2510, 2490, 2600]})
    a = sorted(map(tuple, consolidate(m, macro_df(spark, MACRO), created_at="2026-01-01")
                   .collect()))
    assert len(a) == 14
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        b = sorted(map(tuple, consolidate(m.repartition(5), macro_df(spark, MACRO),
                                          created_at="2026-01-01").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert a == b


def test_start_date_reference_vs_lookback(spark):
    m = market_df(spark, {"bitcoin": PRICES})
    ref = {r.reference_date: r for r in
           consolidate(m, macro_df(spark, MACRO), D(2026, 1, 5)).collect()}
    look = {r.reference_date: r for r in
            consolidate(m, macro_df(spark, MACRO), D(2026, 1, 5), mode="lookback").collect()}
    full = {r.reference_date: r for r in consolidate(m, macro_df(spark, MACRO)).collect()}
    assert set(ref) == set(look) == {D(2026, 1, d) for d in range(5, 11)}
    assert ref[D(2026, 1, 5)].pct_change_1d is None            # predecessor cut off
    assert look[D(2026, 1, 5)].pct_change_1d == full[D(2026, 1, 5)].pct_change_1d
    for d in look:
        assert look[d].volatility_7d == full[d].volatility_7d


def test_zero_previous_price_raises_in_exact_mode(spark):
    m = market_df(spark, {"x": [0, 10]})
    with pytest.raises(Exception):
        market_metrics(m).collect()


def test_asset_with_one_row(spark):
    out = consolidate(market_df(spark, {"solo": [100]}), macro_df(spark, MACRO)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.pct_change_1d is None and r.volatility_7d is None
    assert r.price_brl == half_up(Dec("100") * Dec("5.12345678"), 8)


@pytest.mark.parametrize("bucket", ["year", "month"])
def test_bucketed_windows_equal_per_asset_windows(spark, bucket):
    import random
    rnd = random.Random(11)
    rows = []
    for coin in ("a", "b", "c"):
        for d in sorted(rnd.sample(range(0, 1100), rnd.randint(1, 250))):
            rows.append((coin, D(2019, 12, 20) + dt.timedelta(d), Dec(rnd.randint(100, 999)),
                         Dec("1.00"), Dec("1.00")))
    m = spark.createDataFrame(rows, "coin_id string, reference_date date, "
                                    "price_usd decimal(20,8), market_cap_usd decimal(30,2), "
                                    "volume_24h_usd decimal(30,2)")
    a = sorted(map(tuple, consolidate(m, macro_df(spark, MACRO), created_at="2026-01-01")
                   .collect()))
    b = sorted(map(tuple, consolidate(m, macro_df(spark, MACRO), created_at="2026-01-01",
                                      series_bucket=bucket).collect()))
    assert a == b


def test_lookback_with_sparse_and_delisted_assets(spark):
    rows = []
    # delisted long ago: must not pull the cut back
    for i in range(10):
        rows.append(("old", D(2020, 1, 1) + dt.timedelta(i), Dec(100 + i), Dec("1"), Dec("1")))
    # sparse: one row a month, so its 7-row frame reaches far back
    for i in range(20):
        rows.append(("sparse", D(2024, 1, 15) + dt.timedelta(30 * i), Dec(200 + 3 * i), Dec("1"),
                     Dec("1")))
    # dense: daily
    for i in range(400):
        rows.append(("dense", D(2024, 6, 1) + dt.timedelta(i), Dec(300 + (i * 7) % 50), Dec("1"),
                     Dec("1")))
    m = spark.createDataFrame(rows, "coin_id string, reference_date date, "
                                    "price_usd decimal(20,8), market_cap_usd decimal(30,2), "
                                    "volume_24h_usd decimal(30,2)")
    start = D(2025, 5, 1)
    full = {(r.coin_id, r.reference_date): r for r in
            consolidate(m, macro_df(spark, MACRO), created_at="2026-01-01").collect()}
    look = consolidate(m, macro_df(spark, MACRO), start, mode="lookback",
                       created_at="2026-01-01").collect()
    assert look and all(r.reference_date >= start for r in look)
    for r in look:
        f = full[(r.coin_id, r.reference_date)]
        assert (r.pct_change_1d, r.volatility_7d) == (f.pct_change_1d, f.volatility_7d)
    from cadence.plans.consolidate import lookback_start
    cut = m.select(lookback_start(m, start).alias("c")).first().c
    assert D(2024, 1, 1) < cut < D(2025, 5, 1)      # the sparse asset sets it, not "old"
