import datetime as dt
import statistics

import pytest

from cadence.plans.transforms import transform_macro, transform_market

BTC = [45000, 45500, 45200, 46000, 45900, 46500, 47000, 46800, 47500, 47200]


def market_rows(spark, series):
    rows = []
    for coin, prices in series.items():
        for i, p in enumerate(prices):
            rows.append((coin, dt.datetime(2026, 1, 1) + dt.timedelta(days=i), float(p),
                         p * 2e7, 1e9))
    return spark.createDataFrame(rows, "coin_id string, reference_date timestamp, "
                                       "price_usd double, market_cap_usd double, "
                                       "volume_24h_usd double")


def brute_market(prices):
    pct = [None] + [(b - a) / a * 100 for a, b in zip(prices, prices[1:])]
    vol = []
    for i in range(len(prices)):
        window = [x for x in pct[max(0, i - 6): i + 1] if x is not None]
        vol.append(statistics.stdev(window) if len(window) >= 2 else None)
    return pct, vol


def test_macro_parses_dates_and_annualises_selic_only(spark):
    df = spark.createDataFrame(
        [("dolar", "01/01/2026", 5.2), ("selic", "02/01/2026", 0.05),
         ("ipca", "03/01/2026", 0.45), ("dolar", "04/01/2026", 5.18),
         ("selic", "5/1/2026", 0.052)],
        "indicator string, reference_date string, valor double")
    out = {(r.indicator, r.reference_date): r for r in transform_macro(df).collect()}
    assert out[("dolar", dt.date(2026, 1, 1))].selic_annual is None
    sel = out[("selic", dt.date(2026, 1, 2))].selic_annual
    assert sel == pytest.approx(((1 + 0.05 / 100) ** 252 - 1) * 100, rel=1e-12)
    # one-digit day and month are accepted
    assert ("selic", dt.date(2026, 1, 5)) in out
    assert len(out) == 5
    assert dict(transform_macro(df).dtypes)["valor"] == "double"


def test_macro_drops_null_values_keeps_null_indicator(spark):
    df = spark.createDataFrame(
        [("dolar", "01/01/2026", 5.2), ("selic", "02/01/2026", None),
         (None, "03/01/2026", 0.45)],
        "indicator string, reference_date string, valor double")
    out = transform_macro(df).collect()
    assert len(out) == 2
    assert {r.indicator for r in out} == {"dolar", None}


def test_macro_bad_date_raises(spark):
    df = spark.createDataFrame([("dolar", "2026-01-01", 5.2)],
                               "indicator string, reference_date string, valor double")
    with pytest.raises(Exception):
        transform_macro(df).collect()


def test_market_change_and_volatility_match_brute_force(spark):
    out = transform_market(market_rows(spark, {"bitcoin": BTC})).orderBy("reference_date")
    rows = out.collect()
    pct, vol = brute_market(BTC)
    assert [r.pct_change_1d for r in rows][0] is None
    for r, p, v in zip(rows, pct, vol):
        if p is None:
            assert r.pct_change_1d is None
        else:
            assert r.pct_change_1d == pytest.approx(p, rel=1e-12)
        if v is None:
            assert r.volatility_7d is None
        else:
            assert r.volatility_7d == pytest.approx(v, rel=1e-9)
    # hand-computed: 500 / 45000 * 100
    assert rows[1].pct_change_1d == pytest.approx(1.1111111111, rel=1e-9)
    assert isinstance(rows[0].reference_date, dt.date)


def test_market_windows_are_per_asset(spark):
    out = transform_market(market_rows(spark, {"bitcoin": [45000, 45500],
                                               "ethereum": [2500, 2510]}))
    got = {(r.coin_id, r.reference_date.day): r.pct_change_1d for r in out.collect()}
    assert got[("bitcoin", 1)] is None and got[("ethereum", 1)] is None
    assert got[("ethereum", 2)] == pytest.approx(0.4)
    assert got[("bitcoin", 2)] == pytest.approx(500 / 45000 * 100)


def test_market_order_of_input_does_not_matter(spark):
    import random
    rnd = random.Random(7)
    df = market_rows(spark, {"bitcoin": BTC})
    rows = df.collect()
    rnd.shuffle(rows)
    shuffled = spark.createDataFrame(rows, df.schema).repartition(3)
    a = {r.reference_date: r.volatility_7d for r in transform_market(df).collect()}
    b = {r.reference_date: r.volatility_7d for r in transform_market(shuffled).collect()}
    assert a == b


def test_market_sorted_by_asset_and_day(spark):
    df = market_rows(spark, {"ethereum": [2500, 2510, 2490], "bitcoin": [45000, 45500]})
    rows = df.collect()
    shuffled = spark.createDataFrame(list(reversed(rows)), df.schema).repartition(3)
    keys = [(r.coin_id, r.reference_date) for r in
            transform_market(shuffled, ordered=True).collect()]
    assert keys == sorted(keys)


def test_market_drops_rows_missing_critical_values(spark):
    df = spark.createDataFrame(
        [("bitcoin", dt.datetime(2026, 1, 1), 45000.0, 1.0, 1.0),
         ("bitcoin", dt.datetime(2026, 1, 2), None, 1.0, 1.0),
         (None, dt.datetime(2026, 1, 3), 45000.0, 1.0, 1.0)],
        "coin_id string, reference_date timestamp, price_usd double, "
        "market_cap_usd double, volume_24h_usd double")
    assert transform_market(df).count() == 1


def test_market_zero_previous_price_gives_null_change(spark):
    out = transform_market(market_rows(spark, {"x": [0, 10]})).orderBy("reference_date")
    assert [r.pct_change_1d for r in out.collect()] == [None, None]
