import datetime as dt

import pytest

from cadence.operators.quality import (DataQualityError, check_not_empty, documented_report,
                                       evaluate, validate, violation_report)

D1 = dt.date(2026, 1, 1)


def macro(spark, rows):
    return spark.createDataFrame(rows, "indicator string, reference_date date, valor double")


def market(spark, rows):
    return spark.createDataFrame(rows, "coin_id string, reference_date date, price_usd double, "
                                       "market_cap_usd double, volume_24h_usd double")


def test_valid_macro_passes_unchanged(spark):
    df = macro(spark, [("dolar", D1, 5.2), ("selic", D1, 0.05)])
    assert validate(df, "bcb_indicators") is df


def test_negative_inflation_is_accepted(spark):
    validate(macro(spark, [("ipca", D1, -0.12)]), "bcb_indicators")


def test_duplicate_market_key_raises(spark):
    df = market(spark, [("bitcoin", D1, 1.0, 1.0, 1.0), ("bitcoin", D1, 2.0, 1.0, 1.0)])
    with pytest.raises(DataQualityError) as e:
        validate(df, "crypto_market")
    assert "linhas duplicadas" in str(e.value)
    assert str(e.value) == "crypto_market: 1 linhas duplicadas em coin_id, reference_date"


def test_fx_out_of_range_names_the_column(spark):
    df = spark.createDataFrame([("bitcoin", D1, 60000.0, 50.0, 1.0)],
                               "coin_id string, reference_date date, price_usd double, "
                               "dolar_brl double, volatility_7d double")
    with pytest.raises(DataQualityError) as e:
        validate(df, "daily_consolidated")
    assert "dolar_brl" in str(e.value)
    assert str(e.value) == ("daily_consolidated: dolar_brl possui 1 valores fora do "
                            "intervalo [1, 10]")


def test_rule_order_nulls_before_duplicates(spark):
    df = market(spark, [("bitcoin", D1, None, 1.0, 1.0), ("bitcoin", D1, 2.0, 1.0, 1.0)])
    with pytest.raises(DataQualityError) as e:
        validate(df, "crypto_market")
    assert str(e.value) == "crypto_market: price_usd possui 1 valores nulos"


def test_nan_counts_as_null_but_passes_ranges(spark):
    df = market(spark, [("bitcoin", D1, float("nan"), 1.0, 1.0)])
    res = {(c.rule, c.column): n for c, n in evaluate(df, "crypto_market")}
    assert res[("not_null", "price_usd")] == 1
    assert res[("range", "price_usd")] == 0


def test_non_numeric_text_passes_range(spark):
    df = spark.createDataFrame([("dolar", D1, "abc"), ("dolar", D1 + dt.timedelta(1), "30")],
                               "indicator string, reference_date date, valor string")
    res = {(c.table, c.rule): n for c, n in evaluate(df, "bcb_indicators")}
    assert res[("bcb_indicators[dolar]", "range")] == 1


def test_per_indicator_ranges_and_unknown_indicators(spark):
    df = macro(spark, [("selic", D1, 150.0), ("other", D1, 1e9), ("dolar", D1, 25.0)])
    with pytest.raises(DataQualityError) as e:
        validate(df, "bcb_indicators")
    assert str(e.value).startswith("bcb_indicators[dolar]: valor possui 1")


def test_missing_columns(spark):
    df = spark.createDataFrame([("dolar", 1.0)], "indicator string, valor double")
    with pytest.raises(DataQualityError) as e:
        validate(df, "bcb_indicators")
    assert str(e.value) == "bcb_indicators: colunas ausentes: reference_date"


def test_null_keys_count_as_equal_duplicates(spark):
    df = market(spark, [(None, D1, 1.0, 1.0, 1.0), (None, D1, 1.0, 1.0, 1.0)])
    res = {c.rule: n for c, n in evaluate(df, "crypto_market")}
    assert res["unique_key"] == 1


def test_violation_report_rows(spark):
    df = market(spark, [("bitcoin", D1, 2e6, 1.0, None), ("bitcoin", D1, 1.0, 1.0, 1.0)])
    rep = {(r.rule, r.column_name): r.violations
           for r in violation_report(df, "crypto_market").collect()}
    assert rep == {("not_null", "price_usd"): 0, ("not_null", "volume_24h_usd"): 1,
                   ("unique_key", "coin_id,reference_date"): 1,
                   ("range", "price_usd"): 1, ("range", "volume_24h_usd"): 0}


def test_not_empty_check():
    assert check_not_empty(0) == 0
    with pytest.raises(DataQualityError):
        check_not_empty(None)
    with pytest.raises(DataQualityError):
        check_not_empty(0, strict=True)


def test_documented_rules(spark):
    rows = [("a", D1, 1.0), ("a", D1 + dt.timedelta(10), 1.0), ("a", D1 + dt.timedelta(11), 1.0),
            ("b", D1, 10.0), ("b", D1 + dt.timedelta(400), 10.0)]
    df = spark.createDataFrame(rows, "coin_id string, reference_date date, volatility_7d double")
    rep = {r.rule: r.violations for r in documented_report(df, D1 + dt.timedelta(30)).collect()}
    assert rep == {"future_date": 1, "gap_over_days": 2, "mean_volatility_band": 1}


def test_missing_null_checked_column_reports_missing(spark):
    df = spark.createDataFrame([("dolar", D1)], "indicator string, reference_date date")
    with pytest.raises(DataQualityError) as e:
        validate(df, "bcb_indicators")
    assert str(e.value) == "bcb_indicators: colunas ausentes: valor"
    rep = [(r.rule, r.column_name, r.violations)
           for r in violation_report(df, "bcb_indicators").collect()]
    assert rep == [("required_column", "valor", 1)]
