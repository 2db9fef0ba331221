import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from cadence.functions.formatting import format_br_number, format_percent_int, format_reais
from cadence.plans import reports as R

D = dt.date
Dec = decimal.Decimal


@pytest.fixture()
def facts(spark):
    rows = [("bitcoin", D(2026, 1, 1), 100.0, 500.0, 5.0, None, None, 11.0, 0.4),
            ("bitcoin", D(2026, 1, 2), 110.0, 561.0, 5.1, 10.0, None, 11.0, 0.4),
            ("bitcoin", D(2026, 1, 3), 99.0, 510.0, 5.15, -10.0, 14.1, 11.0, 0.5),
            ("ethereum", D(2026, 1, 1), 10.0, 50.0, 5.0, None, None, 11.0, 0.4),
            ("ethereum", D(2026, 1, 2), 10.0, 51.0, 5.1, 0.0, None, 11.0, 0.4)]
    return spark.createDataFrame(rows, "coin_id string, reference_date date, price_usd double, "
                                       "price_brl double, dolar_brl double, pct_change_1d double, "
                                       "volatility_7d double, selic_annual_rate double, "
                                       "ipca_monthly double")


def test_format_numbers(spark):
    df = spark.createDataFrame([(1234567.5,), (2.5,), (None,), (0.745,)], "x double")
    got = [tuple(r) for r in df.select(format_br_number("x"), format_br_number("x", True),
                                       format_percent_int("x"), format_reais("x")).collect()]
    assert got[0][0] == "1.234.568"
    assert got[1][0] == "2"                      # half-even, as Python's format
    assert got[2] == ("-", "-", "-", "-")
    assert got[3][1] == "74%" or got[3][1] == "75%"
    assert got[0][3] == "R$ 1.234.568"
    assert got[1][2] == "250%"


def test_summary_and_ranking(facts):
    s = {r.coin_id: r for r in R.asset_summary(facts).collect()}
    assert s["bitcoin"].avg_daily_return == 0.0
    assert s["ethereum"].avg_volatility is None
    first = R.asset_summary(facts).first()
    assert first.coin_id == "ethereum"           # NULL volatility sorts first
    rank = [r.coin_id for r in R.price_ranking(facts).collect()]
    assert rank == ["bitcoin", "ethereum"]


def test_kpi_panel_one_scan(facts):
    k = R.kpi_panel(facts, "bitcoin").first()
    assert (k.total_rows, k.total_coins, k.latest_date) == (5, 2, D(2026, 1, 3))
    assert k.avg_price_brl == pytest.approx((500 + 561 + 510) / 3)
    assert k.latest_price_brl == 510.0
    import statistics
    assert k.corr_price_fx == pytest.approx(statistics.correlation([500, 561, 510],
                                                                   [5.0, 5.1, 5.15]))
    f = R.kpi_panel_formatted(R.kpi_panel(facts, "bitcoin")).first()
    assert f.total_rows == "5" and f.latest_price_brl == "R$ 510"


def test_constant_column_correlation_is_null(facts):
    c = {r.coin_id: r for r in R.corr_matrix(facts).collect()}
    assert c["bitcoin"].corr_selic_annual_rate is None
    assert c["bitcoin"].corr_dolar_brl is not None


def test_history_latest_and_fx(facts):
    h = R.asset_history(facts, "bitcoin").collect()
    assert [r.reference_date.day for r in h] == [1, 2, 3]
    assert R.history_series(facts, "bitcoin", "volatility_7d").count() == 1
    assert R.latest_row(facts, "bitcoin").first().price_brl == 510.0
    assert R.fx_history(facts).count() == 5


def test_period_return_histogram_counts(facts):
    p = {r.coin_id: r for r in R.period_return(facts).collect()}
    assert p["bitcoin"].period_return_pct == pytest.approx(-1.0)
    h = {(r.coin_id, r.bucket_lo): r.days for r in R.return_histogram(facts, 5.0).collect()}
    assert h == {("bitcoin", 10.0): 1, ("bitcoin", -10.0): 1, ("ethereum", 0.0): 1}
    n = R.null_counts(facts).first()
    assert n.pct_change_1d == 2 and n.volatility_7d == 4
    c = R.computed_counts(facts).first()
    assert (c.n_pct_change, c.n_volatility, c.n_selic_annual) == (3, 1, 5)


def test_parametrised_query_and_scalar(spark, facts):
    facts.createOrReplaceTempView("daily_consolidated")
    df = R.run_query(spark, "SELECT AVG(price_brl) FROM daily_consolidated "
                            "WHERE coin_id = :coin_id", {"coin_id": "ethereum"})
    assert R.scalar(df) == pytest.approx(50.5)
    assert R.scalar(facts.where(F.lit(False))) is None


def test_count_report_csv_and_missing_table(spark, facts, tmp_dir):
    import os
    from cadence.sources.tables import count_report, write_count_report_csv
    rep = count_report({"daily_consolidated": facts, "crypto_market": None})
    got = {r.table_name: r.row_count for r in rep.collect()}
    assert got == {"daily_consolidated": 5, "crypto_market": 0}
    out = os.path.join(tmp_dir, "counts")
    write_count_report_csv(rep, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out))
                   if f.endswith(".csv"))
    assert text.splitlines()[0] == "Tabela,Quantidade de Registros,Data da Captura"
    assert "daily_consolidated,5," in text


def test_run_log_json_lines(spark):
    import datetime as _dt
    import json
    from cadence.sources.tables import run_log_entry, run_log_json
    log = run_log_entry(spark, "dag", "task", "macro", "failed", 0, "boom",
                        _dt.datetime(2026, 1, 1), _dt.datetime(2026, 1, 1, 0, 0, 1))
    line = json.loads(run_log_json(log).first().line)
    assert line == {"timestamp": "2026-01-01T00:00:01.000000", "level": "ERROR",
                    "logger": "cadence.jobs", "message": "dag/task - failed (0 rows)",
                    "exception": "boom"}


def test_dashboard_views_share_one_table(facts):
    views = R.dashboard(facts, "bitcoin")
    try:
        assert views["kpi"].first().total_rows == 5
        assert [r.coin_id for r in views["assets"].collect()] == ["bitcoin", "ethereum"]
        assert views["price_series"].count() == 3
        assert views["summary_formatted"].count() == 2
    finally:
        views["table"].unpersist()
