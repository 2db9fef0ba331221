import datetime as dt
import json
import os

import pytest

from cadence.operators.quality import DataQualityError
from cadence.plans.jobs import Paths, load_macro, run_all, run_consolidation
from cadence.schemas import CONSOLIDATED, MACRO, MARKET
from cadence.sources.payloads import parse_market_payload
from cadence.sources.tables import read_run_log, run_log_json
from cadence.operators.upsert import read_table

D = dt.date


def paths(tmp):
    return Paths(*(os.path.join(tmp, n) for n in ("macro", "market", "consolidated", "log")))


def landed_macro(spark, days=10):
    rows = []
    for i in range(days):
        d = (dt.date(2026, 1, 2) + dt.timedelta(i)).strftime("%d/%m/%Y")
        rows += [("dolar", d, 5.2 + i / 100), ("selic", d, 0.05)]
    rows.append(("ipca", "01/01/2026", 0.45))
    return spark.createDataFrame(rows, "indicator string, reference_date string, valor double")


def landed_market(spark, days=10):
    start = 1767225600000                       # 2026-01-01 UTC
    docs = []
    for coin, base in (("bitcoin", 45000.0), ("ethereum", 2500.0)):
        pts = [[start + i * 86400000, base * (1 + 0.01 * ((-1) ** i))] for i in range(days)]
        docs.append((coin, json.dumps({"prices": pts, "market_caps": pts,
                                       "total_volumes": [[p[0], 2e7] for p in pts]})))
    return parse_market_payload(spark.createDataFrame(docs, "coin_id string, payload string"))


def test_full_run_and_run_log(spark, tmp_dir):
    p = paths(tmp_dir)
    res = run_all(spark, landed_macro(spark), landed_market(spark), p)
    assert res == {"macro": 21, "market": 20, "consolidated": 20}
    cons = read_table(spark, p.consolidated, CONSOLIDATED)
    assert cons.where("dolar_brl IS NULL").count() == 0
    first = cons.where("coin_id = 'bitcoin' AND reference_date = DATE'2026-01-01'").first()
    assert str(first.dolar_brl) == "5.200000"      # before the first FX day: earliest value
    log = read_run_log(spark, p.run_log)
    assert sorted(r.status for r in log.collect()) == ["success"] * 3
    assert run_log_json(log).count() == 3
    # a second identical run leaves the same tables
    run_all(spark, landed_macro(spark), landed_market(spark), p)
    assert read_table(spark, p.market, MARKET).count() == 20
    assert read_table(spark, p.macro, MACRO).count() == 21
    assert read_table(spark, p.consolidated, CONSOLIDATED).count() == 20


def test_failed_validation_is_logged_and_raised(spark, tmp_dir):
    p = paths(tmp_dir)
    bad = spark.createDataFrame([("dolar", "01/01/2026", 50.0)],
                                "indicator string, reference_date string, valor double")
    with pytest.raises(DataQualityError):
        load_macro(spark, bad, p)
    log = read_run_log(spark, p.run_log).collect()
    assert [r.status for r in log] == ["failed"]
    assert "bcb_indicators[dolar]" in log[0].error_message
    assert not os.path.exists(p.macro)


def test_consolidation_since_date_updates_slice(spark, tmp_dir):
    p = paths(tmp_dir)
    run_all(spark, landed_macro(spark), landed_market(spark), p)
    n = run_consolidation(spark, p, start_date=D(2026, 1, 5), validate_when="after")
    assert n == 20
    cons = read_table(spark, p.consolidated, CONSOLIDATED)
    r = cons.where("coin_id = 'bitcoin' AND reference_date = DATE'2026-01-05'").first()
    assert r.pct_change_1d is None                  # reference mode cuts the predecessor
