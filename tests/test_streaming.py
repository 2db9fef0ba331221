import json
import os

from cadence.operators.upsert import read_table
from cadence.plans.jobs import Paths
from cadence.schemas import MACRO, MARKET
from cadence.streaming import start_macro_stream, start_market_stream


def write(path, name, obj):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        json.dump(obj, f)


def test_macro_stream_picks_up_new_files_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    p = Paths(*(os.path.join(tmp_dir, n) for n in ("macro", "market", "cons", "log")))
    ck = os.path.join(tmp_dir, "ck")
    write(os.path.join(landing, "indicator=dolar"), "d1.json",
          [{"data": "01/01/2026", "valor": "5,2"}, {"data": "02/01/2026", "valor": "5,3"}])
    start_macro_stream(spark, landing, p, ck).awaitTermination(120)
    assert read_table(spark, p.macro, MACRO).count() == 2
    write(os.path.join(landing, "indicator=dolar"), "d2.json",
          [{"data": "02/01/2026", "valor": "5,4"}, {"data": "03/01/2026", "valor": "5,5"}])
    write(os.path.join(landing, "indicator=selic"), "s1.json",
          [{"data": "02/01/2026", "valor": "0,05"}])
    start_macro_stream(spark, landing, p, ck).awaitTermination(120)
    rows = {(r.indicator, r.reference_date.day): float(r.valor)
            for r in read_table(spark, p.macro, MACRO).collect()}
    assert rows == {("dolar", 1): 5.2, ("dolar", 2): 5.4, ("dolar", 3): 5.5, ("selic", 2): 0.05}


def test_market_stream(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    p = Paths(*(os.path.join(tmp_dir, n) for n in ("macro", "market", "cons", "log")))
    ms = 1714521600000
    write(os.path.join(landing, "coin_id=bitcoin"), "b.json",
          {"prices": [[ms, 60000.0], [ms + 86400000, 60500.0]],
           "market_caps": [[ms, 1e9], [ms + 86400000, 1.01e9]],
           "total_volumes": [[ms, 2e7], [ms + 86400000, 2.1e7]]})
    start_market_stream(spark, landing, p, os.path.join(tmp_dir, "ck")).awaitTermination(120)
    rows = read_table(spark, p.market, MARKET).collect()
    assert sorted(float(r.price_usd) for r in rows) == [60000.0, 60500.0]


def test_failed_batch_is_retried_after_restart(spark, tmp_dir):
    import pytest
    landing = os.path.join(tmp_dir, "landing")
    p = Paths(*(os.path.join(tmp_dir, n) for n in ("macro", "market", "cons", "log")))
    ck = os.path.join(tmp_dir, "ck")
    bad = os.path.join(landing, "indicator=dolar")
    write(bad, "d1.json", [{"data": "01/01/2026", "valor": "50,0"}])      # out of range
    with pytest.raises(Exception) as e:
        start_macro_stream(spark, landing, p, ck).awaitTermination(120)
    assert "bcb_indicators[dolar]" in str(e.value)
    assert not os.path.exists(p.macro)
    write(bad, "d1.json", [{"data": "01/01/2026", "valor": "5,0"}])       # corrected in place
    start_macro_stream(spark, landing, p, ck).awaitTermination(120)
    assert [float(r.valor) for r in read_table(spark, p.macro, MACRO).collect()] == [5.0]
