import datetime as dt
import json
import os

import pytest

from cadence.sources.payloads import (daily_bars, parse_macro_payload, parse_market_payload,
                                      read_macro_payloads, read_market_payloads)

D = dt.date
MS1, MS2 = 1678752000000, 1678838400000    # 2023-03-14, 2023-03-15 UTC


def market_doc(prices=None, caps=None, vols=None):
    doc = {}
    if prices is not None:
        doc["prices"] = prices
    if caps is not None:
        doc["market_caps"] = caps
    if vols is not None:
        doc["total_volumes"] = vols
    return json.dumps(doc)


def test_macro_payload_decimal_comma(spark):
    docs = spark.createDataFrame(
        [("dolar", json.dumps([{"data": "09/07/2023", "valor": "7,31"},
                               {"data": "10/07/2023", "valor": "7,4"}])),
         ("selic", json.dumps([{"data": "09/07/2023", "valor": "0,031"},
                               {"data": "10/07/2023", "valor": "0,0325"}])),
         ("ipca", "[]")], "indicator string, payload string")
    rows = sorted(tuple(r) for r in parse_macro_payload(docs).collect())
    assert rows == [("dolar", "09/07/2023", 7.31), ("dolar", "10/07/2023", 7.4),
                    ("selic", "09/07/2023", 0.031), ("selic", "10/07/2023", 0.0325)]


def test_macro_payload_malformed_number_raises(spark):
    docs = spark.createDataFrame([("dolar", json.dumps([{"data": "09/07/2023",
                                                         "valor": "1.234,5"}]))],
                                 "indicator string, payload string")
    with pytest.raises(Exception):
        parse_macro_payload(docs).collect()


def test_market_payload_days_and_arrays(spark):
    doc = market_doc([[MS1, 812.25], [MS2, 799.5]], [[MS1, 3.3e6], [MS2, 3.4e6]],
                     [[MS1, 415.0], [MS2, 420.5]])
    docs = spark.createDataFrame([(c, doc) for c in ("bitcoin", "ethereum", "solana",
                                                     "binancecoin")],
                                 "coin_id string, payload string")
    out = parse_market_payload(docs)
    assert out.columns == ["coin_id", "reference_date", "price_usd", "market_cap_usd",
                           "volume_24h_usd"]
    rows = {(r.coin_id, r.reference_date): r for r in out.collect()}
    assert len(rows) == 8
    r = rows[("bitcoin", D(2023, 3, 15))]
    assert (r.price_usd, r.market_cap_usd, r.volume_24h_usd) == (799.5, 3.4e6, 420.5)


def test_market_payload_last_point_of_day_and_missing_arrays(spark):
    noon = MS1 + 12 * 3600 * 1000
    doc = market_doc([[MS1, 1.0], [noon, 2.0], [noon, 3.0], [MS2, 4.0]],
                     caps=None, vols=[[MS1, 7.0], [noon, 8.0]])
    docs = spark.createDataFrame([("x", doc), ("y", market_doc([], [[MS1, 1.0]], []))],
                                 "coin_id string, payload string")
    rows = {(r.coin_id, r.reference_date): r for r in parse_market_payload(docs).collect()}
    assert set(rows) == {("x", D(2023, 3, 14)), ("x", D(2023, 3, 15))}   # y: no prices
    day1 = rows[("x", D(2023, 3, 14))]
    assert day1.price_usd == 3.0            # tied timestamps: later array element wins
    assert day1.market_cap_usd is None      # missing array -> NULL column
    assert day1.volume_24h_usd == 8.0
    assert rows[("x", D(2023, 3, 15))].volume_24h_usd is None


def test_landed_files_with_series_from_directory(spark, tmp_dir):
    for ind, items in {"dolar": [{"data": "09/07/2023", "valor": "7,31"}],
                       "selic": [{"data": "09/07/2023", "valor": "0,031"}]}.items():
        os.makedirs(os.path.join(tmp_dir, "macro", f"indicator={ind}"))
        with open(os.path.join(tmp_dir, "macro", f"indicator={ind}", "p.json"), "w") as f:
            json.dump(items, f)
    got = sorted(tuple(r) for r in read_macro_payloads(spark, os.path.join(tmp_dir, "macro"))
                 .collect())
    assert got == [("dolar", "09/07/2023", 7.31), ("selic", "09/07/2023", 0.031)]
    os.makedirs(os.path.join(tmp_dir, "market", "coin_id=bitcoin"))
    with open(os.path.join(tmp_dir, "market", "coin_id=bitcoin", "p.json"), "w") as f:
        f.write(market_doc([[MS1, 812.25]], [[MS1, 3.3e6]], [[MS1, 415.0]]))
    m = read_market_payloads(spark, os.path.join(tmp_dir, "market")).collect()
    assert [(r.coin_id, r.reference_date, r.volume_24h_usd) for r in m] == \
        [("bitcoin", D(2023, 3, 14), 415.0)]


def test_daily_bars(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    ticks = spark.createDataFrame(
        [("a", t0, 1, 5.0), ("a", t0, 2, 7.0), ("a", t0 - dt.timedelta(hours=1), 3, 9.0),
         ("a", t0 + dt.timedelta(days=1), 4, 1.0)],
        "series string, ts timestamp, event_id long, value double")
    rows = {r.day: r for r in daily_bars(ticks).collect()}
    d = rows[D(2024, 1, 1)]
    assert (d.open, d.close, d.high, d.low, d.volume, d.points) == (9.0, 7.0, 9.0, 5.0, 21.0, 3)


@pytest.mark.parametrize("text", ['[{"data": "01/02/2023", "valor": "1', "no json",
                                  '{"error": "x"}', '[{"data": "01/02/2023"}]',
                                  '[{"valor": "1,0"}]', None])
def test_bad_macro_documents_raise(spark, text):
    docs = spark.createDataFrame([("dolar", text)], "indicator string, payload string")
    with pytest.raises(Exception):
        parse_macro_payload(docs).collect()


@pytest.mark.parametrize("text", ['{"prices": [[1678752000000, 1.5], [16787', "no json", None])
def test_bad_market_documents_raise(spark, text):
    docs = spark.createDataFrame([("x", text)], "coin_id string, payload string")
    with pytest.raises(Exception):
        parse_market_payload(docs).collect()


def _land(folder, name, text, when):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (when, when))


def test_overlapping_fetches_later_file_wins(spark, tmp_dir):
    item = lambda d, v: {"data": d, "valor": v}
    macro = os.path.join(tmp_dir, "macro")
    folder = os.path.join(macro, "indicator=dolar")
    _land(folder, "b.json", json.dumps([item("01/02/2023", "1,0"), item("02/02/2023", "2,0")]), 1000)
    _land(folder, "a.json", json.dumps([item("02/02/2023", "2,5"), item("03/02/2023", "3,0")]), 2000)
    got = sorted(tuple(r)[:3] for r in read_macro_payloads(spark, macro).select(
        "reference_date", "valor").collect())
    assert got == [("01/02/2023", 1.0), ("02/02/2023", 2.5), ("03/02/2023", 3.0)]
    market = os.path.join(tmp_dir, "market")
    folder = os.path.join(market, "coin_id=bitcoin")
    _land(folder, "b.json", market_doc([[MS1, 1.0], [MS2, 2.0]], [[MS1, 9.0]]), 1000)
    _land(folder, "a.json", market_doc([[MS2, 2.5]], [[MS2, 8.0]]), 2000)
    got = sorted(tuple(r)[1:4] for r in read_market_payloads(spark, market).collect())
    assert got == [(D(2023, 3, 14), 1.0, 9.0), (D(2023, 3, 15), 2.5, 8.0)]
