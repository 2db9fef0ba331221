"""Landed JSON payloads: scanning, parsing, and (for round trips) encoding.

Macro payload (one document per series request)::

    [{"data": "02/01/2024", "valor": "4,8916"}, ...]

Market payload::

    {"prices": [[ms, v], ...], "market_caps": [[ms, v], ...],
     "total_volumes": [[ms, v], ...]}

Parsing is ``from_json`` with an explicit schema and ``posexplode``; the
daily reduction of market points is one grouped aggregate (``max_by`` on
``(ms, position)``), so many points a day never fan out and the caps and
volumes need no join (a day without a price point yields no row, a missing
array leaves its column NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.functions.dates import epoch_ms_to_date
from cadence.operators.dedup import packed_order, timestamp_micros
from cadence.functions.numeric import parse_decimal_comma
from cadence.schemas import MACRO_PAYLOAD, MARKET_PAYLOAD

MARKET_ARRAYS = [("prices", "price_usd"), ("market_caps", "market_cap_usd"),
                 ("total_volumes", "volume_24h_usd")]


def _parsed(payload: str, schema) -> Column:
    """The document, or an error: malformed, truncated and missing documents
    raise instead of becoming NULL."""
    return F.from_json(_required(F.col(payload), "document"), schema, {"mode": "FAILFAST"})


def _required(value: Column, what: str) -> Column:
    return F.when(value.isNull(), F.raise_error(F.lit(f"landed payload: {what} is missing"))) \
        .otherwise(value)


# --------------------------------------------------------------------- macro
def parse_macro_payload(df: DataFrame, payload: str = "payload",
                        indicator: str = "indicator", fetched: str | None = None) -> DataFrame:
    """Rows ``(indicator, payload text)`` -> ``(indicator, reference_date
    text, valor double)``; the decimal comma is parsed strictly and a
    document that is no array of ``data``/``valor`` items raises.

    ``fetched`` names a column that orders overlapping documents: an item is
    dropped if a later document has the same indicator and day (items
    repeated inside one document stay, for the duplicate rule)."""
    order = F.col(fetched) if fetched else F.lit(0)
    items = df.select(F.col(indicator).alias("indicator"), order.alias("_fetched"),
                      F.explode(_parsed(payload, MACRO_PAYLOAD)).alias("p"))
    rows = items.select("indicator", "_fetched",
                        _required(F.col("p.data"), "data").alias("reference_date"),
                        parse_decimal_comma(_required(F.col("p.valor"), "valor")).alias("valor"))
    if fetched:
        # one row per fetch of a day: bounded by the documents landed
        latest = Window.partitionBy("indicator", "reference_date")
        rows = rows.withColumn("_last", F.max("_fetched").over(latest)).where(
            "_fetched = _last").drop("_last")
    return rows.drop("_fetched")


def _landed(spark: SparkSession, path: str) -> DataFrame:
    """Whole files with the order in which they were fetched."""
    return spark.read.option("wholetext", True).text(path).select(
        "*", F.unix_millis("_metadata.file_modification_time").alias("fetched")) \
        .withColumnRenamed("value", "payload")


def read_macro_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed macro files laid out as ``<path>/indicator=<name>/*.json``
    (each file one JSON array); the indicator comes from the directory.
    Where fetches overlap the file written later wins."""
    return parse_macro_payload(_landed(spark, path), fetched="fetched")


# -------------------------------------------------------------------- market
_POINT = "struct<kind:int,pos:int,ms:double,value:double>"


def market_points(df: DataFrame, payload: str = "payload", coin: str = "coin_id",
                  fetched: str | None = None) -> DataFrame:
    """Rows ``(coin, payload text)`` -> one row per array element:
    ``(coin_id, fetched, kind, ms, pos, value)``; empty or missing arrays give
    none, malformed documents raise.  ``fetched`` (0 without it) orders
    overlapping documents, in epoch milliseconds.  The document is parsed once and the three arrays are tagged and
    concatenated before a single explode."""
    order = F.col(fetched) if fetched else F.lit(0)
    parsed = df.select(F.col(coin).alias("coin_id"), order.cast("long").alias("fetched"),
                       _parsed(payload, MARKET_PAYLOAD).alias("m"))

    def tagged(kind: int, field: str) -> Column:
        arr = F.transform(F.col(f"m.{field}"), lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), x[0].alias("ms"), x[1].alias("value")))
        return F.coalesce(arr, F.array().cast(f"array<{_POINT}>"))

    points = F.concat(*[tagged(k, field) for k, (field, _) in enumerate(MARKET_ARRAYS)])
    return parsed.select("coin_id", "fetched", F.inline(points))


def daily_market(points: DataFrame) -> DataFrame:
    """Last point of each UTC day per asset: the price with the greatest
    ``(fetched, ms, position)``; cap and volume likewise from their own
    arrays.  Days without any price point are dropped."""
    day = epoch_ms_to_date("ms")
    # packed into one exact number, which keeps the hash aggregate: fetch,
    # millisecond of the day, position
    in_day = F.pmod(F.col("ms").cast("long"), F.lit(86_400_000).cast("long"))
    order = packed_order(F.col("fetched"),
                         in_day * F.lit(10 ** 9).cast("long") + F.col("pos"), tie_digits=18)

    def last_of(kind: int) -> Column:
        return F.max_by(F.col("value"), F.when(F.col("kind") == kind, order))

    daily = (points.groupBy("coin_id", day.alias("reference_date"))
             .agg(last_of(0).alias("price_usd"), last_of(1).alias("market_cap_usd"),
                  last_of(2).alias("volume_24h_usd"),
                  F.max((F.col("kind") == 0).cast("int")).alias("_has_price")))
    return daily.where(F.col("_has_price") == 1).drop("_has_price")


def parse_market_payload(df: DataFrame, payload: str = "payload",
                         coin: str = "coin_id", fetched: str | None = None) -> DataFrame:
    return daily_market(market_points(df, payload, coin, fetched))


def read_market_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed market files laid out as ``<path>/coin_id=<asset>/*.json``;
    where fetches overlap the file written later wins."""
    return parse_market_payload(_landed(spark, path), fetched="fetched")


# ----------------------------------------------------------------- encoders
def encode_macro_payloads(landed: DataFrame) -> DataFrame:
    """Long rows ``(indicator, reference_date DATE, valor)`` -> one payload
    document per indicator and month (a bounded group), values written with
    a decimal comma, items in day order."""
    month = F.date_format("reference_date", "yyyy-MM")
    item = F.struct(F.col("reference_date").alias("d"),
                    F.date_format("reference_date", "dd/MM/yyyy").alias("data"),
                    F.replace(F.col("valor").cast("string"), F.lit("."), F.lit(","))
                    .alias("valor"))
    docs = landed.groupBy("indicator", month.alias("month")).agg(
        F.array_sort(F.collect_list(item)).alias("items"))
    return docs.select("indicator", "month", F.to_json(F.transform(
        "items", lambda x: F.struct(x["data"].alias("data"), x["valor"].alias("valor"))))
        .alias("payload"))


def encode_market_payloads(ticks: DataFrame, series: str = "series") -> DataFrame:
    """Intra-day points ``(series, ts, event_id, value, user_id)`` -> one
    payload document per series and minute (a group bounded by the point
    rate; points sharing a millisecond always share a document, so the
    ``(ms, position)`` order of the parser equals ``(ms, event_id)``):
    prices are the values, caps the values x 1000, volumes the user ids."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    item = F.struct(ms.alias("ms"), F.col("event_id").alias("id"),
                    F.col("value").cast("double").alias("v"),
                    (F.col("value") * 1000).cast("double").alias("c"),
                    F.col("user_id").cast("double").alias("u"))
    docs = ticks.groupBy(F.col(series).alias("coin_id"), minute.alias("minute")).agg(
        F.array_sort(F.collect_list(item)).alias("items"))

    def arr(field: str) -> Column:
        return F.transform("items", lambda x: F.array(x["ms"].cast("double"), x[field]))

    return docs.select("coin_id", "minute", F.to_json(F.struct(
        arr("v").alias("prices"), arr("c").alias("market_caps"),
        arr("u").alias("total_volumes"))).alias("payload"))


# -------------------------------------------------------------- daily bars
def daily_bars(ticks: DataFrame, series: str = "series", ts: str = "ts",
               tie: str = "event_id", value: str = "value",
               volume: str | None = None) -> DataFrame:
    """Intra-day points -> daily bar per series: first/last (open/close) by
    ``(ts, tie)``, high, low, summed volume (``volume`` column, default the
    value itself) and point count -- one partial+final hash aggregate
    (``tie`` must be a non-negative integer)."""
    order = packed_order(timestamp_micros(F.col(ts)), F.col(tie))
    vol = F.col(volume or value)
    return (ticks.groupBy(F.col(series).alias("series"), F.to_date(F.col(ts)).alias("day"))
            .agg(F.min_by(F.col(value), order).alias("open"),
                 F.max(F.col(value)).alias("high"),
                 F.min(F.col(value)).alias("low"),
                 F.max_by(F.col(value), order).alias("close"),
                 F.sum(vol).alias("volume"),
                 F.count(F.lit(1)).alias("points")))
