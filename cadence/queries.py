"""Query definitions (Spark side) and their oracle SQL (DuckDB side)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cadence import sql_fragments as S
from cadence.catalog import normalize, register
from cadence.operators import quality as Q
from cadence.operators.asof import asof_join
from cadence.operators.prefix import row_numbers
from cadence.operators.reshape import long_to_wide
from cadence.operators.upsert import conform, market_batch_clean, read_table, upsert, upsert_table
from cadence.plans import consolidate as C
from cadence.plans import jobs as J
from cadence.plans import reports as R
from cadence.plans import states as ST
from cadence.plans import transforms as T
from cadence.schemas import CONSOLIDATED, KEYS, MARKET
from cadence.session import checkpoint_dir
from cadence.sources import payloads as P
from cadence.sources import tables as TB
from cadence.sources import testdata as td
from cadence.work import work_table

# Fixed parameters of the registered queries (shared with the oracles).
SLICE_START = "1999-06-01"
FOCUS_ASSET = "1-URGENT"
AS_OF = "2001-06-30"
ALLOWED_ASSETS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
HISTOGRAM_WIDTH = 25.0
CREATED_AT = "2026-01-01 00:00:00"

_BASE = S.with_ctes(S.MARKET, S.MACRO, S.consolidated())


def _consolidated(spark, sf_dir, start_date=None, mode="reference"):
    return C.consolidate(td.market(spark, sf_dir), td.macro(spark, sf_dir), start_date,
                         mode=mode, created_at=CREATED_AT)


def _no_stamp(df):
    return normalize(df.drop("created_at"))


def _round(df, digits, cols):
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ====================================================================== sources
@register("market_daily", S.with_ctes(S.MARKET) + """
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd, CAST(market_cap_usd AS DOUBLE) AS market_cap_usd,
        CAST(volume_24h_usd AS DOUBLE) AS volume_24h_usd
 FROM market""")
def q_market_daily(spark, sf_dir):
    """A1 last point of the day + day sums (orders -> market series)."""
    return normalize(td.market(spark, sf_dir))


@register("macro_daily", S.with_ctes(S.MARKET, S.MACRO) + """
 SELECT indicator, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(valor AS DOUBLE) AS valor FROM macro""")
def q_macro_daily(spark, sf_dir):
    return normalize(td.macro(spark, sf_dir))


@register("macro_points", S.with_ctes(S.MACRO) + """
 SELECT indicator, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(valor AS DOUBLE) AS valor, points FROM macro_counted""")
def q_macro_points(spark, sf_dir):
    """The macro series with the rows behind each value: all of them."""
    return normalize(td.macro_points(spark, sf_dir))


@register("daily_bars", """
 SELECT event_type AS series, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
        arg_min(value, {'t': ts, 'i': event_id}) AS open, max(value) AS high,
        min(value) AS low, arg_max(value, {'t': ts, 'i': event_id}) AS close,
        ROUND(sum(value), 6) AS volume, count(*) AS points
 FROM events GROUP BY 1, 2""")
def q_daily_bars(spark, sf_dir):
    """Intra-day ticks -> daily bar (last-of-day close, summed volume)."""
    return _round(normalize(P.daily_bars(td.ticks(spark, sf_dir))), 6, {"volume"})


@register("json_macro_scan", S.with_ctes(S.MARKET, S.MACRO) + """
 SELECT indicator, strftime(reference_date, '%d/%m/%Y') AS reference_date,
        CAST(valor AS DOUBLE) AS valor FROM macro""")
def q_json_macro_scan(spark, sf_dir):
    """Macro rows -> landed JSON documents (decimal comma) -> parsed
    back; the round trip must be lossless."""
    docs = P.encode_macro_payloads(td.macro(spark, sf_dir))
    return P.parse_macro_payload(docs)


@register("json_market_scan", """
 SELECT event_type AS coin_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS reference_date,
        arg_max(value, {'ms': epoch_ms(ts), 'i': event_id}) AS price_usd,
        arg_max(value * 1000, {'ms': epoch_ms(ts), 'i': event_id}) AS market_cap_usd,
        arg_max(CAST(user_id AS DOUBLE), {'ms': epoch_ms(ts), 'i': event_id}) AS volume_24h_usd
 FROM events GROUP BY 1, 2""")
def q_json_market_scan(spark, sf_dir):
    """Ticks -> market payload documents -> parsed, reduced to
    the last point of each UTC day."""
    docs = P.encode_market_payloads(td.ticks(spark, sf_dir))
    return normalize(P.parse_market_payload(docs))


@register("extraction_window", S.with_ctes(S.MARKET) + f"""
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd
 FROM market
 WHERE coin_id IN ({", ".join(f"'{a}'" for a in ALLOWED_ASSETS)})
   AND reference_date BETWEEN DATE '{AS_OF}' - INTERVAL 365 DAY AND DATE '{AS_OF}'""")
def q_extraction_window(spark, sf_dir):
    """last 365 days up to the as-of date, allow-listed series only."""
    from cadence.functions.dates import in_extraction_window
    m = td.market(spark, sf_dir)
    return normalize(m.where(F.col("coin_id").isin(ALLOWED_ASSETS)
                             & in_extraction_window("reference_date", AS_OF))
                     .select("coin_id", "reference_date", "price_usd"))


# =================================================================== transforms
@register("transform_macro", S.with_ctes(S.MARKET, S.MACRO, S.MACRO_LANDED) + """
 SELECT indicator,
        strftime(strptime(reference_date, '%d/%m/%Y'), '%Y-%m-%d') AS reference_date,
        valor,
        CASE WHEN indicator = 'selic'
             THEN ROUND((POW(1 + valor / 100, 252) - 1) * 100, 6) END AS selic_annual
 FROM macro_landed WHERE valor IS NOT NULL""")
def q_transform_macro(spark, sf_dir):
    """C1 = P2 strict day parse, P5 annualisation (double), F1 drop NULL."""
    out = T.transform_macro(td.macro_landed(spark, sf_dir))
    return _round(normalize(out), 6, {"selic_annual"})


@register("transform_market", S.with_ctes(S.MARKET) + """,
 pct AS (
   SELECT coin_id, reference_date, CAST(price_usd AS DOUBLE) AS price_usd,
          (CAST(price_usd AS DOUBLE) - LAG(CAST(price_usd AS DOUBLE)) OVER w)
            / LAG(CAST(price_usd AS DOUBLE)) OVER w * 100 AS pct_change_1d
   FROM market WINDOW w AS (PARTITION BY coin_id ORDER BY reference_date)
 )
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date, price_usd,
        ROUND(pct_change_1d, 6) AS pct_change_1d,
        ROUND(STDDEV_SAMP(pct_change_1d) OVER (PARTITION BY coin_id ORDER BY reference_date
              ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS volatility_7d
 FROM pct""")
def q_transform_market(spark, sf_dir):
    """C2 = P4, F2, W3 (double change), W5 (unrounded rolling deviation)."""
    m = td.market(spark, sf_dir).select(
        "coin_id", "reference_date", F.col("price_usd").cast("double").alias("price_usd"))
    out = T.transform_market(m).select("coin_id", "reference_date", "price_usd",
                                       "pct_change_1d", "volatility_7d")
    return _round(normalize(out), 6, {"pct_change_1d", "volatility_7d"})


@register("market_metrics", _BASE + """
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd,
        CAST(pct_change_1d AS DOUBLE) AS pct_change_1d,
        CAST(volatility_7d AS DOUBLE) AS volatility_7d
 FROM series""")
def q_market_metrics(spark, sf_dir):
    """W1 previous row, W2 rounded change, W4 rolling deviation of the
    rounded change."""
    out = C.market_metrics(td.market(spark, sf_dir)).select(
        "coin_id", "reference_date", "price_usd", "pct_change_1d", "volatility_7d")
    return normalize(out)


@register("bucketed_metrics", _BASE + """
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd,
        CAST(pct_change_1d AS DOUBLE) AS pct_change_1d,
        CAST(volatility_7d AS DOUBLE) AS volatility_7d
 FROM series""")
def q_bucketed_metrics(spark, sf_dir):
    """W1/W2/W4 with a series spread over its years (7-row halo)."""
    out = C.market_metrics(td.market(spark, sf_dir), "year").select(
        "coin_id", "reference_date", "price_usd", "pct_change_1d", "volatility_7d")
    return normalize(out)


@register("ranked_series", S.with_ctes(S.MARKET) + """
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd,
        row_number() OVER (ORDER BY coin_id, reference_date) AS place,
        row_number() OVER (PARTITION BY coin_id ORDER BY reference_date) AS place_in_series
 FROM market""")
def q_ranked_series(spark, sf_dir):
    """O1/O2: the sort by asset and day as row numbers, over all rows and in
    the asset, by range partitions and prefix sums."""
    m = td.market(spark, sf_dir).select("coin_id", "reference_date", "price_usd")
    placed = row_numbers(m, ["coin_id", "reference_date"], name="place")
    return normalize(row_numbers(placed, ["reference_date"], ["coin_id"], "place_in_series"))


# ======================================================================= as-of
@register("asof_fill", _BASE + """
 SELECT strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(dolar_brl AS DOUBLE) AS dolar_brl,
        CAST(selic_daily_rate AS DOUBLE) AS selic_daily_rate,
        CAST(ipca_monthly AS DOUBLE) AS ipca_monthly
 FROM filled""")
def q_asof_fill(spark, sf_dir):
    """Per market day, the latest value of each indicator at
    or before it, else the indicator's earliest value."""
    days = td.market(spark, sf_dir).select("reference_date").distinct()
    return normalize(C.macro_by_day(days, td.macro(spark, sf_dir)))


@register("asof_bucketed", _BASE + """
 SELECT strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(dolar_brl AS DOUBLE) AS dolar_brl,
        CAST(selic_daily_rate AS DOUBLE) AS selic_daily_rate,
        CAST(ipca_monthly AS DOUBLE) AS ipca_monthly
 FROM filled""")
def q_asof_bucketed(spark, sf_dir):
    """J2/J3/W7 as a scan of both sides by buckets of time."""
    days = td.market(spark, sf_dir).select("reference_date").distinct()
    return normalize(C.macro_by_day(days, td.macro(spark, sf_dir), method="bucket"))


@register("asof_one_series", S.with_ctes(S.MACRO) + """,
 fx AS (SELECT reference_date, valor FROM macro WHERE indicator = 'dolar')
 SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS reference_date,
        CAST(COALESCE(valor, (SELECT arg_min(valor, reference_date) FROM fx)) AS DOUBLE) AS valor
 FROM orders ASOF LEFT JOIN fx ON CAST(o_orderdate AS DATE) >= fx.reference_date""")
def q_asof_one_series(spark, sf_dir):
    """J2 without keys, O5: every order with the exchange rate of its day, one
    long series scanned by prefix."""
    orders = td.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("reference_date"))
    fx = td.macro(spark, sf_dir).where("indicator = 'dolar'").drop("indicator")
    return normalize(asof_join(orders, fx, "reference_date", values=["valor"], backfill=True))


@register("macro_wide", S.with_ctes(S.MARKET, S.MACRO) + """
 SELECT strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(max(valor) FILTER (WHERE indicator = 'dolar') AS DOUBLE) AS dolar,
        CAST(max(valor) FILTER (WHERE indicator = 'selic') AS DOUBLE) AS selic,
        CAST(max(valor) FILTER (WHERE indicator = 'ipca') AS DOUBLE) AS ipca
 FROM macro GROUP BY reference_date""")
def q_macro_wide(spark, sf_dir):
    """Long -> wide by indicator (NULL where an indicator has no row)."""
    return normalize(long_to_wide(td.macro(spark, sf_dir), "reference_date", "indicator",
                                  "valor", ["dolar", "selic", "ipca"]))


# =============================================================== consolidation
@register("consolidate", _BASE + f" SELECT {S.CONSOLIDATED_COLS} FROM consolidated")
def q_consolidate(spark, sf_dir):
    """C3 (flagship): the daily fact table."""
    return _no_stamp(_consolidated(spark, sf_dir))


@register("consolidate_since", S.with_ctes(S.MARKET, S.MACRO, S.consolidated(SLICE_START))
          + f" SELECT {S.CONSOLIDATED_COLS} FROM consolidated")
def q_consolidate_since(spark, sf_dir):
    """C3 + F4, reference mode: the slice is cut before the windows."""
    return _no_stamp(_consolidated(spark, sf_dir, SLICE_START, "reference"))


@register("consolidate_lookback",
          S.with_ctes(S.MARKET, S.MACRO, S.consolidated(SLICE_START, lookback=True))
          + f" SELECT {S.CONSOLIDATED_COLS} FROM consolidated")
def q_consolidate_lookback(spark, sf_dir):
    """C3 + F4, lookback mode: windows see the rows before the slice."""
    return _no_stamp(_consolidated(spark, sf_dir, SLICE_START, "lookback"))


# ===================================================================== upserts
_MARKET_COLS = "coin_id, reference_date, price_usd, market_cap_usd, volume_24h_usd"


@register("upsert_market", S.with_ctes(S.MARKET, S.MARKET_TARGET_BATCH) + """,
 merged AS (""" + S.upsert_sql("market_target", "market_batch", "coin_id, reference_date",
                               _MARKET_COLS, "batch_seq") + """)
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd, CAST(market_cap_usd AS DOUBLE) AS market_cap_usd,
        CAST(volume_24h_usd AS DOUBLE) AS volume_24h_usd FROM merged""")
def q_upsert_market(spark, sf_dir):
    """Batch beats target, the later batch row beats the earlier."""
    cols = _MARKET_COLS.split(", ")
    m = work_table(td.market(spark, sf_dir))
    out = upsert(td.target(spark, sf_dir, m), td.batch(spark, sf_dir, m),
                 ["coin_id", "reference_date"], ["batch_seq"], cols)
    return normalize(out)


# ============================================================== loads and tables
@register("landing_overlap", S.with_ctes(S.MARKET, S.MACRO, S.MACRO_TARGET_BATCH) + """
 SELECT m.indicator, strftime(m.reference_date, '%d/%m/%Y') AS reference_date,
        CAST(COALESCE(later.valor, m.valor) AS DOUBLE) AS valor
 FROM macro m LEFT JOIN (SELECT * FROM macro_batch WHERE batch_seq = 1) later
   USING (indicator, reference_date)""")
def q_landing_overlap(spark, sf_dir):
    """S1 over two overlapping fetches: the later document wins a day."""
    corrected = td.macro_batch(spark, sf_dir).where("batch_seq = 1").drop("batch_seq")
    fetches = [P.encode_macro_payloads(rows).withColumn("fetched", F.lit(n))
               for n, rows in enumerate([td.macro(spark, sf_dir), corrected])]
    return P.parse_macro_payload(fetches[0].unionByName(fetches[1]), fetched="fetched")


@register("landing_empty", S.with_ctes(S.MACRO) + """
 SELECT indicator, strftime(reference_date, '%d/%m/%Y') AS reference_date,
        CAST(valor AS DOUBLE) AS valor FROM macro WHERE month(reference_date) <> 2""")
def q_landing_empty(spark, sf_dir):
    """F8: the documents of every February hold an empty array."""
    docs = P.encode_macro_payloads(td.macro(spark, sf_dir))
    return P.parse_macro_payload(docs.withColumn("payload", F.when(
        F.col("month").endswith("-02"), F.lit("[]")).otherwise(F.col("payload"))))


@register("clean_market", S.with_ctes(S.MARKET) + """
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd, CAST(market_cap_usd AS DOUBLE) AS market_cap_usd,
        CASE WHEN day(reference_date) <> 17 THEN CAST(volume_24h_usd AS DOUBLE) END
          AS volume_24h_usd
 FROM market WHERE day(reference_date) <> 13""")
def q_clean_market(spark, sf_dir):
    """P4 text time to day, F2 rows without a price dropped, P9 NaN to NULL."""
    dom = F.dayofmonth("reference_date")
    landed = td.market(spark, sf_dir).select(
        "coin_id", F.date_format("reference_date", "yyyy-MM-dd 12:30:00").alias("reference_date"),
        F.when(dom != 13, F.col("price_usd").cast("double")).alias("price_usd"),
        F.col("market_cap_usd").cast("double").alias("market_cap_usd"),
        F.when(dom == 17, F.lit(float("nan"))).otherwise(F.col("volume_24h_usd").cast("double"))
        .alias("volume_24h_usd"))
    return normalize(market_batch_clean(T.clean_market(landed)))


@register("stored_market", S.with_ctes(S.MARKET, S.MARKET_TARGET_BATCH) + """,
 merged AS (""" + S.upsert_sql("market_target", "market_batch", "coin_id, reference_date",
                               _MARKET_COLS, "batch_seq") + f""")
 SELECT coin_id, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd, CAST(market_cap_usd AS DOUBLE) AS market_cap_usd,
        CAST(volume_24h_usd AS DOUBLE) AS volume_24h_usd,
        '{CREATED_AT}.000000' AS ingested_at
 FROM merged""")
def q_stored_market(spark, sf_dir):
    """A first load and a merge written as a month-partitioned
    table with the stored schema, read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-market-{uuid.uuid4().hex}/crypto_market"
    sequence = StructField("batch_seq", IntegerType())
    m = work_table(td.market(spark, sf_dir))
    for rows, order in ((td.target(spark, sf_dir, m).withColumn("batch_seq", F.lit(0)), None),
                        (td.batch(spark, sf_dir, m), ["batch_seq"])):
        stamped = conform(rows, StructType([*MARKET.fields, sequence]), "ingested_at", CREATED_AT)
        upsert_table(spark, path, stamped, KEYS["crypto_market"], MARKET, batch_order=order)
    return normalize(read_table(spark, path, MARKET))


@register("upsert_macro", S.with_ctes(S.MARKET, S.MACRO, S.MACRO_TARGET_BATCH) + """,
 merged AS (""" + S.upsert_sql("macro_target", "macro_batch", "indicator, reference_date",
                               "indicator, reference_date, valor", "batch_seq") + """)
 SELECT indicator, strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(valor AS DOUBLE) AS valor FROM merged""")
def q_upsert_macro(spark, sf_dir):
    """S6/S9 on the macro key."""
    m = work_table(td.macro(spark, sf_dir))
    out = upsert(td.macro_target(spark, sf_dir, m), td.macro_batch(spark, sf_dir, m),
                 ["indicator", "reference_date"], ["batch_seq"],
                 ["indicator", "reference_date", "valor"])
    return normalize(out)


_CONS_COLS = ("reference_date, coin_id, price_usd, price_brl, market_cap_usd, volume_24h_usd, "
              "pct_change_1d, volatility_7d, dolar_brl, selic_daily_rate, selic_annual_rate, "
              "ipca_monthly")


@register("upsert_consolidated",
          S.with_ctes(S.MARKET, S.MACRO, S.consolidated(prefix="t_"),
                      S.consolidated(SLICE_START, prefix="b_")) + """,
 t_target AS (SELECT * FROM t_consolidated WHERE reference_date < DATE '2000-01-01'),
 consolidated AS (""" + S.upsert_sql("t_target", "b_consolidated", "coin_id, reference_date",
                                     _CONS_COLS, None) + f""")
 SELECT {S.CONSOLIDATED_COLS} FROM consolidated""")
def q_upsert_consolidated(spark, sf_dir):
    """A re-consolidated slice merged over the stored fact table
    (reference mode: the slice's first rows overwrite with NULL change)."""
    full = _consolidated(spark, sf_dir).where(F.col("reference_date") < F.lit("2000-01-01")
                                              .cast("date"))
    since = _consolidated(spark, sf_dir, SLICE_START, "reference")
    out = upsert(full, since, ["coin_id", "reference_date"], None, _CONS_COLS.split(", "))
    return normalize(out)


# ======================================================================== jobs
def _job_paths(spark) -> J.Paths:
    base = f"{checkpoint_dir(spark).rstrip('/')}/jobs-{uuid.uuid4().hex}"
    return J.Paths(*(f"{base}/{name}" for name in (
        "bcb_indicators", "crypto_market", "daily_consolidated", "run_log", "monthly_states")))


_JOB_SQL = S.with_ctes(S.MARKET, S.MACRO, S.MARKET_TARGET_BATCH) + """,
 loaded AS (
   SELECT * FROM macro WHERE NOT (indicator = 'dolar' AND day(reference_date) = 10)
 ),
 merged AS (""" + S.upsert_sql("market_target", "(SELECT * FROM market_batch WHERE batch_seq = 1)",
                               "coin_id, reference_date", _MARKET_COLS, "batch_seq") + """),
""" + S.consolidated(market="merged", macro="loaded")


def _run_jobs(spark, sf_dir) -> J.Paths:
    """Two market loads that overlap, a macro load and a consolidation."""
    paths, m = _job_paths(spark), work_table(td.market(spark, sf_dir))
    J.load_macro(spark, td.macro_landed(spark, sf_dir), paths)
    J.load_market(spark, td.target(spark, sf_dir, m), paths)
    J.load_market(spark, td.batch(spark, sf_dir, m).where("batch_seq = 1").drop("batch_seq"), paths)
    J.run_consolidation(spark, paths, validate_when="report")
    return paths


@register("job_run", _JOB_SQL + f" SELECT {S.CONSOLIDATED_COLS}, true AS stamped FROM consolidated")
def q_job_run(spark, sf_dir):
    """Load, load, consolidate; the fact table read back."""
    facts = read_table(spark, _run_jobs(spark, sf_dir).consolidated, CONSOLIDATED)
    return _no_stamp(facts.withColumn("stamped", F.col("created_at").isNotNull()))


@register("job_log", S.with_ctes(S.MARKET, S.MARKET_DIRTY, S.MACRO) + """,
 counts AS (
   SELECT (SELECT count(*) FROM macro WHERE NOT (indicator = 'dolar' AND day(reference_date) = 10))
            AS n_macro,
          (SELECT count(*) FROM market WHERE coin_id IN ({assets})
             AND reference_date BETWEEN DATE '{as_of}' - INTERVAL 365 DAY AND DATE '{as_of}')
            AS n_market,
          (SELECT count(*) FROM market_dirty WHERE price_usd IS NOT NULL
             AND volume_24h_usd IS NULL) AS n_bad
 )
 SELECT 'INFO' AS level, 'cadence.jobs' AS logger,
        'load_macro/load_macro - success (' || n_macro || ' rows)' AS message,
        CAST(NULL AS VARCHAR) AS exception FROM counts
 UNION ALL SELECT 'INFO', 'cadence.jobs',
        'load_market/load_market - success (' || n_market || ' rows)', NULL FROM counts
 UNION ALL SELECT 'ERROR', 'cadence.jobs', 'load_market/load_market - failed (0 rows)',
        'crypto_market: volume_24h_usd possui ' || n_bad || ' valores nulos' FROM counts"""
          .format(as_of=AS_OF, assets=", ".join(f"'{a}'" for a in ALLOWED_ASSETS)))
def q_job_log(spark, sf_dir):
    """S10/P16, V9, F6/F7 in a load: the JSON log lines of a macro load, of a
    market load of the listed assets' last year, and of a load that fails its
    rules (without the time)."""
    paths = _job_paths(spark)
    J.load_macro(spark, td.macro_landed(spark, sf_dir), paths)
    J.load_market(spark, td.market(spark, sf_dir), paths, assets=ALLOWED_ASSETS, as_of=AS_OF)
    try:
        J.load_market(spark, td.dirty(spark, sf_dir), paths)
    except Q.DataQualityError:
        pass        # written to the log
    lines = TB.run_log_json(TB.read_run_log(spark, paths.run_log))
    fields = ("level", "logger", "message", "exception")
    return lines.select(*[F.get_json_object("line", f"$.{f}").alias(f) for f in fields])


# ============================================================== monthly states
_MERGED = S.with_ctes(S.MARKET, S.MACRO, S.consolidated(prefix="t_"),
                      S.consolidated(SLICE_START, prefix="b_")) + """,
 t_target AS (SELECT * FROM t_consolidated WHERE reference_date < DATE '2000-01-01'),
 consolidated AS (""" + S.upsert_sql("t_target", "b_consolidated", "coin_id, reference_date",
                                     _CONS_COLS, None) + ")"


def _states(spark, sf_dir):
    """The states after a first load and the merge of a slice, of which only
    the touched months are computed again."""
    paths = _job_paths(spark)
    market, macro = work_table(td.market(spark, sf_dir)), work_table(td.macro(spark, sf_dir))
    full = C.consolidate(market, macro, created_at=CREATED_AT).where(
        F.col("reference_date") < F.lit("2000-01-01").cast("date"))
    for facts in (full, C.consolidate(market, macro, SLICE_START, created_at=CREATED_AT)):
        touched = J.store_facts(spark, paths, facts)
        ST.refresh(spark, paths.states, paths.consolidated, touched)
    return ST.read_states(spark, paths.states)


@register("state_summary", _MERGED + """
 SELECT coin_id,
        CAST(ROUND(AVG(pct_change_1d), 4) AS DOUBLE) AS avg_daily_return,
        CAST(ROUND(AVG(volatility_7d), 4) AS DOUBLE) AS avg_volatility,
        CAST(ROUND(AVG(price_brl), 4) AS DOUBLE) AS avg_price_brl
 FROM consolidated GROUP BY coin_id""")
def q_state_summary(spark, sf_dir):
    """A7/O3 from the monthly states."""
    return normalize(ST.asset_summary(_states(spark, sf_dir)))


# =============================================================== data quality
def _range_sql(table, col, lo, hi, src, where=""):
    cond = f"(CAST({col} AS DOUBLE) < {float(lo)!r} OR CAST({col} AS DOUBLE) > {float(hi)!r})"
    if where:
        cond = f"{where} AND {cond}"
    return (f"SELECT '{table}' AS table_name, 'range' AS rule, '{col}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM {src}")


def _null_sql(table, col, src):
    return (f"SELECT '{table}' AS table_name, 'not_null' AS rule, '{col}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS violations FROM {src}")


def _dup_sql(table, keys, src):
    return (f"SELECT '{table}' AS table_name, 'unique_key' AS rule, "
            f"'{keys.replace(' ', '')}' AS column_name, "
            f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {src})) "
            f"AS BIGINT) AS violations FROM {src}")


@register("dq_market", S.with_ctes(S.MARKET, S.MARKET_DIRTY) + "\n" + "\nUNION ALL\n".join([
    _null_sql("crypto_market", "price_usd", "market_dirty"),
    _null_sql("crypto_market", "volume_24h_usd", "market_dirty"),
    _dup_sql("crypto_market", "coin_id, reference_date", "market_dirty"),
    _range_sql("crypto_market", "price_usd", 0.0001, 1_000_000, "market_dirty"),
    _range_sql("crypto_market", "volume_24h_usd", 0, 1_000_000_000_000, "market_dirty"),
]))
def q_dq_market(spark, sf_dir):
    """V2/V3/V4/V7 violation report of a market load with defects."""
    return Q.violation_report(td.dirty(spark, sf_dir), "crypto_market")


@register("dq_macro", S.with_ctes(S.MARKET, S.MACRO, S.MACRO_DIRTY) + "\n" + "\nUNION ALL\n".join([
    _null_sql("bcb_indicators", "valor", "macro_dirty"),
    _dup_sql("bcb_indicators", "indicator, reference_date", "macro_dirty"),
    _range_sql("bcb_indicators[dolar]", "valor", 0, 20, "macro_dirty", "indicator = 'dolar'"),
    _range_sql("bcb_indicators[selic]", "valor", 0, 100, "macro_dirty", "indicator = 'selic'"),
    _range_sql("bcb_indicators[ipca]", "valor", -20, 20, "macro_dirty", "indicator = 'ipca'"),
]))
def q_dq_macro(spark, sf_dir):
    """V2/V3/V5/V6 violation report of a macro load with defects."""
    return Q.violation_report(td.macro_dirty(spark, sf_dir), "bcb_indicators")


@register("dq_consolidated", _BASE + "\n" + "\nUNION ALL\n".join([
    _null_sql("daily_consolidated", "price_usd", "consolidated"),
    _null_sql("daily_consolidated", "dolar_brl", "consolidated"),
    _dup_sql("daily_consolidated", "coin_id, reference_date", "consolidated"),
    _range_sql("daily_consolidated", "price_usd", 0.0001, 1_000_000, "consolidated"),
    _range_sql("daily_consolidated", "dolar_brl", 1, 10, "consolidated"),
    _range_sql("daily_consolidated", "volatility_7d", 0, 100, "consolidated"),
]))
def q_dq_consolidated(spark, sf_dir):
    """V8 violation report of the consolidated table."""
    return Q.violation_report(_consolidated(spark, sf_dir), "daily_consolidated")


@register("dq_documented", _BASE + f""",
 g AS (SELECT coin_id, reference_date, volatility_7d,
              date_diff('day', LAG(reference_date) OVER (PARTITION BY coin_id
                        ORDER BY reference_date), reference_date) AS gap
       FROM consolidated),
 per_asset AS (SELECT coin_id, avg(CAST(volatility_7d AS DOUBLE)) AS v FROM consolidated
               GROUP BY coin_id)
 SELECT 'daily_consolidated' AS table_name, 'future_date' AS rule,
        'reference_date' AS column_name,
        CAST(count(*) FILTER (WHERE reference_date > DATE '{AS_OF}') AS BIGINT) AS violations
 FROM consolidated
 UNION ALL SELECT 'daily_consolidated', 'gap_over_days', 'reference_date',
        CAST(count(*) FILTER (WHERE gap > 7) AS BIGINT) FROM g
 UNION ALL SELECT 'daily_consolidated', 'mean_volatility_band', 'volatility_7d',
        CAST(count(*) FILTER (WHERE v < 0.5 OR v > 5.0) AS BIGINT) FROM per_asset""")
def q_dq_documented(spark, sf_dir):
    """D4 future dates, D5 gaps > 7 days, D6 mean-volatility band."""
    return Q.documented_report(_consolidated(spark, sf_dir), AS_OF)


@register("dq_gaps", """
 WITH days AS (SELECT DISTINCT o_custkey AS customer, CAST(o_orderdate AS DATE) AS day FROM orders),
 steps AS (SELECT customer, day - LAG(day) OVER (PARTITION BY customer ORDER BY day) AS step FROM days)
 SELECT customer, count(*) FILTER (WHERE step > 7) AS gaps FROM steps GROUP BY customer""")
def q_dq_gaps(spark, sf_dir):
    """D5 on series with gaps: one series per customer, by session windows."""
    orders = td.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"), F.to_date("o_orderdate").alias("reference_date"))
    return Q.gap_counts(orders, "customer")


# ===================================================================== reports
@register("asset_summary", _BASE + """
 SELECT coin_id,
        CAST(ROUND(AVG(pct_change_1d), 4) AS DOUBLE) AS avg_daily_return,
        CAST(ROUND(AVG(volatility_7d), 4) AS DOUBLE) AS avg_volatility,
        CAST(ROUND(AVG(price_brl), 4) AS DOUBLE) AS avg_price_brl
 FROM consolidated GROUP BY coin_id""")
def q_asset_summary(spark, sf_dir):
    """A7 + O3 (flagship report)."""
    return normalize(R.asset_summary(_consolidated(spark, sf_dir)))


@register("summary_formatted", _BASE + """,
 s AS (SELECT coin_id, ROUND(AVG(pct_change_1d), 4) AS r, ROUND(AVG(volatility_7d), 4) AS v,
              ROUND(AVG(price_brl), 4) AS p FROM consolidated GROUP BY coin_id)
 SELECT coin_id,
        COALESCE(CAST(CAST(round_even(r * 100, 0) AS BIGINT) AS VARCHAR) || '%', '-')
          AS avg_daily_return,
        COALESCE(CAST(CAST(round_even(v * 100, 0) AS BIGINT) AS VARCHAR) || '%', '-')
          AS avg_volatility,
        CASE WHEN p IS NULL THEN '-'
             ELSE 'R$ ' || translate(format('{:,.0f}', p), ',.', '.,') END AS avg_price_brl
 FROM s""")
def q_summary_formatted(spark, sf_dir):
    """P14 display form of the summary (P13 number format)."""
    return R.summary_formatted(R.asset_summary(_consolidated(spark, sf_dir)))


@register("ranked_summary", _BASE + """,
 s AS (SELECT coin_id, ROUND(AVG(volatility_7d), 4) AS v FROM consolidated GROUP BY coin_id)
 SELECT coin_id, CAST(v AS DOUBLE) AS avg_volatility,
        row_number() OVER (ORDER BY v DESC NULLS FIRST, coin_id) AS place FROM s""")
def q_ranked_summary(spark, sf_dir):
    """O3: the summary's order (NULLs first) as row numbers."""
    s = R.asset_summary(_consolidated(spark, sf_dir)).select(
        "coin_id", "avg_volatility", F.col("avg_volatility").isNotNull().alias("known"),
        (-F.col("avg_volatility")).alias("down"))
    return normalize(row_numbers(s, ["known", "down", "coin_id"], name="place")
                     .drop("known", "down"))


@register("price_ranking", _BASE + """
 SELECT coin_id, CAST(ROUND(AVG(price_brl), 4) AS DOUBLE) AS avg_price_brl
 FROM consolidated GROUP BY coin_id HAVING AVG(price_brl) IS NOT NULL""")
def q_price_ranking(spark, sf_dir):
    """Mean BRL price per asset, NULLs dropped, highest first."""
    return normalize(R.price_ranking(_consolidated(spark, sf_dir)))


@register("asset_history", _BASE + f"""
 SELECT strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_usd AS DOUBLE) AS price_usd, CAST(price_brl AS DOUBLE) AS price_brl,
        CAST(pct_change_1d AS DOUBLE) AS pct_change_1d,
        CAST(volatility_7d AS DOUBLE) AS volatility_7d, CAST(dolar_brl AS DOUBLE) AS dolar_brl,
        CAST(selic_annual_rate AS DOUBLE) AS selic_annual_rate,
        CAST(ipca_monthly AS DOUBLE) AS ipca_monthly
 FROM consolidated WHERE coin_id = '{FOCUS_ASSET}'""")
def q_asset_history(spark, sf_dir):
    """One asset's history in day order."""
    return normalize(R.asset_history(_consolidated(spark, sf_dir), FOCUS_ASSET))


@register("history_sql", _BASE + f"""
 SELECT strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_brl AS DOUBLE) AS price_brl, CAST(volatility_7d AS DOUBLE) AS volatility_7d
 FROM consolidated WHERE coin_id = '{FOCUS_ASSET}'""")
def q_history_sql(spark, sf_dir):
    """The history query as parametrised Spark SQL (``:coin_id``)."""
    return normalize(R.run_query(
        spark, "SELECT reference_date, price_brl, volatility_7d FROM {cons} "
               "WHERE coin_id = :coin_id ORDER BY reference_date",
        {"coin_id": FOCUS_ASSET}, cons=_consolidated(spark, sf_dir)))


@register("volatility_series", _BASE + f"""
 SELECT strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(volatility_7d AS DOUBLE) AS volatility_7d
 FROM consolidated WHERE coin_id = '{FOCUS_ASSET}' AND volatility_7d IS NOT NULL""")
def q_volatility_series(spark, sf_dir):
    """C8 chart series: F3 drops the NULL points."""
    return normalize(R.history_series(_consolidated(spark, sf_dir), FOCUS_ASSET,
                                      "volatility_7d"))


@register("fx_history", _BASE + """
 SELECT strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(dolar_brl AS DOUBLE) AS dolar_brl
 FROM consolidated WHERE dolar_brl IS NOT NULL""")
def q_fx_history(spark, sf_dir):
    """Exchange rate per asset-day (not de-duplicated), day order."""
    return normalize(R.fx_history(_consolidated(spark, sf_dir)))


@register("latest_price", _BASE + f"""
 SELECT strftime(reference_date, '%Y-%m-%d') AS reference_date,
        CAST(price_brl AS DOUBLE) AS price_brl
 FROM consolidated WHERE coin_id = '{FOCUS_ASSET}'
 ORDER BY reference_date DESC NULLS FIRST LIMIT 1""")
def q_latest_price(spark, sf_dir):
    """Latest BRL price of one asset (top-1 is the feature)."""
    return normalize(R.latest_row(_consolidated(spark, sf_dir), FOCUS_ASSET))


_KPI = f""",
 k AS (
  SELECT count(*) AS total_rows, count(DISTINCT coin_id) AS total_coins,
         max(reference_date) AS latest_date,
         avg(price_brl) FILTER (WHERE coin_id = '{FOCUS_ASSET}') AS avg_price_brl,
         arg_max(price_brl, reference_date) FILTER (WHERE coin_id = '{FOCUS_ASSET}')
           AS latest_price_brl,
         CASE WHEN stddev_pop(CAST(price_brl AS DOUBLE)) FILTER (WHERE coin_id = '{FOCUS_ASSET}'
                      AND price_brl IS NOT NULL AND dolar_brl IS NOT NULL) = 0
                OR stddev_pop(CAST(dolar_brl AS DOUBLE)) FILTER (WHERE coin_id = '{FOCUS_ASSET}'
                      AND price_brl IS NOT NULL AND dolar_brl IS NOT NULL) = 0 THEN NULL
              ELSE corr(CAST(price_brl AS DOUBLE), CAST(dolar_brl AS DOUBLE))
                   FILTER (WHERE coin_id = '{FOCUS_ASSET}') END AS corr_price_fx
  FROM consolidated)"""
_KPI_SQL = _BASE + _KPI
_KPI_ROW = """
 SELECT total_rows, total_coins, strftime(latest_date, '%Y-%m-%d') AS latest_date,
        ROUND(CAST(avg_price_brl AS DOUBLE), 6) AS avg_price_brl,
        CAST(latest_price_brl AS DOUBLE) AS latest_price_brl,
        ROUND(corr_price_fx, 6) AS corr_price_fx FROM k"""


@register("kpi_panel", _KPI_SQL + _KPI_ROW)
def q_kpi_panel(spark, sf_dir):
    """C11: A2 count, A3 distinct, A4 max, A5 filtered mean, O4 latest,
    A6 correlation -- one aggregate over one scan."""
    panel = normalize(R.kpi_panel(_consolidated(spark, sf_dir), FOCUS_ASSET))
    return _round(panel, 6, {"avg_price_brl", "corr_price_fx"})


@register("kpi_formatted", _KPI_SQL + """
 SELECT translate(format('{:,.0f}', CAST(total_rows AS DOUBLE)), ',.', '.,') AS total_rows,
        translate(format('{:,.0f}', CAST(total_coins AS DOUBLE)), ',.', '.,') AS total_coins,
        COALESCE(strftime(latest_date, '%Y-%m-%d'), '-') AS latest_date,
        'R$ ' || COALESCE(translate(format('{:,.0f}', avg_price_brl), ',.', '.,'), '-')
          AS avg_price_brl,
        'R$ ' || COALESCE(translate(format('{:,.0f}', latest_price_brl), ',.', '.,'), '-')
          AS latest_price_brl,
        COALESCE(translate(format('{:,.0f}', corr_price_fx * 100), ',.', '.,') || '%', '-')
          AS corr_price_fx
 FROM k""")
def q_kpi_formatted(spark, sf_dir):
    """KPI values in pt-BR display form."""
    return R.kpi_panel_formatted(R.kpi_panel(_consolidated(spark, sf_dir), FOCUS_ASSET))


def _safe_corr_sql(x, y):
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return (f"CASE WHEN stddev_pop(CAST({x} AS DOUBLE)) FILTER (WHERE {both}) = 0 "
            f"OR stddev_pop(CAST({y} AS DOUBLE)) FILTER (WHERE {both}) = 0 THEN NULL "
            f"ELSE ROUND(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6) END")


_CORR_ROWS = f"""
 SELECT coin_id,
        {_safe_corr_sql("price_brl", "dolar_brl")} AS corr_dolar_brl,
        {_safe_corr_sql("price_brl", "selic_annual_rate")} AS corr_selic_annual_rate,
        {_safe_corr_sql("price_brl", "ipca_monthly")} AS corr_ipca_monthly
 FROM consolidated GROUP BY coin_id"""


@register("state_kpi", _MERGED + _KPI + _KPI_ROW)
def q_state_kpi(spark, sf_dir):
    """C11, A2-A6, O4 from the monthly states."""
    panel = normalize(ST.kpi_panel(_states(spark, sf_dir), FOCUS_ASSET))
    return _round(panel, 6, {"avg_price_brl", "corr_price_fx"})


@register("state_corr", _MERGED + _CORR_ROWS)
def q_state_corr(spark, sf_dir):
    """A6/D1 from the monthly states."""
    return _round(ST.corr_matrix(_states(spark, sf_dir)), 6,
                  {"corr_dolar_brl", "corr_selic_annual_rate", "corr_ipca_monthly"})


@register("corr_matrix", _BASE + _CORR_ROWS)
def q_corr_matrix(spark, sf_dir):
    """Per-asset correlation of the BRL price with each macro column."""
    out = R.corr_matrix(_consolidated(spark, sf_dir))
    return _round(out, 6, {"corr_dolar_brl", "corr_selic_annual_rate", "corr_ipca_monthly"})


_PERIOD_ROWS = """,
 p AS (SELECT coin_id, arg_min(price_usd, reference_date) AS f,
              arg_max(price_usd, reference_date) AS l,
              avg(CAST(selic_annual_rate AS DOUBLE)) AS s
       FROM consolidated GROUP BY coin_id)
 SELECT coin_id, CAST(f AS DOUBLE) AS first_price_usd, CAST(l AS DOUBLE) AS last_price_usd,
        ROUND(s, 6) AS avg_selic_annual_rate,
        CAST(ROUND((l / f - 1) * 100, 4) AS DOUBLE) AS period_return_pct
 FROM p"""


@register("state_period_return", _MERGED + _PERIOD_ROWS)
def q_state_period_return(spark, sf_dir):
    """D2 from the monthly states."""
    out = normalize(ST.period_return(_states(spark, sf_dir)))
    return _round(out, 6, {"avg_selic_annual_rate"})


@register("period_return", _BASE + _PERIOD_ROWS)
def q_period_return(spark, sf_dir):
    """Period return per asset and mean annual policy rate."""
    out = normalize(R.period_return(_consolidated(spark, sf_dir)))
    return _round(out, 6, {"avg_selic_annual_rate"})


@register("return_histogram", _BASE + f"""
 SELECT coin_id, floor(CAST(pct_change_1d AS DOUBLE) / {HISTOGRAM_WIDTH}) * {HISTOGRAM_WIDTH}
          AS bucket_lo, count(*) AS days
 FROM consolidated WHERE pct_change_1d IS NOT NULL GROUP BY 1, 2""")
def q_return_histogram(spark, sf_dir):
    """D3: daily-change histogram per asset."""
    return normalize(R.return_histogram(_consolidated(spark, sf_dir), HISTOGRAM_WIDTH))


@register("distinct_assets", _BASE + " SELECT DISTINCT coin_id FROM consolidated")
def q_distinct_assets(spark, sf_dir):
    """Distinct assets."""
    return R.distinct_assets(_consolidated(spark, sf_dir))


@register("null_counts", S.with_ctes(S.MARKET, S.MARKET_DIRTY) + """
 SELECT count(*) FILTER (WHERE coin_id IS NULL) AS coin_id,
        count(*) FILTER (WHERE reference_date IS NULL) AS reference_date,
        count(*) FILTER (WHERE price_usd IS NULL) AS price_usd,
        count(*) FILTER (WHERE market_cap_usd IS NULL) AS market_cap_usd,
        count(*) FILTER (WHERE volume_24h_usd IS NULL) AS volume_24h_usd
 FROM market_dirty""")
def q_null_counts(spark, sf_dir):
    """NULL count per column in one pass."""
    return R.null_counts(td.dirty(spark, sf_dir))


@register("computed_counts", _BASE + """
 SELECT count(pct_change_1d) AS n_pct_change, count(volatility_7d) AS n_volatility,
        count(selic_annual_rate) AS n_selic_annual FROM consolidated""")
def q_computed_counts(spark, sf_dir):
    """A10: rows carrying computed values."""
    return R.computed_counts(_consolidated(spark, sf_dir))


@register("table_counts", S.with_ctes(S.MARKET, S.MACRO, S.consolidated()) + """
 SELECT 'bcb_indicators' AS table_name, count(*) AS row_count FROM macro
 UNION ALL SELECT 'crypto_market', count(*) FROM market
 UNION ALL SELECT 'daily_consolidated', count(*) FROM consolidated""")
def q_table_counts(spark, sf_dir):
    """Row count of each stored table."""
    from cadence.sources.tables import count_report
    return count_report({"bcb_indicators": td.macro(spark, sf_dir),
                         "crypto_market": td.market(spark, sf_dir),
                         "daily_consolidated": _consolidated(spark, sf_dir)},
                        with_timestamp=False)
