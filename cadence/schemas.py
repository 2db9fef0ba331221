"""Table schemas and rule configuration.

Stored tables use decimals of the stored widths; the surrogate serial id of
the stored tables is never read by any query and is not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------
# Macro indicators and their series codes.
INDICATORS = {"dolar": 1, "selic": 11, "ipca": 433}
# Monitored assets.
ASSETS = ["bitcoin", "ethereum", "solana", "binancecoin"]
# Extraction window, days back from the as-of date (both ends inclusive).
EXTRACTION_DAYS_BACK = 365
# Business days per year used by the compound annualisation of the policy rate.
BUSINESS_DAYS_PER_YEAR = 252
# Rolling volatility frame: the current row and the 6 preceding rows.
VOLATILITY_ROWS = 7
# Validation rules: (table, kind, column, indicator, minimum, maximum); a range
# is a closed interval, for the rows of one indicator or for all (None).
@dataclass(frozen=True)
class Rule:
    table: str
    kind: str
    column: str
    indicator: str | None = None
    minimum: float | None = None
    maximum: float | None = None


RULES = [
    Rule("bcb_indicators", "not_null", "valor"),
    Rule("bcb_indicators", "range", "valor", "dolar", 0, 20),
    Rule("bcb_indicators", "range", "valor", "selic", 0, 100),
    Rule("bcb_indicators", "range", "valor", "ipca", -20, 20),
    Rule("crypto_market", "not_null", "price_usd"),
    Rule("crypto_market", "not_null", "volume_24h_usd"),
    Rule("crypto_market", "range", "price_usd", None, 0.0001, 1_000_000),
    Rule("crypto_market", "range", "volume_24h_usd", None, 0, 1_000_000_000_000),
    Rule("daily_consolidated", "not_null", "price_usd"),
    Rule("daily_consolidated", "not_null", "dolar_brl"),
    Rule("daily_consolidated", "range", "price_usd", None, 0.0001, 1_000_000),
    Rule("daily_consolidated", "range", "dolar_brl", None, 1, 10),
    Rule("daily_consolidated", "range", "volatility_7d", None, 0, 100),
]
# Required columns checked before the rules of each table.
REQUIRED_COLUMNS = {
    "bcb_indicators": ["indicator", "reference_date", "valor"],
    "crypto_market": ["coin_id", "reference_date", "price_usd", "market_cap_usd",
                      "volume_24h_usd"],
    "daily_consolidated": ["coin_id", "reference_date", "price_usd", "dolar_brl",
                           "volatility_7d"],
}
# Natural keys.
KEYS = {
    "bcb_indicators": ["indicator", "reference_date"],
    "crypto_market": ["coin_id", "reference_date"],
    "daily_consolidated": ["coin_id", "reference_date"],
}
# Count-report CSV header.
COUNT_REPORT_HEADER = ["Tabela", "Quantidade de Registros", "Data da Captura"]
# ---------------------------------------------------------------------------

MACRO = T.StructType([
    T.StructField("indicator", T.StringType(), False),
    T.StructField("reference_date", T.DateType(), False),
    T.StructField("valor", T.DecimalType(15, 8), False),
    T.StructField("ingested_at", T.TimestampNTZType(), False),
])

MARKET = T.StructType([
    T.StructField("coin_id", T.StringType(), False),
    T.StructField("reference_date", T.DateType(), False),
    T.StructField("price_usd", T.DecimalType(20, 8), True),
    T.StructField("market_cap_usd", T.DecimalType(30, 2), True),
    T.StructField("volume_24h_usd", T.DecimalType(30, 2), True),
    T.StructField("ingested_at", T.TimestampNTZType(), False),
])

CONSOLIDATED = T.StructType([
    T.StructField("reference_date", T.DateType(), False),
    T.StructField("coin_id", T.StringType(), False),
    T.StructField("price_usd", T.DecimalType(20, 8), True),
    T.StructField("price_brl", T.DecimalType(20, 8), True),
    T.StructField("market_cap_usd", T.DecimalType(30, 2), True),
    T.StructField("volume_24h_usd", T.DecimalType(30, 2), True),
    T.StructField("pct_change_1d", T.DecimalType(10, 4), True),
    T.StructField("volatility_7d", T.DecimalType(10, 4), True),
    T.StructField("dolar_brl", T.DecimalType(10, 6), True),
    T.StructField("selic_daily_rate", T.DecimalType(12, 8), True),
    T.StructField("selic_annual_rate", T.DecimalType(10, 6), True),
    T.StructField("ipca_monthly", T.DecimalType(8, 4), True),
    T.StructField("created_at", T.TimestampNTZType(), False),
])

RUN_LOG = T.StructType([
    T.StructField("dag_id", T.StringType(), False),
    T.StructField("task_id", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("rows_inserted", T.IntegerType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("finished_at", T.TimestampNTZType(), False),
])

# Landed payloads.
MACRO_PAYLOAD = T.ArrayType(T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("valor", T.StringType()),
]))

_POINTS = T.ArrayType(T.ArrayType(T.DoubleType()))
MARKET_PAYLOAD = T.StructType([
    T.StructField("prices", _POINTS),
    T.StructField("market_caps", _POINTS),
    T.StructField("total_volumes", _POINTS),
])

TABLE_SCHEMAS = {
    "bcb_indicators": MACRO,
    "crypto_market": MARKET,
    "daily_consolidated": CONSOLIDATED,
    "pipeline_run_log": RUN_LOG,
}
