"""cadence: daily time-series consolidation on Spark.

Two landed worlds -- low-frequency macro indicators (long format) and
per-asset market series -- are normalised, checked, merged by natural key
and consolidated into one fact table with daily change, rolling volatility
and an as-of aligned macro context.  Every step is a DataFrame/SQL plan, so
Catalyst prunes, pushes down and picks the join strategy.
"""

__version__ = "0.1.0"
