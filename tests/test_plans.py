"""Plan-shape tests: the scale properties the design relies on."""

import os
import re

import __spark_entry__ as E
from cadence.operators.upsert import conform, read_table, upsert, upsert_table
from cadence.plans.consolidate import consolidate
from cadence.schemas import MARKET
from cadence.sources import testdata as td
from tests.conftest import SF_SMALL


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_flagship_plan_shape(spark):
    plan = executed(E.queries()["consolidate"](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "Exchange SinglePartition"):
        assert bad not in plan
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", plan)
    assert windows and all(w.strip() for w in windows)          # always partitioned
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "o_orderdate:timestamp_ntz" in schemas               # days branch: one column
    assert not any("o_custkey" in s or "l_partkey" in s for s in schemas)   # pruned
    assert "BroadcastHashJoin" in plan                           # AQE measured and broadcast


def test_slice_prunes_month_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "market")
    rows = conform(td.market(spark, SF_SMALL), MARKET, stamp_col="ingested_at")
    upsert_table(spark, path, rows, ["coin_id", "reference_date"], MARKET)
    stored = read_table(spark, path, MARKET, keep_partition=True)
    plan = executed(consolidate(stored, td.macro(spark, SF_SMALL), "2001-06-01"))
    assert "PartitionFilters: [isnotnull(ref_month), (ref_month >= 2001-06)]" in plan


def test_upsert_filters_target_without_aggregating_it(spark):
    t = td.target(spark, SF_SMALL)
    b = td.batch(spark, SF_SMALL)
    plan = executed(upsert(t, b, ["coin_id", "reference_date"], ["batch_seq"],
                           ["coin_id", "reference_date", "price_usd", "market_cap_usd",
                            "volume_24h_usd"]))
    assert "LeftAnti" in plan
    assert "BroadcastHashJoin" in plan


def test_raw_point_reductions_are_hash_aggregates(spark):
    # a struct ordering key would force a map-side sort of every raw row
    for name in ("market_daily", "daily_bars", "json_market_scan"):
        plan = executed(E.queries()[name](spark, SF_SMALL))
        assert "SortAggregate" not in plan, name
        assert "HashAggregate" in plan, name
