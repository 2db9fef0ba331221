import datetime as dt
import decimal
import os

import pytest

from cadence.operators.quality import DataQualityError, validate
from cadence.operators.upsert import read_table, upsert, upsert_table
from cadence.schemas import MACRO

D = dt.date
Dec = decimal.Decimal
SCHEMA = "indicator string, reference_date date, valor decimal(15,8)"


def rows_of(df):
    return sorted((r.indicator, r.reference_date, r.valor) for r in df.collect())


def test_batch_beats_target_and_later_batch_row_wins(spark):
    target = spark.createDataFrame([("dolar", D(2026, 1, 1), Dec("5.0")),
                                    ("dolar", D(2026, 1, 2), Dec("5.1"))], SCHEMA)
    batch = spark.createDataFrame([("dolar", D(2026, 1, 2), Dec("6.0"), 1),
                                   ("dolar", D(2026, 1, 2), Dec("7.0"), 2),
                                   ("dolar", D(2026, 1, 3), Dec("5.3"), 1)],
                                  SCHEMA + ", seq int")
    out = upsert(target, batch, ["indicator", "reference_date"], ["seq"],
                 ["indicator", "reference_date", "valor"])
    assert rows_of(out) == [("dolar", D(2026, 1, 1), Dec("5.0")),
                            ("dolar", D(2026, 1, 2), Dec("7.0")),
                            ("dolar", D(2026, 1, 3), Dec("5.3"))]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([("a", D(2026, 1, 1), Dec("1"))], SCHEMA)
    batch = spark.createDataFrame([("a", D(2026, 1, 1), Dec("2")),
                                   ("b", D(2026, 1, 1), Dec("3"))], SCHEMA)
    keys = ["indicator", "reference_date"]
    once = upsert(target, batch, keys)
    twice = upsert(once, batch, keys)
    assert rows_of(once) == rows_of(twice)


def test_hot_key_batch_reduces_to_last(spark):
    batch = spark.range(0, 5000).selectExpr(
        "'hot' AS indicator", "DATE'2026-01-01' AS reference_date",
        "CAST(id AS DECIMAL(15,8)) AS valor", "id AS seq").repartition(8)
    out = upsert(None, batch, ["indicator", "reference_date"], ["seq"],
                 ["indicator", "reference_date", "valor"]).collect()
    assert len(out) == 1 and out[0].valor == Dec("4999")


def _stamp(df):
    from pyspark.sql import functions as F
    return df.withColumn("ingested_at", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))


def test_upsert_table_rewrites_only_touched_months(spark, tmp_dir):
    path = os.path.join(tmp_dir, "macro")
    keys = ["indicator", "reference_date"]
    first = _stamp(spark.createDataFrame([("dolar", D(2026, 1, 5), Dec("5.0")),
                                          ("dolar", D(2026, 2, 5), Dec("5.1"))], SCHEMA))
    assert upsert_table(spark, path, first, keys, MACRO) == 2
    jan_files = sorted(os.listdir(os.path.join(path, "ref_month=2026-01")))
    second = _stamp(spark.createDataFrame([("dolar", D(2026, 2, 5), Dec("6.0")),
                                           ("dolar", D(2026, 3, 1), Dec("6.1"))], SCHEMA))
    assert upsert_table(spark, path, second, keys, MACRO) == 2
    assert sorted(os.listdir(os.path.join(path, "ref_month=2026-01"))) == jan_files
    got = rows_of(read_table(spark, path, MACRO))
    assert got == [("dolar", D(2026, 1, 5), Dec("5.0")), ("dolar", D(2026, 2, 5), Dec("6.0")),
                   ("dolar", D(2026, 3, 1), Dec("6.1"))]
    # re-running the same load gives the same table
    upsert_table(spark, path, second, keys, MACRO)
    assert rows_of(read_table(spark, path, MACRO)) == got


def test_failed_check_leaves_table_untouched(spark, tmp_dir):
    path = os.path.join(tmp_dir, "macro")
    keys = ["indicator", "reference_date"]
    upsert_table(spark, path, _stamp(spark.createDataFrame(
        [("dolar", D(2026, 1, 5), Dec("5.0"))], SCHEMA)), keys, MACRO)
    bad = _stamp(spark.createDataFrame([("dolar", D(2026, 1, 5), Dec("50.0"))], SCHEMA))
    with pytest.raises(DataQualityError):
        upsert_table(spark, path, bad, keys, MACRO,
                     check=lambda staged: validate(staged, "bcb_indicators"))
    assert rows_of(read_table(spark, path, MACRO)) == [("dolar", D(2026, 1, 5), Dec("5.0"))]


def test_not_null_columns_are_enforced_at_store_time(spark, tmp_dir):
    from cadence.operators.upsert import conform
    path = os.path.join(tmp_dir, "macro")
    bad = conform(spark.createDataFrame([(None, D(2026, 1, 5), Dec("5.0"))], SCHEMA), MACRO,
                  stamp_col="ingested_at", table="bcb_indicators")
    with pytest.raises(Exception) as e:
        upsert_table(spark, path, bad, ["indicator", "reference_date"], MACRO)
    assert "NOT NULL violated for column indicator" in str(e.value)
    ok = conform(spark.createDataFrame([("dolar", D(2026, 1, 5), Dec("5.123456789"))], SCHEMA),
                 MACRO, stamp_col="ingested_at")
    assert ok.first().valor == Dec("5.12345679")


def test_staging_is_beside_the_table_and_removed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "macro")
    keys = ["indicator", "reference_date"]
    rows = _stamp(spark.createDataFrame([("dolar", D(2026, 1, 5), Dec("5.0"))], SCHEMA))
    upsert_table(spark, path, rows, keys, MACRO)
    seen = []
    upsert_table(spark, path, rows, keys, MACRO, check=lambda _: seen.extend(os.listdir(tmp_dir)))
    assert any(x.startswith("_staging_macro_") for x in seen)
    assert os.listdir(tmp_dir) == ["macro"]


def test_merge_prunes_months_by_literals(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "macro")
    keys = ["indicator", "reference_date"]
    upsert_table(spark, path, _stamp(spark.createDataFrame(
        [("dolar", D(2024 + m // 12, 1 + m % 12, 5), Dec("5.0")) for m in range(24)], SCHEMA)),
        keys, MACRO)
    from cadence.operators import upsert as U
    plans, plain = [], U.upsert

    def spy(current, *args):
        plans.append(current._jdf.queryExecution().executedPlan().toString())
        return plain(current, *args)

    monkeypatch.setattr(U, "upsert", spy)
    upsert_table(spark, path, _stamp(spark.createDataFrame(
        [("dolar", D(2025, 3, 5), Dec("6.0"))], SCHEMA)), keys, MACRO)
    assert "ref_month" in plans[0] and "2025-03" in plans[0].split("PartitionFilters")[1]
    assert read_table(spark, path, MACRO).count() == 24


def test_empty_batch_leaves_table_unchanged(spark, tmp_dir):
    path = os.path.join(tmp_dir, "macro")
    keys = ["indicator", "reference_date"]
    rows = _stamp(spark.createDataFrame([("dolar", D(2026, 1, 5), Dec("5.0"))], SCHEMA))
    upsert_table(spark, path, rows, keys, MACRO)
    empty = _stamp(spark.createDataFrame([], SCHEMA))
    assert upsert_table(spark, path, empty, keys, MACRO) == 0
    assert rows_of(read_table(spark, path, MACRO)) == [("dolar", D(2026, 1, 5), Dec("5.0"))]
