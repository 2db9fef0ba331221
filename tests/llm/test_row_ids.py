"""Row ids of a stored table do not depend on how a scan is split."""

import random

import pytest
from pyspark.sql import functions as F

from cadence.llm import decontamination, line_dedup, quality_rules, simhash_dedup
from cadence.llm.common import with_row_id
from tests.llm.fixtures import SCHEMA, sentence


@pytest.fixture()
def docs(spark, tmp_dir):
    """A table of 40 small files, which few or many splits can hold."""
    rng = random.Random(7)
    texts = [sentence(rng, rng.randrange(60, 90)) for _ in range(150)]
    texts = [t if i % 4 else texts[i // 8] + "\n" + texts[i // 9] for i, t in enumerate(texts)]
    rows = [(i, t, "en", f"s{i % 3}", len(t), "x", "y", "z") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(40, "doc_id").write.parquet(f"{tmp_dir}/many")
    return spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/many")


def at_parallelism(spark, n, fn):
    name = "spark.sql.leafNodeDefaultParallelism"
    spark.conf.set(name, n)
    try:
        return fn()
    finally:
        spark.conf.unset(name)


def test_ids_agree_between_scans(spark, docs):
    def ids():
        rows = with_row_id(docs, "id").select("doc_id", "id").collect()
        return {r["doc_id"]: tuple(r["id"]) for r in rows}

    few, many = (at_parallelism(spark, n, ids) for n in (1, 64))
    assert few == many and len(set(few.values())) == len(few) == 150

    def numbers():
        rows = docs.select("doc_id", F.monotonically_increasing_id()).collect()
        return {r[0]: r[1] for r in rows}

    assert at_parallelism(spark, 1, numbers) != at_parallelism(spark, 64, numbers)


def test_columns_subsets_and_other_frames(spark, docs):
    some = with_row_id(docs.select("text").where("length(text) > 10"), "id")
    assert some.columns == ["text", "id"] and some.select("id").distinct().count() == 150
    joined = docs.groupBy("doc_id").agg(F.first("text").alias("text"))
    stored = with_row_id(joined, "id")
    assert stored.select("id").distinct().count() == 150
    assert sorted(map(str, stored.collect())) == sorted(map(str, stored.collect()))


@pytest.mark.parametrize("operator", ["lines", "near", "benchmark", "rules"])
def test_results_survive_a_change_between_scans(spark, docs, operator):
    """A plan made with one split of the table and run with another."""
    item = spark.createDataFrame([(1, docs.first()["text"].split("\n")[0])],
                                 "item_id long, text string")
    make = {"lines": lambda: line_dedup.dedup_lines(docs),
            "near": lambda: simhash_dedup.keep_one(docs),
            "benchmark": lambda: decontamination.flag_contaminated(docs, item),
            "rules": lambda: quality_rules.assess(docs)}[operator]
    same = sorted(map(str, at_parallelism(spark, 4, lambda: make().collect())))
    plan = at_parallelism(spark, 64, make)
    assert sorted(map(str, at_parallelism(spark, 1, plan.collect))) == same
