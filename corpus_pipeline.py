"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark
decontamination, packing.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and reread as
the next stage's ``docs``.  All but the last return the columns of ``docs``.

``ORACLE_SQL`` is None: XXH64 fingerprints, tokenizer ids and components have
no DuckDB equivalent; ``tests/llm/test_pipeline.py`` compares ``run`` with a
brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cadence.llm import decontamination, line_dedup, packing, quality_rules, simhash_dedup
from cadence.llm.common import materialise, table
from cadence.session import checkpoint_dir, configure


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects short, repetitive and depleted documents; removes lines above
    their host's limits from the others."""
    configure(spark)
    return quality_rules.filter_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated and similar lines but the first of each group."""
    configure(spark)
    return line_dedup.dedup_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near duplicates."""
    configure(spark)
    return simhash_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that hold a benchmark item."""
    configure(spark)
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining documents into token sequences."""
    import public_tokenizers
    configure(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, with a written table between
    them."""
    configure(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
