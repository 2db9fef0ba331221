"""The pipeline: stage by stage against brute force, and as a whole."""

import corpus_pipeline
import __spark_entry__ as entry
from cadence.llm.common import materialise
from tests.llm.fixtures import SF
from tests.llm.test_line_dedup import brute as dedup_lines
from tests.llm.test_packing import check as check_packing
from tests.llm.test_quality_rules import brute as quality
from tests.llm.test_simhash import brute as components
from tests.llm.test_simhash import slow_fingerprint


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
        "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(docs.collect(), key=lambda r: r["doc_id"])
        ids, texts = [r["doc_id"] for r in before], [r["text"] for r in before]
        docs = materialise(stage(spark, docs, SF))
        after = {r["doc_id"]: r for r in docs.collect()}
        if name == "best_fit_packing":
            used, least = check_packing(docs.collect(), list(zip(ids, texts, strict=True)))
            assert used <= least + 1
            continue
        assert docs.columns == columns
        if name == "quality_rules":
            verdict = quality([(r["doc_id"], r["text"], r["source"]) for r in before])
            assert set(after) == {i for i, v in verdict.items() if v[-1]}
        elif name == "line_dedup":
            assert set(after) == set(ids)
            kept = sum(len(r["text"].split("\n")) for r in after.values())
            assert kept == sum(len(t.split("\n")) for t in dedup_lines(texts))
        elif name == "simhash_near_dedup":
            assert set(after) == set(components(ids, [slow_fingerprint(t) for t in texts]))
        else:
            assert set(after) <= set(ids)
    total = corpus_pipeline.run(spark, SF).count()
    assert total == docs.count()
    assert entry.queries()["pipeline"] and "pipeline" not in entry.oracle_sql()
