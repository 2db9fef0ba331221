"""Hard negatives: threshold algorithm and brute force, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import hard_negatives as hn
from cadence.llm.queries import QUERIES
from tests.llm.fixtures import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, relabel=True):
    """Rows (vec_id, embedding, label)."""
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(
                x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, [int(np.floor(256 * float(x))) for x in v],
                     (label + 1) % 10 if relabel and i % 7 == 0 else label))
    out = []
    for n, (a, va, la) in enumerate(kept):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(va, v)), i, label)
                  for m, (i, v, label) in enumerate(kept) if m != n and len(v) == len(va)]
        for p, i, _ in sorted(s for s in scored if s[2] == la)[:5]:
            fit = sorted(s for s in scored if s[2] != la and 50 * -p <= 100 * -s[0] <= 95 * -p)
            out += [(a, i, k + 1, j, -p, -s) for k, (s, j, _) in enumerate(fit[:3])]
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in
                  hn.mine(df, F.col("vec_id") % 50 == 0, relabel=(7, 1, 10), **kw).collect())


def clustered(n, dims, seed=5):
    """Rows whose components differ much, so that lists end early."""
    rng = np.random.default_rng(seed)
    scale = 2.0 ** -np.arange(dims)
    return rng.normal(size=(n, dims)) * scale


def test_search_equals_all_scores_and_stops_early():
    vectors = np.floor(256 * clustered(4000, 3)).astype(np.int64)
    anchors, labels = vectors[:40], np.arange(4000) % 3
    windows = [np.array([[s // 2, s * 95 // 100] for s in
                         np.sort(vectors[a % 3::3] @ anchors[a])[-6:-1]]) for a in range(40)]
    found, scored = hn.search(hn.SortedLists(vectors), anchors, lambda a: labels != labels[a],
                              windows, 3, first=32)
    assert scored < 0.7 * 40 * 4000
    for a in range(40):
        scores = vectors @ anchors[a]
        for (low, high), (got, rows) in zip(windows[a], found[a]):
            fit = np.flatnonzero((labels != labels[a]) & (scores >= low) & (scores <= high))
            want = sorted((-scores[i], i) for i in fit)[:3]
            assert sorted((-s, i) for s, i in zip(got, rows))[:3] == want


def test_threshold_bounds_unread_rows():
    vectors = np.floor(256 * clustered(300, 6)).astype(np.int64)
    anchors = vectors[::30]
    lists = hn.SortedLists(vectors)
    for depth in (1, 10, 100):
        met = lists.read(anchors, 0, depth)
        rest = lists.threshold(anchors, depth)
        for a, anchor in enumerate(anchors):
            unread = vectors[~met[a]] @ anchor
            assert not len(unread) or unread.max() <= rest[a]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    found = sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, SF).collect())
    assert found == brute(rows) and found


def test_blocks_on_both_sides(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROW_BLOCK", 64)
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", 3)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    assert mined(df) == brute(rows)


def test_edges(spark):
    """NULLs, non-finite components, ties, repeated rows, a hot label, zero and
    negative scores, vectors of other lengths, clashing names."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(0, 400):
        v = [float(x) for x in rng.integers(-2, 3, size=4) / 16]
        rows.append((i, v, 0 if i % 3 else int(rng.integers(0, 4))))
    rows += [rows[50], rows[50], rows[51]]                      # repeated rows, an anchor's too
    rows += [(1000, None, 1), (1050, [1.0, float("nan"), 0.0, 0.0], 1), (1100, [1.0, None], 2),
             (1150, [float("inf")] * 4, 2), (1200, [0.1] * 4, None), (None, [0.1] * 4, 1),
             (1250, [0.0] * 4, 1), (1300, [0.5, 0.5], 1), (1301, [0.25, 0.25], 1),
             (1302, [0.4, 0.01], 2), (1350, [], 3), (1351, [], 3), (1352, [], 4),
             (1400, [-0.3, 0.2, 0.1, 0.0], 9), (1401, [0.3, -0.2, -0.1, 0.0], 9)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rid", F.lit(1)).withColumn(
        "block", F.lit("b")).withColumn("score", F.lit(2))
    assert mined(df) == brute(rows)


def test_empty_and_out_of_range(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    no_anchor = spark.createDataFrame([(1, [0.5], 1), (2, [0.5], 2)], SCHEMA)
    assert mined(no_anchor) == []
    with pytest.raises(Exception, match="64 bits"):
        mined(spark.createDataFrame([(50, [1e15], 1), (51, [1e15], 1)], SCHEMA))
