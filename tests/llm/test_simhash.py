"""SimHash near-dedup against all pairs."""

from itertools import combinations

import numpy as np
import xxhash

from cadence.llm import simhash_dedup as S
from cadence.llm.queries import QUERIES
from tests.llm.fixtures import SF, corpus, frame, stored


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(ids, prints):
    parent = dict(enumerate(ids))
    label = list(range(len(ids)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in combinations(range(len(ids)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 2:
            label[root(j)] = root(i)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(parent[i])
    return [min(groups[root(i)]) for i in range(len(ids))]


def check(found, ids, texts):
    prints = [slow_fingerprint(t) for t in texts]
    expected = dict(zip(ids, brute(ids, prints), strict=True))
    got = {r["doc_id"]: r for r in found}
    assert len(found) == len(ids)
    for i, p in zip(ids, prints, strict=True):
        assert got[i]["fingerprint"] == f"{p:016x}"
        assert got[i]["component_id"] == expected[i]


def test_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op5_simhash_dedup"](spark, SF).collect()
    check(found, [r["doc_id"] for r in docs], [r["text"] for r in docs])


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(3)
    tables = S.golay_tables()
    assert (tables[2][:, 0] >= 0).all()
    base = rng.integers(-2**63, 2**63 - 1, size=300)
    for flips in (0, 1, 2):
        other = base.copy()
        for k in range(len(other)):
            for b in rng.choice(64, size=flips, replace=False):
                other[k] ^= np.uint64(1 << int(b)).astype(np.int64)
        x, xo = S.golay_keys(base, tables)
        y, yo = S.golay_keys(other, tables)
        for k in range(len(base)):
            assert set(x[xo == k]) & set(y[yo == k])


def test_crowded_keys_give_the_same_components(spark):
    rng = np.random.default_rng(5)
    start = int(rng.integers(2**62))
    prints = {start}
    for _ in range(300):   # a chain and cloud of near fingerprints
        x = int(rng.choice(sorted(prints)))
        for b in rng.choice(64, size=int(rng.integers(1, 4)), replace=False):
            x ^= 1 << int(b)
        prints.add(x & (2**63 - 1))
    fps = spark.createDataFrame([(p,) for p in sorted(prints)], "fp long")
    from cadence.llm.components import connected_components
    want = dict(zip(sorted(prints), brute(sorted(prints), sorted(prints)), strict=True))
    for limit in (2, 32):
        rows = connected_components(S.links(fps, limit)).collect()
        got = {p: p for p in prints} | {r["node"]: r["component"] for r in rows}
        assert got == want


def test_edge_cases(spark, tmp_dir):
    texts = corpus()
    docs = stored(spark, texts, tmp_dir)
    found = S.near_duplicates(docs).collect()
    expected = brute(list(range(len(texts))), [slow_fingerprint(t) for t in texts])
    assert {r["doc_id"]: r["component"] for r in found} == dict(enumerate(expected))
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected))
    assert S.near_duplicates(frame(spark, [])).count() == 0
    assert S.keep_one(frame(spark, [])).count() == 0


def test_null_and_repeated_keys(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (3, "x y z"), (3, "x y z"),
                           (4, None)], "doc_id long, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    found = sorted(S.near_duplicates(docs).select("doc_id", "component").collect(), key=str)
    assert [tuple(r) for r in found] == [(3, 3), (3, 3), (4, 4), (None, None), (None, None)]
    assert S.keep_one(docs).count() == 3
