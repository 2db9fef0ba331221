"""Source mixing: targets, brute-force fair queueing, edge cases."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cadence.llm import mixing
from cadence.llm.queries import QUERIES
from tests.llm.fixtures import SF, SCHEMA, corpus, sentence
import random


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    stopped = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        free = sum(w for s, w in weight.items() if s not in stopped)
        more = {s for s in order if s not in stopped and weight[s] * left / free > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in stopped else weight[s] * left / max(free, 1)
                    for s in order}
        stopped |= more


def brute(rows):
    """Rows (doc_id, text, source) with unique keys."""
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t, _ in rows}
    total = defaultdict(int)
    for k, _, s in rows:
        total[s] += size[k]
    target = brute_targets(total)
    packets = []
    for s in total:
        mine = [k for k, _, x in rows if x == s and size[k]]
        mine.sort(key=lambda k: hashlib.md5(f"mix:{k}".encode()).hexdigest())
        at = 0
        for epoch in range(3):
            for k in mine:
                for lo in range(0, size[k], 512):
                    words = min(512, size[k] - lo)
                    at += words
                    if target[s]:
                        packets.append((at / target[s], k, epoch, lo, words))
    left, taken = sum(total.values()), defaultdict(int)
    for _, k, _, _, words in sorted(packets):
        taken[k] += min(words, left)
        left -= min(words, left)
    return {k: (size[k], total[s], target[s], taken[k]) for k, _, s in rows}


def read(df):
    return {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"])
            for r in df.collect()}


def check(found, source):
    by = defaultdict(lambda: [0, 0.0])
    for k, (size, _, target, taken) in found.items():
        assert 0 <= taken <= 3 * size
        by[source[k]][0] += taken
        by[source[k]][1] = target
    assert sum(t for t, _ in by.values()) == sum(s for s, *_ in found.values())
    for t, target in by.values():
        assert abs(t - target) <= 2 * mixing.PACKET


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text", "source").collect()]
    found = read(QUERIES["op12_source_mixing"](spark, SF))
    want = brute(rows)
    assert set(found) == set(want)
    for k in want:
        assert found[k] == pytest.approx(want[k])
    check(found, {k: s for k, _, s in rows})


def test_reruns_agree(spark):
    first = read(QUERIES["op12_source_mixing"](spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(7, "text")
    assert read(mixing.mix(docs.select("doc_id", "text", "source"))) == first


def test_hot_source_and_caps(spark):
    """A source of half the rows, small sources that stop at three times their
    size, one document larger than its source's target."""
    rng = random.Random(3)
    rows = [(i, sentence(rng, rng.randrange(1, 60)), "hot") for i in range(300)]
    rows += [(300 + i, sentence(rng, 30), f"s{i % 7}") for i in range(120)]
    rows += [(500, sentence(rng, 9000), "s6"), (501, sentence(rng, 2), "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found, want = read(mixing.mix(df)), brute(rows)
    for k in want:
        assert found[k] == pytest.approx(want[k])
    check(found, {k: s for k, _, s in rows})
    assert found[501][3] == 6       # all of the tiny source, three times


def test_edges(spark):
    """NULL and blank texts, NULL source, clashing names; NULL and repeated
    keys stay rows of their own."""
    rows = [(i, t, [None, "b", "a", "ä", ""][i % 5]) for i, t in enumerate(corpus(n=12))]
    df = spark.createDataFrame([(k, t, "en", s, 1, "x", "y", "z") for k, t, s in rows], SCHEMA) \
        .withColumn("size", F.lit(9)).withColumn("target", F.lit(1.5))
    found, want = read(mixing.mix(df)), brute(rows)
    for k in want:
        assert found[k] == pytest.approx(want[k])
    again = spark.createDataFrame([(1, "a b c", "s")] * 4 + [(None, "d e", "s")] * 2,
                                  "doc_id long, text string, source string")
    out = mixing.mix(again).collect()
    assert len(out) == 6 and sum(r["taken"] for r in out) == 16
    assert all(r["taken"] == r["size"] for r in out)
    empty = mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string"))
    assert empty.collect() == []
    blank = mixing.mix(spark.createDataFrame([(1, None, None), (2, " ", "s")],
                                             "doc_id long, text string, source string"))
    assert [tuple(r)[1:5] for r in blank.collect()] == [(0, 0, 0.0, 0)] * 2
