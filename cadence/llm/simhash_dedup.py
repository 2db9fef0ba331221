"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A document's 64-bit fingerprint is the majority of the XXH64 hashes of its
word shingles.  Fingerprints at most two bits apart are linked.

Candidates.  The fingerprint is cut into three segments of 22, 21 and 21
bits.  Two differing bits over three segments always leave one segment equal
whose cyclic successor has at most one differing bit.  So a key joins an
exact segment with an index of the successor under the perfect [23,12,7]
Golay code: a word within two bits of its codeword emits that codeword; a
word three bits away also emits the five codewords at distance four.  Words
one bit apart then share an index (a word at distance <= 2 keeps its
codeword after one flip; at distance 3 the neighbour's codeword lies at
distance <= 4).  Every fingerprint emits 3 to 18 keys of about 34 bits.

Verification.  Members of one key are compared bit by bit.  A key with more
than ``pair_limit`` fingerprints is not expanded into pairs: each of its
fingerprints emits itself and its 64 one-bit neighbours.  Two fingerprints
share such a midpoint exactly if they are at most two bits apart, so linking
every member of a midpoint to its smallest member gives the same components
at a linear cost.

Python (Arrow batches) computes fingerprints and keys; all grouping, joining
and component search are DataFrame operations over distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm.common import col, fresh, materialise, ship, with_row_id
from cadence.llm.components import connected_components

SHINGLE = 3          # words in a shingle
MAX_BITS = 2         # differing bits of linked fingerprints
SEED = 42
PAIR_LIMIT = 32      # fingerprints of a key compared pair by pair
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GOLAY = 0xC75        # generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1

ship(__name__)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint; 0 if the text is NULL or has no word.  A
    bit is set if it is set in over half of the shingles' hashes."""
    import xxhash
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), dtype="<u8", count=len(grams))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(grams), bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_udf(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="int64")


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and for every syndrome the
    error patterns to try: the coset leader, then (weight-3 leaders) the five
    weight-4 patterns of the coset; -1 where there is none."""
    from itertools import combinations
    single = []
    r = 1
    for _ in range(23):
        single.append(r)
        r <<= 1
        if r >> 11:
            r ^= GOLAY

    def syndromes(base: int, width: int) -> np.ndarray:
        out = np.zeros(1 << width, dtype=np.int64)
        for k in range(width):
            out[1 << k: 2 << k] = out[: 1 << k] ^ single[base + k]
        return out

    patterns = np.full((2048, 6), -1, dtype=np.int64)
    filled = np.zeros(2048, dtype=int)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            syndrome = 0
            for k in bits:
                syndrome ^= single[k]
            patterns[syndrome, filled[syndrome]] = sum(1 << k for k in bits)
            filled[syndrome] += 1
    return syndromes(0, 12), syndromes(12, 11), patterns


def golay_keys(fingerprints: np.ndarray, tables=None) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of the fingerprint) for every key of every one."""
    low, high, patterns = tables or golay_tables()
    f = fingerprints.astype(np.int64).view(np.uint64)
    parts = [((f >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)
             for at, n in SEGMENTS]
    keys, owners = [], []
    for i, exact in enumerate(parts):
        near = parts[(i + 1) % len(parts)]
        errors = patterns[low[near & 0xFFF] ^ high[near >> 12]]
        for k in range(errors.shape[1]):
            at = np.flatnonzero(errors[:, k] >= 0)
            index = (near[at] ^ errors[at, k]) >> 11
            keys.append((i << 34) | (exact[at] << 12) | index)
            owners.append(at)
    return np.concatenate(keys), np.concatenate(owners)


def _emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tables = golay_tables()
    for batch in batches:
        f = batch["fp"].to_numpy(dtype=np.int64)
        keys, owners = golay_keys(f, tables)
        yield pd.DataFrame({"bucket": keys, "fp": f[owners]})


def _apart(x: str, y: str):
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y)))


def links(fps: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fp`` whose components
    are those of "at most ``MAX_BITS`` bits differ"."""
    keys = materialise(fps.mapInPandas(_emit, "bucket long, fp long"))
    shared = keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    keys = materialise(keys.join(shared, "bucket"))
    few = keys.where(F.col("n") <= pair_limit)
    pairs = (few.select("bucket", F.col("fp").alias("a"))
             .join(few.select("bucket", F.col("fp").alias("b")), "bucket")
             .where((F.col("a") < F.col("b")) & (_apart("a", "b") <= MAX_BITS))
             .select("a", "b"))
    flips = F.array(F.lit(0).cast("long"), *(F.shiftleft(F.lit(1).cast("long"), k)
                                             for k in range(64)))
    many = keys.where(F.col("n") > pair_limit).select("fp").distinct()
    middle = many.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
    lowest = middle.groupBy("middle").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
    stars = (middle.join(lowest.where("n > 1"), "middle")
             .where(F.col("a") != F.col("fp"))
             .select("a", F.col("fp").alias("b")))
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id",
                    pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``fp`` (signed fingerprint),
    ``label`` (smallest fingerprint reachable) and ``component`` (smallest
    ``key`` reachable).

    NULL and word-free texts have fingerprint 0 and are linked like any
    other; a NULL key keeps its row and never becomes a component unless all
    keys of the component are NULL; repeated rows stay.  An empty table gives
    an empty result."""
    rows = materialise(docs.select(col(key).alias("key"), fingerprint_udf(col(text)).alias("fp")))
    firsts = materialise(rows.groupBy("fp").agg(F.min("key").alias("first")))
    labels = connected_components(links(firsts.select("fp"), pair_limit))
    named = (firsts.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("label", F.coalesce("component", "fp")).drop("component"))
    lowest = named.groupBy("label").agg(F.min("first").alias("component"))
    by_fp = named.join(lowest, "label").select("fp", "label", "component")
    return rows.join(by_fp, "fp").select(F.col("key").alias(key), "fp", "label", "component")


def keep_one(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of every component the
    row with the smallest ``order`` stays (the first in table order among
    equals; NULLs last).  ``docs`` must be a stored table, since it is read
    twice."""
    rid, = fresh(docs, "rid")
    numbered = with_row_id(docs, rid)
    # smallest row number of the smallest order value of each component
    rows = numbered.select(F.struct(col(order).isNull().alias("n"), col(order).alias("o"),
                                    col(rid).alias("r")).alias("key"), col(text).alias("text"))
    found = near_duplicates(rows, "text", "key")
    keep = found.where(F.col("key") == F.col("component")).select(F.col("key.r").alias(rid))
    return numbered.join(keep, rid, "left_semi").select(*(col(c) for c in docs.columns))
