"""Pattern packing of token sequences.

Documents are tokenised (Arrow batches), an end id is added and longer ones
are cut into pieces of ``CAPACITY``.  Packing then works on the histogram of
piece lengths, which has at most ``CAPACITY`` entries however many documents
there are:

1. patterns of few documents are enumerated: for each length the partners
   that fill a sequence exactly (two, three or four pieces);
2. non-negative least squares fits how often each pattern is repeated so
   that the patterns use up the histogram;
3. repeat counts are rounded down, so no length is used more often than it
   occurs;
4. the residual pieces are packed best fit, longest first, still by counts.

The plan is a bounded table of slots ``(length, first rank, last rank, first
sequence, offset)``.  Pieces find their slot by their rank among the pieces
of their length.  Ranks come from per-partition counts and prefix sums, so a
length that a third of all pieces share is not gathered anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm.common import col, materialise, ship

CAPACITY = 4096
END_ID = 1
CACHE_PIECES = 1_000_000   # remembered pieces of a task
SLICE_BYTES = 8_000_000    # texts encoded at once

ship(__name__)


# ---------------------------------------------------------------- tokens
class TextEncoder:
    """Token ids of texts, piece by piece.

    The tokenizer cuts lower-cased text into pieces (letters, single digits,
    other characters, English endings) and never joins across them or across
    white space.  Texts of Latin-1 characters are cut into the same pieces by
    Arrow string functions, many texts at once; each distinct piece is
    encoded once per cache life, many pieces in one call.  Texts with other
    characters or special tokens go to the tokenizer whole."""

    OTHER = r"[^\t-\r -~\x{a1}-\x{ff}]|<\|"
    PIECE = (r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]"
             r"|[^\t-\r a-z0-9ªµºß-öø-ÿ²³¹¼-¾]+")

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}          # piece -> its row in the three below
        self.starts = np.zeros(1, dtype=np.int64)
        self.sizes = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text; NULL has none."""
        texts = pc.fill_null(texts, "")
        other = pc.match_substring_regex(texts, self.OTHER).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        own = np.flatnonzero(~other)
        for i, ids in zip(own.tolist(), self._encode_plain(texts.take(pa.array(own))),
                          strict=True):
            out[i] = ids
        for i in np.flatnonzero(other).tolist():
            out[i] = self._whole([texts[i].as_py()])[0]
        return out

    def _encode_plain(self, texts: pa.Array) -> list[np.ndarray]:
        cut = pc.replace_substring_regex(pc.utf8_lower(texts), self.PIECE, r"\0 ")
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(cut))
        coded = lists.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.known) > CACHE_PIECES:
            self.forget()
        self._learn([p for p in names if p not in self.known])
        row = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        row = row[coded.indices.to_numpy()]
        sizes = self.sizes[row]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[row] - (ends - sizes), sizes) + np.arange(total)]
        # text boundaries in pieces, then in ids
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else [0]
        bounds = np.concatenate([[0], ends])[bounds].tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        codes = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, dtype="<u4") for c in codes]

    def _learn(self, new: list[str]) -> None:
        if not new:
            return
        ids, sizes = [], []
        for at in range(0, len(new), 500):
            batch = new[at: at + 500]
            code = self.tokenizer.encode(" ".join(batch), add_special_tokens=False)
            found = np.array(code.ids, dtype="<u4")
            count = np.bincount(np.array(code.word_ids, dtype=np.int64), minlength=len(batch))
            if len(count) != len(batch) or not count.all():      # not one pre-token per piece
                each = self._whole(batch)
                found, count = np.concatenate(each), np.array([len(x) for x in each])
            ids.append(found)
            sizes.append(count)
        sizes = np.concatenate(sizes)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)),
                              strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *ids])


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    first = 0
    while first < len(ends):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield first, last
        first = last


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` of every piece."""
    end = np.array([end_id], dtype="<u4").tobytes()
    docs = docs.select(col(key).alias("key"), col(text).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for first, last in slices(texts, SLICE_BYTES):
                rows: list[tuple[int, int, int, int, int]] = []
                for row, ids in enumerate(encoder.encode(texts.slice(first, last - first))):
                    # the end id closes the last piece
                    for n, at in enumerate(range(0, len(ids) + 1, capacity)):
                        part = ids[at: at + capacity]
                        crc = zlib.crc32(part)
                        if len(part) < capacity:
                            crc = zlib.crc32(end, crc)
                        rows.append((row, n, at, min(capacity, len(ids) + 1 - at), crc))
                owner, piece, start, length, crc = np.array(rows, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(first + owner)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crc)],
                    ["key", "piece", "start", "length", "ids_crc32"])

    schema = T.StructType([docs.schema["key"], T.StructField("piece", T.IntegerType()),
                           *(T.StructField(c, T.LongType())
                             for c in ("start", "length", "ids_crc32"))])
    return docs.mapInArrow(cut, schema)


# ---------------------------------------------------------------- plan
def patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int, per_length: int = 6
             ) -> list[tuple[int, ...]]:
    """Sequences of two to four piece lengths that fill the capacity exactly.
    For each length the partners are the ``per_length`` most frequent that
    leave a fitting rest."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    have[lengths] = counts
    frequent = lengths[np.argsort(-counts, kind="stable")]
    found: set[tuple[int, ...]] = set()
    for a in lengths.tolist():
        rest = capacity - a
        if have[rest]:
            found.add(tuple(sorted((a, rest), reverse=True)))
        inner = frequent[frequent < rest]
        inner = inner[have[rest - inner] > 0][:per_length]
        for b in inner.tolist():
            found.add(tuple(sorted((a, b, rest - b), reverse=True)))
        half = rest // 2
        pair = frequent[frequent <= half][:per_length]
        for b in pair.tolist():
            left = rest - b
            third = frequent[frequent < left][:4 * per_length]
            third = third[have[left - third] > 0][:1]
            for c in third.tolist():
                found.add(tuple(sorted((a, b, c, left - c), reverse=True)))
    return sorted(found, reverse=True)


def repeat_counts(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, target: np.ndarray,
                  n: int, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares ``min |A x - target|, x >= 0`` for a sparse
    non-negative matrix, by multiplicative updates (they keep x >= 0)."""
    weight = 1.0 / np.maximum(target, 1.0)          # relative errors of the lengths
    atb = np.bincount(cols, values * (target * weight)[rows], minlength=n)
    x = atb / np.maximum(np.bincount(cols, values * values * weight[rows], minlength=n), 1e-12)
    x /= max(1.0, float((np.bincount(rows, values * x[cols], minlength=len(target))
                         * weight).max()))
    for _ in range(rounds):
        ax = np.bincount(rows, values * x[cols], minlength=len(target))
        down = np.bincount(cols, values * (ax * weight)[rows], minlength=n)
        x *= atb / np.maximum(down, 1e-12)
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first rank, end rank, first sequence, offset)``: the
    piece of that length with rank r goes to sequence ``first + r - first
    rank`` at ``offset``."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    used = np.zeros(capacity + 1, dtype=np.int64)
    slots: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def take(pattern: tuple[int, ...], times: int) -> None:
        nonlocal sequence
        offset = 0
        for length in pattern:
            # repeated lengths of a pattern take consecutive rank ranges
            first = int(used[length])
            slots.append((length, first, first + times, sequence, offset))
            used[length] += times
            left[length] -= times
            offset += length
        sequence += times

    if left[capacity]:
        take((capacity,), int(left[capacity]))
    lengths = np.flatnonzero(left)
    if len(lengths):
        found = patterns(lengths, left[lengths], capacity)
        if found:
            row_of = {int(length): i for i, length in enumerate(lengths)}
            entries: dict[tuple[int, int], int] = {}
            for c, pattern in enumerate(found):
                for length in pattern:
                    entries[row_of[length], c] = entries.get((row_of[length], c), 0) + 1
            rows, cols = (np.array(x) for x in zip(*entries, strict=True))
            values = np.array(list(entries.values()), dtype=float)
            fitted = repeat_counts(rows, cols, values, left[lengths].astype(float), len(found))
            for c in np.argsort(-fitted, kind="stable").tolist():
                need: dict[int, int] = {}
                for length in found[c]:
                    need[length] = need.get(length, 0) + 1
                times = min(int(fitted[c]), *(int(left[x]) // k for x, k in need.items()))
                if times:
                    take(found[c], times)
    while True:   # residual: best fit by counts, longest first
        lengths = np.flatnonzero(left)
        if not len(lengths):
            break
        pattern, spare, rest = [], capacity, left.copy()
        while True:
            fits = lengths[(lengths <= spare)]
            fits = fits[rest[fits] > 0]
            if not len(fits):
                break
            # the longest fitting piece, or a pair that fills the gap exactly
            x = int(fits[-1])
            if pattern and x < spare:
                pair = fits[(rest[spare - fits] > 0) & ((fits * 2 != spare) | (rest[fits] > 1))]
                pair = pair[(spare - pair) > 0]
                if len(pair):
                    x = int(pair[-1])
            pattern.append(x)
            rest[x] -= 1
            spare -= x
        need = {x: pattern.count(x) for x in pattern}
        take(tuple(pattern), min(int(left[x]) // k for x, k in need.items()))
    return slots


# ---------------------------------------------------------------- packing
def pack(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32,
    sequence_id, offset``.  A NULL or empty text is its end id alone; NULL
    keys and repeated rows are packed like any other.  An empty table gives
    an empty result."""
    spark = docs.sparkSession
    cut = materialise(pieces(docs, tokenizer, text, key, capacity, end_id)
                      .withColumn("part", F.spark_partition_id()))
    by_part = materialise(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    # at most `capacity` rows reach the driver
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(
        F.sum("n").alias("n")).collect()}
    slots = np.array(sorted(plan(histogram, capacity)), dtype=np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = by_part.select("length", "part",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part", "length").orderBy("key", "piece", "start")
    ranked = (cut.withColumn("rank", F.row_number().over(inside) - 1)
              .join(starts, ["length", "part"])
              .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "part"))
    if not len(slots):
        return ranked.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32",
                             F.lit(0).cast("long").alias("sequence_id"),
                             F.lit(0).cast("long").alias("offset"))
    # slots sorted by (length, first rank): one search key over both
    shared = spark.sparkContext.broadcast(slots)

    @F.pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s = shared.value
        at = np.empty(len(length), dtype=np.int64)
        n, r = length.to_numpy(), rank.to_numpy()
        for x in np.unique(n):
            lo, hi = np.searchsorted(s[:, 0], [x, x + 1])
            own = n == x
            at[own] = lo + np.searchsorted(s[lo:hi, 1], r[own], side="right") - 1
        return pd.DataFrame({"sequence_id": s[at, 3] + r - s[at, 1], "offset": s[at, 4]})

    placed = ranked.withColumn("p", place("length", "rank"))
    return placed.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32",
                         "p.sequence_id", "p.offset")
