"""Language identification with language-bitmask n-gram filters.

For every learned language the most frequent character 4-grams of its
training texts go into a Bloom filter.  All filters have the same size and
hash functions and are stored bit-sliced: one bitmask over languages per bit
position.  Looking an n-gram up ANDs the masks at its positions and returns
all languages that contain it at once.  Over a text the hits per language
are population counts of the masks' bits; each is corrected for the false
positives its filter gives by its fill, ``(hits - n fp) / (1 - fp)``, and the
largest decides.

Training reads a bounded, hash-chosen sample per language (``TRAIN_DOCS``
documents in expectation).  N-grams are counted by a Spark aggregate; the
driver receives at most ``GRAMS`` of them per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import col, ship

ORDER = 4               # characters of an n-gram
TRAIN_DOCS = 3000       # sampled documents per language
GRAMS = 4000            # n-grams of a language's filter
BITS = 1 << 18          # positions of a filter
HASHES = 4
UNKNOWN = "und"

ship(__name__)


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters (built once per process)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool,
                                    count=0x110000))
    return _LETTERS[0]


def grams(text: str | None, letters: np.ndarray) -> np.ndarray:
    """64-bit hashes of the text's letter n-grams, in order, repeats
    included; runs of other characters are one blank.  Empty without a
    letter."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    cps = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    is_letter = letters[np.minimum(cps, 0x10FFFF)]
    if not is_letter.any():
        return np.empty(0, dtype=np.uint64)
    cps = np.where(is_letter, cps, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]            # the first blank of a run
    body = cps[keep]
    pad = np.full(ORDER - 1, 32, dtype=np.uint32)
    body = np.concatenate([pad[:1], body, pad if len(body) < ORDER else pad[:1]]).astype(np.uint64)
    n = len(body) - ORDER + 1
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(ORDER):
            h = h * np.uint64(0x9E3779B97F4A7C15) + body[k: k + n]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def positions(h: np.ndarray) -> list[np.ndarray]:
    """The Bloom positions of n-gram hashes."""
    first = (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
    second = ((h >> np.uint64(32)) | np.uint64(1)).astype(np.int64)
    return [(first + k * second) & (BITS - 1) for k in range(HASHES)]


@dataclass
class Model:
    """``table[position]`` is a bitmask over ``languages`` (bit i of byte
    i // 8); ``wrong`` are the filters' false-positive rates."""
    languages: list[str]
    table: np.ndarray
    wrong: np.ndarray
    fallback: int

    @classmethod
    def of(cls, filters: dict[str, np.ndarray], docs: dict[str, int]) -> Model:
        languages = sorted(filters)
        table = np.zeros((BITS, max(1, -(-len(languages) // 8))), dtype=np.uint8)
        wrong = np.zeros(len(languages))
        for i, name in enumerate(languages):
            bit = np.uint8(1 << (i % 8))
            for at in positions(filters[name]):
                table[at, i // 8] |= bit
            wrong[i] = ((table[:, i // 8] & bit) > 0).mean() ** HASHES
        fallback = max(range(len(languages)), key=lambda i: (docs.get(languages[i], 0), -i),
                       default=-1)
        return cls(languages, table, wrong, fallback)

    def predict(self, text: str | None, letters: np.ndarray) -> tuple[str, float]:
        h = grams(text, letters)
        if not len(h) or not self.languages:
            return UNKNOWN, 0.0
        masks = None
        for at in positions(h):
            masks = self.table[at] if masks is None else masks & self.table[at]
        bits = np.unpackbits(masks, axis=1, bitorder="little")[:, : len(self.languages)]
        hits = bits.sum(axis=0, dtype=np.int64)
        true = np.clip((hits - len(h) * self.wrong) / (1 - np.minimum(self.wrong, 0.999)), 0, None)
        best = int(true.argmax()) if true.max() > 0 else self.fallback
        return self.languages[best], float(min(1.0, true[best] / len(h)))


def held_out(key: str) -> Column:
    """Whether crc32 of the key as text leaves 1 modulo 3 (NULL: no)."""
    return F.coalesce(F.crc32(col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learns from the documents with a language that are not held out."""
    known = docs.where(col(lang).isNotNull() & col(text).isNotNull() & ~held_out(key)).select(
        col(text).alias("text"), col(lang).alias("lang"), col(key).alias("key"))
    docs_of = {r["lang"]: r["n"] for r in
               known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one per language
    share = F.create_map(*(F.lit(x) for name, n in docs_of.items()
                           for x in (name, min(1.0, TRAIN_DOCS / n)))) if docs_of else None
    if share is None:
        return Model.of({}, {})
    dice = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(dice < F.element_at(share, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = _letters()
        for batch in batches:
            for name, rows in batch.groupby("lang")["text"]:
                h = [grams(t, letters) for t in rows]
                each, n = np.unique(np.concatenate(h), return_counts=True)
                yield pd.DataFrame({"lang": name, "gram": each.view(np.int64), "n": n})

    counted = sample.mapInPandas(count, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= GRAMS).select("lang", "gram")
    chosen = top.toPandas()                       # at most GRAMS rows per language
    filters = {name: rows.to_numpy(dtype=np.int64).view(np.uint64)
               for name, rows in chosen.groupby("lang")["gram"]}
    return Model.of(filters, docs_of)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (share of the text's n-grams
    that the language is estimated to hold).  ``und`` with score 0 if the
    text is NULL or has no letter, or nothing was learned; a text without any
    known n-gram gets the most frequent training language; ties go to the
    first in alphabetical order."""
    # BITS bytes per 8 languages
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.table, model.wrong, model.fallback))

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        letters, own = _letters(), Model(*shared.value)
        return pd.DataFrame([own.predict(t, letters) for t in texts],
                            columns=["lang_pred", "score"])

    return docs.withColumn("_p", predict(col(text))).select(
        *(col(c) for c in docs.columns), "_p.lang_pred", "_p.score")
