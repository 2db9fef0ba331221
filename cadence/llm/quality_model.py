"""Quality classifier from weak labels.

Heuristic labellers vote good (1), bad (-1) or abstain (0) on every document.
Expectation-maximisation over the votes estimates how often each labeller
says what on good and on bad documents (no labels are read).  The posterior
of a vote pattern labels a bounded sample on which a hashed linear scorer is
trained; the scorer reads the whole text and scores every document.

The votes have at most 3^n patterns, so EM works on a pattern histogram that
Spark counts over all documents.  ``TRAIN_DOCS`` bounds the sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import col, fresh, materialise, ship, with_row_id

TRAIN_DOCS = 4000       # sampled documents in expectation
DIMENSIONS = 1 << 14    # hashed features
GRAM = 3                # bytes of a feature
ROUNDS = 100            # EM rounds
STEPS = 300             # gradient steps
INSULT_WORDS = 200      # one insult in so many words rejects a document
# Words of abuse.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic",
           "disgusting", "clown")

LABELLERS = ("length", "symbols", "shouting", "repetition", "variety", "word_length", "exclaim",
             "sentences", "abuse")

_ABUSE = re.compile(r"\b(?:" + "|".join(INSULTS) + r")s?\b", re.IGNORECASE)

ship(__name__)


def _say(good: bool, bad: bool) -> int:
    return -1 if bad else 1 if good else 0


def votes(text: str | None) -> tuple[list[int], int, int]:
    """The labellers' votes, the words and the words of abuse of a text."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [-1] + [0] * (len(LABELLERS) - 1), 0, 0
    chars = sum(map(len, words))
    letters = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8),
                          minlength=256)
    upper, lower = int(letters[65:91].sum()), int(letters[97:123].sum())
    symbols = int(letters[[ord(c) for c in "#*$%&|<>"]].sum())
    exclaims = int(letters[33])
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    distinct = len(set(words))
    lines = [x.rstrip() for x in text.split("\n") if x.strip()]
    ended = sum(x.endswith((".", "!", "?", '"', "…")) for x in lines) / len(lines)
    abuse = len(_ABUSE.findall(text))
    shout = upper / max(1, upper + lower)
    mean = chars / n
    return [
        _say(n >= 50, n < 5),
        _say(symbols <= 0.002 * chars, symbols > 0.02 * chars),
        _say(shout < 0.1, shout > 0.3),
        _say(repeats <= 0.01 * n, repeats > 0.1 * n),
        _say(distinct > 0.4 * n, n >= 50 and distinct < 0.2 * n) if n < 1000 else 0,
        _say(3 <= mean <= 9, mean > 14 or mean < 2),
        _say(exclaims <= 0.02 * n, exclaims > 0.2 * n),
        _say(ended >= 0.8, ended < 0.2),
        _say(False, abuse * INSULT_WORDS > n),
    ], n, abuse


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS
                  ) -> tuple[float, np.ndarray]:
    """EM over vote patterns (rows of -1/0/1) and their counts: the share of
    good documents and ``rates[labeller, vote + 1, class]``."""
    k = patterns.shape[1]
    good = np.clip(0.5 + patterns.sum(axis=1) / (2 * k), 0.05, 0.95)   # majority vote
    rates, prior = np.full((k, 3, 2), 1 / 3), 0.5
    for _ in range(rounds):
        mass = np.stack([counts * (1 - good), counts * good], axis=1)
        prior = float(mass[:, 1].sum() / mass.sum())
        for j in range(k):
            for v in range(3):
                rates[j, v] = mass[patterns[:, j] == v - 1].sum(axis=0) + 0.1
            rates[j] /= rates[j].sum(axis=0)
        good = posterior(patterns, prior, rates)
    return prior, rates


def posterior(patterns: np.ndarray, prior: float, rates: np.ndarray) -> np.ndarray:
    """Probability that a document with these votes is good."""
    odds = np.log(max(prior, 1e-6)) - np.log(max(1 - prior, 1e-6))
    odds = odds + sum(np.log(rates[j, patterns[:, j] + 1, 1] / rates[j, patterns[:, j] + 1, 0])
                      for j in range(patterns.shape[1]))
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def features(text: str | None) -> np.ndarray:
    """Hashed byte n-grams of a text, in order, repeats included."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    h = np.zeros(n, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            h = (h * np.uint32(0x01000193)) ^ raw[k: k + n]
        h *= np.uint32(0x85EBCA6B)
    return (h >> np.uint32(18)).astype(np.int64) & (DIMENSIONS - 1)


def fit_scorer(texts: list[str], target: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Logistic weights (the last is the bias) on square-rooted feature
    shares, by full-batch Adagrad on soft labels."""
    rows, cols, values = [], [], []
    for i, text in enumerate(texts):
        f, n = np.unique(features(text), return_counts=True)
        rows.append(np.full(len(f), i))
        cols.append(f)
        values.append(n / max(1, n.sum()))
    w = np.zeros(DIMENSIONS + 1)
    if not texts:
        return w
    r, c, v = np.concatenate(rows), np.concatenate(cols), np.concatenate(values)
    squares = np.full_like(w, 1e-8)
    for _ in range(steps):
        z = np.bincount(r, v * w[c], minlength=len(texts)) + w[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - target
        slope = np.append(np.bincount(c, v * error[r], minlength=DIMENSIONS), error.sum())
        slope += 1e-4 * w
        squares += slope * slope
        w -= 1.0 * slope / np.sqrt(squares)
    return w


def classify(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs`` (a stored table): ``key, votes`` (one
    letter ``g``/``b``/``-`` per labeller), ``posterior`` of the votes,
    ``score`` of the trained scorer and ``kept`` (score of at least one half
    and not abusive).  NULL and empty texts score 0 and are not kept;
    repeated rows stay; an empty table gives an empty result."""
    spark = docs.sparkSession

    @F.pandas_udf("struct<votes:string,n:bigint,abuse:bigint>")
    def vote(texts: pd.Series) -> pd.DataFrame:
        out = [votes(t) for t in texts]
        return pd.DataFrame({"votes": ["".join("b-g"[x + 1] for x in v) for v, _, _ in out],
                             "n": [n for _, n, _ in out], "abuse": [a for _, _, a in out]})

    rid, = fresh(docs, "rid")
    base = with_row_id(docs, rid).select(col(rid).alias("rid"), col(key).alias("key"),
                                         col(text).alias("text"))
    voted = materialise(base.select("rid", "key",
                                    vote("text").alias("v"))
                        .select("rid", "key", "v.*"))
    histogram = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").toPandas()
    names = histogram["votes"].tolist()            # at most 3^labellers rows
    total = int(histogram["n"].sum())
    patterns = np.array([["b-g".index(x) - 1 for x in v] for v in names],
                        dtype=int).reshape(-1, len(LABELLERS))
    good = np.empty(0)
    weights = np.zeros(DIMENSIONS + 1)
    if total:
        good = posterior(patterns, *fit_labellers(patterns, histogram["n"].to_numpy(dtype=float)))
        of = dict(zip(names, good, strict=True))
        share = min(1.0, TRAIN_DOCS / total)
        dice = F.pmod(F.xxhash64("rid", "text"), F.lit(1 << 30)) / float(1 << 30)
        # at most TRAIN_DOCS documents in expectation; votes are recomputed
        rows = base.where((dice < share) & F.col("text").isNotNull()).select(
            "text", vote("text")["votes"].alias("votes")).toPandas()
        weights = fit_scorer(rows["text"].tolist(),
                             np.array([of.get(v, 0.5) for v in rows["votes"]]))
    shared = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shared.value
        for batch in batches:
            out = []
            for t in batch:
                f = features(t)
                z = w[f].mean() + w[-1] if len(f) else -50.0
                out.append(1 / (1 + np.exp(-min(50.0, max(-50.0, z)))) if len(f) else 0.0)
            yield pd.Series(out, dtype="float64")

    table = spark.createDataFrame(pd.DataFrame({"votes": names, "posterior": good}),
                                  "votes string, posterior double")
    scored = voted.join(F.broadcast(table), "votes").join(
        base.select("rid", score("text").alias("score")), "rid")
    return scored.select(
        F.col("key").alias(key), "votes", "posterior", "score",
        ((F.col("score") >= 0.5) & (F.col("abuse") * INSULT_WORDS <= F.col("n"))).alias("kept"))
