"""Hard negatives by Fagin's threshold algorithm.

An anchor's positives are the rows of its label with the highest inner
product; the hard negatives of a positive are the best rows of other labels
whose score lies in a window below the positive's.

Rows are kept in blocks.  A block holds one sorted list a dimension.  For an
anchor every list is read from the end its component's sign points to, some
rows at a time in all lists together (sorted access).  Rows met for the first
time are scored with integers (random access).  No row still unread can score
more than the threshold: the sum of the anchor's components times the values
the lists have come to.  Reading stops once the threshold is strictly below
the k-th score that each window has found (below its lower end, as long as it
has fewer).  Anchors of a block are read in step, so that rows met by several
are scored in one matrix product; what an anchor has not met is not used.

Anchors and rows meet in blocks on both sides (a stated query set against all
rows): a task holds ``ROW_BLOCK`` rows and ``ANCHOR_BLOCK`` anchors.  The best
rows of the blocks are merged by a ranked window, of which only the first k of
every input partition are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import col, materialise, ship
from cadence.operators.prefix import row_numbers

SCALE = 256             # a component x becomes floor(SCALE * x)
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95      # window in per cent of the positive's score
ROW_BLOCK = 16_384
ANCHOR_BLOCK = 16_384
GROUP = 32              # anchors read in step
FIRST_STEP = 128        # rows of every list read at first; then twice as deep

_TOP = {"anchor": pa.int64(), "window": pa.int32(), "rid": pa.int64(), "vec_id": pa.int64(),
        "score": pa.int64()}


# ------------------------------------------------------- one block of rows
class SortedLists:
    """The rows of a block and, per dimension, their order by that component
    (ascending)."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)

    def read(self, anchors: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Sorted access: (anchor, row) marks of the rows at depths lo to hi of
        the anchors' lists."""
        n = len(self.vectors)
        met = np.zeros((len(anchors), n), dtype=bool)
        for a, anchor in enumerate(anchors):
            met[a, self.order[anchor > 0, n - hi:n - lo].ravel()] = True
            met[a, self.order[anchor < 0, lo:hi].ravel()] = True
            if hi == n and not anchor.any():
                met[a] = True       # no list leads to any row
        return met

    def threshold(self, anchors: np.ndarray, depth: int) -> np.ndarray:
        """What an unread row can score at most when ``depth`` rows of every
        list are read."""
        n, dims = self.vectors.shape
        every = np.arange(dims)
        high = self.vectors[self.order[:, n - depth], every]
        low = self.vectors[self.order[:, depth - 1], every]
        return np.where(anchors > 0, anchors * high, anchors * low).sum(axis=1)


def _bound(anchors: np.ndarray, vectors: np.ndarray) -> int:
    return (int(np.abs(anchors).max(initial=0)) * int(np.abs(vectors).max(initial=0))
            * max(1, vectors.shape[1]))


def _check_range(anchors: np.ndarray, vectors: np.ndarray) -> None:
    if _bound(anchors, vectors) >= 2 ** 63:
        raise OverflowError("inner products beyond 64 bits")


def _products(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where that is exact."""
    if _bound(anchors, vectors) < 2 ** 53:
        return (anchors.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return anchors @ vectors.T


def search(lists: SortedLists, anchors: np.ndarray, allowed, windows: list, k: int,
           group: int = GROUP, first: int = FIRST_STEP) -> tuple[list, int]:
    """Per anchor its windows' best rows: ``(found, scored)``.  ``windows[a]``
    is an array of rows ``(low, high)``; ``allowed(a)`` marks the rows that
    count for anchor ``a``; ``found[a][w]`` is an array of (score, row) pairs
    that holds the k best of the window with all ties of the k-th.  ``scored``
    counts the random accesses."""
    n, dims = lists.vectors.shape
    _check_range(anchors, lists.vectors)
    found: list = [None] * len(anchors)
    scored = 0
    for start in range(0, len(anchors), group):
        live = np.arange(start, min(start + group, len(anchors)))
        met = np.zeros((len(live), n), dtype=bool)
        scores = np.zeros((len(live), n), dtype=np.int64)
        done, depth = 0, min(first, n) if dims else n
        while len(live):
            now = anchors[live]
            fresh = lists.read(now, done, depth) & ~met
            rows = np.flatnonzero(fresh.any(axis=0))
            scores[:, rows] = np.where(fresh[:, rows], _products(now, lists.vectors[rows]),
                                       scores[:, rows])
            scored += int(fresh.sum())
            met |= fresh
            ended = met.all(axis=1) | (depth >= n)
            rest = lists.threshold(now, depth) if dims else np.zeros(len(live), dtype=np.int64)
            going = np.ones(len(live), dtype=bool)
            for i, a in enumerate(live):
                lows, highs = windows[a][:, 0], windows[a][:, 1]
                if len(highs) and not ended[i] and rest[i] >= highs.min():
                    continue            # above some window: no k-th score can stop it
                rows = np.flatnonzero(met[i] & (scores[i] >= lows.min(initial=0))
                                      & (scores[i] <= highs.max(initial=0)) & allowed(a))
                rows = rows[np.argsort(-scores[i, rows], kind="stable")]
                down = -scores[i, rows]
                begin = np.searchsorted(down, -highs)
                end = np.searchsorted(down, -lows, "right")
                if ended[i] or all(rest[i] < (-down[f + k - 1] if t - f >= k else low)
                                   for f, t, low in zip(begin, end, lows)):
                    found[a] = []
                    for f, t in zip(begin, end):
                        if t - f > k:       # with the ties of the k-th
                            t = min(t, np.searchsorted(down, down[f + k - 1], "right"))
                        found[a].append((-down[f:t], rows[f:t]))
                    going[i] = False
            live, met, scores = live[going], met[going], scores[going]
            done, depth = depth, min(2 * depth, n)
    return found, scored


# -------------------------------------------------------------- tables
def prepare(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
            label: str = "label", relabel: tuple[int, int, int] | None = None) -> DataFrame:
    """The rows that take part, stored: ``rid, vec_id, label, v`` (integers)
    and ``block``.  ``relabel = (d, k, m)``: where ``d`` divides the id the
    label becomes ``(label + k) % m``."""
    ids, labels = col(vec_id).cast("long"), col(label).cast("long")
    if relabel:
        d, k, m = relabel
        labels = F.when(ids % d == 0, (labels + k) % m).otherwise(labels)
    x = col(embedding).cast("array<double>")
    finite = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = materialise(vectors.where(
        ids.isNotNull() & col(label).isNotNull() & x.isNotNull() & finite).select(
        ids.alias("vec_id"), labels.alias("label"),
        F.transform(x, lambda c: F.floor(c * SCALE)).alias("v"),
        F.monotonically_increasing_id().alias("rid")))
    return materialise(_blocks(rows, "rid", ROW_BLOCK, "block"))


def _blocks(rows: DataFrame, rid: str, size: int, name: str) -> DataFrame:
    numbered = row_numbers(rows, [rid], name="_n")
    return numbered.withColumn(name, F.floor((F.col("_n") - 1) / size)).drop("_n")


def _meet(anchors: DataFrame, rows: DataFrame, work, columns: list[str]) -> DataFrame:
    """Runs ``work`` on every pair of a block of rows and a block of anchors."""
    def upto(df: DataFrame, name: str) -> Column:
        last = df.agg(F.max(name)).first()[0] or 0
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))

    sent = anchors.select("part", *columns, upto(rows, "block").alias("block"))
    held = rows.select("block", "rid", "vec_id", "label", "v",
                       upto(anchors, "part").alias("part"))
    keys = ["block", "part"]

    def pairs(held: pa.Table, sent: pa.Table) -> pa.Table:
        out = []
        sizes, a_sizes = (pc.list_value_length(t["v"]) for t in (held, sent))
        for dims in set(pc.unique(sizes).to_pylist()) & set(pc.unique(a_sizes).to_pylist()):
            out += work(held.filter(pc.equal(sizes, dims)), sent.filter(pc.equal(a_sizes, dims)),
                        dims)
        columns = list(zip(*out)) if out else [[]] * len(_TOP)
        return pa.table([pa.array(c, t) for c, t in zip(columns, _TOP.values())],
                        names=list(_TOP))

    schema = ", ".join(f"{n} {'int' if t == pa.int32() else 'long'}" for n, t in _TOP.items())
    return held.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(pairs, schema)


def _matrix(table: pa.Table, dims: int) -> np.ndarray:
    flat = pc.list_flatten(table["v"]).to_numpy().astype(np.int64)
    return flat.reshape(len(table), dims)


def _best(found: list, anchor_rids: np.ndarray, rids: np.ndarray, ids: np.ndarray, k: int
          ) -> list[tuple]:
    """The k first rows of every window, as rows of ``_TOP``."""
    out = []
    for a, per_window in enumerate(found):
        for w, (scores, rows) in enumerate(per_window):
            first = np.lexsort((rids[rows], ids[rows], -scores))[:k]
            out.extend((int(anchor_rids[a]), w, int(rids[rows[i]]), int(ids[rows[i]]),
                        int(scores[i])) for i in first)
    return out


def _ranked(top: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "rid")
    return top.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(anchors: DataFrame, rows: DataFrame, k: int = POSITIVES) -> DataFrame:
    """``anchor, window, rid, vec_id, score, rank``: the k best other rows of
    an anchor's label."""
    ship(__name__)
    limits = np.iinfo(np.int64)
    everything = np.array([[limits.min + 1, limits.max]])

    def work(held: pa.Table, sent: pa.Table, dims: int) -> list[tuple]:
        vectors, labels = _matrix(held, dims), held["label"].to_numpy()
        rids, ids = held["rid"].to_numpy(), held["vec_id"].to_numpy()
        a_vectors, a_labels = _matrix(sent, dims), sent["label"].to_numpy()
        a_rids, out = sent["anchor"].to_numpy(), []
        for label in np.intersect1d(labels, a_labels):
            own, mine = np.flatnonzero(labels == label), np.flatnonzero(a_labels == label)
            found, _ = search(SortedLists(vectors[own]), a_vectors[mine],
                              lambda a, r=rids[own], m=a_rids[mine]: r != m[a],
                              [everything] * len(mine), k)
            out += _best(found, a_rids[mine], rids[own], ids[own], k)
        return out

    return _ranked(_meet(anchors, rows, work, ["anchor", "label", "v"]), k)


def negatives(anchors: DataFrame, rows: DataFrame, k: int = NEGATIVES) -> DataFrame:
    """``anchor, window, rid, vec_id, score, rank``: per window of an anchor
    (``lows``, ``highs``) the k best rows of other labels in it."""
    ship(__name__)

    def work(held: pa.Table, sent: pa.Table, dims: int) -> list[tuple]:
        labels, rids, ids = (held[c].to_numpy() for c in ("label", "rid", "vec_id"))
        a_labels = sent["label"].to_numpy()
        windows = [np.array(list(zip(lo, hi)), dtype=np.int64).reshape(-1, 2)
                   for lo, hi in zip(sent["lows"].to_pylist(), sent["highs"].to_pylist())]
        found, _ = search(SortedLists(_matrix(held, dims)), _matrix(sent, dims),
                          lambda a: labels != a_labels[a], windows, k)
        return _best(found, sent["anchor"].to_numpy(), rids, ids, k)

    return _ranked(_meet(anchors, rows, work, ["anchor", "label", "v", "lows", "highs"]), k)


def mine(vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id",
         embedding: str = "embedding", label: str = "label",
         relabel: tuple[int, int, int] | None = None, n_positives: int = POSITIVES,
         n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every anchor (``is_anchor`` over ``vec_id``) and each
    of its first positives, the first rows of other labels that score from
    ``low`` to ``high`` per cent of the positive's score.

    Higher scores come first, ties by smaller id.  Rows without id, label or
    vector, or with a NULL or non-finite component, take no part.  Only
    vectors of equal length meet; scores that do not fit 64 bits raise.
    Repeated rows are rows of their own.  A positive with a negative score has
    no window; one of score 0 has 0 itself.  An empty table gives an empty
    result."""
    rows = prepare(vectors, vec_id, embedding, label, relabel)
    anchors = materialise(_blocks(rows.where(is_anchor).select(
        F.col("rid").alias("anchor"), "vec_id", "label", "v"), "anchor", ANCHOR_BLOCK, "part"))
    pos = materialise(positives(anchors, rows, n_positives).select(
        "anchor", F.col("rank").alias("p"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")))
    score = F.col("positive_score")
    # 100 * s >= low * p and 100 * s <= high * p, in integers
    window = F.struct("p", F.expr(f"-((-{low} * positive_score) div 100)").alias("near"),
                      F.expr(f"({high} * positive_score) div 100").alias("far"))
    wanted = pos.where(score >= 0).groupBy("anchor").agg(
        F.array_sort(F.collect_list(window)).alias("w")).select(
        "anchor", F.col("w.near").alias("lows"), F.col("w.far").alias("highs"))
    found = negatives(anchors.join(wanted, "anchor"), rows, n_negatives)
    # windows are numbered from 0 in the order of the positives
    return (found.withColumn("p", F.col("window") + 1)
            .select("anchor", "p", "rank", F.col("vec_id").alias("negative_id"),
                    F.col("score").alias("negative_score"))
            .join(pos, ["anchor", "p"])
            .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
