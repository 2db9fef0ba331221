"""Mixing sources to target weights by weighted fair queueing.

``targets`` gives every source its share of the budget (the size of all
documents) by weight, at most ``MAX_EPOCHS`` times its own size; what a
stopped source leaves is reshared by weight until none is above.

``mix`` queues every source's documents in a shuffled order (by a hash of the
document's key), the whole order again for each further epoch.  A document
enters the queue in packets of at most ``PACKET`` words.  A packet's virtual
finish time is the cumulative size of its source up to its end, divided by
the source's target.  All packets are range-sorted globally by finish time
and taken until the budget is spent; the packet in which it ends is taken in
part.  So every source is within about one packet of its target at any cut,
also where one document is larger than its source's target.

Both running sums (per source, and over all packets) are prefix scans over
range partitions, so a source that holds a third of all rows is spread like
any other.  Only key, hash and size are sorted, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import col, materialise, words
from cadence.operators.prefix import row_numbers, running_sum

WEIGHTS = (5, 2, 1)     # repeating over the sources by code point, NULL last
MAX_EPOCHS = 3          # times a document is taken at most
PACKET = 512            # words


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
            ) -> DataFrame:
    """``source, source_size, weight, target`` of rows ``source, source_size``
    (one per source).  A round fixes the sources above ``max_epochs`` times
    their size there and reshares the rest; two numbers a round reach the
    driver.  A source of no size gets 0."""
    ranked = row_numbers(sizes.withColumn("_null", F.col("source").isNull()),
                         ["_null", "source"], name="_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    sources = materialise(ranked.select(
        "source", "source_size", weight.cast("long").alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap")))
    whole = sources.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    left, free = whole["n"] or 0, whole["w"] or 0
    while True:
        # left / free is the target of a free source of weight 1
        share = F.col("weight") * F.lit(left) / F.lit(max(free, 1))
        stopped = sources.where(share > F.col("cap")).agg(
            F.sum("cap").alias("n"), F.sum("weight").alias("w")).first()
        now = ((whole["n"] or 0) - (stopped["n"] or 0), (whole["w"] or 0) - (stopped["w"] or 0))
        if now == (left, free):
            break
        left, free = now
    return sources.select("source", "source_size", "weight",
                          F.least(share, F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, packet: int = PACKET,
        seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: ``key, size, source_size, target, taken``,
    and the place ``first_finish`` (virtual finish time of the first packet
    taken; NULL if none is).

    A NULL or blank text has size 0 and takes part with nothing; a NULL
    source is a source of its own, after all others; rows with equal or NULL
    keys are documents of their own.  An empty table gives an empty result.
    Reruns agree: the order depends on the rows' values only (equal rows are
    interchangeable)."""
    rows = materialise(docs.select(
        col(key).alias("key"), col(source).alias("source"), F.crc32(col(text)).alias("crc"),
        F.size(words(col(text))).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(col(key).cast("string"), F.lit("-"))))
        .alias("shuffle"), F.monotonically_increasing_id().alias("rid")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = materialise(targets(sizes, weights, max_epochs))
    queued = running_sum(rows.where("size > 0").drop("key"), "size",
                         ["shuffle", "crc", "size", "rid"], by=["source"], name="end")
    # No packet that finishes after 1 + packet / (smallest target) is taken: by
    # then every source has served its target, and the targets are the budget.
    bound = shares.where("target > 0").agg(
        F.min("target").alias("low"), F.sum("source_size").alias("budget")).first()
    budget = shares.agg(F.sum("source_size")).first()[0] or 0
    last = 1 + packet / (bound["low"] or 1)
    served = (queued.alias("q").join(shares.alias("s"), F.col("q.source").eqNullSafe(
        F.col("s.source"))).where("target > 0")
        .select("q.rid", "size", "end", "source_size", "target",
                F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"))
        .withColumn("start", F.col("epoch") * F.col("source_size") + F.col("end") - F.col("size"))
        .where(F.col("start") / F.col("target") <= last)
        .select("*", F.explode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(packet)))
                .alias("from"))
        .withColumn("words", F.least(F.lit(packet), F.col("size") - F.col("from")))
        .withColumn("finish", (F.col("start") + F.col("from") + F.col("words")) / F.col("target"))
        .where(F.col("finish") <= last)
        .select("rid", "epoch", "from", "words", "finish"))
    spent = running_sum(served, "words", ["finish", "rid", "epoch", "from"], name="spent")
    taken = (spent.where(F.col("spent") - F.col("words") < budget)
             .groupBy("rid").agg(
                 F.sum(F.least(F.col("words"), budget - (F.col("spent") - F.col("words"))))
                 .alias("taken"), F.min("finish").alias("first_finish")))
    return (rows.join(taken, "rid", "left").alias("r")
            .join(shares.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
            .select(F.col("key").alias(key), "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_finish"))
