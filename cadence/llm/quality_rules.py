"""Quality rules: per-document counts and cross-document line frequency.

Document rules need at least ``MIN_WORDS`` words, of which at most half lie
in repeated three-word windows.

Line frequency: lines are normalised (lower case, single blanks, trimmed) and
hashed.  A line found in more than ``MIN_DOCS`` distinct documents of a host,
however large the host, is removed from all of them but the first that has
it.  Equal texts are one document,
so copies do not make their own lines frequent.  A document that keeps less
than ``KEPT_SHARE`` of its words is depleted and rejected.

Everything is built-in functions: repeated windows are found by sorting an
array of (hash prefix, position) longs inside the row, so no word-level
shuffle is needed; only line hashes are shuffled, pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import SPACES, col, fresh, materialise, with_row_id, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_DOCS = 20
HOST_SHARE = 0.0       # no share of the host: a line's verdict does not depend on its size
KEPT_SHARE = 0.3
HEAVY_ROWS = 200_000   # heavy lines are broadcast up to this many (under 50 bytes each)
HOST_ROWS = 2_000      # and up to this many of one host, since each row looks through them
SYMBOLS = r"[#*$%&|<>]"

_SHORT = 20   # bits of a position beside a hash prefix


def with_repeated_words(df: DataFrame, w: str, out: str) -> DataFrame:
    """Adds ``out``: the words inside three-word windows that occur at least
    twice in the array column ``w``, the first occurrence included; each word
    counts once.

    Windows are sorted as longs of a hash prefix and a position, so equal ones
    are neighbours unless another window has their prefix.  Rows in which two
    neighbours share a prefix but not the hash, and arrays too long for such
    positions, are sorted by the full hash instead.  Arrays that lambdas index
    are columns of their own, so they are computed once."""
    packed, full, found = fresh(df, "packed", "full", "found")
    n = F.size(col(w))
    mask = F.lit((1 << _SHORT) - 1).cast("long")

    def window(i: Column) -> Column:
        return F.xxhash64(F.get(col(w), i), F.get(col(w), i + 1), F.get(col(w), i + 2))

    def at(x: Column) -> Column:
        return window(x.bitwiseAND(mask).cast("int"))

    def near(a: Column, b: Column) -> Column:
        return F.shiftrightunsigned(a, _SHORT) == F.shiftrightunsigned(b, _SHORT)

    def twin(a: Column, b: Column) -> Column:
        return F.coalesce(near(a, b) & (at(a) == at(b)), F.lit(False))

    places = F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0)))
    windows = F.sort_array(F.transform(
        places, lambda i: F.shiftleft(window(i), _SHORT).bitwiseOR(i.cast("long"))))
    mixed = F.filter(col(packed), lambda x, k: F.coalesce(
        near(x, F.get(col(packed), k + 1)) & (at(x) != at(F.get(col(packed), k + 1))),
        F.lit(False)))
    hashed = F.sort_array(F.transform(places, lambda i: F.struct(window(i).alias("h"),
                                                                 i.cast("long").alias("i"))))

    def same(x: Column, k: Column) -> Column:
        return F.coalesce(x["h"] == F.get(col(full), k)["h"], F.lit(False))

    repeats = F.when(col(full).isNull(), F.transform(
        F.filter(col(packed), lambda x, k: twin(x, F.get(col(packed), k + 1))
                 | twin(x, F.get(col(packed), k - 1))), lambda x: x.bitwiseAND(mask))).otherwise(
        F.transform(F.filter(col(full), lambda x, k: same(x, k + 1) | same(x, k - 1)),
                    lambda x: x["i"]))
    words_in = F.flatten(F.transform(col(found), lambda x: F.sequence(x, x + 2)))
    return (df.withColumn(packed, F.when((n > 3) & (n < (1 << _SHORT)), windows))
            .withColumn(full, F.when((n > 3) & (col(packed).isNull() | (F.size(mixed) > 0)), hashed))
            .withColumn(found, F.when(n > 3, repeats))
            .withColumn(out, F.when(F.size(col(found)) > 0, F.size(F.array_distinct(words_in)))
                        .otherwise(F.lit(0)).cast("long"))
            .drop(packed, full, found))


def _line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"\s+", " "))


def heavy_lines(docs: DataFrame, text: str, host: str, rid: str) -> tuple[DataFrame, DataFrame]:
    """``(lines, heavy)``: every distinct line of a document (``rid, host,
    doc, line, words``) and the lines above the host's limits (``host, line,
    holder``; ``holder`` is the document that keeps the line)."""
    each = F.transform(
        F.filter(F.split(col(text), "\n"), lambda x: F.trim(x) != ""),
        lambda x: F.struct(F.xxhash64(_line(x)).alias("line"), F.size(words(x)).alias("words")))
    lines = materialise(
        docs.select(col(rid).alias("rid"), F.coalesce(col(host), F.lit("")).alias("host"),
                    F.xxhash64(col(text)).alias("doc"), F.explode(each).alias("x"))
        .select("rid", "host", "doc", "x.line", "x.words")
        .groupBy("rid", "host", "doc", "line").agg(F.sum("words").alias("words")))
    held = lines.groupBy("host", "line", "doc").agg(F.min("rid").alias("rid"))
    # the smallest row number decides which text keeps the line
    counted = held.groupBy("host", "line").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "doc")).alias("first"))
    heavy = counted.where(F.col("n") > MIN_DOCS)
    return lines, materialise(heavy.select("host", "line", F.col("first.doc").alias("holder")))


def _with_own_lines(docs: DataFrame) -> DataFrame:
    """Adds ``own``: hashes of the lines that go from the row (may be NULL).

    Up to ``HEAVY_ROWS`` heavy lines, and ``HOST_ROWS`` of any one host, both
    counted, are broadcast and the documents stay where they are; beyond, rows
    fetch their lines by a shuffle join."""
    lines, heavy = heavy_lines(docs, "text", "host", "rid")
    most = heavy.groupBy("host").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("all"),
        F.coalesce(F.max("n"), F.lit(0)).alias("host")).first()
    if most["all"] > HEAVY_ROWS or most["host"] > HOST_ROWS:
        gone = lines.join(heavy, ["host", "line"]).where("doc <> holder")
        return docs.join(gone.groupBy("rid").agg(F.collect_list("line").alias("own")),
                         "rid", "left")
    by_host = heavy.groupBy(F.col("host").alias("heavy_host")).agg(
        F.collect_list(F.struct("line", "holder")).alias("heavy"))
    joined = docs.join(F.broadcast(by_host),
                       F.coalesce("host", F.lit("")) == F.col("heavy_host"), "left")
    others = F.filter("heavy", lambda x: x["holder"] != F.xxhash64("text"))
    return joined.withColumn("own", F.transform(others, lambda x: x["line"])).drop(
        "heavy_host", "heavy")


def _with_removals(docs: DataFrame) -> DataFrame:
    """Adds ``removed_words`` and ``clean``, the text without its own heavy
    lines.  What lambdas index is a column of its own, computed once."""
    split = (_with_own_lines(docs)
             .withColumn("parts", F.when(F.size("own") > 0, F.split("text", "\n")))
             .withColumn("hashes", F.transform("parts", lambda x: F.xxhash64(_line(x)))))

    def goes(i: Column) -> Column:
        return F.array_contains("own", F.get("hashes", i))

    removed = F.aggregate(F.filter("parts", lambda x, i: goes(i)), F.lit(0).cast("long"),
                          lambda total, x: total + F.size(words(x)))
    rest = F.array_join(F.filter("parts", lambda x, i: ~goes(i)), "\n")
    return (split.withColumn("removed_words", F.coalesce(removed, F.lit(0).cast("long")))
            .withColumn("clean", F.coalesce(rest, "text")).drop("own", "parts", "hashes"))


def _counted(docs: DataFrame) -> DataFrame:
    """``row, clean, removed_words`` and the base counts of ``docs``."""
    body = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    split = docs.select("row", "clean", "removed_words", words(F.col("text")).alias("w"),
                        lines.alias("lines"),
                        F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")).cast("long")
                        .alias("word_chars"),
                        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    # through a generator: verdicts name the counts often, which would repeat the counting
    return with_repeated_words(split, "w", "n_repeat_words").select(F.inline(F.array(F.struct(
        "row", "clean", "removed_words", F.size("w").cast("long").alias("n_words"), "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words"))))


def _base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _depleted() -> Column:
    return F.col("n_words") - F.col("removed_words") < KEPT_SHARE * F.col("n_words")


def _verdicts(docs: DataFrame, text: str, host: str, row: Column) -> DataFrame:
    """``row``, the counts, ``removed_words``, ``clean``, ``base_failed`` and
    ``kept`` of every row of ``docs``."""
    rid, = fresh(docs, "rid")
    numbered = with_row_id(docs, rid).select(col(rid).alias("rid"), row.alias("row"),
                                             col(text).alias("text"), col(host).alias("host"))
    return _counted(_with_removals(numbered)).select(
        "*", _base_failed().alias("base_failed"),
        (~_base_failed() & ~_depleted()).alias("kept"))


def assess(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id"
           ) -> DataFrame:
    """One row per row of ``docs`` (a stored table): ``key``, the counts,
    ``base_failed``, ``removed_words``, ``kept``.  A NULL text has no word
    and fails; NULL hosts are one host; repeated rows stay and are one
    document to the line frequency.  An empty table gives an empty result."""
    return _verdicts(docs, text, host, F.struct(col(key).alias("key"))).select(
        F.col("row.key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "removed_words", "kept")


def filter_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, without the lines above the limits.  Columns
    are those of ``docs`` (a stored table)."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    row = F.struct(*(col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)
                     if c != text))
    judged = _verdicts(docs, text, host, row)
    # a generator, since a filter would be pushed down and repeat the counting
    one = judged.select(F.explode_outer(F.when(F.col("kept"), F.array(
        F.struct("row", "clean")))).alias("x")).where("x IS NOT NULL")
    return one.select(*((F.col("x.clean") if c == text else F.col(f"x.row.{n}")).alias(c)
                        for c, n in zip(docs.columns, names, strict=True)))
