"""Benchmark decontamination by template windows.

Texts are canonicalised into templates: numbers, names (capitalised words
that are not ``COMMON``, at the start of a sentence too) and units (after a number) become typed placeholders.
Windows of ``WINDOW`` template tokens are hashed and joined by hash.  A
document is contaminated by an item if, in one place, it shares at least
``COVERAGE`` of the item's windows and the slots agree: a benchmark value
stands for one document value throughout (renamed or renumbered questions are
caught, unrelated texts of the same shape are not).  A place is one alignment
(diagonal) or the neighbouring ones, up to ``SLACK`` apart, into which
inserted and dropped words split a copy; there an item window counts once, by
its match on the diagonal with the most.

The benchmark's windows are counted; up to ``BROADCAST_ROWS`` they are
broadcast, so documents are not shuffled; beyond that the join shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import col, fresh, materialise, maybe_broadcast, with_row_id

WINDOW = 5
COVERAGE = 0.5
SLACK = 8                    # net words inserted or dropped inside a copy
BROADCAST_ROWS = 1_000_000   # 40 bytes each
# Units that may follow a number.
UNITS = ("km|m|cm|mm|mi|ft|kg|g|mg|lb|lbs|oz|l|ml|s|sec|min|h|hr|hrs|hours?|days?|weeks?|months?|"
         "years?|minutes?|seconds?|meters?|metres?|miles?|feet|inch|inches|dollars?|euros?|cents?|"
         "pounds?|percent|degrees?|kmh|mph|usd|eur|gb|mb|kb")

NUMBER = r"(?<![\p{L}\p{N}])[$€£]?\p{N}+(?:[.,:/]\p{N}+)*+[%°]?"
# Words that sentences begin with; capitalised, they are no names.
COMMON = ("A|About|After|All|Also|Although|An|And|Another|Any|Are|As|At|Based|Because|Before|Both|But|"
          "By|Calculate|Can|Compute|Consider|Could|Determine|Did|Do|Does|During|Each|Every|Explain|"
          "Find|First|For|From|Given|Had|Has|Have|He|Her|Here|His|How|However|I|If|In|Is|It|Its|Last|"
          "Let|Many|More|Most|My|Next|No|Not|Now|Of|On|Once|One|Only|Or|Other|Our|She|Should|Since|"
          "So|Some|Such|Suppose|Than|That|The|Their|Then|There|These|They|This|Those|Three|Through|"
          "Thus|To|Today|Together|Two|Under|Until|Was|We|Were|What|When|Where|Which|While|Who|Whose|"
          "Why|Will|With|Without|Would|Yes|You|Your")
_CAPITAL = rf"(?=\p{{Lu}})(?!(?:{COMMON})(?![\p{{L}}\p{{N}}'’-]))\p{{Lu}}[\p{{Ll}}'’-]++"
NAME = rf"(?<![^ \"“‘(\[]){_CAPITAL}(?: {_CAPITAL})*+"


def _marked(text: Column) -> Column:
    """The text with slots written as one token: type, ``\\u0001``, value
    without blanks."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s\x01]+", " ")
    has_digit = flat.rlike(r"\p{N}")
    names = F.regexp_replace(flat, f"({NAME})", " name\u0001$1\u0002")
    numbers = F.when(has_digit, F.regexp_replace(
        F.regexp_replace(names, f"({NUMBER})", " num\u0001$1 "),
        rf"(num\x01[^ ]+ ?) +(?i:({UNITS}))(?![\p{{L}}\p{{N}}])", "$1 unit\u0001$2 ")).otherwise(names)
    return numbers


def _tokens(marked: Column) -> Column:
    """Template tokens of a marked text with their values: ``word`` or
    ``type\\u0001value``.  A name of several words is glued into one token
    before splitting."""
    glued = F.when(F.contains(marked, F.lit("\u0002")), F.array_join(F.transform(
        F.split(marked, "\u0002"),
        lambda part: F.when(F.contains(part, F.lit("name\u0001")), F.concat(
            F.substring_index(part, "name\u0001", 1), F.lit("name\u0001"),
            F.translate(F.substring_index(part, "name\u0001", -1), " ", "_")))
        .otherwise(part)), " ")).otherwise(marked)
    return F.filter(F.split(F.lower(glued), r"[^\p{L}\p{N}\x01_.,:/$€£%°'’-]+|[.,:'’-]+(?= |$)"),
                    lambda t: t != "")


def windows(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """``keys, at, window, head, tail``: the template windows of each row and
    the value hashes of their first and last token (0: not a slot).  A text
    of fewer tokens is one window; none has no window."""
    # columns of their own: what lambdas name would be computed for each mention
    tokens = rows.select(*keys, _marked(col(text)).alias("marked")).select(
        *keys, _tokens(F.col("marked")).alias("t"))
    parts = tokens.select(
        *keys,
        F.transform("t", lambda t: F.xxhash64(F.substring_index(t, "\u0001", 1))).alias("h"),
        F.transform("t", lambda t: F.when(F.contains(t, F.lit("\u0001")), F.xxhash64(t))
                    .otherwise(F.lit(0).cast("long"))).alias("v"))
    last = F.size("h") - WINDOW
    starts = F.when(F.size("h") == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))))

    def window(i: Column) -> Column:
        end = F.least(i + WINDOW, F.size("h")) - 1
        return F.struct(i.alias("at"),
                        F.xxhash64(*(F.get("h", i + k) for k in range(WINDOW))).alias("window"),
                        F.get("v", i).alias("head"), F.get("v", end).alias("tail"))

    return parts.select(*keys, F.inline(F.transform(starts, window)))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", rid: str = "rid",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``rid, item, coverage``: every document and the items whose template
    it holds with consistent slots.  Items without a token match nothing; a
    NULL item id is an item like any other; repeated items are one."""
    variants = benchmark.select(col(item).alias("item"), col(item_text).alias("body")) \
        .dropDuplicates().withColumn("variant", F.xxhash64("item", "body"))
    items = materialise(windows(variants, "body", ["variant", "item"]))
    sizes = items.groupBy("variant").agg(F.count("*").alias("size"))
    probe = items.select("variant", "item", F.col("at").alias("item_at"), "window",
                         F.col("head").alias("item_head"), F.col("tail").alias("item_tail"))
    n = items.count()
    hits = materialise(
        windows(docs.select(col(rid).alias("rid"), col(text).alias("text")), "text", ["rid"])
        .join(maybe_broadcast(probe, n, BROADCAST_ROWS), "window")
        .select("rid", "variant", "item", (F.col("at") - F.col("item_at")).alias("diagonal"),
                "item_at", "head", "tail", "item_head", "item_tail"))
    aligned = _placed(hits)
    on = ["rid", "variant", "kind", "place"]
    runs = (aligned.groupBy(*on, "item").agg(F.count("*").alias("shared"))
            .join(maybe_broadcast(sizes, n, BROADCAST_ROWS), "variant")
            .where(F.col("shared") >= F.col("size") * COVERAGE))
    runs = materialise(runs)
    both = aligned.join(runs.select(*on), on)
    slots = (both.select(*on, F.col("item_head").alias("old"), F.col("head").alias("new"))
             .unionByName(both.select(*on, F.col("item_tail").alias("old"),
                                      F.col("tail").alias("new")))
             .where("old <> 0").distinct())
    torn = (slots.groupBy(*on, "old").agg(F.count("*").alias("n")).where("n > 1")
            .select(*on).distinct())
    return (runs.join(torn, on, "left_anti")
            .groupBy("rid", "item").agg(F.max(F.col("shared") / F.col("size")).alias("coverage")))


def _placed(hits: DataFrame) -> DataFrame:
    """``hits`` with ``kind, place``: every hit in its diagonal (kind 0) and,
    where several diagonals fall together, in the two overlapping stretches of
    ``2 * SLACK`` diagonals that hold it (kind 1), so that any diagonals up to
    ``SLACK`` apart share a stretch.  There an item window has one hit."""
    same = ["rid", "variant", "item"]
    alone = hits.withColumn("kind", F.lit(0)).withColumn("place", F.col("diagonal").cast("long"))
    diagonals = hits.groupBy(*same, "diagonal").agg(F.count("*").alias("n"))
    step = F.floor(F.col("diagonal") / SLACK)
    stretches = diagonals.select(*same, "diagonal", "n",
                                 F.explode(F.array(step, step - 1)).alias("place"))
    # a stretch of one diagonal says no more than the diagonal
    mixed = (stretches.groupBy("rid", "variant", "place").agg(F.count("*").alias("m"))
             .where("m > 1").drop("m"))
    wide = stretches.join(mixed, ["rid", "variant", "place"])
    values = ["head", "tail", "item_head", "item_tail", "diagonal"]
    best = (hits.join(wide.drop("item"), ["rid", "variant", "diagonal"])
            .groupBy(*same, "place", "item_at")
            .agg(F.max_by(F.struct(*values), F.struct("n", "diagonal")).alias("x")))
    return alone.unionByName(best.select(*same, *(f"x.{v}" for v in values), "item_at",
                                         F.lit(1).alias("kind"), "place"))


def flag_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                      item: str = "item_id") -> DataFrame:
    """``docs`` (a stored table) with ``contaminated``, ``n_items``,
    ``items`` (ids, sorted, comma-joined) and ``coverage`` (largest); names
    that ``docs`` has get a suffix.  NULL and empty texts are clean; every
    row stays, repeated rows too."""
    rid, c_flag, c_n, c_items, c_cov = fresh(docs, "rid", "contaminated", "n_items", "items",
                                             "coverage")
    numbered = with_row_id(docs, rid)
    found = contamination(numbered.select(col(rid), col(text)), benchmark, text, rid, item)
    per_doc = found.groupBy(F.col("rid").alias(rid)).agg(
        F.array_sort(F.collect_set(F.coalesce(F.col("item"), F.lit(-1)))).alias(c_items),
        F.max("coverage").alias(c_cov))
    joined = numbered.join(per_doc, rid, "left")
    return joined.select(
        *(col(c) for c in docs.columns), col(c_cov).isNotNull().alias(c_flag),
        F.coalesce(F.size(col(c_items)), F.lit(0)).cast("long").alias(c_n),
        F.coalesce(F.array_join(col(c_items).cast("array<string>"), ","), F.lit("")).alias(c_items),
        F.coalesce(col(c_cov), F.lit(0.0)).alias(c_cov))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                        item: str = "item_id") -> DataFrame:
    """The rows of ``docs`` (a stored table) that hold no benchmark item."""
    rid, = fresh(docs, "rid")
    numbered = with_row_id(docs, rid)
    found = contamination(numbered.select(col(rid), col(text)), benchmark, text, rid, item)
    return numbered.join(found.select(F.col("rid").alias(rid)).distinct(), rid, "left_anti").select(
        *(col(c) for c in docs.columns))
