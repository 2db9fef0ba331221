"""One registered query per corpus operator, over whole tables.

``ORACLES`` holds DuckDB SQL where SQL can express the query; the others are
compared with brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import (
    decontamination,
    hard_negatives,
    language_id,
    licenses,
    line_dedup,
    merkle,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    sharding,
    simhash_dedup,
)
from cadence.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


@register("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.flag_contaminated(
        _documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.drop("text")


@register("op2_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_documents(spark, sf_dir, "doc_id", "text"),
                                  counts=("n_lines", "n_removed"))


@register("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text", "lang")
    model = language_id.train(docs)
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@register("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_documents(spark, sf_dir, "doc_id", "text")).withColumn(
        "grown_shard", F.lit(None).cast("int"))


@register("op5_simhash_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(_documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@register("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(_documents(spark, sf_dir, "doc_id", "text"))


@register("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(_documents(spark, sf_dir, "doc_id", "text"),
                        public_tokenizers.path("word_bpe_49k.json"))


@register("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir, "doc_id", "text")).drop("detections")


@register("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(_documents(spark, sf_dir, "doc_id", "text", "source"))


@register("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_documents(spark, sf_dir, "doc_id", "text")))


# CRC-32 of a byte list, bit by bit, with the polynomial of the standard.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {digits}),
   lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
     lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)))"""
_DIGITS = "list_transform(str_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"


def _merkle_sql() -> str:
    def part(value: str) -> str:
        text = f"CAST({value} AS VARCHAR)"
        return f"COALESCE(strlen({text}) || ':' || {text}, '-')"

    def leaf(n_chars: str) -> str:
        return ("sha256(" + " || ".join(part(c) for c in (
            "doc_id", "source", "lang", n_chars, "text")) + ")")

    return f"""
WITH RECURSIVE hit AS (
  SELECT *, {_CRC32.format(digits=_DIGITS)} % 7 = 0 AS bent FROM documents
),
leaves AS (
  SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
         CASE WHEN bent THEN {leaf("n_chars + 1")} ELSE {leaf("n_chars")} END AS claimed,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
         dense_rank() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS t,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hit
),
low AS (
  SELECT t, 0 AS lvl, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT t, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low
  WHERE n > 1 GROUP BY t, lvl, i // 2, n
),
subroots AS (SELECT t, h, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lvl, t AS i, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM high
  WHERE n > 1 GROUP BY lvl, i // 2, n
),
steps AS (
  SELECT doc_id, 0 AS tier, low.lvl, (leaves.i >> low.lvl) & 1 AS odd, s.h
  FROM leaves JOIN low ON low.t = leaves.t AND low.n > 1 AND low.i = leaves.i >> low.lvl
  LEFT JOIN low s ON s.t = low.t AND s.lvl = low.lvl AND s.i = xor(low.i, 1)
  UNION ALL
  SELECT doc_id, 1, high.lvl, (leaves.t >> high.lvl) & 1, s.h
  FROM leaves JOIN high ON high.n > 1 AND high.i = leaves.t >> high.lvl
  LEFT JOIN high s ON s.lvl = high.lvl AND s.i = xor(high.i, 1)
),
path AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tier, lvl) AS k FROM steps
),
proof AS (
  SELECT doc_id, sha256(COALESCE(string_agg(h, '' ORDER BY k), '')) AS proof_sha256
  FROM path GROUP BY doc_id
),
folded AS (
  SELECT doc_id, 0 AS k, claimed AS h FROM leaves
  UNION ALL
  SELECT f.doc_id, f.k + 1, sha256(CASE WHEN p.h IS NULL THEN f.h WHEN p.odd = 1
                                   THEN p.h || f.h ELSE f.h || p.h END)
  FROM folded f JOIN path p ON p.doc_id = f.doc_id AND p.k = f.k + 1
),
ends AS (SELECT doc_id, arg_max(h, k) AS folded_root FROM folded GROUP BY doc_id)
SELECT leaves.doc_id, leaf, subroots.h AS subroot, root.h AS root,
       COALESCE(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root.h AS verified
FROM leaves JOIN subroots USING (t) JOIN ends USING (doc_id) LEFT JOIN proof USING (doc_id),
     (SELECT h FROM high WHERE n = 1) root"""


@register("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, merkle.tampered(docs))


def _mixing_sql(packet: int = mixing.PACKET) -> str:
    return f"""
WITH docs AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
),
sources AS (
  SELECT source, sum(size) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS w
  FROM docs GROUP BY source
),
-- sources by how soon they reach three times their size; the first k stop there
ranked AS (
  SELECT *, 3 * source_size AS cap,
         row_number() OVER (ORDER BY 3.0 * source_size / w, source) AS k FROM sources
),
shares AS (
  SELECT k, sum(source_size) OVER () - (sum(cap) OVER (ORDER BY k) - cap) AS rest,
         sum(w) OVER () - (sum(w) OVER (ORDER BY k) - w) AS free, w, cap
  FROM ranked
),
level AS (
  SELECT rest, free FROM shares WHERE CAST(w * rest AS HUGEINT) <= CAST(cap * free AS HUGEINT)
  ORDER BY k LIMIT 1
),
targets AS (
  SELECT source, source_size, least(CAST(w * rest AS DOUBLE) / free, CAST(cap AS DOUBLE)) AS target
  FROM ranked, level
),
queue AS (
  SELECT doc_id, size, target, source_size,
         sum(size) OVER (PARTITION BY docs.source
                         ORDER BY md5('mix:' || COALESCE(CAST(doc_id AS VARCHAR), '-')), doc_id)
           - size AS before
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
  WHERE size > 0 AND target > 0
),
packets AS (
  SELECT doc_id, epoch, lo, least({packet}, size - lo) AS words,
         CAST(epoch * source_size + before + lo + least({packet}, size - lo) AS DOUBLE) / target
           AS finish
  FROM (SELECT *, unnest(range(0, size, {packet})) AS lo
        FROM (SELECT *, unnest([0, 1, 2]) AS epoch FROM queue))
),
spent AS (
  SELECT *, sum(words) OVER (ORDER BY finish, doc_id, epoch, lo ROWS UNBOUNDED PRECEDING) AS upto
  FROM packets
),
taken AS (
  SELECT doc_id, sum(least(words, budget - (upto - words))) AS taken, min(finish) AS first_finish
  FROM spent, (SELECT sum(size) AS budget FROM docs) WHERE upto - words < budget GROUP BY doc_id
)
SELECT docs.doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(COALESCE(taken, 0) AS BIGINT) AS taken, first_finish
FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
LEFT JOIN taken USING (doc_id)"""


@register("op12_source_mixing", _mixing_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir, "doc_id", "text", "source"))


@register("op13_hard_negatives", """
WITH vectors AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id
                               ORDER BY score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0,
                               relabel=(7, 1, 10))
