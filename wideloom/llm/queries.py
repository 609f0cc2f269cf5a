"""Registered queries of the operators (one each) and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, language_model, mixing, negatives, packing, pii, quality, runs, simhash, sketches, toxicity, url_rules, warc
from .common import SPACE, Scratch, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts and digests of the base spans, and all spans."""
    found = pii.find_pii(_documents(spark, sf_dir), F.col("doc_id"), F.col("text"))
    base = F.concat(*[F.col(k) for k in pii.BASE])
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.digest(base), 256).alias("base_sha256"),
        pii.digest(F.concat(base, F.col("added"))).alias("spans"))


@register("op2_exact_dedup", """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts and the row that stays."""
    return exact_dedup.exact_dedup(Scratch(spark, "op2"), _documents(spark, sf_dir), F.col("doc_id"),
                                   F.col("text")).drop("row")


@register("op4_source_mix")
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs, _ = mixing.mix(Scratch(spark, "op4"), _documents(spark, sf_dir), F.col("doc_id"),
                         F.col("source"), F.col("text"))
    return docs.select("doc_id", "size", "source_size", "target", "taken")


@register("op10_sketches")
def op10_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every text and its edited form, and their likenesses."""
    out = sketches.fingerprints(_documents(spark, sf_dir), F.col("doc_id"), F.col("text"))
    return out.select("doc_id", "n_chars", "edited_sha256",
                      sketches.as_text(F.col("sketch")).alias("fingerprint"),
                      sketches.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                      "near_edited", "near_next")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    parts = packing.pieces(_documents(spark, sf_dir), F.col("doc_id"), F.col("text"), tokenizer_path())
    return packing.pack(Scratch(spark, "op7"), parts)


@register("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and the smallest document reachable by links."""
    found = simhash.near_duplicates(Scratch(spark, "op8"), _documents(spark, sf_dir), F.col("doc_id"),
                                    F.col("text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def _judged(scores: DataFrame, least: float) -> DataFrame:
    return scores.select("doc_id", _held_out().alias("held_out"), "score",
                         (F.col("score") >= least).cast("int").alias("predicted"))


@register("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, F.col("doc_id"), F.col("text"), labels, F.col("quality"))
    return _judged(quality.scored(docs, F.col("doc_id"), F.col("text"), model), 0.5)


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every restored text."""
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, F.col("doc_id"), F.col("text"), labels, F.col("toxic"))
    return _judged(quality.scored(docs, F.col("doc_id"), F.col("text"), model), 0.7)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@register("op3_url_rules")
def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every URL: of the longest written rule, else of the mined rules."""
    return url_rules.judge(Scratch(spark, "op3"), _pages(spark, sf_dir), F.col("page_id"), F.col("url")).drop("mined")


@register("op6_warc", """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
""")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the archives written from all pages, as read back."""
    return warc.archive(Scratch(spark, "op6"), _pages(spark, sf_dir), F.col("page_id"), F.col("url"), F.col("html"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: where crc32(doc_id) % 10 is 0, the words from a on go round a period."""
    w = F.filter(F.split(text_or_empty("text"), SPACE + "+"), lambda x: x != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("g", F.floor(F.col("h") / 10))
    w = F.when(F.col("h") % 10 == 0, w)                           # null elsewhere: only these texts are split
    rows = rows.withColumn("w", w).withColumn("n", F.size("w"))
    a = F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int")
    rows = rows.withColumn("a", a).withColumn(
        "p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    planted = F.concat(F.slice("w", 1, F.col("a")), F.transform(
        F.sequence(F.lit(0), F.col("n") - F.col("a") - 1),
        lambda i: F.get("w", F.col("a") + i % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " "))
                       .otherwise(F.col("text")).alias("text"))


@register("op13_periodic_runs", """
WITH RECURSIVE t AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS row, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
  FROM documents),
n AS (SELECT *, len(w)::BIGINT AS n, h // 10 AS g FROM t),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM n),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
words AS (
  SELECT row, n, i, CASE WHEN i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM p)),
four AS (
  SELECT row, n, i, word || ' ' || lead(word) OVER r || ' ' || lead(word, 2) OVER r || ' ' || lead(word, 3) OVER r AS k
  FROM words WINDOW r AS (PARTITION BY row ORDER BY i)),
pairs AS (
  SELECT x.row, x.i, y.i - x.i AS q
  FROM four x JOIN four y ON x.row = y.row AND x.k = y.k AND y.i > x.i AND (y.i - x.i) * 4 <= x.n),
islands AS (
  SELECT row, q, min(i) AS s, max(i) + 4 + q AS e
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS z FROM pairs) GROUP BY row, q, z),
runs AS (
  SELECT row, q, s, e - s AS size FROM islands x
  WHERE e - s >= greatest(6, 4 * q) AND NOT EXISTS (
    SELECT 1 FROM islands y WHERE y.row = x.row AND y.q < x.q AND x.q % y.q = 0 AND y.s <= x.s AND y.e >= x.e)),
per AS (
  SELECT row, count(*) AS n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
         min([-size, s, q]) AS best
  FROM runs GROUP BY row),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM words x
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.row = x.row AND x.i >= r.s + r.q AND x.i < r.s + r.size)
  GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[2]::BIGINT AS start, (-best[1])::BIGINT AS length, best[3]::BIGINT AS period,
       (1000 * -best[1] // best[3])::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(text, '')) AS collapsed_sha256
FROM t LEFT JOIN per USING (row) LEFT JOIN kept USING (row)
""")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, its longest run, and a digest of the text without what runs repeat."""
    found = runs.find_runs(Scratch(spark, "op13"), _with_planted_runs(_documents(spark, sf_dir)),
                           F.col("doc_id"), F.col("text"))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                              r["period"].cast("string")), F.lit("\n")))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return found.withColumn("best", best).select(
        "doc_id", F.coalesce(F.size("runs"), F.lit(0)).cast("bigint").alias("n_runs"), "best.start",
        (-F.col("best.less")).alias("length"), "best.period",
        F.floor(F.lit(-1000) * F.col("best.less") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.coalesce(F.array_join(line, ""), F.lit("")), 256).alias("runs_sha256"),
        F.coalesce(F.sha2("collapsed", 256), F.col("words_sha256")).alias("collapsed_sha256"))


@register("op11_hard_negatives", """
WITH e AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.row AS a, a.vec_id AS anchor_id, c.row AS c, c.vec_id, a.label = c.label AS same,
         list_dot_product(a.v, c.v)::BIGINT AS score
  FROM e a JOIN e c ON a.vec_id % 50 = 0 AND a.row <> c.row),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, c) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.vec_id, s.c)::INTEGER AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT * FROM n WHERE rank <= 3
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hardest rows of other labels for every anchor and positive."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(Scratch(spark, "op11"), rows, F.col("vec_id"), label, F.transform(
        "embedding", lambda x: 256 * x.cast("double")), F.col("vec_id") % 50 == 0)


@register("op12_maxent_lm")
def op12_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add-one unigram score and maximum-entropy score of every text."""
    docs, scratch = _documents(spark, sf_dir), Scratch(spark, "op12")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    counts, model = language_model.train(scratch, docs, F.col("text"), ~held_out)
    found = language_model.scored(scratch, docs, F.col("doc_id"), F.col("text"), counts, model)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
