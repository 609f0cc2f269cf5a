"""URL filter by association rules (operator 3).

A list of written rules (host, path prefix, verdict) judges the URLs it fits. Their verdicts are the
labels from which FP-growth mines combinations of URL tokens; rules with enough support and
confidence, less those with a shorter rule that says the same as surely, judge the other URLs: each rule
is indexed under its rarest token, meets the URLs that have this token, and fits if all its tokens
are there. The surest fitting rule decides; where none fits, the verdict is ``DEFAULT``.

All work is done once per distinct (host, path).

Defined cases: null, empty and malformed URLs (without ``://``) have an empty host and path, no rule
and the default verdict; without any labelled URL nothing is mined; repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii, text_or_empty

DEFAULT = "allow"
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str                     # host and path prefix, such as example.com/en/

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


# The written rules.
RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
         Rule("block", "net/es/"), Rule("block", "net/fr/"))


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(text_or_empty(url), r"(?s)://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), r"(?s)://[^/?#]*([^?#]*)", 1)


def tokens(host_col: Column, path_col: Column) -> Column:
    """Distinct tokens: host suffixes by depth, and path segments, whole numbers as one token."""
    labels = F.filter(F.split(host_col, r"\."), lambda x: x != "")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.concat(
        F.lit("h:"), F.array_join(F.slice(labels, F.greatest(F.size(labels) - i + 1, F.lit(1)), i), ".")))
    parts = F.filter(F.split(path_col, "/"), lambda x: x != "")
    segments = F.transform(parts, lambda x, i: F.concat(
        F.lit("p"), i.cast("string"), F.lit(":"),
        F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(x)))
    return F.array_distinct(F.concat(F.when(host_col == "", F.array().cast("array<string>")).otherwise(suffixes),
                                     segments))


def written(urls: DataFrame, rules=RULES) -> DataFrame:
    """``urls`` (host, path) with the text and verdict of the longest rule that fits (or nulls).

    Rules and URLs meet on (host suffix, path up to a slash): as many keys as a URL has labels times
    path segments; the rest of a rule's path is compared afterwards.
    """
    spark = urls.sparkSession
    list_ = spark.createDataFrame(
        [(r.host, r.path[:r.path.rindex("/") + 1], r.path, r.text, r.verdict) for r in rules],
        "rule_host string, stem string, rule_path string, rule string, verdict string")
    labels, parts = F.split("host", r"\."), F.split("path", "/")
    keys = urls.filter("host <> ''").select(
        "host", "path",
        F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
            F.slice(labels, i, F.size(labels)), "."))).alias("rule_host")) \
        .withColumn("stem", F.explode(F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
            lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))))
    fits = keys.join(list_, ["rule_host", "stem"]).filter(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        F.char_length("rule").alias("size"), "rule", "verdict")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(
        *urls.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def mine(scratch: Scratch, labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (antecedent, verdict, confidence, support) from ``labelled`` (tokens, verdict, weight)."""
    kind = "antecedent array<string>, verdict string, confidence double, support double"
    if labelled.isEmpty():
        return scratch.spark.createDataFrame([], kind)
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("verdict:"), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.filter(F.col("consequent")[0].startswith("verdict:")) \
        .filter(F.forall("antecedent", lambda t: ~t.startswith("verdict:"))) \
        .select(F.array_sort("antecedent").alias("antecedent"),
                F.substring(F.col("consequent")[0], 9, 99).alias("verdict"), "confidence", "support")
    rules = scratch.table(rules, "mined")
    # a longer rule is needless if a rule within it says the same at least as surely: they meet on the
    # rule without one of its tokens
    part = rules.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("t")) \
        .select("antecedent", "verdict", "confidence", F.array_remove("antecedent", F.col("t")).alias("inner"))
    inner = rules.select(F.col("antecedent").alias("inner"), "verdict", F.col("confidence").alias("inner_confidence"))
    needless = part.join(inner, ["inner", "verdict"]).filter("inner_confidence >= confidence") \
        .select("antecedent", "verdict").distinct()
    return scratch.table(rules.join(needless, ["antecedent", "verdict"], "left_anti"), "pruned")


def match(scratch: Scratch, urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path, tokens) with the verdict of the surest mined rule that fits."""
    words = urls.select("host", "path", F.explode("tokens").alias("token"))
    known = rules.select(F.explode("antecedent").alias("token")).distinct()
    counts = words.groupBy("token").agg(F.count("*").alias("n")).join(known, "token")
    rarest = rules.withColumn("token", F.explode("antecedent")).join(counts, "token") \
        .groupBy("antecedent", "verdict", "confidence", "support") \
        .agg(F.min(F.struct("n", "token")).alias("m")) \
        .select("antecedent", "verdict", "confidence", "support", F.col("m.token").alias("token"))
    index = scratch.table(rarest, "index")
    hits = urls.withColumn("token", F.explode("tokens")).join(index, "token") \
        .filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    return hits.groupBy("host", "path").agg(F.max(F.struct(
        "confidence", "support", "verdict", "antecedent")).alias("m")) \
        .select("host", "path", "m.verdict", F.col("m.antecedent").alias("antecedent"))


def judge(scratch: Scratch, pages: DataFrame, id_col: Column, url_col: Column, rules=RULES,
          default: str = DEFAULT, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and mined (the tokens of the mined rule, if one decided)."""
    src = scratch.table(pages.select(id_col.alias("page_id"), host(url_col).alias("host"),
                                     path(url_col).alias("path")), "urls")
    kinds = src.groupBy("host", "path").agg(F.lit(1).alias("one")).drop("one") \
        .withColumn("tokens", tokens(F.col("host"), F.col("path")))
    known = scratch.table(written(kinds, rules), "written")
    found = mine(scratch, known.filter("verdict IS NOT NULL AND size(tokens) > 0"), min_support, min_confidence)
    extra = match(scratch, known.filter("verdict IS NULL").select("host", "path", "tokens"), found)
    verdicts = known.select("host", "path", "rule", "verdict").join(
        extra.select("host", "path", F.col("verdict").alias("method"), F.col("antecedent").alias("mined")),
        ["host", "path"], "left") \
        .select("host", "path", "rule", F.coalesce("verdict", "method", F.lit(default)).alias("verdict"), "mined")
    return src.join(verdicts, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "mined")
