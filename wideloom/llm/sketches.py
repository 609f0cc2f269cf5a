"""Document fingerprints by a threshold-scaled sketch (operator 10).

A text's sketch holds every distinct hash of its five-word shingles that lies below a fixed fraction
of the hash range, and the smallest hash (so that a short text has one). Sketches of unions are
unions of sketches cut at the same threshold, and containment can be estimated between texts of very
different length, because the kept share does not depend on the length.

Words are lower-cased (A-Z) runs of ``[^\\x20\\x09-\\x0D]``; fewer than five words make one shingle.

Defined cases: null and empty texts have an empty sketch (fingerprint ""); two empty sketches are
alike 1.0, an empty and another one 0.0. Rows with one id and one text are one document and get the
same result (rows with one id and different texts are in the order of a hash of the text); null ids come
last in the order of documents. A single document is its own next one; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, lower_ascii, shuffle_partitions, text_or_empty

SHINGLE_WORDS = 5
SCALE = 4                                  # one hash of SCALE is kept
MAX_RANGES = 1 << 14                       # ranges of ids, whose bounds are sent with the plan


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text_or_empty(text)), SPACE + "+"), lambda w: w != "")


def with_sketch(df: DataFrame, text: str, out: str, shingle_words: int = SHINGLE_WORDS,
                scale: int = SCALE) -> DataFrame:
    """``df`` with the sorted hashes (signed longs, all in [0, 2^63 / scale) but for the smallest one)
    of its column ``text``. Two projections, so that the words are split once for each text."""
    kept, w = F.col(f"{out}_h"), F.col(f"{out}_w")
    at = F.sequence(F.lit(0), F.greatest(F.size(w) - shingle_words, F.lit(0)))
    one = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle_words)])
                      .bitwiseAND(F.lit((1 << 63) - 1)))
    low = F.array_sort(F.array_distinct(F.filter(kept, lambda h: h < F.lit((1 << 63) // scale))))
    return (df.withColumn(f"{out}_w", words(F.col(text)))
            .withColumn(f"{out}_h", F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(one))
            .withColumn(out, F.when((F.size(low) == 0) & (F.size(kept) > 0),
                                    F.array(F.array_min(kept))).otherwise(low))
            .drop(f"{out}_w", f"{out}_h"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard estimate of two sketches."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Share of a's sketch that b has: how much of a document is inside another, longer one."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ",")


def _bounds(keys: DataFrame, ranges: int) -> list[str]:
    """The first key of each of about ``ranges`` ranges of the distinct ``keys`` (none, id, hash), in
    order, as JSON: one row per range reaches the driver."""
    ordered = keys.repartitionByRange(ranges, "none", "id", "hash")
    least = ordered.groupBy(F.spark_partition_id()).agg(F.min(F.struct("none", "id", "hash")).alias("m"))
    return [r.j for r in least.orderBy("m").select(F.to_json("m").alias("j")).collect()]


def _range_of(key: Column, bounds: Column, n: int) -> Column:
    """Number of the last of ``n`` ordered bounds that is not over ``key``, by halving."""
    steps = max(n - 1, 1).bit_length()
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(steps - 1)), F.struct(F.lit(0).alias("low"), F.lit(n - 1).alias("high")),
        lambda s, _: F.when(
            F.element_at(bounds, F.floor((s["low"] + s["high"] + 1) / 2).cast("int") + 1) <= key,
            F.struct(F.floor((s["low"] + s["high"] + 1) / 2).cast("int").alias("low"), s["high"].alias("high")))
        .otherwise(F.struct(s["low"].alias("low"), F.greatest(
            F.floor((s["low"] + s["high"] + 1) / 2).cast("int") - 1, s["low"]).alias("high"))),
        lambda s: s["low"])


def next_documents(docs: DataFrame, id_col: Column, text_col: Column, **sketch) -> DataFrame:
    """Every document beside the start of the next one (ascending id; after the last the first):
    doc_id, text, n, sketch, next_start (its first floor(n / 4) code points), next_sketch.

    A text is shuffled once, to the range of ids it lies in; the first text of each range goes to the range
    before as well, where it stands behind the last one. Next documents are then neighbours in the sorted
    range, so no text is joined. Repeated rows are one row with a count on the way.
    """
    src = docs.select(id_col.alias("id"), text_or_empty(text_col).alias("text"))
    src = src.withColumn("none", F.col("id").isNull()).withColumn("hash", F.xxhash64("text"))
    same = src.groupBy("none", "id", "hash").agg(F.count("*").alias("rows"))
    spark = docs.sparkSession
    bounds = _bounds(same, min(8 * shuffle_partitions(spark), MAX_RANGES))
    if same.agg(F.max("rows")).first()[0] not in (None, 1):
        src = src.groupBy("none", "id", "hash").agg(F.first("text").alias("text"), F.count("*").cast("int").alias("rows"))
    else:
        src = src.withColumn("rows", F.lit(1))
    n = max(len(bounds), 1)
    kind = f"array<struct<none:boolean,id:{src.schema['id'].dataType.simpleString()},hash:bigint>>"
    first = F.from_json(F.lit("[" + ",".join(bounds) + "]"), kind)               # folded to a constant
    key, at = F.struct("none", "id", "hash"), _range_of(F.struct("none", "id", "hash"), first, n)
    src = src.withColumn("at", at if bounds else F.lit(0))
    opens = key.eqNullSafe(F.element_at(first, F.col("at") + 1)) if bounds else F.lit(False)
    own = F.struct(F.col("at"), F.lit(False).alias("after"))
    before = F.struct(((F.col("at") + n - 1) % n).alias("at"), F.lit(True).alias("after"))
    src = src.withColumn("place", F.explode(F.when(opens, F.array(own, before)).otherwise(F.array(own))))
    src = src.withColumn("at", F.col("place.at")).withColumn("after", F.col("place.after")).drop("place").repartition("at")
    line = Window.partitionBy("at").orderBy("after", "none", "id", "hash")
    full = with_sketch(src.withColumn("n", F.char_length("text")), "text", "sketch", **sketch)
    full = full.select("*", F.lead("text").over(line).alias("next_text"), F.lead("sketch").over(line).alias("next_sketch"))
    return full.filter(~F.col("after")).select(
        F.col("id").alias("doc_id"), "text", "n", "sketch", F.expr("substring(next_text, 1, cast(floor(n / 4) as int))").alias("next_start"),
        "next_sketch", "rows")


def fingerprints(docs: DataFrame, id_col: Column, text_col: Column, **sketch) -> DataFrame:
    """Per document: the sketch, that of the text with its last quarter replaced by the start of the
    next document, and the likenesses of the document's sketch to that one and to the next one's."""
    pairs = next_documents(docs, id_col, text_col, **sketch)
    cut = F.floor(F.col("n") / 4)
    edited = F.concat(F.expr("substring(text, 1, n - cast(floor(n / 4) as int))"), F.col("next_start"))
    both = with_sketch(pairs.withColumn("edited", F.when(cut > 0, edited).otherwise(F.col("text"))),
                       "edited", "edited_sketch", **sketch)
    out = both.select(
        "doc_id", F.col("n").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"), "sketch", "edited_sketch", "next_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"), "rows")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("rows"))).alias("copy")
    return out.select("*", copies).drop("rows", "copy")
