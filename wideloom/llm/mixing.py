"""Mixing sources to target weights by a low-discrepancy schedule (operator 4).

Every source's documents are shuffled by a hash and read as one stream of words, cut into blocks
of (nearly) equal size. Slot k of the mix maps the golden-ratio point frac((k + 1/2) * phi) through
the cumulative weights of the sources; the slots of a source are ranked, and the j-th one takes its
block j modulo its number of blocks. No stream is read more than ``max_epochs`` times.

Prefix sums and ranks run in two levels (hash buckets or slot chunks first, rows inside them second),
so a source that holds a third of everything is split over many tasks.

Defined cases: a null source is a source of its own and comes last; null text has size 0; empty
texts are taken 0 times; repeated rows are separate documents; without any word nothing is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch, global_order, text_or_empty

WEIGHTS = (3, 1, 2)          # repeating over the sources in code point order
SHARE = 1.5                  # words of the mix per word of the corpus
MAX_EPOCHS = 2               # times a source may be read
BLOCK_WORDS = 64
BUCKET_ROWS = 4096           # documents of a source that are ordered together, about
CHUNK = 1 << 16              # slots that are ranked together
GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text_or_empty(text), F.lit(WORD), F.lit(0))).cast("bigint")


def targets(scratch: Scratch, sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) with weight and target. Sources over ``max_epochs`` times their size are
    held there and the excess is shared again by weight, until none is above.

    Each round is one small aggregate over the source table; the sources held so far follow from
    the level alone (target per weight), which only rises.
    """
    src = global_order(scratch, sizes, [F.col("source").isNull(), F.col("source")], "sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("at") % len(weights) + 1).cast("int"))
    src = scratch.table(src.select("source", "source_size", w.alias("weight"),
                                   (F.col("source_size") * float(max_epochs)).alias("most")), "weights")
    budget = src.agg(F.sum("source_size")).first()[0]
    budget, level = float(budget or 0) * share, 0.0
    while True:
        held = F.col("weight") * F.lit(level) >= F.col("most")
        fixed, free = src.agg(F.sum(F.when(held, F.col("most"))), F.sum(F.when(~held, F.col("weight")))).first()
        now = (budget - (fixed or 0.0)) / free if free else level
        if not free or now <= level:
            break
        level = now
    return src.withColumn("target", F.least("most", F.col("weight") * F.lit(level)))


def mix(scratch: Scratch, docs: DataFrame, id_col: Column, source_col: Column, text_col: Column,
        row: Column | None = None, block_words: int = BLOCK_WORDS, seed: int = 42,
        **plan) -> tuple[DataFrame, DataFrame]:
    """(documents, schedule). documents: row, doc_id, source, size, source_size, target, taken.
    schedule: slot, row, doc_id, start, length: the words of the document that this slot takes."""
    meta = scratch.table(docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"), id_col.alias("doc_id"),
        source_col.alias("source"), word_count(text_col).alias("size")), "sizes")
    tgt = targets(scratch, meta.groupBy("source").agg(F.sum("size").alias("source_size")), **plan)
    most = int(plan.get("max_epochs", MAX_EPOCHS))
    blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    src = tgt.withColumn("blocks", blocks).withColumn(
        "quota", F.when(F.col("source_size") > 0,
                        F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    # cumulative quotas over the sources in order; one row per source
    src = global_order(scratch, src, [F.col("source").isNull(), F.col("source")], "quotas")
    src = src.withColumnRenamed("at", "sid")
    chunk = F.floor(F.col("sid") / 1024)
    part = src.groupBy(chunk.alias("chunk")).agg(F.sum("quota").alias("q"))
    before = part.withColumn("before", F.sum("q").over(Window.orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1))).select("chunk", F.coalesce("before", F.lit(0.0)).alias("before"))
    inside = Window.partitionBy("chunk").orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    src = scratch.table(
        src.withColumn("chunk", chunk).join(before, "chunk")
        .withColumn("hi", F.col("before") + F.sum("quota").over(inside))
        .withColumn("lo", F.col("hi") - F.col("quota")).drop("chunk", "before"), "spans")
    total = src.agg(F.max("hi")).first()[0] or 0.0
    slots = int(round(total))

    # slots -> sources: points and spans meet in grid cells (a span lies in the cells it overlaps)
    spark = scratch.spark
    cells = max(1, src.count())
    scale = F.lit(cells / total if total else 0.0)
    point = spark.range(slots).withColumn(
        "u", ((F.col("id") + 0.5) * GOLDEN) % 1.0 * F.lit(total))
    spans = src.filter("quota > 0").select("sid", "blocks", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * scale), F.floor(F.col("hi") * scale))).alias("cell"))
    hit = point.withColumn("cell", F.floor(F.col("u") * scale)).join(spans, "cell") \
        .filter("u >= lo AND u < hi").select("id", "sid", "blocks", F.floor(F.col("id") / CHUNK).alias("chunk"))
    hit = scratch.table(hit, "slots")
    counts = hit.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    run = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("id")) - 1 + F.col("ahead")
    ranked = hit.join(ahead, ["sid", "chunk"]).withColumn("rank", rank) \
        .filter(F.col("rank") < most * F.col("blocks")) \
        .select(F.col("id").alias("slot"), "sid", (F.col("rank") % F.col("blocks")).alias("block"))

    # documents -> their place in the shuffled stream of the source
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    buckets = 1 + meta.count() // BUCKET_ROWS
    place = meta.withColumn("key", key).withColumn("bucket", F.pmod("key", F.lit(buckets)))
    sums = place.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                       F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    near = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "row") \
        .rowsBetween(Window.unboundedPreceding, 0)
    local = place.withColumn("upto", F.sum("size").over(near))
    at = local.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))) \
        .withColumn("from", F.col("base") + F.col("upto") - F.col("size"))
    small = src.select(F.col("source").alias("s2"), "sid", "blocks", "source_size", "target")
    at = at.join(small, F.col("source").eqNullSafe(F.col("s2")))
    at = scratch.table(at.select("row", "doc_id", "source", "size", "source_size", "target", "sid",
                                 "blocks", "from"), "places")

    # block b of a source: words floor(b * width) up to floor((b + 1) * width)
    width = F.col("source_size") / F.col("blocks")

    def edge(b):
        return F.when(b >= F.col("blocks"), F.col("source_size")).otherwise(F.floor(b * width))
    first = F.floor(F.col("from") / width)
    final = F.floor((F.col("from") + F.col("size")) / width)
    pieces = at.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.greatest(first - 1, F.lit(0)),
                                      F.least(final + 1, F.col("blocks") - 1)))) \
        .withColumn("lo", F.greatest(edge(F.col("block")), F.col("from"))) \
        .withColumn("hi", F.least(edge(F.col("block") + 1), F.col("from") + F.col("size"))) \
        .filter("hi > lo") \
        .select("row", "doc_id", "sid", "block", (F.col("lo") - F.col("from")).alias("start"),
                (F.col("hi") - F.col("lo")).alias("length"))
    schedule = ranked.join(pieces, ["sid", "block"]).select("slot", "row", "doc_id", "start", "length")
    times = ranked.groupBy("sid", "block").agg(F.count("*").alias("times"))
    taken = pieces.join(times, ["sid", "block"]).groupBy("row") \
        .agg(F.sum(F.col("length") * F.col("times")).alias("taken"))
    result = at.join(taken, "row", "left").select(
        "row", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    return result, schedule
