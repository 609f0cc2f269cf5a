"""Exact deduplication by deterministic block naming (operator 2).

The normalised text is cut into blocks of a fixed number of characters. The distinct blocks are
sorted and named by integers; then adjacent names are paired, the distinct pairs sorted and named,
and so on until each document has one name. Two documents of equal normalised length get the same
name exactly if their texts are equal: every naming step is a bijection.

Blocks are sorted by (64-bit digest, text). Where one digest has one text only (checked over all
blocks) the digest decides the order alone, so the text is shuffled once, after the map side has
merged equal blocks; digests with several texts are resolved by the text itself.

Defined cases: null text counts as empty; empty texts equal each other; null ids sort last; rows
repeated exactly are members of one group and one of them stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import SPACE, Scratch, text_or_empty

BLOCK_CHARS = 4096


def normalise(text: Column) -> Column:
    """Delete every character of ``[\\x20\\x09-\\x0D]``; null becomes empty."""
    return F.regexp_replace(text_or_empty(text), SPACE + "+", "")


def blocks(text: Column, chars: int) -> Column:
    """Consecutive blocks of ``chars`` code points (the last may be shorter); empty text: none."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % chars), F.lit(0))


def _names(scratch: Scratch, keys: DataFrame, cols: list[str], level: int) -> DataFrame:
    """Distinct key tuples, sorted, each with an integer ``name`` (increasing in sort order)."""
    distinct = keys.select(*cols).groupBy(*cols).agg(F.lit(1).alias("one")).drop("one")
    return scratch.table(distinct.orderBy(*cols).withColumn("name", F.monotonically_increasing_id()),
                         f"names{level}")


def exact_dedup(scratch: Scratch, docs: DataFrame, id_col: Column, text_col: Column,
                row: Column | None = None, block_chars: int = BLOCK_CHARS,
                digest=F.xxhash64) -> DataFrame:
    """One row per input row: row, doc_id, keep_id, group_size, kept, text_sha256.

    ``row`` is a stored unique key of ``docs``; without it a key is made and returned. The row
    with the most code points in the original text stays, then the smallest id. ``digest`` maps a
    block to a long and may collide (tests pass a poor one).
    """
    src = docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"),
                      id_col.alias("id"), text_or_empty(text_col).alias("text"))
    cut = src.select("row", "id", F.char_length("text").alias("n"), normalise(F.col("text")).alias("norm"))

    # digests that several different blocks share: with a 64-bit digest usually none
    texts = (cut.select(F.explode(blocks(F.col("norm"), block_chars)).alias("block"))
             .select(digest("block").alias("h"), "block").groupBy("h", "block").agg(F.lit(1).alias("one")))
    digests = scratch.table(texts.groupBy("h").agg(F.count("*").alias("variants"))
                            .orderBy("h"), "digests")
    clash = scratch.table(
        texts.join(digests.filter("variants > 1").select("h"), "h", "left_semi")
        .select("h", "block", (F.row_number().over(Window.partitionBy("h").orderBy("block")) - 1)
                .cast("int").alias("sub")), "clash") \
        if not digests.filter("variants > 1").isEmpty() else None

    # one pass over the texts: everything that later steps need, without the text
    slim = cut.select("row", "id", "n", F.char_length("norm").alias("len"),
                      F.sha2(F.col("norm"), 256).alias("sha"), "norm")
    part = F.posexplode(blocks(F.col("norm"), block_chars)).alias("pos", "block")
    if clash is None:
        rows = scratch.table(slim.select(
            "row", "id", "n", "len", "sha",
            F.transform(blocks(F.col("norm"), block_chars), lambda b: digest(b)).alias("hs")), "rows")
        at = rows.select("row", F.posexplode("hs").alias("pos", "h")).withColumn("sub", F.lit(0))
    else:
        rows = scratch.table(slim.drop("norm"), "rows")
        at = (slim.select("row", part).withColumn("h", digest("block"))
              .join(clash, ["h", "block"], "left")
              .select("row", "pos", "h", F.coalesce("sub", F.lit(0)).alias("sub")))

    # level 0: names of blocks in the order of (digest, rank of the text within the digest)
    named = scratch.table(
        digests.select("h", F.explode(F.sequence(F.lit(0), (F.col("variants") - 1).cast("int")))
                       .alias("sub"))
        .orderBy("h", "sub").withColumn("name", F.monotonically_increasing_id()), "names0")
    level = scratch.table(at.join(named, ["h", "sub"]).select("row", "pos", "name"), "level0")

    # pair adjacent names until one is left; documents that are done wait in ``done``
    k, done = 0, []
    while True:
        alone = level.groupBy("row").agg(F.count("*").alias("c"), F.first("name").alias("name"))
        alone = scratch.table(alone, f"count{k}")
        done.append(alone.filter("c = 1").select("row", "name"))
        rest = alone.filter("c > 1").select("row")
        if rest.isEmpty():
            break
        pairs = scratch.table(
            level.join(rest, "row", "left_semi")
            .groupBy("row", F.shiftright("pos", 1).alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                 F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")),
            f"pairs{k + 1}")
        names = _names(scratch, pairs, ["a", "b"], k + 1)
        k += 1
        level = scratch.table(pairs.join(names, ["a", "b"]).select("row", "pos", "name"), f"level{k}")
    last = done[0]
    for d in done[1:]:
        last = last.unionByName(d)

    # identity: length and final name (lengths fix the number of levels, so names never mix)
    ident = rows.join(last, "row", "left").select(
        "row", "id", "n", "sha", "len", F.coalesce("name", F.lit(-1)).alias("name"))
    ident = scratch.table(ident, "ident")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("null"), "id", "row"))
    groups = ident.groupBy("len", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    return ident.join(groups, ["len", "name"]).select(
        "row", F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))
