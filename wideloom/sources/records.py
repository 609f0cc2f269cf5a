"""Records of delimited text files whose quoted fields hold line breaks, read in parallel.

A file is cut into blocks by the reader, and a block's first line may lie inside a quoted field. Whether a
line ends inside one depends only on whether it began inside one, so each line is a function on two
states, and so is each run of lines:

* a line without a quote keeps the state; another one is looked at twice, as begun outside and inside;
* a task reads the lines of a block in their order and joins them to records both ways at once, until a line
  ends outside quotes either way; from there on both ways are one, and most blocks meet at their first records;
* the pieces (whole records, and the cut ones at both ends of a block) are stored by the task that read the
  lines, beside one row per block of what the block makes of either state;
* a prefix scan over the rows of blocks gives the state in which each begins, and with it the pieces that hold.

So text is moved only for the records cut by the end of a block, and written once; a block that never meets
(every quoted field ends at the start of a line) is written both ways.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

# The grammar of a line of comma separated fields. A quoted field may hold doubled quotes;
# what follows its closing quote up to the next comma belongs to it.
_QUOTED_REST = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
_FIELDS = rf'\G(?:"{_QUOTED_REST}|[^",][^,]*+)?+(?:,|$)'
_CLOSING = rf"^{_QUOTED_REST}(?:,|$)"

# Bytes of an open record that a task holds; beyond them it is handed on in parts.
PART_BYTES = 16 << 20

# A piece: ``begun`` is the state its block must begin in (inside quotes or not; null: holds in both), ``kind``
# whole, part (of a record) or block; ``at`` orders the parts of a block, ``since`` names the record among those that
# begin in the block (null: one of an earlier block); ``first``: of the first record that begins in the block among
# those of its ``begun``. A row of kind block has, for either state, whether the block ends inside quotes, the
# ``since`` of the record that goes on after it, and where the first record is (0: none begins, 1: among the
# pieces of that state, 2: among those that hold in both).
_OF_BLOCK = pa.struct([("open", pa.bool_()), ("since", pa.int32()), ("first", pa.int32())])
_PIECE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("begun", pa.bool_()), ("kind", pa.string()), ("at", pa.int32()),
                    ("since", pa.int32()), ("first", pa.bool_()), ("record", pa.binary()), ("from_outside", _OF_BLOCK), ("from_inside", _OF_BLOCK)])
_PIECE_DDL = "file string, block long, begun boolean, kind string, at int, since int, first boolean, record binary" + "".join(
    f", {c} struct<open: boolean, since: int, first: int>" for c in ("from_outside", "from_inside"))


def leaves_open(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside a quoted field: what is left when all
    complete fields are taken from its start begins with the open quote."""
    return F.when(line.contains('"'), F.regexp_replace(line, _FIELDS, "") != "").otherwise(F.lit(False))


def stays_open(line: Column) -> Column:
    """Whether a line that begins inside a quoted field ends inside one, the same or a later one."""
    rest = F.regexp_replace(line, _CLOSING, "")
    return F.when(~line.contains('"') | ~line.rlike(_CLOSING), F.lit(True)).otherwise(leaves_open(rest))


def tagged_lines(spark: SparkSession, files: list[str], encoding: str) -> DataFrame:
    """file, block, line, and whether the line ends inside a quoted field if begun outside (``out``) and
    inside one (``in``); a block's lines come in their order, in one task."""
    v = F.col("value")
    text = v if encoding.upper() == "UTF-8" else F.decode(v.cast("binary"), encoding)
    lines = spark.read.text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), text.alias("line"))
    return lines.withColumn("out", leaves_open(F.col("line"))).withColumn("in", stays_open(F.col("line")))


def _ends(out: np.ndarray, in_: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each line ends inside quotes, the first one begun ``inside``: what the last line that ends alike
    either way has set, turned by each line since then that turns the state."""
    turns = np.cumsum(out & ~in_)
    last = np.maximum.accumulate(np.where(out == in_, np.arange(len(out)), -1))
    since = turns - np.where(last < 0, 0, turns[last])
    return np.where(last < 0, inside, out[last]) ^ (since % 2 == 1)


def _joined(lines: pa.Array, cuts: np.ndarray) -> pa.Array:
    """The lines between each cut and the next one as one text."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), lines), b"\n")


class _Reading:
    """Lines of a block joined to records, begun outside or inside quotes (``begun``; null: either way alike).
    ``numbers`` are those of the block's parts."""

    def __init__(self, begun: bool | None, numbers: Iterator[int]):
        self.begun, self.inside, self.numbers = begun, bool(begun), numbers
        self.seen = False                                  # a record has begun
        self.open(None, False)

    def open(self, since: int | None, first: bool, *lines: bytes) -> None:
        """The record that the last line leaves open, the lines of it held here, and whether some were handed on."""
        self.since, self.first, self.lines, self.cut = since, first, [*lines], since is None

    def part(self):
        """The lines held of the open record as a piece."""
        piece = "part", next(self.numbers), self.since, [self.first], pa.array([b"\n".join(self.lines)], pa.binary())
        self.lines, self.cut = [], True
        return piece

    def take(self, lines: pa.Array, blank: np.ndarray, ends: np.ndarray):
        """The pieces (kind, at, since, whether each is of the first record, texts) that end among the next lines."""
        inside = np.append(self.inside, ends[:-1])
        kept = np.flatnonzero(inside | ~blank)             # blank lines outside quotes are no records
        if len(kept) < len(lines):
            lines = lines.take(pa.array(kept))
        starts = np.flatnonzero(~inside[kept])
        before = starts[0] if len(starts) else len(kept)
        self.inside = bool(ends[-1])
        if before:
            self.lines.append(_joined(lines, np.array([0, before]))[0].as_py())
            if len(starts) or not self.inside:
                yield self.part() if self.cut else ("whole", None, None, *self.part()[3:])
                self.open(None, False)
        if len(starts):
            texts = _joined(lines, np.append(starts, len(kept)))
            first = np.arange(len(starts)) + self.seen == 0
            self.seen = True
            if self.inside:
                self.open(next(self.numbers), bool(first[-1]), texts[-1].as_py())
                texts, first = texts[:-1], first[:-1]
            if len(texts):
                yield "whole", None, None, first, texts
        if sum(map(len, self.lines)) > PART_BYTES:
            yield self.part()


class _Block:
    """A block read both ways at once, until a line ends outside quotes either way; a file's first block
    begins outside."""

    def __init__(self, file: str, block: int):
        self.file, self.block = file, block
        self.numbers = count()
        self.ways = [_Reading(begun, self.numbers) for begun in ((None,) if block == 0 else (False, True))]
        self.seen = [False, False]                         # a record has begun before both ways met

    def rows(self, begun: bool | None, kind: str, at: int | None, since: int | None, first, texts: pa.Array) -> pa.RecordBatch:
        n, alike = len(texts), (self.file, self.block, begun, kind, at, since)
        columns = [pa.repeat(pa.scalar(v, f.type), n) for v, f in zip(alike, _PIECE)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(first, pa.bool_()), texts, pa.nulls(n, _OF_BLOCK), pa.nulls(n, _OF_BLOCK)],
                                          schema=_PIECE)

    def take(self, lines: pa.Array, blank: np.ndarray, out: np.ndarray, in_: np.ndarray):
        n, ends = len(lines), [_ends(out, in_, w.inside) for w in self.ways]
        met = np.flatnonzero(~ends[0] & ~ends[1])[:1] + 1 if len(ends) == 2 else []
        upto = met[0] if len(met) else n
        for way, end in zip(self.ways, ends):
            for piece in way.take(lines[:upto], blank[:upto], end[:upto]):
                yield self.rows(way.begun, *piece)
        if len(met):
            self.seen = [w.seen for w in self.ways]
            self.ways = [_Reading(None, self.numbers)]
            if upto < n:
                yield from self.take(lines[upto:], blank[upto:], out[upto:], in_[upto:])

    def end(self):
        made = []
        for begun in (False, True):
            way = self.ways[begun if len(self.ways) == 2 else 0]
            seen = way.seen if way.begun is not None else self.seen[begun]
            made.append({"open": way.inside, "since": way.since, "first": 1 if seen else 2 if way.seen else 0})
        for way in self.ways:
            if way.lines:
                yield self.rows(way.begun, *way.part())
        yield pa.RecordBatch.from_pylist([{"file": self.file, "block": self.block, "kind": "block", "first": False,
                                           "from_outside": made[0], "from_inside": made[1]}], schema=_PIECE)


def _read_blocks(batches):
    """Pieces of the blocks whose lines (file, block, line, blank, out, in) come one after the other."""
    now = None
    for b in batches:
        file, at, line = b.column("file"), b.column("block").to_numpy(), b.column("line")
        flags = [b.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("blank", "out", "in")]
        other = (at[1:] != at[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        cuts = [0, *(np.flatnonzero(other) + 1), len(at)] if len(at) else []
        for lo, hi in zip(cuts, cuts[1:]):
            key = file[int(lo)].as_py(), int(at[lo])
            if now is None or (now.file, now.block) != key:
                if now is not None:
                    yield from now.end()
                now = _Block(*key)
            yield from now.take(line[lo:hi], *(f[lo:hi] for f in flags))
    if now is not None:
        yield from now.end()


def _pieces(spark: SparkSession, files: list[str], encoding: str) -> DataFrame:
    """The pieces of all blocks; stored, so that reader and scan see the same blocks."""
    lines = tagged_lines(spark, files, encoding).withColumn("blank", F.trim("line") == "").withColumn("line", F.col("line").cast("binary"))
    path = f"{scratch_dir(spark)}/csv-records-{uuid.uuid4().hex}"
    lines.select("file", "block", "line", "blank", "out", "in").mapInArrow(_read_blocks, _PIECE_DDL).write.parquet(path)
    return spark.read.schema(_PIECE_DDL).parquet(path)


def _blocks(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """One row per block: ``inside`` (its state at the start), ``head`` (where the header of its file is: 1 among the
    pieces of that state, 2 among those that hold in both; else null) and ``origin`` (block and ``since`` of the
    last record cut by the end of a block before it); stored."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    a, b = F.col("from_outside.open"), F.col("from_inside.open")
    df = pieces.filter("kind = 'block'").select("file", "block", "from_outside", "from_inside", F.when(a == b, a.cast("int")).alias("sets"),
                                                (F.sum((a & ~b).cast("int")).over(upto) % 2).alias("turned"))
    # the state set last and the turns since then, those up to it taken off again
    turned = F.coalesce(F.last("turned").over(earlier), F.lit(0))
    state = F.coalesce(F.last(F.when(F.col("sets").isNotNull(), F.col("sets") + F.col("turned")), ignorenulls=True).over(earlier), F.lit(0))
    df = df.withColumn("inside", (state + turned) % 2 == 1)
    df = df.withColumn("own", F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")))
    started = F.coalesce(F.max("own.first").over(earlier), F.lit(0)) > 0
    df = df.select("file", "block", "inside", F.when(~started & (F.col("own.first") > 0), F.col("own.first")).alias("head"),
                   F.last(F.when(F.col("own.since").isNotNull(), F.struct("block", "own.since")), ignorenulls=True).over(earlier).alias("origin"))
    path = f"{scratch_dir(spark)}/csv-blocks-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def records(spark: SparkSession, files: list[str], encoding: str) -> DataFrame:
    """One row ``record`` (text, line breaks as line feeds) per record of ``files`` but the first of each,
    its header. Blank lines outside quotes are no records."""
    pieces = _pieces(spark, files, encoding)
    blocks = _blocks(spark, pieces)
    text, begun = F.col("record").cast("string").alias("record"), F.col("begun")
    plain = (F.col("kind") == "whole") & ~F.col("first") & begun.isNull()
    ends = pieces.filter((F.col("kind") != "block") & ~plain).join(blocks, ["file", "block"]) \
        .filter(begun.isNull() | (begun == F.col("inside"))) \
        .withColumn("header", F.col("first") & F.coalesce(F.col("head") == F.when(begun.isNull(), 2).otherwise(1), F.lit(False)))
    place = F.when(F.col("since").isNotNull(), F.struct("block", "since")).otherwise(F.col("origin")).alias("place")
    joined = ends.filter("kind = 'part'").groupBy("file", place).agg(F.bool_or("header").alias("header"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "at", text))), lambda x: x["record"]), "\n").alias("record"))
    return pieces.filter(plain).select(text).unionByName(ends.filter("kind = 'whole' AND NOT header").select(text)) \
        .unionByName(joined.filter("NOT header").select("record"))
