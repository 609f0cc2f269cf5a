"""Hard negatives by Four-Russians scoring (operator 11).

Vectors are whole numbers. The anchors' components are cut into groups of eight dimensions, and for each
group the sums of all 256 subsets are put into a table. A candidate is stored as packed bit planes: for
each bit of its components (two's complement) and each group one byte. The byte indexes the table, so a
plane's share of the inner product is one lookup per group; the planes' shares, shifted by their bit and
the sign plane taken away, add up to the full exact score.

Candidates and anchors are packed into blocks of bounded size where they are read; each block of anchors
meets each block of candidates as one row, so the anchors are never broadcast and no task holds more than
two blocks. Scores are made twice: for the positives (same label, each label scored by itself inside a
block) and, with the positives known, for the negatives between the bounds. Each pair of blocks hands on
its best few of each anchor (positive), and windows over these take the first ones.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part;
shorter vectors count as filled up with zeros; a row is its own key, so repeated rows are several
candidates and anchors (a repeated anchor has its copy among its positives); ties go to the smaller id,
null ids last (a null id is no anchor); without candidates between the bounds an (anchor, positive) has
no row. Whole components outside 32 bits, or so many that a score could leave 46 bits, raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95                      # per cent of the positive's score
CANDIDATE_ROWS, ANCHOR_ROWS = 8192, 1024  # of a block
_GROUP = 8


def vectors(scratch: Scratch, rows: DataFrame, id_col: Column, label_col: Column, vector_col: Column,
            is_anchor: Column) -> DataFrame:
    """row, id, label, v (array of long), anchor of the rows that take part; stored."""
    src = rows.select(id_col.cast("bigint").alias("id"), label_col.cast("bigint").alias("label"),
                      vector_col.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    src = src.filter("label IS NOT NULL AND v IS NOT NULL").filter(
        F.forall("v", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))))   # NaN is larger
    src = src.withColumn("v", F.transform("v", lambda x: F.floor(x))) \
        .withColumn("row", F.monotonically_increasing_id())
    return scratch.table(src, "vectors")


def shape(rows: DataFrame) -> tuple[int, int, int]:
    """(dimensions, bits of a component, largest score) of all stored vectors."""
    got = rows.select(F.size("v").alias("n"), F.array_min("v").alias("low"), F.array_max("v").alias("high")) \
        .agg(F.max("n"), F.min("low"), F.max("high")).first()
    n, low, high = (int(x or 0) for x in got)
    bits = 1 + max(int(low if low >= 0 else ~low).bit_length(), int(high if high >= 0 else ~high).bit_length())
    score = n << (2 * (bits - 1))
    if bits > 32 or score >= 1 << 46:
        raise ValueError(f"components of {bits} bits in {n} dimensions: scores do not fit")
    return n, bits, score


def planes(v: np.ndarray, bits: int) -> np.ndarray:
    """Packed bit planes of integer vectors: (bits, groups, rows) of bytes, bit d of a byte for dimension d."""
    u = v.astype(np.int64)
    return np.stack([np.packbits((u >> b & 1).astype(np.uint8), axis=1, bitorder="little").T for b in range(bits)])


def tables(anchors: np.ndarray, kind) -> np.ndarray:
    """Sums of all subsets of each group of eight dimensions: (groups, 256, anchors)."""
    n, dims = anchors.shape
    groups = -(-dims // _GROUP)
    full = np.zeros((n, groups * _GROUP), np.int64)
    full[:, :dims] = anchors
    parts = full.reshape(n, groups, _GROUP).transpose(1, 2, 0)
    out = np.zeros((groups, 1 << _GROUP, n), np.int64)
    for d in range(_GROUP):                                   # a subset's sum from that without its last member
        out[:, 1 << d:2 << d] = out[:, :1 << d] + parts[:, d, None]
    return out.astype(kind)


def scores(table: np.ndarray, packed: np.ndarray, wide) -> np.ndarray:
    """Exact inner products (candidates, anchors) of packed candidates by lookups, shifts and adds."""
    bits, groups, n = packed.shape
    total = np.zeros((n, table.shape[2]), wide)
    for b in range(bits):
        share = table[0].take(packed[b, 0], axis=0)
        for g in range(1, groups):
            share += table[g].take(packed[b, g], axis=0)
        share = share.astype(wide)
        share <<= b
        if b == bits - 1:
            total -= share                                    # sign plane of two's complement
        else:
            total += share
    return total


def _kinds(n: int, bits: int, score: int):
    """Number types that hold a plane's share (a sum of components) and a score."""
    share = n << (bits - 1)
    return (np.int16 if share < 1 << 15 else np.int32 if share < 1 << 31 else np.int64,
            np.int32 if score < 1 << 31 else np.int64)


_BLOCK = "n int, dims int, id binary, no_id binary, row binary, label binary, v binary"


def blocks(rows: DataFrame, size: int, dims: int, bits: int, extra: str | None = None) -> DataFrame:
    """Packed blocks of at most ``size`` rows, ordered by (label, id, row): components of anchors as 32-bit
    integers, or bit planes of candidates (``bits`` > 0). ``extra``: an array column kept beside."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, size):
                part = b.slice(at, size)
                ids = part.column("id")
                none = ids.is_null().to_numpy(zero_copy_only=False)
                col = {"id": ids.fill_null(0).to_numpy(zero_copy_only=False), "no_id": none}
                col |= {c: part.column(c).to_numpy(zero_copy_only=False) for c in ("row", "label")}
                order = np.lexsort((col["row"], col["id"], none, col["label"]))
                v = np.zeros((part.num_rows, dims), np.int64)
                lists = part.column("v")
                count = np.diff(lists.offsets.to_numpy()) if part.num_rows else np.zeros(0, int)
                at_row = np.repeat(np.arange(part.num_rows), count)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                v[at_row, np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)] = flat
                v = v[order]
                data = planes(v, bits).tobytes() if bits else v.astype(np.int32).tobytes()
                out = [part.num_rows, dims, *(col[c][order].tobytes() for c in ("id", "no_id", "row", "label")), data]
                kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
                arrays = [pa.array([x], k) for x, k in zip(out, kinds)]
                names = ["n", "dims", "id", "no_id", "row", "label", "v"]
                if extra:
                    e = part.column(extra).to_pylist()
                    arrays.append(pa.array([[e[i] for i in order]], pa.list_(part.column(extra).type)))
                    names.append(extra)
                yield pa.RecordBatch.from_arrays(arrays, names)
    kept = ["id", "row", "label", "v"] + ([extra] if extra else [])
    more = f", {extra} array<{rows.schema[extra].dataType.simpleString()}>" if extra else ""
    return rows.select(*kept).mapInArrow(run, _BLOCK + more)


class _Side:
    """One side of a row of two blocks."""

    def __init__(self, get):
        self.n = get("n")
        self.id, self.row, self.label = (np.frombuffer(get(c), np.int64) for c in ("id", "row", "label"))
        self.no_id = np.frombuffer(get("no_id"), bool)

    def ids(self, at):
        return pa.array(self.id[at], pa.int64(), mask=self.no_id[at])


def paired(scratch: Scratch, anchors: DataFrame, candidates: DataFrame, name: str) -> DataFrame:
    """Each block of anchors (``a``) beside each block of candidates (``c``), one row a pair: candidates go
    to the number of every anchor block, by an equal join that Spark can broadcast, sort or split."""
    a = scratch.table(anchors.withColumn("block", F.monotonically_increasing_id()), f"{name}-anchors")
    keys = a.agg(F.collect_list("block").alias("k"))          # one number a block of anchors
    k = keys.first()["k"]
    if not k:
        k = [-1]
    goes = candidates.select(F.struct("*").alias("c")).withColumn("block", F.explode(F.lit(k)))
    return a.select("block", F.struct([x for x in a.columns if x != "block"]).alias("a")).join(goes, "block") \
        .select("a", "c")


def _runs(labels: np.ndarray) -> dict[int, slice]:
    cut = np.flatnonzero(np.diff(labels, prepend=labels[:1] - 1)) if len(labels) else []
    return {int(labels[s]): slice(s, e) for s, e in zip(cut, [*cut[1:], len(labels)])}


def _ranked(score: np.ndarray, k: int) -> np.ndarray:
    """For each anchor (column) the candidates' places by score from the top, ties by place; all (or k)."""
    n = len(score)
    width = max(1, int(n).bit_length())
    key = (score.astype(np.int64).T << width) + (n - 1 - np.arange(n))
    if k < n:
        key = np.partition(key, n - k, axis=1)[:, n - k:]
    key.sort(axis=1)
    return n - 1 - (key[:, ::-1] & ((1 << width) - 1))


def positives(scratch: Scratch, anchors: DataFrame, candidates: DataFrame, dims, bits, score,
              k: int = POSITIVES) -> DataFrame:
    """(anchor row, place, id, row, score) of the first ``k`` other rows of each anchor's label."""
    narrow, wide = _kinds(dims, bits, score)

    def run(batches):
        for b in batches:
            for pair in b.to_pylist():
                a, c = _Side(pair["a"].get), _Side(pair["c"].get)
                v = np.frombuffer(pair["a"]["v"], np.int32).reshape(a.n, dims)
                p = np.frombuffer(pair["c"]["v"], np.uint8).reshape(bits, -1, c.n)
                mine, got = _runs(a.label), []
                for label, at in _runs(c.label).items():
                    if label not in mine:
                        continue
                    own = mine[label]
                    s = scores(tables(v[own], narrow), p[:, :, at], wide)
                    rank = _ranked(s, min(k + 1, len(s)))     # one more: the anchor itself may be among them
                    col = np.repeat(np.arange(len(rank)), rank.shape[1])
                    place = rank.ravel()
                    keep = c.row[at][place] != a.row[own][col]
                    col, place = col[keep], place[keep]
                    got.append((a.row[own][col], place + at.start, s[place, col].astype(np.int64)))
                if got:
                    who, place, value = (np.concatenate(x) for x in zip(*got))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(who), c.ids(place), pa.array(c.row[place]), pa.array(value)],
                        ["anchor", "id", "row", "score"])
    best = paired(scratch, blocks(anchors, ANCHOR_ROWS, dims, 0), blocks(candidates, CANDIDATE_ROWS, dims, bits),
                  "positives").mapInArrow(run, "anchor long, id long, row long, score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def negatives(scratch: Scratch, anchors: DataFrame, candidates: DataFrame, dims, bits, score,
              k: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """``anchors`` have ``wanted``, an array of (place, score) of positives: (anchor row, place, id, row,
    score, rank) of the first ``k`` rows of other labels that score between the bounds."""
    narrow, wide = _kinds(dims, bits, score)

    def run(batches):
        for b in batches:
            for pair in b.to_pylist():
                a, c = _Side(pair["a"].get), _Side(pair["c"].get)
                v = np.frombuffer(pair["a"]["v"], np.int32).reshape(a.n, dims)
                p = np.frombuffer(pair["c"]["v"], np.uint8).reshape(bits, -1, c.n)
                # candidates by id, so that ties of the score fall to the smaller id
                order = np.lexsort((c.row, c.id, c.no_id))
                s = scores(tables(v, narrow), p[:, :, order], wide)
                n = len(s)
                width = int(n).bit_length()
                key = (s.astype(np.int64).T << width) + (n - 1 - np.arange(n))
                key[c.label[order][None] == a.label[:, None]] = -(1 << 62) - (1 << 61)
                key.sort(axis=1)
                who, place, at, value = [], [], [], []
                for i, wanted in enumerate(pair["a"]["wanted"]):
                    for w in wanted:
                        # least * p <= 100 * n <= most * p, in whole numbers
                        top = (most * w["score"] // 100 + 1) << width
                        low = -(-least * w["score"] // 100) << width
                        e = int(np.searchsorted(key[i], top, "left"))
                        f = max(int(np.searchsorted(key[i], low, "left")), e - k)
                        for x in key[i][f:e][::-1].tolist():
                            who.append(i)
                            place.append(w["place"])
                            at.append(n - 1 - (x & ((1 << width) - 1)))
                            value.append(x >> width)
                at = order[np.array(at, np.int64)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(a.row[np.array(who, np.int64)]), pa.array(place, pa.int32()), c.ids(at),
                    pa.array(c.row[at]), pa.array(value, pa.int64())], ["anchor", "place", "id", "row", "score"])
    found = paired(scratch, blocks(anchors, ANCHOR_ROWS, dims, 0, "wanted"), blocks(candidates, CANDIDATE_ROWS, dims, bits),
                   "negatives").mapInArrow(run, "anchor long, place int, id long, row long, score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(scratch: Scratch, rows: DataFrame, id_col: Column, label_col: Column, vector_col: Column,
                   is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    all_rows = vectors(scratch, rows, id_col, label_col, vector_col, is_anchor)
    dims, bits, score = shape(all_rows)
    dims = max(dims, 1)
    anchors = all_rows.filter(F.col("anchor") & F.col("id").isNotNull())
    first = scratch.table(positives(scratch, anchors, all_rows, dims, bits, score), "first")
    wanted = first.groupBy("anchor").agg(F.collect_list(F.struct("place", "score")).alias("wanted"))
    found = negatives(scratch, anchors.withColumnRenamed("row", "key").join(
        wanted.withColumnRenamed("anchor", "key"), "key").withColumnRenamed("key", "row"), all_rows, dims, bits, score)
    return found.select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")) \
        .join(first.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
              ["anchor", "place"]) \
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor") \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                "negative_score")
