"""Periodic runs of words, found by scale-tiled distribution (operator 13).

A run of period q is a maximal stretch of words in which words q apart are identical; runs of at least
``EXPONENT`` periods and ``MIN_WORDS`` words count, each under its smallest period. Periods fall into
octaves [B, 2B), B = 2^k. A document is tiled once per octave, with a boundary every B words. At a
boundary b the Z-function says how far the words from b on repeat those from b + q on (forward, and in
the same way backward). Every counted run holds two whole tiles in a row that repeat at distance q, so

* a tile is proposed where the name of its B words (names of two halves are mixed, octave by octave)
  equals the name q words on; tiles in a row under one period are one chain;
* a chain whose first q words repeat a shorter word is dropped (a checked chain of the smaller period,
  found in an earlier octave, holds it);
* a chain is grown word by word over both ends and checked word by word, so an equal name of
  different words changes nothing (the period is then searched word by word).

Tiles of a document of up to ``TILE_WORDS`` words are solved where the document is read. A longer one
is exploded into overlapping windows of tiles per octave, which are dealt out as rows of their own.
All chains are stitched by (document, period): intervals that touch are one. Texts move only where a
document has a chain.

Defined cases: null, empty and white-space texts have no words and no run; repeated rows are documents
of their own; the document's id is carried along and never used as a key; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

MIN_WORDS, EXPONENT = 6, 4
TILE_WORDS = 1 << 16                # a longer document is dealt out in windows of tiles
GROUP_WORDS = 1 << 18               # short documents solved together
MEMO_WORDS = 1 << 20                # words whose codes a worker remembers
_STEP = 32


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of a block from the names of its halves."""
    with np.errstate(over="ignore"):
        x = (a + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x = (x + b) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=1)
def _least_factors(n: int) -> np.ndarray:
    """Smallest prime factor of every number below n."""
    least = np.arange(n)
    for p in range(2, int(n ** 0.5) + 1):
        if least[p] == p:
            part = least[p * p::p]
            part[part == np.arange(p * p, n, p)] = p
    return least


def _roots(names, halves, half, at, period) -> np.ndarray:
    """By names, the smallest divisor of ``period`` that the ``period`` words from ``at`` on repeat."""
    root = period.copy()
    if half == 0:
        return root                                             # period 1
    rest, least = period.copy(), _least_factors(1 << int(period.max(initial=1)).bit_length())
    while (rest > 1).any():
        p = least[rest]
        p[rest <= 1] = 1
        shift = root // p
        size = np.where(p > 1, period - shift, 0)               # words to compare, half of the tile at least
        long = size >= 2 * half
        same = p > 1
        for offset in (np.zeros_like(size), np.maximum(size - np.where(long, 2 * half, half), 0)):
            a = at + np.where(p > 1, offset, 0)
            b = a + np.where(p > 1, shift, 0)
            same &= np.where(long, names[a] == names[b], halves[a] == halves[b])
        root = np.where(same, shift, root)
        rest = np.where(p > 1, rest // p, rest)
    return root


def _confirmed(found, at, period, root) -> np.ndarray:
    """Whether a checked interval of period ``root`` holds all of the ``period`` words from ``at`` on."""
    have = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3)]
    order = np.lexsort((have[1], have[0]))
    p, s, e = (np.append(-1, h[order]) for h in have)
    span = 1 + max(int(s.max()), int(at.max(initial=0)))
    i = np.searchsorted(p * span + s, root * span + at, "right") - 1
    return (p[i] == root) & (e[i] >= at + period - root)


def _grown(codes, x, y, way) -> np.ndarray:
    """How many words from x and from y on (way 1) or before them (way -1) are the same."""
    size, live = np.zeros(len(x), np.int64), np.arange(len(x))
    span = np.arange(_STEP) if way > 0 else -1 - np.arange(_STEP)
    while len(live):
        a, b = (v[live, None] + way * size[live, None] + span for v in (x, y))
        differ = codes[a] != codes[b]
        stop = differ.any(1)
        size[live] += np.where(stop, differ.argmax(1), _STEP)
        live = live[~stop]
    return size


def _holds(codes, start, end, period) -> np.ndarray:
    """Whether words ``period`` apart are the same all over [start, end), for each interval."""
    size = end - start
    first = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(start - first, size)
    return np.logical_and.reduceat(codes[at] == codes[at + np.repeat(period, size)], first) if len(size) else size > 0


def _plain(codes, low, high, period):
    """Intervals of [low, high) where words ``period`` apart are the same, by comparing all."""
    same = np.concatenate(([0], (codes[low:high - period] == codes[low + period:high]).view(np.int8), [0]))
    edge = np.diff(same)
    return low + np.flatnonzero(edge == 1), low + np.flatnonzero(edge == -1)


def solve(parts: list[np.ndarray], low: int, high: int) -> tuple[np.ndarray, ...]:
    """(part, period, start, end) of the chains of octaves ``low`` to ``high`` in arrays of word codes:
    words in [start, end) are the same as those ``period`` on; maximal within the part."""
    top = 1 << high
    places, total = [], 2 * top + _STEP
    for p in parts:
        places.append(total)
        total += -(-(len(p) + _STEP) // top) * top
    total += 4 * top + 2 * _STEP
    codes = -1 - np.arange(total, dtype=np.int64)               # no two fillers are the same
    for at, p in zip(places, parts):
        codes[at:at + len(p)] = p
    places = np.array(places, np.int64)
    ends = places + np.array([len(p) for p in parts], np.int64)
    found, names, halves = [], codes.view(np.uint64), None
    for k in range(high + 1):
        size = 1 << k
        n = len(names) // size
        tiles = names[:n * size].reshape(n, size)
        t, r = np.nonzero(tiles[1:] == tiles[:-1, :1])
        key = np.sort(r * n + t)
        cut = np.flatnonzero(np.diff(key, prepend=-9) != 1)
        last = np.append(cut[1:], len(key))[:len(cut)] - 1
        cut, last = cut[last > cut], last[last > cut]       # two tiles at least
        period, start, end = size + key[cut] // n, key[cut] % n * size, (key[last] % n + 1) * size
        root = _roots(names, halves, size >> 1, start, period)
        own = root == period
        true = own.copy()
        true[own] = _holds(codes, start[own], end[own], period[own])
        for i in np.flatnonzero(~np.where(own, true, _confirmed(found, start, period, root))):
            # equal names of different words
            part = np.searchsorted(places, start[i], "right") - 1
            s, e = _plain(codes, places[part], ends[part], int(period[i]))
            keep = (e - s >= 2 * size) & ~_repeats_exactly(codes, s, int(period[i]))
            found.append((np.full(keep.sum(), period[i]), s[keep], e[keep]))
        period, start, end = period[true], start[true], end[true]
        found.append((period, start - _grown(codes, start, start + period, -1),
                      end + _grown(codes, end, end + period, 1)))
        if k < high:
            halves, names = names, _mix(names[:-size], names[size:])
    # octaves below ``low`` only confirm: another window of the text reports them
    period, start, end = (np.concatenate([f[i][f[0] >= 1 << low] for f in found]) for i in range(3))
    part = np.searchsorted(places, start, "right") - 1
    return part, period, start - places[part], end - places[part]


def _repeats_exactly(codes, starts, period: int) -> np.ndarray:
    """Whether the ``period`` words from each start on are a shorter word several times over, word by word."""
    shifts = [d for d in range(1, period) if period % d == 0]
    return np.array([any((codes[s:s + period - d] == codes[s + d:s + period]).all() for d in shifts)
                     for s in starts], bool)


def octaves(n: int) -> int:
    """The last octave that a counted run of a text of n words can be in, or -1."""
    return (n // EXPONENT).bit_length() - 1 if n >= MIN_WORDS else -1


def windows(n: int, tile_words: int = TILE_WORDS) -> list[tuple[int, int, int, int]]:
    """(first octave, last octave, start, end) of the windows of a long text. Windows of an octave
    overlap by at least eight tiles, so a run that leaves one is found by its neighbour too."""
    high, k, out = octaves(n), 0, []
    while k <= high:
        last = k
        while last < high and 16 << (last + 1) <= max(tile_words, 16 << k):
            last += 1
        size = max(tile_words, 16 << last)
        if size >= n:
            out.append((k, high, 0, n))
            break
        out += [(k, last, a, min(a + size, n)) for a in range(0, n - (8 << last), size - (8 << last))]
        k = last + 1
    return out


class _Codes(dict):
    def __missing__(self, word):
        self[word] = code = len(self)
        return code


_CODES = _Codes()


def _encoded(words: list[bytes]) -> np.ndarray:
    if len(_CODES) > MEMO_WORDS:
        _CODES.clear()
    return np.fromiter(map(_CODES.__getitem__, words), np.int64, len(words))


def _counted(period, start, end):
    return end - start >= np.maximum(MIN_WORDS - period, (EXPONENT - 1) * period)


_CHAIN = "struct<period:bigint,start:bigint,end:bigint>"
_WINDOW = "struct<low:int,high:int,at:bigint,codes:binary>"


def chains(docs: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """(row, doc_id, text) to one row each: words_sha256 (of the words joined by one space), chains of a
    short document, windows of a long one, and its joined words where it has either."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "words_sha256", "chains", "windows", "words"]

    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            sha, joined, split, found, cut = [], [], [], [[] for _ in texts], [[] for _ in texts]
            groups: dict[int, list] = {}

            def flush(high):
                held = groups.pop(high)
                part, period, start, end = solve([c for _, c in held], 0, high)
                ok = _counted(period, start, end)
                for i, q, s, e in zip(*(v[ok].tolist() for v in (part, period, start, end))):
                    found[held[i][0]].append({"period": q, "start": s, "end": e})
            size: dict[int, int] = {}
            for i, t in enumerate(texts):
                words = (t.as_py() or b"").split()
                joined.append(b" ".join(words))
                sha.append(hashlib.sha256(joined[-1]).hexdigest())
                high = octaves(len(words))
                if high < 0:
                    continue
                codes = _encoded(words)
                if len(words) > tile_words:
                    cut[i] = [{"low": lo, "high": hi, "at": a, "codes": codes[a:z].tobytes()}
                              for lo, hi, a, z in windows(len(words), tile_words)]
                    continue
                groups.setdefault(high, []).append((i, codes))
                size[high] = size.get(high, 0) + len(words)
                if size[high] > GROUP_WORDS:
                    flush(high)
                    size[high] = 0
            for high in list(groups):
                flush(high)
            words = [j.decode("utf-8") if f or w else None for j, f, w in zip(joined, found, cut)]
            yield pa.RecordBatch.from_arrays([
                b.column("row"), b.column("doc_id"), pa.array(sha, pa.string()),
                pa.array(found, pa.list_(pa.struct([(n, pa.int64()) for n in ("period", "start", "end")]))),
                pa.array(cut, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32()), ("at", pa.int64()),
                                                  ("codes", pa.binary())]))),
                pa.array(words, pa.string())], names)
    return docs.select("row", "doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, words_sha256 string, chains array<{_CHAIN}>, "
             f"windows array<{_WINDOW}>, words string")


def solved_windows(cut: DataFrame) -> DataFrame:
    """(row, low, high, at, codes) to (row, period, start, end) of the chains of each window."""
    def run(batches):
        for b in batches:
            for row, low, high, at, codes in zip(*(c.to_pylist() for c in b.columns)):
                _, period, start, end = solve([np.frombuffer(codes, np.int64)], low, high)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(period), row)), pa.array(period), pa.array(start + at), pa.array(end + at)],
                    ["row", "period", "start", "end"])
    return cut.select("row", "low", "high", "at", "codes").mapInArrow(
        run, "row long, period long, start long, end long")


def stitched(parts: DataFrame) -> DataFrame:
    """(row, period, start, length) of the counted runs: touching intervals of one period are one."""
    line = Window.partitionBy("row", "period").orderBy("start", "end")
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    parts = parts.withColumn("island", F.sum("new").over(line))
    return parts.groupBy("row", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")) \
        .select("row", "period", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length")) \
        .filter(F.col("length") >= F.greatest(F.lit(MIN_WORDS), F.lit(EXPONENT) * F.col("period")))


def find_runs(scratch: Scratch, docs: DataFrame, id_col: Column, text_col: Column,
              tile_words: int = TILE_WORDS) -> DataFrame:
    """doc_id, runs (array of start, length, period, in this order) and collapsed (the words without
    those that a run repeats, joined by one space; null where there is no run) with words_sha256."""
    src = docs.select(F.monotonically_increasing_id().alias("row"), id_col.alias("doc_id"), text_col.alias("text"))
    found = scratch.table(chains(src, tile_words), "chains")
    long = found.select("row", F.explode("windows").alias("w")).select("row", "w.*")
    if not long.isEmpty():
        long = long.repartition(F.col("row"), F.col("low"), F.col("at"))
    parts = found.select("row", F.explode("chains").alias("c")).select("row", "c.*") \
        .unionByName(solved_windows(long))
    runs = stitched(parts).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    return collapsed(found.select("row", "doc_id", "words_sha256", "words").join(runs, "row", "left").drop("row"))


def collapsed(found: DataFrame) -> DataFrame:
    """(doc_id, words_sha256, words, runs) with ``collapsed`` in place of the words."""
    def run(batches):
        for b in batches:
            out = []
            for text, runs in zip(b.column("words").to_pylist(), b.column("runs").to_pylist()):
                if not runs:
                    out.append(None)
                    continue
                words = text.split(" ")
                gone = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    gone[r["start"] + r["period"]] += 1
                    gone[r["start"] + r["length"]] -= 1
                out.append(" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("words_sha256"), b.column("runs"), pa.array(out, pa.string())],
                ["doc_id", "words_sha256", "runs", "collapsed"])
    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "words_sha256", "words", "runs").mapInArrow(
        run, f"doc_id {kind}, words_sha256 string, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
             "collapsed string")
