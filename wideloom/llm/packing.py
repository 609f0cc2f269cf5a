"""Best-two-fit packing of tokenised documents into sequences (operator 7).

A document longer than a sequence is cut into full pieces and a rest. Pieces of one length are
interchangeable, so the plan is made on the histogram of lengths, which has at most as many rows as a
sequence has tokens, whatever the number of documents. A bin is filled greedily (longest piece that
fits); then its smallest piece is replaced by two unpacked pieces that fill the expanded gap better,
as long as that helps. The same bin is repeated while its lengths last. Then every piece is ranked
among those of its length (in two levels, so a hot length is split) and takes its place in the plan.

Defined cases: null text counts as empty; an empty document is the end id alone; repeated rows are
packed as often as they come; without documents there is no sequence.
"""

from __future__ import annotations

import os
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SEQUENCE = 2048
END_ID = 0
BUCKET_ROWS = 4096
CACHE_WORDS = 400_000              # chunks whose ids a worker remembers
CACHE_PIECES = 150_000             # letters and punctuation by themselves, likewise
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class _Ids(dict):
    """Ids of white-space separated chunks as little-endian bytes.

    The tokenizer drops white space and never looks across it, so a text's ids are those of its
    chunks. A chunk of letters and final punctuation goes to the model at once, letters and punctuation
    each by itself and remembered each by itself (its normaliser only lower-cases such letters); any
    other chunk takes the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        kinds = str(self.tokenizer.normalizer) + str(self.tokenizer.pre_tokenizer)
        self.direct = "Lowercase" in kinds and "ByteLevel" in kinds and "NFC" in kinds
        self.pieces: dict[bytes, bytes] = {}               # of letters in lower case, and of punctuation

    def forget(self) -> None:
        self.clear()
        self.pieces.clear()

    def _piece(self, raw: bytes) -> bytes:
        ids = self.pieces.get(raw)
        if ids is None:
            piece = raw.decode("ascii") if raw.isascii() else self.byte_level.pre_tokenize_str(raw.decode("utf-8"))[0][0]
            self.pieces[raw] = ids = array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
        return ids

    def _letters(self, core: bytes) -> bytes | None:
        """Letters in lower case if the normaliser would only lower-case them."""
        if core.isalpha():                                 # ASCII
            return core.lower()
        if core.isascii():
            return None
        text = core.decode("utf-8")
        return text.lower().encode("utf-8") if text.isalpha() and max(text) < "ƀ" and "İ" not in text else None

    def __missing__(self, raw: bytes) -> bytes:
        core = raw.rstrip(_PUNCTUATION)
        low = self._letters(core) if self.direct else None
        if low is not None:
            ids = self._piece(low)
            if len(core) < len(raw):
                ids += self._piece(raw[len(core):])
        else:
            ids = array("I", self.tokenizer.encode(raw.decode("utf-8"), add_special_tokens=False).ids).tobytes()
        self[raw] = ids
        return ids


@lru_cache(maxsize=2)
def _ids(path: str) -> _Ids:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _Ids(path)


def encode(text: bytes | None, path: str) -> bytes:
    """Ids of a text in UTF-8, little-endian 32 bit, without the end id. (A split of bytes cuts at
    ASCII white space only, all of which the tokenizer drops.)"""
    ids = _ids(path)
    out = b"".join(map(ids.__getitem__, (text or b"").split()))
    if len(ids) > CACHE_WORDS:
        ids.clear()
    if len(ids.pieces) > CACHE_PIECES:
        ids.pieces.clear()
    return out


def pieces(docs: DataFrame, id_col: Column, text_col: Column, tokenizer: str,
           sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document."""
    src = docs.select(id_col.alias("doc_id"), text_col.alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        for b in batches:
            at, rows = [], []
            for i, t in enumerate(b.column("text").cast(pa.binary())):
                ids = encode(t.as_py(), tokenizer) + end
                for k, a in enumerate(range(0, len(ids), 4 * sequence)):
                    part = ids[a:a + 4 * sequence]
                    at.append(i)
                    rows.append((k, a // 4, len(part) // 4, zlib.crc32(part), part))
            cols = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            data = [pa.array(c, t) for c, t in zip(cols, kinds)][:4 + with_ids]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(at, pa.int64())), *data], names)
        _ids(tokenizer).forget()                           # the worker goes on to other work
    return src.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
                          + ", ids binary" * with_ids)


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, dict[int, int]]]:
    """[(times, {length: copies})]: bins by best-two-fit over the counts of the lengths."""
    left = np.zeros(sequence + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    bins = []
    while (lengths := np.flatnonzero(left)).size:
        used: dict[int, int] = {}
        gap = sequence

        def take(length, n=1):
            used[length] = used.get(length, 0) + n
            if not used[length]:
                del used[length]

        def fill(gap):
            while True:
                free = lengths[lengths <= gap]
                pick = next((int(x) for x in free[::-1] if left[x] > used.get(int(x), 0)), 0)
                if not pick:
                    return gap
                n = min(int(left[pick]) - used.get(pick, 0), gap // pick)
                take(pick, n)
                gap -= n * pick
        gap = fill(gap)
        while gap:
            least = min(used)
            room = gap + least
            free = left - np.bincount(list(used), list(used.values()), sequence + 1).astype(np.int64)
            ok = np.flatnonzero(free[:room + 1] > 0)
            if not ok.size:
                break
            # for each a the largest b <= a that fits beside it
            at = np.searchsorted(ok, np.minimum(room - ok, ok), "right") - 1
            other = np.where(at >= 0, ok[at], 0)
            same = (other == ok) & (free[ok] < 2)
            other = np.where(same, np.where(at > 0, ok[np.maximum(at - 1, 0)], 0), other)
            total = np.where(other > 0, ok + other, 0)
            best = int(total.argmax())
            if total[best] <= least:
                break
            take(least, -1)
            take(int(ok[best]))
            take(int(other[best]))
            gap = fill(room - int(total[best]))
        times = min(int(left[x]) // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= times * n
        bins.append((times, dict(used)))
    return bins


def pack(scratch: Scratch, parts: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``parts`` (with a ``length`` of at most ``sequence``) with sequence_id and offset."""
    parts = scratch.table(parts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    buckets = 1 + parts.count() // BUCKET_ROWS
    parts = parts.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = parts.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    over = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("length", "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("ahead"))
    near = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = parts.withColumn("rank", F.row_number().over(near) - 1).join(ahead, ["length", "bucket"]) \
        .withColumn("rank", F.col("rank") + F.col("ahead")).drop("ahead", "bucket", "row")
    # at most one row per length: bounded by the sequence, not by the data
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    key, first, times, offset, taken, number = [], [], [], [], {}, 0
    for n, used in plan(histogram, sequence):
        place = 0
        for length, copies in sorted(used.items(), reverse=True):
            rank = taken.get(length, 0)
            key.append((length, rank))
            first.append(number)
            times.append(n)
            offset.append(place)
            taken[length] = rank + copies * n
            place += copies * length
        number += n
    order = sorted(range(len(key)), key=key.__getitem__)
    at = np.array([key[i] for i in order], np.int64).reshape(-1, 2)
    first, times, offset = (np.array(x, np.int64)[order] if order else np.zeros(0, np.int64)
                            for x in (first, times, offset))
    span = np.int64(1) << 48                                  # over any rank

    def place_all(frames):
        starts = at[:, 0] * span + at[:, 1]
        for f in frames:
            length, rank = f["length"].to_numpy(), f["rank"].to_numpy()
            i = np.searchsorted(starts, length * span + rank, "right") - 1
            copy, which = np.divmod(rank - at[i, 1], times[i])
            yield f.drop(columns="rank").assign(sequence_id=first[i] + which, offset=offset[i] + copy * length)
    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInPandas(place_all, schema)


def packed_ids(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, of pieces packed with their ids."""
    return packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p")) \
        .select("sequence_id", F.expr("aggregate(p, cast('' as binary), (s, x) -> concat(s, x.ids))").alias("ids"))
