"""Hashed maximum-entropy language model (operator 12).

Texts are lower-cased (A-Z) words and one end token each. A token's probability given the three before it
is class-factored: P(w | h) = P(class(w) | h) * P(w | class(w), h).

* P(class | h) is a softmax over ``CLASSES`` classes of a sum of hashed features of the history: the last
  word, the one before (skip), both together, and the last with the third (skip pair).
* Inside a class the softmax has a bias for each word and a weight for each hashed last word and word.
* Words rarer than the ``HEAD`` most frequent ones, unknown ones among them, are the last class; inside
  it a word has probability (count + 1) / (tokens + words + 1), so unknown words share one event.

All counts are exact and cover all training documents. They are made in partial sums by each task, summed
by shuffles, and only tables of fixed size reach the driver: the head's words, the (last word's bucket,
word) counts, and the weights. The classes are k-means groups of the head's words by the buckets before
them. The class softmax is fitted by distributed gradient updates: in each round every task follows the
gradient over its own share of the round's documents in batches, and the weights are averaged, each row by
how often tasks met its feature. The model inside the classes is fitted by gradient steps on its sums.

Counts of words outside the ``KNOWN`` most frequent ones are never broadcast: a text's rare words are
joined to the table of counts.

Defined cases: null, empty and white-space texts are one end token; without training documents every
count is 0 and both scores of a text are 0; repeated rows are documents of their own and count as often as
they come; a null id counts as empty text when the training documents are chosen; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textarrays as T
from .common import Scratch

HEAD, KNOWN, LEAST_COUNT = 8192, 1 << 18, 3
BUCKETS = 256                                  # of the last word, inside the classes
CLASSES, ROWS = 32, 1 << 15                    # the last class holds the rare words; hashed feature rows
ROUNDS, BATCH, RATE, DECAY = 2, 16384, 0.15, 1e-6
TASK_TOKENS = 1 << 21                          # training tokens that are worth a set of weights
SLICE_BYTES = 1 << 21                          # of texts split at once
END = b"\n"                                    # no word holds white space
_BLOCK_ROWS = 256
_SALT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def slices(texts: pa.Array, size: int | None = None):
    """(number of the first text, texts) of runs of whole texts of about ``size`` bytes."""
    size = SLICE_BYTES if size is None else size
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:][1:len(texts) + 1]
    at = 0
    while at < len(texts):
        start = ends[at - 1] if at else np.frombuffer(texts.buffers()[1], np.int64)[texts.offset]
        to = max(at + 1, int(np.searchsorted(ends, start + size, "right")))
        yield at, texts.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of words of each text, and all words as places in an array of the different ones."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    own = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    kinds, place = coded.dictionary.cast(pa.large_binary()), coded.indices.to_numpy()
    empty = pc.index(kinds, pa.scalar(b"", pa.large_binary())).as_py()
    if empty >= 0:                                         # before leading and after trailing white space
        keep = place != empty
        own, place = own[keep], place[keep]
    return np.bincount(own, minlength=len(texts)), place, kinds


def hashes(kinds: pa.Array) -> np.ndarray:
    """Stable 64-bit hashes of words."""
    ends = np.frombuffer(kinds.buffers()[1], np.int64)[kinds.offset:][:len(kinds) + 1]
    data = np.frombuffer(kinds.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return T.hashes(data, ends[:-1] - ends[0], [ends[1:] - ends[0]])[0]


class Vocabulary:
    """The tables that words are looked up in: the head's words, and the known words with their counts."""

    def __init__(self, head: pa.Array, known: pa.Array | None = None, counts: np.ndarray | None = None):
        self.heads, self.known, self.counts = head, known, counts

    def _look_up(self, table: pa.Array) -> np.ndarray:
        return pc.index_in(self.kinds, value_set=table).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def read(self, texts: pa.Array):
        """(text number, word place, hashes of the three tokens before) of all tokens of an array of texts,
        an end token after each. ``kinds``, ``head`` (the head's number, or -1) and ``count`` (of known words,
        else 0) hold what the places stand for."""
        size, place, kinds = words(texts)
        self.kinds = pa.concat_arrays([kinds, pa.array([END], pa.large_binary())])
        self.head = self._look_up(self.heads)
        if self.known is not None:
            self.count = np.append(self.counts, 0)[self._look_up(self.known)]
        # per text: three ends as the history of its start, its words, an end
        first = np.cumsum(size + 4) - size - 1
        line = np.full(int(size.sum()) + 4 * len(size), len(kinds), np.int64)
        line[np.arange(len(place)) + np.repeat(first - (np.cumsum(size) - size), size)] = place
        owner = np.repeat(np.arange(len(size)), size + 1)
        at = np.arange(len(owner)) + 3 * (owner + 1)
        line_hash = hashes(self.kinds)[line]
        return owner, line[at], [line_hash[at - k] for k in (1, 2, 3)]


def features(before) -> np.ndarray:
    """(tokens, 4) rows of the class softmax: last word, skip, last two, skip pair."""
    one, two, three = before
    with np.errstate(over="ignore"):
        keys = np.stack([one * _SALT[0], two * _SALT[1], (one * _SALT[0] ^ two) * _SALT[2],
                         (one * _SALT[1] ^ three) * _SALT[3]], 1)
    keys ^= keys >> np.uint64(32)
    return (keys % np.uint64(ROWS)).astype(np.uint16)


def bucket(before) -> np.ndarray:
    return (before[0] >> np.uint64(17)).astype(np.int64) % BUCKETS


# ---------------------------------------------------------------- sums over all tasks

def summed(parts: DataFrame, kind: str, fan: int = 16) -> DataFrame:
    """(block int, part int, data binary) to one row for each block: arrays of one number type, added.
    Two levels, so that no task reads more than about ``fan`` or the root of all partial sums; streamed."""
    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for block, data in zip(b.column("block").to_pylist(), b.column("data").to_pylist()):
                new = np.frombuffer(data, kind)
                if block in held:
                    held[block] += new
                else:
                    held[block] = new.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())],
                                         ["block", "data"])
    schema = "block int, data binary"
    first = parts.withColumn("part", F.floor(F.col("part") / fan)).repartition("block", "part") \
        .select("block", "data").mapInArrow(add, schema)
    return first.repartition("block").mapInArrow(add, schema)


def _numbered(name: str, blocks) -> pa.RecordBatch:
    from pyspark import TaskContext
    at = list(blocks)
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in at], pa.int32()), pa.array([TaskContext.get().partitionId()] * len(at), pa.int32()),
         pa.array([d for _, d in at], pa.binary())], ["block", "part", name])


# ---------------------------------------------------------------- exact counts

def word_counts(texts: DataFrame) -> DataFrame:
    """(word binary, n) of all tokens of ``texts(text)``; partial counts of slices of texts, then of tasks."""
    def run(batches):
        for b in batches:
            for _, part in slices(b.column("text"), 4 * SLICE_BYTES):
                _, place, kinds = words(part)
                n = np.append(np.bincount(place, minlength=len(kinds)), len(part))
                kinds = pa.concat_arrays([kinds, pa.array([END], pa.large_binary())])
                yield pa.RecordBatch.from_arrays([kinds.filter(pa.array(n > 0)).cast(pa.binary()), pa.array(n[n > 0])], ["word", "n"])
    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Counts:
    """Exact counts: ``table`` (word, n), its size, and the most frequent words (bounded)."""
    table: DataFrame
    tokens: int
    words: int
    known: pa.Array
    counts: np.ndarray
    head: pa.Array
    in_head: int

    def rare(self) -> DataFrame:
        """The counts of the words that are not in ``known``."""
        if len(self.known) == self.words:
            return self.table.limit(0)
        return self.table.filter(F.col("n") < int(self.counts.min())) if len(self.known) else self.table


def count(scratch: Scratch, texts: DataFrame) -> Counts:
    table = scratch.table(word_counts(texts), "counts")
    # the least count that keeps at most KNOWN words, from a histogram of a fixed number of count classes:
    # nothing is sorted, and no task holds more than its share
    kind = F.floor(F.lit(64) * F.log2("n"))
    kinds = table.groupBy(kind.alias("kind")).agg(F.min("n").alias("least"), F.count("*").alias("words"),
                                                  F.sum("n").alias("tokens")).collect()
    words_, least = 0, None
    for r in sorted(kinds, key=lambda r: -r["kind"]):
        words_ += r["words"]
        if words_ > KNOWN:
            break
        least = r["least"]
    top = table.filter(F.col("n") >= least if least is not None else F.lit(False)).toArrow()       # bounded
    top = top.sort_by([("n", "descending"), ("word", "ascending")])
    known = pa.concat_arrays([pa.array([], pa.large_binary()), *(c.cast(pa.large_binary()) for c in top.column("word").chunks)])
    n = top.column("n").to_numpy()
    heads = min(HEAD, int((n >= LEAST_COUNT).sum()))
    return Counts(table, sum(r["tokens"] for r in kinds), sum(r["words"] for r in kinds), known, n, known[:heads], int(n[:heads].sum()))


# ---------------------------------------------------------------- the model

@dataclass
class Model:
    """Tables of fixed size. ``inside``: log P(word | class, bucket) of the head's words."""
    head: pa.Array
    group: np.ndarray                    # class of each head word
    inside: np.ndarray                   # (buckets, head)
    weights: np.ndarray                  # (feature rows, classes)
    bias: np.ndarray
    rare_total: int                      # tokens + words + 1 of the last class

    def log_classes(self, rows: np.ndarray) -> np.ndarray:
        """Log P(class | h), (tokens, classes)."""
        z = self.weights.take(rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            z += self.weights.take(rows[:, k], axis=0)
        z += self.bias
        z -= z.max(1, keepdims=True)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        return z

    def log_class(self, rows: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Log P(class | h) of one class for each token, in batches that fit a processor's cache."""
        out = np.empty(len(rows))
        for a in range(0, len(rows), BATCH):
            own = group[a:a + BATCH]
            out[a:a + BATCH] = self.log_classes(rows[a:a + BATCH])[np.arange(len(own)), own]
        return out


def pair_counts(texts: DataFrame, head: pa.Array) -> np.ndarray:
    """(buckets, head) counts of (last word's bucket, head word) over all tokens."""
    size = max(len(head), 1)

    def run(batches):
        vocabulary, total = Vocabulary(head), np.zeros(BUCKETS * size, np.int64)
        for b in batches:
            for _, part in slices(b.column("text")):
                _, at, before = vocabulary.read(part)
                own = vocabulary.head[at]
                ok = own >= 0
                total += np.bincount(bucket(before)[ok] * size + own[ok], minlength=len(total))
        rows = total.reshape(BUCKETS, size)
        yield _numbered("data", ((i, r.tobytes()) for i, r in enumerate(rows) if r.any()))
    sums = summed(texts.select("text").mapInArrow(run, "block int, part int, data binary"), "<i8")
    out = np.zeros((BUCKETS, size), np.int64)
    for r in sums.collect():                                                              # of fixed size
        out[r["block"]] = np.frombuffer(bytes(r["data"]), "<i8")
    return out[:, :len(head)]


def groups(pairs: np.ndarray, classes: int, rounds: int = 12) -> np.ndarray:
    """Class of each head word: weighted k-means on the square roots of its shares by bucket, from evenly
    spaced words (of the order by count)."""
    n = pairs.shape[1]
    if n <= classes:
        return np.arange(n)
    x = np.sqrt(pairs.T / np.maximum(pairs.sum(0)[:, None], 1)).astype(np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    mass = np.sqrt(pairs.sum(0))
    centre = x[np.unique(np.geomspace(1, n, classes).astype(int) - 1)]
    if len(centre) < classes:
        centre = x[:classes]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(1)
        for c in range(classes):
            if (own == c).any():
                centre[c] = (x[own == c] * mass[own == c, None]).sum(0)
        centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
    return np.unique((x @ centre.T).argmax(1), return_inverse=True)[1]      # no class is empty


def fit_inside(pairs: np.ndarray, group: np.ndarray, steps: int = 40) -> np.ndarray:
    """Log P(word | class, bucket): softmax inside each class of a bias and a (bucket, word) weight, by
    gradient steps on the sums of all tokens (each weight's step is scaled by its own count)."""
    if not pairs.shape[1]:
        return np.zeros((BUCKETS, 0))
    total = pairs.sum(0).astype(np.float64)
    bias = np.log(total + 0.5)
    weight = np.zeros(pairs.shape, np.float32)
    order = np.argsort(group, kind="stable")
    cut = np.flatnonzero(np.diff(group[order], prepend=-1))
    own = np.repeat(np.arange(len(cut)), np.diff(np.append(cut, len(order))))
    data = pairs[:, order].astype(np.float32)
    seen = np.add.reduceat(data, cut, axis=1)[:, own]         # of the class after the bucket
    base = bias[order].astype(np.float32)

    def log_p():
        z = base + weight
        top = np.maximum.reduceat(z, cut, axis=1)[:, own]
        return z - top - np.log(np.add.reduceat(np.exp(z - top), cut, axis=1))[:, own]
    prior = 3.0                                               # strength of the pull to no weight
    for _ in range(steps):
        p = np.exp(log_p())
        weight += (data - seen * p - prior * weight) / (data + seen * p + prior)
    out = np.empty_like(weight)
    out[:, order] = log_p()
    return out


def train_classes(scratch: Scratch, texts: DataFrame, model: Model, tokens_: int, rounds: int) -> None:
    """Rounds of distributed gradient updates; each round reads its own share of the documents."""
    classes = len(model.bias)
    tasks = max(1, math.ceil(tokens_ / rounds / TASK_TOKENS))
    step = np.full(ROWS + 1, 0.0)                             # how often rows were met in earlier rounds
    for k in range(rounds):
        def run(batches, model=replace(model, inside=None), step=step):
            vocabulary = Vocabulary(model.head)
            group = np.append(model.group, classes - 1).astype(np.int64)     # of -1: the last class
            w = np.vstack([model.weights, model.bias[None]]).astype(np.float32)
            sums = np.repeat(step.astype(np.float32)[:, None] / classes, classes, 1) + np.float32(0.1)
            met = np.zeros(ROWS + 1, np.float32)
            for b in batches:
                for _, part in slices(b.column("text")):
                    _, at, before = vocabulary.read(part)
                    y = group[vocabulary.head[at]]
                    rows = features(before)
                    for a in range(0, len(y), BATCH):
                        _update(w, sums, met, rows[a:a + BATCH], y[a:a + BATCH])
            out = np.concatenate([w * met[:, None], met[:, None]], 1).astype("<f4")
            yield _numbered("data", ((i, out[a:a + _BLOCK_ROWS].tobytes())
                                     for i, a in enumerate(range(0, ROWS + 1, _BLOCK_ROWS))))
        part = texts.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k).select("text")
        part = part.coalesce(tasks)                           # no shuffle: small partitions are read together
        got = np.zeros((ROWS + 1, classes + 1), np.float32)
        for r in summed(part.mapInArrow(run, "block int, part int, data binary"), "<f4").collect():   # of fixed size
            block = np.frombuffer(bytes(r["data"]), "<f4").reshape(-1, classes + 1)
            got[r["block"] * _BLOCK_ROWS:][:len(block)] = block
        met = got[:, -1]
        seen = met > 0
        model.weights = np.where(seen[:-1, None], got[:-1, :-1] / np.maximum(met[:-1, None], 1e-9), model.weights).astype(np.float32)
        if seen[-1]:
            model.bias = (got[-1, :-1] / met[-1]).astype(np.float32)
        step = step + met / max(tasks, 1)


def _update(w, sums, met, rows, y) -> None:
    """One batch: the gradient of the log loss, summed by feature row, with a step size of each weight's own."""
    n, classes = len(y), w.shape[1]
    z = w.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        z += w.take(rows[:, k], axis=0)
    z += w[-1]
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    z[np.arange(n), y] -= 1
    at, count, g = _row_sums(z, rows)
    met[at] += count
    met[-1] += n
    own = w.take(at, axis=0)
    g += (DECAY * count[:, None]).astype(g.dtype) * own
    past = sums.take(at, axis=0)
    past += g * g
    sums[at] = past
    g /= np.sqrt(past, out=past)
    g *= RATE
    own -= g
    w[at] = own
    bias = z.sum(0)
    sums[-1] += bias * bias
    w[-1] -= RATE * bias / np.sqrt(sums[-1])


def _row_sums(z, rows, few: int = 6):
    """(feature rows, how often each is met, sum of its tokens' gradients). Most rows are met once or a few
    times: these are added turn by turn, the rest segment by segment."""
    n = len(z)
    flat = rows.T.ravel()
    order = np.argsort(flat, kind="stable")                   # radix sort of 16-bit numbers
    line = flat[order]
    cut = np.flatnonzero(np.diff(line.astype(np.int32), prepend=-1))
    count = np.diff(np.append(cut, len(flat)))
    order %= n
    g = z.take(order[cut], axis=0)
    for turn in range(1, few):
        more = np.flatnonzero((count > turn) & (count <= few))
        g[more] += z.take(order[cut[more] + turn], axis=0)
    many = count > few
    if many.any():
        inside = np.repeat(many, count)
        first = np.cumsum(count[many]) - count[many]
        g[many] = np.add.reduceat(z.take(order[inside], axis=0), first, axis=0)
    return line[cut], count, g


def train(scratch: Scratch, docs: DataFrame, text_col: Column, training: Column, rounds: int = ROUNDS) -> tuple[Counts, Model]:
    """Counts and model of the documents for which ``training`` holds."""
    texts = docs.filter(training).select(text_col.alias("text"))
    counts = count(scratch, texts)
    tasks = max(1, math.ceil(counts.tokens / TASK_TOKENS))
    pairs = pair_counts(texts.coalesce(tasks), counts.head)
    group = groups(pairs, CLASSES - 1)
    classes = 2 + int(group.max(initial=-1))
    mass = np.bincount(group, pairs.sum(0), classes).astype(np.float64)
    mass[-1] = counts.tokens - counts.in_head
    model = Model(counts.head, group, fit_inside(pairs, group), np.zeros((ROWS, classes), np.float32),
                  np.log((mass + 1) / (mass + 1).sum()).astype(np.float32),
                  counts.tokens - counts.in_head + counts.words - len(counts.head) + 1)
    if counts.tokens:
        train_classes(scratch, texts, model, counts.tokens, rounds)
    return counts, model


# ---------------------------------------------------------------- scores

def partial_scores(docs: DataFrame, counts: Counts, model: Model) -> DataFrame:
    """(row, doc_id, text) to row, doc_id, n_tokens, and what is known without the rare words' counts:
    n_known, base, score; ``rare`` are the words (with how often) whose counts are to be joined."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    total, log_rare = math.log10(counts.tokens + counts.words + 1), math.log10(model.rare_total)
    every = len(counts.known) == counts.words
    shared = docs.sparkSession.sparkContext.broadcast((counts.known, counts.counts, model))     # KNOWN words, fixed tables

    def run(batches):
        known, n_of, m = shared.value
        vocabulary = Vocabulary(m.head, known, n_of)
        group = np.append(m.group, len(m.bias) - 1)                              # of -1: the last class
        for b in batches:
            n = b.num_rows
            n_tokens, n_known, base, score = np.zeros((4, n))
            who, word, times = [], [pa.array([], pa.binary())], []
            for first, part in slices(b.column("text")):
                owner, at, before = vocabulary.read(part)
                owner += first
                c, head = vocabulary.count[at], vocabulary.head[at]
                log_c = np.log10(vocabulary.count + 1)[at]
                own = head >= 0
                z = (log_c - log_rare) * math.log(10)
                z[own] = m.inside[bucket(before)[own], head[own]]
                z += m.log_class(features(before), group[head])
                n_tokens += np.bincount(owner, minlength=n)
                n_known += np.bincount(owner, c > 0, n)
                base += np.bincount(owner, log_c - total, n)
                score += np.bincount(owner, z / math.log(10), n)
                if not every and (c == 0).any():
                    key, often = np.unique(owner[c == 0] << 32 | at[c == 0], return_counts=True)
                    who.append(key >> 32)
                    word.append(vocabulary.kinds.take(pa.array(key & 0xFFFFFFFF)).cast(pa.binary()))
                    times.append(often)
            who = np.concatenate([np.zeros(0, np.int64), *who])                  # ascending: texts come in order
            rare = pa.StructArray.from_arrays([pa.concat_arrays(word), pa.array(
                np.concatenate([np.zeros(0, np.int64), *times]))], ["word", "n"])
            ends = np.searchsorted(who, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(n_tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)),
                 pa.array(base), pa.array(score), pa.ListArray.from_arrays(pa.array(ends), rare)],
                ["row", "doc_id", "n_tokens", "n_known", "base", "score", "rare"])
    return docs.select("row", "doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, n_tokens long, n_known long, base double, score double, "
             "rare array<struct<word:binary,n:bigint>>")


def scored(scratch: Scratch, docs: DataFrame, id_col: Column, text_col: Column, counts: Counts, model: Model,
           keep: Column | None = None) -> DataFrame:
    """doc_id (or ``keep``), n_tokens, n_known, train_tokens, base_score and score of every whole text."""
    src = docs.select(F.monotonically_increasing_id().alias("row"), (id_col if keep is None else keep).alias("doc_id"),
                      text_col.alias("text"))
    found = scratch.table(partial_scores(src, counts, model), "partial")
    more = found.select("row", F.explode("rare").alias("r")).select("row", "r.*") \
        .join(counts.rare().withColumnRenamed("n", "c"), "word") \
        .groupBy("row").agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
    more_of = F.coalesce("more", F.lit(0.0))
    return found.join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(counts.tokens).cast("bigint").alias("train_tokens"), (F.col("base") + more_of).alias("base_score"),
        (F.col("score") + more_of).alias("score"))
