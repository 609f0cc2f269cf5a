"""Toxicity of texts restored by noisy-channel decoding (operator 9).

A character trigram model is counted over all documents. Stretches that may be disguised (every token of
letters and signs or digits, letters drawn out, letters or signs set apart) become lattices: each sign may
stand for some letters or for itself, a run of one letter for one or two, separators between single letters
for themselves or for nothing. Viterbi search over the whole stretch finds the likeliest letters under the model; a stretch without a choice is its own
decoding, so only the others are searched. The restored words are then scored: smoothed log-odds of
word and word-start hashes, learned from one half of the sample, are summed up for each text and
calibrated by a logistic regression on the other half. The sample is at most ``SAMPLE`` labelled
documents, one row of each id, read in whole; the tasks reduce it to counts of hash buckets and to a few
statistics of each text, so no text reaches the driver.

Defined cases: null and empty texts get the score of a text without any word; without labelled rows
(or with one class) every score is the share of label 1, or 0.0 without any; an id with several labels has
the largest one; repeated rows get equal scores. Labels, language, source and id are no inputs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textarrays as T
from .quality import training_rows

SAMPLE = 12_000                               # labelled texts that the fit may read
BITS = 20                                     # buckets of word hashes
MIN_TEXTS = 3                                 # labelled texts that a bucket needs
REMEMBERED = 64                               # characters of the longest stretch whose decoding is kept
LITERAL = -12.0                               # log cost of a sign that stands for itself

# Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l"}
SIGNS = "".join(LEET)
_S = re.escape(SIGNS).replace("-", r"\-")
_L, _D = r"[^\W\d_]", rf"[\d{_S}]"            # a letter; a digit or other sign
_X = rf"(?:{_L}|{_D})"
_APART = rf"(?<![^\W_]){_X}(?P<sep>[ .*_\-]){_X}(?:(?P=sep){_X})+(?![^\W_])"
_MIXED = rf"(?<!{_L})(?<!{_D})(?:{_L}++{_D}|{_D}++{_L}){_X}*+"
_DRAWN = rf"(?<!{_L}){_L}*({_L})\2\2{_L}*"
_SUSPECT = re.compile(rf"(?:{_APART})|(?:{_MIXED})|(?:{_DRAWN})")

# 64 symbols: 0 for no letter, a to z, and 32 classes of bytes above 127.
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:256] = 27 + np.arange(128) % 32
SYMBOLS = 64


def trigrams(texts: list[bytes]) -> np.ndarray:
    """Counts of byte-class trigrams, case folded, over all texts."""
    total = np.zeros(SYMBOLS ** 3, np.int64)
    for data, _, _ in T.groups(texts):
        s = _SYMBOL[data]
        s = np.concatenate(([0], s))
        total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3)
    return total


def language_model(docs: DataFrame, text_col: Column) -> np.ndarray:
    """log P(c | a, b) over the whole corpus; the counts are bounded by 64^3 classes."""
    def count(batches):
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                total += trigrams([t.as_py() or b"" for t in b.column("text").slice(i, 256).cast(pa.binary())])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["gram", "n"])
    rows = docs.select(text_col.alias("text")).mapInArrow(count, "gram long, n long") \
        .groupBy("gram").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(SYMBOLS ** 3)
    for r in rows:
        n[r["gram"]] = r["n"]
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = n.sum((0, 1)) + 1.0
    one /= one.sum()
    two = (n.sum(0) + 5 * one) / (n.sum(0).sum(1, keepdims=True) + 5)
    return np.log((n + 5 * two) / (n.sum(2, keepdims=True) + 5)).astype(np.float32)


def _lattice(stretch: str) -> Iterator[list[tuple[str, float]]]:
    """Per unit of the stretch: its readings (letters, log cost); a sign may also stand for itself."""
    i = 0
    apart = len(stretch) > 4 and all(not c.isalpha() and c not in SIGNS for c in stretch[1::2])
    while i < len(stretch):
        c = stretch[i]
        j = i
        while j < len(stretch) and stretch[j] == c:
            j += 1
        if c in LEET:
            letters = [(x, -1.0) for x in LEET[c]] + ([("", -4.0)] if c in "!|+(" else [])
            if j - i < 3:
                yield from [[*letters, (c, LITERAL)]] * (j - i)
            else:
                yield [*letters, *[(x + x, -1.2) for x in LEET[c]], (c * (j - i), LITERAL)]
        elif c.isalpha():
            yield [(c * (j - i), 0.0)] if j - i < 3 else [(c, -0.5), (c + c, -0.7)]
        else:
            yield [("", 0.0), (c, 0.0)] if apart and i % 2 else [(c, 0.0)]
        i = j


def decode(stretch: str, lm: np.ndarray) -> str:
    """Likeliest letters of a whole stretch: Viterbi over the last two symbols. Paths are linked lists;
    where one state is left, its path is settled and let go."""
    done, states = [], {(0, 0): (0.0, None)}
    for readings in chain(_lattice(stretch.lower()), [[(" ", 0.0)]]):
        coded = [(letters, cost, _SYMBOL[list(letters.encode()[:8])].tolist()) for letters, cost in readings]
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, path) in states.items():
            for letters, cost, symbols in coded:
                p, q, s = a, b, score + cost
                for c in symbols if symbols[:1] != [0] else symbols[:2]:   # a run of signs counts as two
                    s += float(lm[p, q, c])
                    p, q = q, c
                if (p, q) not in step or step[p, q][0] < s:
                    step[p, q] = (s, (path, letters))
        if len(step) == 1:
            (state, (score, path)), = step.items()
            done.append(_letters(path))
            step = {state: (score, None)}
        states = step
    return ("".join(done) + _letters(max(states.values(), key=lambda s: s[0])[1]))[:-1]


def _letters(path: tuple | None) -> str:
    out = []
    while path is not None:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out))


class Restorer:
    """Restores texts; remembers decoded stretches."""

    def __init__(self, lm: np.ndarray):
        self.lm, self.known = lm, {}

    def _one(self, match) -> str:
        stretch = match.group()
        if len(stretch) > REMEMBERED:
            return decode(stretch, self.lm)
        if stretch not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[stretch] = decode(stretch, self.lm)
        return self.known[stretch]

    def __call__(self, text: str) -> str:
        return _SUSPECT.sub(self._one, text) if _worth(text) else text


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in SIGNS if ord(c) < 128]] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(b" .*_-")] = True


def _worth(text: str) -> bool:
    """Whether any stretch can match: necessary conditions on the bytes of an ASCII text."""
    if not text.isascii():
        return True
    b = np.frombuffer(text.encode(), np.uint8)
    if len(b) < 2:
        return False
    letter, sign = _LETTER[b], _SIGN[b]
    if ((sign[:-1] & letter[1:]) | (letter[:-1] & sign[1:])).any():
        return True
    fold = b | 32
    if (letter[2:] & (fold[2:] == fold[1:-1]) & (fold[1:-1] == fold[:-2])).any():
        return True
    some, part = letter | sign, _SEPARATOR[b]
    return bool((some[:-4] & part[1:-3] & some[2:-2] & part[3:-1] & some[4:]).any())


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of every word and of its starts of 4, 5 and 6 bytes."""
    owners, buckets = [], []
    for data, starts, owner in T.groups(texts):
        ws, we = T.words(_LETTER[data])
        if not len(ws):
            continue
        own = owner[np.searchsorted(starts, ws, "right") - 1]
        ends = [we] + [np.minimum(ws + k, we) for k in (4, 5, 6)]
        found = T.hashes(data, ws, ends)
        cols = [h ^ np.uint64(0x5851F42D4C957F2D * k % (1 << 64)) for k, h in enumerate(found)]
        owners.append(own)
        buckets.append(np.stack([(c >> np.uint64(64 - BITS)).astype(np.int64) for c in cols], 1))
    if not owners:
        return np.zeros(0, np.int64), np.zeros((0, 4), np.int64)
    return np.concatenate(owners), np.concatenate(buckets)


@dataclass
class Model:
    lm: np.ndarray
    weight: np.ndarray | None = None
    line: np.ndarray | None = None
    constant: float = 0.0
    _restore: Restorer | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_restore": None}

    def restored(self, texts: list[bytes]) -> list[bytes]:
        self._restore = self._restore or Restorer(self.lm)
        return [self._restore(t.decode("utf-8", "replace").lower()).encode() for t in texts]

    def statistics(self, texts: list[bytes]) -> np.ndarray:
        """Per text: strong words, their share, the weight over all words, and the strongest one."""
        owner, bucket = features(self.restored(texts))
        n = len(texts)
        w = self.weight[bucket].max(1) if len(bucket) else np.zeros(0)
        words = np.bincount(owner, minlength=n)
        out = []
        for least in (1.5, 3.0):
            hits = np.bincount(owner[w > least], minlength=n)
            out += [np.log1p(hits), 100 * hits / np.maximum(words, 1)]
        top = np.zeros(n)
        np.maximum.at(top, owner, w)
        mean = np.bincount(owner, np.maximum(w, 0), n) / np.maximum(words, 1)
        return np.stack([*out, top, mean, np.minimum(out[1], 2.0), np.minimum(out[3], 2.0), np.ones(n)], 1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.weight is None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.statistics(texts) @ self.line, -30, 30)))


def bucket_counts(rows: DataFrame, model: Model) -> np.ndarray:
    """(half, label, bucket) counts of the sample's texts that have a bucket; the last bucket counts all."""
    def run(batches):
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column("text").cast(pa.binary())]
            total: dict[tuple, np.ndarray] = {}
            for half, y, clean in zip(b.column("half").to_pylist(), b.column("y").to_pylist(), model.restored(texts)):
                at = np.append(np.unique(features([clean])[1]), 1 << BITS)
                total.setdefault((half, y), np.zeros((1 << BITS) + 1, np.int64))[at] += 1
            for (half, y), n in total.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), half, np.int32)), pa.array(np.full(len(at), y, np.int32)), pa.array(at), pa.array(n[at])],
                    ["half", "y", "bucket", "n"])
    sums = rows.select("text", "half", "y").mapInArrow(run, "half int, y int, bucket long, n long") \
        .groupBy("half", "y", "bucket").agg(F.sum("n").alias("n")).toArrow()        # four counts a bucket at most
    out = np.zeros((2, 2, (1 << BITS) + 1), np.int64)
    out[tuple(sums.column(c).to_numpy() for c in ("half", "y", "bucket"))] = sums.column("n").to_numpy()
    return out


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of each bucket from (label, bucket) counts."""
    (neg, pos), (b, a) = counts[:, :-1], np.maximum(counts[:, -1], 1)
    ratio = np.log((pos + 0.2) / (a + 0.4)) - np.log((neg + 0.2) / (b + 0.4))
    return np.where(pos + neg >= MIN_TEXTS, ratio, 0.0).astype(np.float32)


def sample_statistics(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the texts of the second half, ordered so that any order of tasks gives one model."""
    def run(batches):
        for b in batches:
            x = model.statistics([t.as_py() or b"" for t in b.column("text").cast(pa.binary())])
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([r.tobytes() for r in x], pa.binary())], ["y", "x"])
    got = rows.filter("half = 1").select("text", "y").mapInArrow(run, "y int, x binary").collect()   # a few numbers a text
    got.sort(key=lambda r: (r["y"], bytes(r["x"])))
    return np.array([np.frombuffer(bytes(r["x"])) for r in got]), np.array([r["y"] for r in got])


def calibrated(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Newton steps of a ridge regression of the labels on the statistics."""
    line = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        g = x.T @ (p - t) + 0.05 * line
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.05 * np.eye(len(line))
        step = np.linalg.solve(h, g)
        line -= step
        if np.abs(step).max() < 1e-6:
            break
    return line


def train(docs: DataFrame, id_col: Column, text_col: Column, labels: DataFrame, label: Column,
          sample: int = SAMPLE) -> Model:
    """Log-odds from one half of the sample, calibration on the other, then log-odds from all."""
    model = Model(language_model(docs, text_col))
    rows = training_rows(docs, id_col, text_col, labels, label, sample) \
        .withColumn("half", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(2)).cast("int")) \
        .withColumn("y", (F.col("y") > 0).cast("int"))
    counts = bucket_counts(rows, model)
    texts = counts[:, :, -1]                                   # by half and label
    if not texts.sum(0).all():
        model.constant = float(texts[:, 1].sum() / texts.sum()) if texts.any() else 0.0
        return model
    model.weight = log_odds(counts[0])
    x, t = sample_statistics(rows, model)
    model.line = calibrated(x, t) if len(x) else np.zeros(9)
    model.weight = log_odds(counts.sum(0))
    return model
