"""Quality by attention-based multiple-instance learning (operator 5).

A document is a bag of passages (about 50 words each); every passage of every text is encoded: shares
of byte classes, word lengths, repeated and distinct words. Gated attention weights are learned from
document labels alone (no passage has a label), and the weighted passage representation is scored:

    h = tanh(x W + b),  a = softmax(w . (tanh(h V) * sigmoid(h U))),  score = sigmoid(c . sum a h + d)

The fit runs over a sample of at most ``SAMPLE`` labelled documents, one row of each id, and reads all
of their passages; scoring reads every passage of every text.

Defined cases: null and empty texts have no passage and get the score of an empty bag; without
labelled rows (or with one class only) every score is the share of label 1, or 0.5 without any; an id with
several labels has the largest one, and of its rows the one whose text has the least hash is read;
repeated rows get equal scores. A byte counts only for passages of its own text (a block of 1 MB of a
text that is white space only has no passage). Labels, language, source and id are no inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import textarrays as T

PASSAGE_WORDS = 50
SAMPLE = 4000
HIDDEN, GATE = 16, 8
EPOCHS, RATE, DECAY = 60, 0.02, 1e-4

# Byte classes: every ASCII sign its own, letters by case, digits, line feed, other space, high bytes.
_CLASS = np.zeros(256, np.int64)
_signs = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_signs] = np.arange(len(_signs))
for _k, _set in enumerate((range(48, 58), range(65, 91), range(97, 123), (10,), (9, 11, 12, 13, 32), range(128, 256))):
    _CLASS[list(_set)] = len(_signs) + _k
_OTHER = len(_signs) + 6
_CLASS[[*range(9), *range(14, 32), 127]] = _OTHER
CLASSES = _OTHER + 1
FEATURES = CLASSES + 5


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, features) of all passages of all texts."""
    owners, rows = [], []
    for data, starts, owner in T.groups(texts):
        ws, we = T.words(~T.SPACE[data])
        if not len(ws):
            continue
        block = np.searchsorted(starts, ws, "right") - 1
        at = np.arange(len(ws)) - np.searchsorted(block, block)
        new = at % PASSAGE_WORDS == 0
        passage = np.cumsum(new) - 1
        first = ws[new]
        n = len(first)
        # a passage's bytes: up to the next one of its block; the first and last reach the block's ends
        part = block[new]
        head = np.concatenate(([True], part[1:] != part[:-1]))
        stops = np.append(starts[1:], len(data)) - 1
        begin = np.where(head, starts[part], first)
        end = np.append(np.where(head[1:], stops[part[:-1]], begin[1:]), stops[part[-1]])
        inside = np.zeros(len(data), np.int8)
        inside[starts[part[head]]] = 1
        inside[stops[part[head]]] = -1
        place = np.repeat(np.arange(n), end - begin)
        kind = _CLASS[data[np.cumsum(inside, dtype=np.int8).view(bool)]]
        hist = np.bincount(place * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
        x = np.zeros((n, FEATURES), np.float32)
        x[:, :CLASSES] = np.sqrt(hist / np.maximum(hist.sum(1, keepdims=True), 1))
        size = (we - ws).astype(np.float64)
        count = np.bincount(passage, minlength=n)
        mean = np.bincount(passage, size, n) / count
        spread = np.sqrt(np.maximum(np.bincount(passage, size * size, n) / count - mean * mean, 0))
        word, = T.hashes(data, ws, [we])
        again = np.zeros(len(ws))
        again[1:] = (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])
        key = np.sort(passage.astype(np.uint64) << np.uint64(40) | word >> np.uint64(24))
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        kinds = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)
        x[:, CLASSES:] = np.stack([np.log1p(mean), np.log1p(spread), np.bincount(passage, again, n) / count,
                                   kinds / count, np.log1p(count)], 1)
        owners.append(owner[block[new]])
        rows.append(x)
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, FEATURES), np.float32)
    return np.concatenate(owners), np.concatenate(rows)


@dataclass
class Model:
    """Standardisation and weights; small, sent to the tasks with the function that scores."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] | None
    constant: float = 0.5

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.constant)
        owner, x = passages(texts)
        return _forward(self.weights, self._scaled(x), owner, len(texts))[0]

    def _scaled(self, x):
        return (x - self.mean) / self.scale


def _reduce(values, owner, n):
    if values.ndim == 1:
        return np.bincount(owner, values, n)
    return np.stack([np.bincount(owner, values[:, k], n) for k in range(values.shape[1])], 1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w, x, owner, n):
    h = np.tanh(x @ w["W"] + w["b"])
    v, u = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    s = (v * u) @ w["w"]
    top = np.full(n, -np.inf)
    np.maximum.at(top, owner, s)
    e = np.exp(s - top[owner])
    a = e / np.maximum(_reduce(e, owner, n), 1e-30)[owner]
    z = _reduce(a[:, None] * h, owner, n)
    return _sigmoid(z @ w["c"] + w["d"]), h, v, u, a, z


def _gradient(w, x, owner, y):
    n = len(y)
    p, h, v, u, a, z = _forward(w, x, owner, n)
    do = (p - y) / n
    dz = (do[:, None] * w["c"])[owner]
    da = (dz * h).sum(1)
    ds = a * (da - _reduce(a * da, owner, n)[owner])
    gate = ds[:, None] * w["w"]
    dv, du = gate * u * (1 - v * v), gate * v * u * (1 - u)
    dh = a[:, None] * dz + dv @ w["V"].T + du @ w["U"].T
    pre = dh * (1 - h * h)
    return {"W": x.T @ pre, "b": pre.sum(0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ ds,
            "c": z.T @ do, "d": do.sum()}


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Adam over shuffled batches of bags."""
    y = np.asarray(labels, float)
    x = np.concatenate([np.zeros((0, FEATURES), np.float32), *bags])
    if not len(x) or not 0 < y.mean() < 1:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), None, float(y.mean()) if len(y) else 0.5)
    model = Model(x.mean(0), x.std(0) + 1e-3, None)
    bags = [model._scaled(b) for b in bags]
    rng = np.random.default_rng(seed)
    share = y.mean()
    w = {"W": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
         "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "w": rng.normal(0, GATE ** -0.5, GATE), "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN),
         "d": np.array(np.log(share / (1 - share)))}
    m, s, t = {k: np.zeros_like(g) for k, g in w.items()}, {k: np.zeros_like(g) for k, g in w.items()}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for part in np.array_split(order, max(1, len(bags) // 256)):
            owner = np.repeat(np.arange(len(part)), [len(bags[i]) for i in part])
            g = _gradient(w, np.concatenate([bags[i] for i in part]), owner, y[part])
            t += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k in w:
                g[k] = g[k] + DECAY * w[k] * (k != "d")
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                w[k] = w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.999 ** t)) + 1e-8)
    model.weights = w
    return model


def training_rows(docs: DataFrame, id_col: Column, text_col: Column, labels: DataFrame, label: Column,
                  sample: int = SAMPLE) -> DataFrame:
    """(id, text, y) of at most ``sample`` labelled documents that are not held out, by a hash of the id;
    one row per id, however often it comes."""
    ids = labels.select(F.col("doc_id").alias("id"), label.cast("int").alias("y")) \
        .filter("y IS NOT NULL AND id IS NOT NULL") \
        .filter(F.crc32(F.col("id").cast("string")) % 3 != 1).groupBy("id").agg(F.max("y").alias("y"))
    picked = ids.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(id_col.alias("id"), text_col.alias("text")).join(F.broadcast(picked), "id")
    return rows.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("id", "text", "y")


def train(docs: DataFrame, id_col: Column, text_col: Column, labels: DataFrame, label: Column,
          sample: int = SAMPLE) -> Model:
    rows = training_rows(docs, id_col, text_col, labels, label, sample)

    def encode(batches):
        for b in batches:
            texts = [t.as_py() or b"" for t in b.column("text").cast(pa.binary())]
            owner, x = passages(texts)
            cut = np.searchsorted(owner, np.arange(len(texts) + 1))
            out = [x[i:j].astype("<f4").tobytes() for i, j in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(out, pa.binary())], ["y", "x"])
    got = rows.select("text", "y").mapInArrow(encode, "y int, x binary").collect()   # features of ``sample`` texts
    got.sort(key=lambda r: (r["y"], bytes(r["x"])))                 # any order of tasks gives one model
    bags = [np.frombuffer(bytes(r["x"]), "<f4").reshape(-1, FEATURES) for r in got]
    return fit(bags, np.array([r["y"] for r in got]))


def scored(docs: DataFrame, id_col: Column, text_col: Column, model, keep: Column | None = None) -> DataFrame:
    """doc_id (or the column ``keep``) and score of every whole text."""
    src = docs.select((id_col if keep is None else keep).alias("doc_id"), text_col.alias("text"))
    schema = StructType([src.schema["doc_id"], StructField("score", DoubleType())])

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = [t.as_py() or b"" for t in part.column("text").cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.score(texts), pa.float64())], ["doc_id", "score"])
    return src.mapInArrow(run, schema)
