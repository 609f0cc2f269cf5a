"""The maximum-entropy language model: counts and base scores by brute force, its probabilities sum to
one, its gradient, and held-out texts."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wideloom.llm import language_model as lm
from wideloom.llm import queries
from wideloom.llm.common import Scratch

SCHEMA = "doc_id long, text string, score double, row string, held_out int"
LONG = " ".join(f"Word{i % 83} x{i % 7}" for i in range(4000))


def rows():
    rng = random.Random(2)
    out = [(0, None), (1, ""), (2, " \t\n"), (3, LONG), (4, "ÜBER über A a\tB"), (None, "one two"), (None, "one two"), (7, "z" * 9000)]
    for i in range(300):
        word, text = rng.randrange(40), []
        for _ in range(rng.randint(1, 60)):                       # a chain: the last word says much of the next
            word = (word * 7 + rng.choice((1, 2))) % 40
            text.append(f"W{word}" if rng.random() < 0.95 else f"rare{rng.randrange(10**6)}")
        out.append((10 + i, " ".join(text)))
    return out


def write(spark, path, data, parts=3):
    spark.createDataFrame([(i, t, 1.0, "x", 2) for i, t in data], SCHEMA).repartition(parts) \
        .write.parquet(str(path / "documents.parquet"))


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["\n"]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


@pytest.mark.parametrize("known", [1 << 18, 20])
def test_base_scores_and_counts(spark, tmp_path, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    monkeypatch.setattr(lm, "HEAD", min(known, 64))
    write(spark, tmp_path, rows())
    got = queries.QUERIES["op12_maxent_lm"](spark, str(tmp_path)).collect()
    c = collections.Counter(w for i, t in rows() if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in rows())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 50


def test_texts_do_not_depend_on_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in rows()], "doc_id long, text string").coalesce(1)
    scratch = Scratch(spark, "test")
    counts, model = lm.train(scratch, docs, F.col("text"), F.lit(True))

    def run(name):
        return sorted((r.n_tokens, round(r.base_score, 6), round(r.score, 3)) for r in lm.scored(
            Scratch(spark, name), docs, F.col("doc_id"), F.col("text"), counts, model).collect())
    whole = run("a")
    monkeypatch.setattr(lm, "SLICE_BYTES", 50)
    monkeypatch.setattr(lm, "BATCH", 13)
    assert run("b") == whole


def test_words_and_histories():
    texts = pa.array(["", None, " A\x0bb \x1c\tÜB\n", "a b a b", "x" * 70])
    size, place, kinds = lm.words(texts.fill_null(""))
    split = [words(t.as_py())[:-1] for t in texts]
    assert size.tolist() == [len(w) for w in split]
    assert [kinds[i].as_py().decode() for i in place.tolist()] == [w for ws in split for w in ws]
    assert [len(t) for _, t in lm.slices(texts, 20)] == [4, 1] and [a for a, _ in lm.slices(texts.slice(2), 20)] == [0, 2]
    v = lm.Vocabulary(pa.array([b"x", b"a"], pa.large_binary()), pa.array([b"b", b"\n"], pa.large_binary()), np.array([7, 9]))
    owner, at, before = v.read(texts.slice(2, 2).cast(pa.large_string()))
    line = [w.encode() for t in split[2:4] for w in [*t, "\n"]]
    assert [v.kinds[i].as_py() for i in at.tolist()] == line and owner.tolist() == [0] * (len(split[2]) + 1) + [1] * 5
    assert v.head[at].tolist() == [1 if w == b"a" else -1 for w in line]
    assert v.count[at].tolist() == [{b"b": 7, b"\n": 9}.get(w, 0) for w in line]
    past = [([b"\n"] * 3 + [w.encode() for w in t])[i:i + 3][::-1] for t in split[2:4] for i in range(len(t) + 1)]
    assert [[h[i] for h in before] for i in range(len(line))] == [hash_of(p).tolist() for p in past]


def hash_of(ws):
    return lm.hashes(pa.array(ws, pa.large_binary()))


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, t) for i, t in rows()], "doc_id long, text string")
    counts, model = lm.train(Scratch(spark, "test"), docs, F.col("text"), F.lit(True))
    head = set(model.head.to_pylist())
    rare = [c for w, c in zip(counts.known.to_pylist(), counts.counts.tolist()) if w not in head]
    assert math.isclose(sum(c + 1 for c in rare) + 1, model.rare_total)
    assert sorted(set(model.group.tolist())) == list(range(len(model.bias) - 1))
    before = [hash_of(p) for p in ([b"w1", b"never"], [b"w2", b"x"], [lm.END, b"y"])]
    classes = np.exp(model.log_classes(lm.features(before)))
    inside = np.exp(model.inside[lm.bucket(before)])
    for k in range(2):
        assert math.isclose(sum(classes[k, model.group] * inside[k]) + classes[k, -1], 1, rel_tol=1e-4)


def test_update_follows_the_gradient():
    rng = np.random.default_rng(1)
    rows_, y = rng.integers(0, 6, (50, 4)).astype(np.uint16), rng.integers(0, 3, 50)
    w = rng.normal(0, 0.5, (lm.ROWS + 1, 3))

    def loss(w):
        z = w[rows_].sum(1) + w[-1]
        return (np.log(np.exp(z).sum(1)) - z[np.arange(50), y]).sum() + lm.DECAY / 2 * (np.bincount(rows_.ravel())[:, None] * w[:6] ** 2).sum()
    after, sums, met = w.copy(), np.ones_like(w), np.zeros(lm.ROWS + 1)
    lm._update(after, sums, met, rows_, y)
    g = (w - after) * np.sqrt(sums) / lm.RATE
    for at in ((0, 0), (3, 2), (5, 1), (lm.ROWS, 0)):
        up, down = w.copy(), w.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        assert math.isclose((loss(up) - loss(down)) / 2e-5, g[at], rel_tol=1e-3, abs_tol=1e-5)
    assert met[-1] == 50 and met[:6].sum() == 200


def test_no_training_documents_and_empty_table(spark, tmp_path):
    nobody = [(i, "some words") for i in range(200) if held(i)][:3]
    write(spark, tmp_path, nobody, 1)
    got = queries.QUERIES["op12_maxent_lm"](spark, str(tmp_path)).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(True, 3, 0, 0, 0.0, 0.0)] * 3
    none = spark.createDataFrame([], SCHEMA)
    counts, model = lm.train(Scratch(spark, "test"), none, F.col("text"), F.lit(True))
    assert lm.scored(Scratch(spark, "test"), none, F.col("doc_id"), F.col("text"), counts, model).collect() == []
