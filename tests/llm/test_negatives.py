"""Hard negatives against a search of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wideloom.llm import negatives, queries
from wideloom.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score long"


def rows(n=260, dims=19, seed=1):
    rng = random.Random(seed)
    out = [(i, [round(rng.gauss(0, 0.4) * 8) / 8 for _ in range(dims)], rng.randrange(3), "x", 1) for i in range(n)]
    out += [(300, None, 1, "x", 1), (350, [0.5] * dims, None, "x", 1), (301, [None] + [0.1] * (dims - 1), 1, "x", 1),
            (302, [float("nan")] * dims, 1, "x", 1), (303, [float("inf")] * dims, 2, "x", 1), (400, [], 1, "x", 1),
            (450, [0.25] * (dims - 4), 2, "x", 1), (None, [0.3] * dims, 1, "x", 1)]
    return out + out[100:104] * 2 + [out[50]]                              # repeated rows, an anchor among them


def plain(data):
    use = []
    for i, v, y, *_ in data:
        if v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        use.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (y + 1) % 10 if i is not None and i % 7 == 0 else y))
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    for k, (i, v, y) in enumerate(use):
        if i is None or i % 50:
            continue
        every = sorted(((sum(a * b for a, b in zip(v, w)), j, m, z) for m, (j, w, z) in enumerate(use) if m != k), key=order)
        for ps, pid, _, _ in [r for r in every if r[3] == y][:5]:
            bad = [r for r in every if r[3] != y and 50 * ps <= 100 * r[0] <= 95 * ps][:3]
            out += [(i, pid, n + 1, r[1], ps, r[0]) for n, r in enumerate(bad)]
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("sizes", [(8192, 1024), (37, 2)])
def test_against_all_pairs(spark, tmp_path, monkeypatch, sizes):
    monkeypatch.setattr(negatives, "CANDIDATE_ROWS", sizes[0])
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", sizes[1])
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.QUERIES["op11_hard_negatives"](spark, str(tmp_path)).collect()
    want = plain(rows())
    assert len(want) > 40
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("low,high,dims", [(-1, 0, 3), (-256, 255, 64), (0, 40000, 9), (-(1 << 19), 1 << 19, 17)])
def test_scores_are_exact_inner_products(low, high, dims):
    rng = np.random.default_rng(4)
    a, c = (rng.integers(low, high + 1, (n, dims)) for n in (7, 33))
    bits = 1 + max(int(x if x >= 0 else ~x).bit_length() for x in (low, high))
    narrow, wide = negatives._kinds(dims, bits, dims << 2 * (bits - 1))
    got = negatives.scores(negatives.tables(a, narrow), negatives.planes(c, bits), wide)
    assert (got == c @ a.T).all()


def test_subset_sums():
    t = negatives.tables(np.array([[1, 2, 4, 8, 16, 32, 64, 128, 5]]), np.int32)
    assert t.shape == (2, 256, 1) and (t[0, :, 0] == np.arange(256)).all() and t[1, 1, 0] == 5 and t[1, 2, 0] == 0


def test_empty_table_and_too_large_components(spark):
    def run(data):
        df = spark.createDataFrame(data, SCHEMA)
        return negatives.hard_negatives(Scratch(spark, "test"), df, F.col("vec_id"), F.col("label"), F.col("embedding"),
                                        F.lit(True)).collect()
    assert run([]) == []
    assert run([(1, [], 1, "x", 1), (2, None, 1, "x", 1)]) == []
    with pytest.raises(ValueError):
        run([(1, [1e30], 1, "x", 1)])
