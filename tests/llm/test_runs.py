"""Periodic runs against a search of all periods of all texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wideloom.llm import queries, runs
from wideloom.llm.common import Scratch


def plain(words):
    """[(start, length, period)] by comparing all words at all periods."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and not any(
                    q % d == 0 and all(words[x] == words[x + d] for x in range(i, j + q - d)) for d in range(1, q)):
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found)


def kept(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rng = random.Random(3)
    out = ["", None, " \t\n", "a", "a a a a a", "a a a a a a", "a b " * 4, "a b " * 3 + "a", "x " + "a b c " * 9 + "a b d",
           "la " * 500, "a a b a a b a a b a a b", "a a a a a a a a b " * 6, "  x " * 8, "é " * 7]
    for _ in range(150):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            piece = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            at = rng.randint(0, len(words))
            words[at:at] = (piece * 8)[:rng.randint(len(piece), 8 * len(piece))]
        out.append(" ".join(words))
    return out


def check(got, rows):
    want = sorted((i, hashlib.sha256(" ".join(w).encode()).hexdigest(), plain(w)) for i, w in rows)
    assert sorted((r.doc_id, r.words_sha256, [tuple(x) for x in r.runs or []]) for r in got) == want
    words = {}
    for i, w in rows:
        words.setdefault(i, set()).add(kept(w, plain(w)))
    assert all((r.collapsed is None) == (not r.runs) and (not r.runs or r.collapsed in words[r.doc_id]) for r in got)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("tile_words", [runs.TILE_WORDS, 40])
def test_runs_against_brute_force(spark, tile_words):
    rows = list(enumerate(texts())) + [(3, "a a a a a a a")] * 2                # repeated rows
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, runs string")
    got = runs.find_runs(Scratch(spark, "test"), docs, F.col("doc_id"), F.col("text"), tile_words).collect()
    check(got, [(i, split(t)) for i, t in rows])


def test_windows_cover_long_texts():
    rng = random.Random(5)
    for n in (100, 999, 5000):
        for tile in (16, 64, 700):
            spans = runs.windows(n, tile)
            assert {k for lo, hi, _, _ in spans for k in range(lo, hi + 1)} == set(range(runs.octaves(n) + 1))
            for _ in range(200):
                k = rng.randrange(runs.octaves(n) + 1)
                size = 4 * rng.randrange(1 << k, min(2 << k, n // 4 + 1))
                at = rng.randrange(n - size + 1)
                spans_k = sorted((a, z) for lo, hi, a, z in spans if lo <= k <= hi)
                assert spans_k[0][0] == 0 and spans_k[-1][1] == n
                assert all(a2 + (8 << k) <= z1 for (_, z1), (a2, _) in zip(spans_k, spans_k[1:]))
                assert any(a <= at and at + size <= z or a < at + size and z > at for a, z in spans_k)


def test_equal_names_of_different_words_change_nothing(monkeypatch):
    monkeypatch.setattr(runs, "_mix", lambda a, b: (a ^ b) & np.uint64(3))
    for text in texts()[4:60]:
        words = split(text)
        high = runs.octaves(len(words))
        if high < 0:
            continue
        codes = np.unique(words, return_inverse=True)[1].astype(np.int64)
        _, period, start, end = runs.solve([codes], 0, high)
        got = {(s, e - s + q, q) for q, s, e in zip(period.tolist(), start.tolist(), end.tolist())
               if e - s + q >= max(6, 4 * q)}
        assert got >= set(plain(words))


def test_very_long_text_of_one_word_is_linear(spark):
    docs = spark.createDataFrame([(1, "la " * 300_000), (2, "x y " * 200_000 + "z")], "doc_id long, text string")
    got = {r.doc_id: r for r in runs.find_runs(Scratch(spark, "test"), docs, F.col("doc_id"), F.col("text")).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 300_000, 1)] and got[1].collapsed == "la"
    assert [tuple(r) for r in got[2].runs] == [(0, 400_000, 2)] and got[2].collapsed == "x y z"


def test_empty_table_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert runs.find_runs(Scratch(spark, "test"), none, F.col("doc_id"), F.col("text")).collect() == []
    docs = spark.createDataFrame([(None, "a " * 9), (None, None)], "doc_id long, text string")
    got = runs.find_runs(Scratch(spark, "test"), docs, F.col("doc_id"), F.col("text")).collect()
    assert sorted(len(r.runs or []) for r in got) == [0, 1]


def test_query_against_brute_force(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())] + [(1000 + i, " ".join(f"w{(i * j) % 13}" for j in range(i))) for i in range(120)]
    spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for i, t in rows:
        w, h = split(t), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (j - a) % p] for j in range(a, n)]
        found = plain(w)
        s, size, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda r: (r[0], r[2])))
        want.append((i, len(found), s, size, q, size and 1000 * size // q, hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(kept(w, found).encode()).hexdigest()))
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r[1] > 0 for r in want) > 30
