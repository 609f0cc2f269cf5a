"""Sketches and likenesses against brute force over shingles; the order of documents."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wideloom.llm import queries, sketches


def texts(n=400, seed=6):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(60)]
    return ["" if i % 37 == 0 else " ".join(rng.choice(words) for _ in range(rng.choice((1, 3, 5, 9, 40, 300)))) for i in range(n)]


def shingles(spark, all_texts, k=sketches.SHINGLE_WORDS):
    """text -> set of (hash without its sign) of its shingles, hashed by Spark one shingle a row."""
    rows = []
    for t in all_texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        rows += [(t, w[i:i + k] + [None] * (k - len(w))) for i in range(max(len(w) - k, 0) + 1)] if w else []
    df = spark.createDataFrame(rows, "t string, w array<string>")
    out = {t: set() for t in all_texts}
    for r in df.distinct().select("t", F.xxhash64(*[F.get("w", i) for i in range(k)]).alias("h")).collect():
        out[r.t].add(r.h & (1 << 63) - 1)
    return out


def sketch(hashes, scale=sketches.SCALE):
    low = {h for h in hashes if h < (1 << 63) // scale}
    return low or set(sorted(hashes)[:1])


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("null_ids", [0, 5])
def test_sketches_and_likeness(spark, tmp_path, null_ids):
    rows = [(i * 7 if i >= null_ids else None, t) for i, t in enumerate(texts())]
    random.Random(1).shuffle(rows)
    spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, rows int, at string") \
        .repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op10_sketches"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    if null_ids:
        return                                      # several nulls come in the order of a hash: counted only
    rows.sort()
    edited = [t[:len(t) - len(t) // 4] + rows[(k + 1) % len(rows)][1][:len(t) // 4] for k, (_, t) in enumerate(rows)]
    have = shingles(spark, sorted({t for _, t in rows} | set(edited)))

    def text(hashes):
        return ",".join(f"{h:016x}" for h in sorted(sketch(hashes)))
    for r, (i, t), e, (_, after) in zip(sorted(got), rows, edited, rows[1:] + rows[:1]):
        assert (r.doc_id, r.n_chars) == (i, len(t))
        assert (r.fingerprint, r.edited_fingerprint) == (text(have[t]), text(have[e]))
        assert r.near_edited == pytest.approx(like(sketch(have[t]), sketch(have[e])))
        assert r.near_next == pytest.approx(like(sketch(have[t]), sketch(have[after])))


def test_text_is_shuffled_once(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts(50))], "doc_id long, text string")
    plan = sketches.fingerprints(docs, F.col("doc_id"), F.col("text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "from_json" not in plan


def test_containment_of_unequal_texts(spark):
    t = [x for x in texts(200) if len(x.split()) == 300]
    df = spark.createDataFrame([(" ".join(t[:4]), t[1])], "long string, short string")
    df = sketches.with_sketch(sketches.with_sketch(df, "long", "a"), "short", "b")
    r = df.select(sketches.containment(F.col("b"), F.col("a")).alias("inside"), sketches.containment(F.col("a"), F.col("b")).alias("part")).first()
    assert r.inside == 1.0 and 0.1 < r.part < 0.45
