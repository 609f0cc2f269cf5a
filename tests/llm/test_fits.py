"""Fits of the classifiers on held-out labels; packing against the whole tokenizer; archives of large
payloads; stages of the pipeline one after the other."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF
from wideloom.llm import packing, quality, queries, stages, toxicity, warc
from wideloom.llm.common import Scratch


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("name,label,least", [("op5_quality", "quality", 0.95), ("op9_toxicity", "toxic", 0.85)])
def test_held_out_labels(spark, name, label, least):
    sf = SF["0.01"]
    got = queries.QUERIES[name](spark, sf).filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id") \
        .select("score", F.col(label).alias("y")).filter("y is not null").collect()
    y = np.array([r.y for r in got])
    assert 0 < y.mean() < 1 and auc(np.array([r.score for r in got]), y) > least


def test_fits_read_one_row_of_an_id_in_whole(spark):
    docs = spark.createDataFrame([(1, "a " * 50000 + "end")] * 3 + [(1, "b"), (2, None), (4, "c"), (5, "held out?")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, None), (None, 1), (9, 1)], "doc_id long, q int")
    ids = [i for i in (1, 2) if zlib.crc32(str(i).encode()) % 3 != 1]
    got = quality.training_rows(docs, F.col("doc_id"), F.col("text"), labels, F.col("q")).collect()
    assert sorted((r.id, r.y) for r in got) == [(i, {1: 1, 2: 0}[i]) for i in ids]
    assert all(r.text is None or r.text == "b" or r.text.endswith("end") for r in got)


def test_classifiers_on_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    for op, label in ((quality, "quality"), (toxicity, "toxic")):
        model = op.train(docs, F.col("doc_id"), F.col("text"), labels, F.col(label))
        assert quality.scored(docs, F.col("doc_id"), F.col("text"), model).collect() == []


def test_one_class_gives_its_share(spark):
    docs = spark.createDataFrame([(i, f"word{i} text") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, y int")
    model = toxicity.train(docs, F.col("doc_id"), F.col("text"), labels, F.col("y"))
    assert {r.score for r in quality.scored(docs, F.col("doc_id"), F.col("text"), model).collect()} == {1.0}


def tokenizer():
    return Tokenizer.from_file(queries.tokenizer_path())


def test_pieces_are_those_of_the_whole_tokenizer(spark):
    rng = random.Random(5)
    alphabet = "abcXYZ .,!?'-0123é ÜßñİǅƀЖ漢😀\n\t\u00a0@#<|>"
    texts = ["", None, " \n", "a" * 30000, "Word word, WORD; word.", "don't (stop) it's", "naïve Ünïcode ﬁ", "<|endoftext|> x"] + \
        ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(300)] + ["w0rd, " * 5000]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, piece int, length int")
    got = packing.pieces(docs, F.col("doc_id"), F.col("text"), queries.tokenizer_path(), with_ids=True).collect()
    whole = tokenizer()
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and [r.start for r in own] == list(range(0, len(ids), 2048))
        assert b"".join(bytes(r.ids) for r in own) == ids.tobytes()
        assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[a:a + 2048].tobytes()) for a in range(0, len(ids), 2048)]
        assert [r.length for r in own] == [len(ids[a:a + 2048]) for a in range(0, len(ids), 2048)]


def test_archives_of_large_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "LARGE_BYTES", 1000)
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    rows = [(i, f"u{i}", "x" * (i * 37 % 5000), i, "z") for i in range(120)] + [(500 + i, "u", "y" * 4000, i, "z") for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, row int, digest string")
    got = warc.archive(Scratch(spark, "test"), pages, F.col("page_id"), F.col("url"), F.col("html")).collect()
    first = {}
    for i, _, h, *_ in rows:
        first.setdefault(h, i)
    want = [(i, len(h), "revisit" if len(h) >= 100 and first[h] != i else "response") for i, _, h, *_ in rows]
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in got) == sorted(want)
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {i: 500 for i in range(501, 509)}


def test_payloads_are_joined_once(spark):
    pages = spark.read.parquet(SF["0.001"] + "/pages.parquet")
    rows = pages.withColumn(warc.ROW, F.monotonically_increasing_id())
    plan = warc.resolve(rows, F.col("page_id"), F.col("url"), F.col("html"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" not in plan


def test_pipeline_runs_its_stages_in_order(spark):
    sf = SF["0.001"]
    got = corpus_pipeline.run(spark, sf).collect()
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = Scratch(spark, name).table(stage(spark, docs, sf), "docs")
        assert out.columns == docs.columns
        seen.append(out.count())
        docs = out
    assert seen[0] >= seen[1] >= seen[2] > 0
    whole, want = tokenizer(), []
    for r in docs.collect():
        ids = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(r.doc_id, k, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got) == sorted(want)
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 2048 and [o for o, _ in sorted(v)] == np.cumsum([0] + [n for _, n in sorted(v)])[:-1].tolist()
               for v in filled.values())
