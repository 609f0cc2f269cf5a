"""The ten operators on a small table with nulls, empty and long texts, ties, repeated rows and
columns of clashing names, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wideloom.llm import (exact_dedup, golay, mixing, packing, pii, quality, queries, simhash, sketches,
                          stages, toxicity, url_rules, warc)
from wideloom.llm.common import Scratch, keyed_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, row int"
LONG = " ".join(f"word{i % 977} x{i}" for i in range(9000))
ROWS = [(1, "Alpha beta gamma delta epsilon zeta", "s1"), (2, "Alpha  beta\tgamma delta epsilon zeta", "s1"),
        (3, None, "s2"), (4, "", None), (5, " \n", "s2"), (6, LONG, "s1"), (7, LONG + " end", "s3"),
        (8, "Ünï 😀 a@b.co +49 (30) 123-4567, 4111 1111 1111 1111, 10.0.0.255 1.2.3.999", "s3"),
        (8, "Ünï 😀 a@b.co +49 (30) 123-4567, 4111 1111 1111 1111, 10.0.0.255 1.2.3.999", "s3"),
        (None, "one two three", None), (None, "one two three", None), (11, "7" * 30000, "s1"),
        (12, "a" * 30000, "s2"), (13, "AlphabetagammadeltaepsilonzetA", "s2")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", s, 1, True, "x", 7) for i, t, s in ROWS], SCHEMA)


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


@pytest.mark.parametrize("digest,block", [(F.xxhash64, 4096), (lambda c: F.length(c).cast("bigint"), 16)])
def test_exact_dedup(scratch, docs, digest, block):
    small = docs if block > 99 else docs.filter("text is null or length(text) < 1000")
    got = exact_dedup.exact_dedup(scratch, small, F.col("doc_id"), F.col("text"), block_chars=block,
                                  digest=digest).collect()
    rows = [r for r in ROWS if block > 99 or len(r[1] or "") < 1000]
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(squeeze(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = sorted((i if i is not None else -1, min(groups[squeeze(t)])[3] or -1, len(groups[squeeze(t)]),
                   hashlib.sha256(squeeze(t).encode()).hexdigest()) for i, t, _ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.keep_id or -1, r.group_size, r.text_sha256)
                  for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_pii_base_and_added(spark, docs):
    more = spark.createDataFrame([(50, "IBAN GB82 WEST 1234 5698 7654 32 but not GB83 WEST 1234 5698 7654 32", ""),
                                  (51, "my phone 212-555-0187, part no 212-555-0187x", "")], "doc_id long, text string, z string")
    out = {r.doc_id: r for r in pii.find_pii(docs.select("doc_id", "text").unionByName(more.drop("z")),
                                             F.col("doc_id"), F.col("text")).collect()}
    r = out[8]
    assert [s.value for s in r.email] == ["a@b.co"] and [s.value for s in r.ip] == ["10.0.0.255"]
    at = ROWS[7][1].index("4111")
    assert [(s.start, s.end) for s in r.card] == [(at, at + 19)] and len(r.phone) == 1
    assert out[3].email == [] and out[11].card == []
    assert [s.value for s in out[50].added] == ["GB82 WEST 1234 5698 7654 32"]
    assert [s.kind for s in out[51].added] == ["local_phone"]


def test_pii_context_reaches_past_other_matches(spark):
    far = "é" * 37
    texts = ["Call 212-555-0187 or 212-555-0188", "SSN 123-45-6789, 987-65-4321", "visa 4222222222222, 4222222222222",
             "123-45-6789 (SSN)", "visa 4222222222223, 4222222222222", "123-45-6789", f"ssn{far}123-45-6789",
             f"ssn {far[1:]}123-45-6789", f"ssn {far}123-45-6789", f"123-45-6789{far[1:]} ssn"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.added for r in pii.find_pii(df, F.col("doc_id"), F.col("text")).collect()}
    assert [len(got[i]) for i in range(len(texts))] == [2, 2, 2, 1, 1, 0, 0, 1, 0, 1]
    assert all(texts[i][s.start:s.end] == s.value for i in got for s in got[i])


def test_pii_random_against_re(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("1234567890 .-+@ab%😀()"), 60)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(df, F.col("doc_id"), F.col("text")).collect()}
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
             "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"}
    for i, t in enumerate(texts):
        for kind, p in plain.items():
            ok = {"email": lambda v: True, "ip": lambda v: all(int(x) <= 255 for x in v.split(".")),
                  "phone": lambda v: 8 <= len(re.sub("[^0-9]", "", v)) <= 15}[kind]
            assert [(m.start(), m.end()) for m in re.finditer(p, t) if ok(m.group())] == \
                [(s.start, s.end) for s in got[i][kind]]


def test_mixing(scratch, docs):
    got, schedule = mixing.mix(scratch, docs, F.col("doc_id"), F.col("source"), F.col("text"), block_words=8)
    rows = got.collect()
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in ROWS]
    assert sorted(r["size"] for r in rows) == sorted(sizes)
    assert all(r.taken <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.source, [r.target, 0, r.source_size])[1] += r.taken
    assert abs(sum(v[0] for v in by.values()) - 1.5 * sum(sizes)) < 1e-6 * sum(sizes)
    assert all(abs(v[1] - v[0]) <= 40 for v in by.values())
    assert schedule.agg(F.sum("length")).first()[0] == sum(v[1] for v in by.values())


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    grams = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(g >> b & 1 for g in grams) > len(grams))


def test_simhash_fingerprints_and_components(scratch, docs):
    got = simhash.near_duplicates(scratch, docs, F.col("doc_id"), F.col("text")).collect()
    fps = {t: plain_fingerprint(t) for _, t, _ in ROWS}
    assert sorted(r.fp % (1 << 64) for r in got) == sorted(fps[t] for _, t, _ in ROWS)
    assert {r.component_id for r in got if r.fp == 0} == {3}


def test_simhash_links_of_dense_groups(spark, scratch):
    rng = np.random.default_rng(5)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    for base in fps[:3]:                      # chains and clouds around three fingerprints
        at = base
        for _ in range(40):
            for bit in rng.choice(63, rng.integers(1, 5), replace=False):
                at ^= 1 << int(bit)
            fps.append(at)
            fps.append(base ^ (1 << int(rng.integers(63))) ^ (1 << int(rng.integers(63))))
    fps = sorted(set(fps))
    label = {r.node: r.label for r in simhash.links(scratch, spark.createDataFrame([(x,) for x in fps], "fp long")).collect()}
    want = list(range(len(fps)))
    for _ in fps:
        new = [min(want[j] for j, y in enumerate(fps) if (x ^ y).bit_count() <= 4) for x in fps]
        if new == want:
            break
        want = new
    mine = [label.get(x, x) for x in fps]
    pairs = set(zip(mine, want))
    assert len(pairs) == len(set(mine)) == len(set(want))


def test_golay_is_perfect():
    home, probes = golay.tables()
    assert (probes[:, 0] == home).all() and set(np.unique((probes >= 0).sum(1))) == {1, 6}


def test_packing(scratch, docs):
    path = queries.tokenizer_path()
    parts = packing.pieces(docs, F.col("doc_id"), F.col("text"), path, sequence=64, with_ids=True)
    rows = packing.pack(scratch, parts, 64).collect()
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    whole = sorted((i or 0, t.encode(x or "", add_special_tokens=False).ids + [0]) for i, x, _ in ROWS if x != "a" * 30000)
    mine = {}
    for r in rows:
        assert r.length <= 64 and zlib.crc32(r.ids) == r.ids_crc32
        mine.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in mine.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(len(ids) for _, ids in whole)
    assert total <= sum(r.length for r in rows)
    assert len(mine) <= -(-sum(r.length for r in rows) // 64) + 1


def test_plan_takes_every_piece_once():
    rng = np.random.default_rng(1)
    histogram = {int(k): int(v) for k, v in zip(rng.integers(1, 100, 40), rng.integers(1, 50, 40))}
    used = {}
    for times, lengths in packing.plan(histogram, 100):
        assert sum(k * n for k, n in lengths.items()) <= 100
        for k, n in lengths.items():
            used[k] = used.get(k, 0) + n * times
    assert used == histogram and packing.plan({}, 100) == []


def test_sketches(docs):
    rows = sketches.fingerprints(docs, F.col("doc_id"), F.col("text")).collect()
    order = sorted({(i is None, i or 0, t or "") for i, t, _ in ROWS})
    nxt = {o: order[(k + 1) % len(order)] for k, o in enumerate(order)}
    want = []
    for i, t, _ in ROWS:
        t = t or ""
        after = nxt[(i is None, i or 0, t)][2]
        cut = len(t) // 4
        want.append(hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in rows) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_url_rules(spark, scratch):
    urls = [None, "", "no scheme", "http://A.Example.com/en/1?x#y", "http://www.example.com/en/2",
            "http://x.net/es/1", "http://x.net/fr", "https://x.org/de/1", "http://com", "http://b.com?q=/en/"] * 2
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_rules.judge(scratch, df, F.col("page_id"), F.col("url")).collect()}
    assert len(got) == len(urls) and (got[0].host, got[0].path, got[0].rule) == ("", "", None)
    assert (got[3].host, got[3].path, got[3].rule, got[3].verdict) == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[4].rule == "www.example.com/en/" and got[5].rule == "net/es/" and got[6].rule is None
    assert got[9].rule is None and all(r.verdict in ("allow", "block") for r in got.values())


def test_warc(spark, scratch):
    big, tricky = "é" * 80, "x\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(5, "http://a/\r\nb", big), (2, None, big), (2, None, big), (None, "u", big), (7, "u", None), (8, "u", ""),
            (9, "u", "short"), (10, "u", "short"), (11, "u", tricky)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.archive(scratch, df, F.col("page_id"), F.col("url"), F.col("html")).collect()
    assert sorted(((r.page_id or 0), r.record_type, r.refers_to or 0, r.payload_bytes) for r in got) == sorted([
        (5, "revisit", 2, 160), (2, "response", 0, 160), (2, "revisit", 2, 160), (0, "revisit", 2, 160),
        (7, "response", 0, 0), (8, "response", 0, 0), (9, "response", 0, 5), (10, "response", 0, 5),
        (11, "response", 0, len(tricky))])


def test_restoration():
    corpus = [b"you are such an idiot and a moron they said to the clown " * 50]
    n = toxicity.trigrams(corpus).reshape(64, 64, 64)
    lm = np.log((n + 0.01) / (n.sum(2, keepdims=True) + 0.64))
    restore = toxicity.Restorer(lm)
    assert restore("an 1d10t and a m0r0n") == "an idiot and a moron"
    assert restore("you c l o w n") == "you clown" and restore("idiooot") == "idiot"
    assert restore("plain words stay, 2024 too") == "plain words stay, 2024 too"


def restorer(words):
    n = toxicity.trigrams([(words + " ").encode() * 50]).reshape(64, 64, 64)
    return toxicity.Restorer(np.log((n + 0.01) / (n.sum(2, keepdims=True) + 0.64)))


def test_restoration_of_every_token_with_signs():
    restore = restorer("asshole hate dumbass idiot stupid wow b2b so now")
    for disguised, word in (("@$$hole", "asshole"), ("h473", "hate"), ("dumba$$", "dumbass"), ("id107", "idiot"),
                            ("57up1d", "stupid"), ("455h0l3", "asshole"), ("s 7 u p i d", "stupid"),
                            ("1 d i o t", "idiot"), ("w o w", "wow"), ("b2b", "b2b")):
        assert restore(f"so {disguised} now") == f"so {word} now"


def test_restoration_without_ascii_signs():
    restore = restorer("fec сука é")
    assert [restore(t) for t in ("f€c", "ééé", "сукаааа", "с у к а")] == ["fec", "é", "сука", "сука"]


def test_restoration_of_long_stretches():
    restore = restorer("fuck asshole")
    assert restore("f" + "u" * 80 + "ck") == "fuck"
    assert restore("455h0l3" * 40) == "asshole" * 40
    assert restore(" ".join("asshole" * 10)) == " ".join(["asshole"] * 10)


def test_scores_are_defined_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for op, label, score in ((quality, "quality", 0.5), (toxicity, "toxic", 0.0)):
        model = op.train(docs, F.col("doc_id"), F.col("text"), labels, F.col(label))
        got = quality.scored(docs, F.col("doc_id"), F.col("text"), model).collect()
        assert len(got) == len(ROWS) and {r.score for r in got} == {score}


def test_passages_do_not_depend_on_neighbours():
    text, long = b"Some words, \t and 12 more.  ", b"  \n" + b"one two, three\n" * 200 + b"\t"
    texts = [b" \n " * 90, text, b"\t" * 500, text, b"", b" \n" * 40 + b"x", long, b" " * 70, long]
    owner, x = quality.passages(texts)
    for i, t in enumerate(texts):
        assert np.array_equal(x[owner == i], quality.passages([t])[1])
    own = np.bincount(quality._CLASS[np.frombuffer(text, np.uint8)], minlength=quality.CLASSES)
    assert np.allclose(x[owner == 1][0, :quality.CLASSES] ** 2, own / own.sum())


def test_gradient_of_the_bags():
    rng = np.random.default_rng(0)
    x, owner, y = rng.normal(size=(9, quality.FEATURES)), np.array([0, 0, 1, 1, 1, 2, 3, 3, 3]), np.array([1., 0, 1, 0])
    w = {k: rng.normal(size=s) * 0.3 for k, s in {"W": (quality.FEATURES, 4), "b": 4, "V": (4, 3), "U": (4, 3), "w": 3, "c": 4, "d": ()}.items()}

    def loss():
        p = quality._forward(w, x, owner, 4)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    g = quality._gradient(w, x, owner, y)
    for k, at in (("W", (3, 1)), ("V", (2, 1)), ("U", (1, 2)), ("w", (1,)), ("c", (2,)), ("b", (0,))):
        old = w[k][at]
        w[k][at] = old + 1e-5
        up = loss()
        w[k][at] = old - 1e-5
        assert abs((up - loss()) / 2e-5 - g[k][at]) < 1e-5
        w[k][at] = old


def test_empty_tables(spark, scratch, docs):
    none = docs.limit(0)
    i, t = F.col("doc_id"), F.col("text")
    assert exact_dedup.exact_dedup(scratch, none, i, t).count() == 0
    assert mixing.mix(Scratch(spark, "t"), none, i, F.col("source"), t)[0].count() == 0
    assert simhash.near_duplicates(Scratch(spark, "t"), none, i, t).count() == 0
    assert packing.pack(Scratch(spark, "t"), packing.pieces(none, i, t, queries.tokenizer_path())).count() == 0
    assert sketches.fingerprints(none, i, t).count() == 0
    assert pii.find_pii(none, i, t).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_rules.judge(Scratch(spark, "t"), pages, F.col("page_id"), F.col("url")).count() == 0
    assert warc.archive(Scratch(spark, "t"), pages, F.col("page_id"), F.col("url"), F.col("html")).count() == 0


def test_stages_keep_the_columns(spark, docs):
    for stage in (stages.exact_dedup, stages.near_dedup, stages.mixing):
        out = stage(spark, docs, "")
        assert out.dtypes == docs.dtypes
    left = stages.exact_dedup(spark, docs, "").count()
    assert left == len({squeeze(t) for _, t, _ in ROWS})


def test_stages_on_files(spark, docs, tmp_path):
    path = str(tmp_path / "docs")
    docs.repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    for stage in (stages.exact_dedup, stages.near_dedup, stages.mixing):
        assert stage(spark, table, "").dtypes == docs.dtypes
    left = stages.exact_dedup(spark, table, "")
    assert left.count() == len({squeeze(t) for _, t, _ in ROWS})
    assert stages.near_dedup(spark, table, "").count() == stages.near_dedup(spark, docs, "").count()


def test_row_keys(spark, scratch, docs, tmp_path):
    path = str(tmp_path / "docs")
    docs.repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    assert keyed_rows(scratch, table).schema["row"].dataType.simpleString() == "struct<file:bigint,at:bigint>"
    twice = table.withColumn("n_chars", F.explode(F.array(F.lit(1), F.lit(2))))
    for i, df in enumerate((table, docs, twice, table.filter("doc_id > 5"), table.limit(0))):
        rows = keyed_rows(scratch, df, f"rows{i}")
        assert rows.select("row").distinct().count() == rows.count() == df.count()
        assert rows.select("rec.*").dtypes == df.dtypes


def test_quality_stage_keeps_whole_rows(spark, docs, tmp_path):
    labels = [(i, i % 2, 0) for i in range(14)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = stages.quality(spark, docs, str(tmp_path))
    assert out.dtypes == docs.dtypes and out.exceptAll(docs).count() == 0
