"""Personal data in texts of many matches: brute force, and time in proportion."""

import random
import re
import time

from pyspark.sql import functions as F

from wideloom.llm import pii, queries

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(int(c) for c in reversed(d))) % 10 == 0


def spans(text):
    out = {}
    for kind, pattern in BASE.items():
        keep = []
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (16 <= len(d) <= 19 and luhn(d)) \
                    or kind == "phone" and not 8 <= len(d) <= 15:
                continue
            keep.append((m.start(), m.end()))
        out[kind] = keep
    return out


def texts():
    rng = random.Random(8)
    bits = ["a@b.co", "x.y+z@q-r.org.uk", "10.0.0.1", "1.2.3.999", "+49 (30) 123-4567", "+1", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "é😀 ", "call 212-555-0187", "SSN 123-45-6789", ", ", " ", "\n", "7", "@", ".", "GB82 WEST 1234 5698 7654 32", "-", "word "]
    out = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    for _ in range(40):                                          # random cards, half of them with a right check digit
        d = "".join(rng.choice("0123456789") for _ in range(rng.randint(14, 19)))
        d += next(c for c in "0123456789" if luhn(d + c) == (rng.random() < 0.5 or c == "9"))
        out.append(" and ".join([d, "-".join(re.findall(".{1,4}", d)), d[:4] + " " + d[4:]]))
    return out


def check(spark, many, block=None):
    df = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(df, F.col("doc_id"), F.col("text")).collect()}
    for i, t in enumerate(many):
        assert {k: [(x.start, x.end) for x in got[i][k]] for k in pii.BASE} == spans(t), t
        assert all(t[x.start:x.end] == x.value for k in (*pii.BASE, "added") for x in got[i][k])
    return got


def test_base_spans_by_brute_force(spark, monkeypatch):
    check(spark, texts())
    monkeypatch.setattr(pii, "BLOCK", 3)
    check(spark, texts())


def test_surroundings_are_those_of_the_text(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    for kind in pii.ADDED:
        out = pii.with_surroundings(pii.with_matches(df, "text", kind.name, kind.pattern, None), kind, 40).filter(F.col(kind.name).isNotNull())
        for r in out.collect():
            for x in r[kind.name]:
                assert x.before == r.text[max(x.start - 40, 0):x.start] and x.after == r.text[x.end:x.end + 40]
                assert len(x.value) >= kind.least


def test_many_matches_in_one_text_take_time_in_proportion(spark):
    def took(n):
        text = "".join(f"user{i}@mail.example.com, 212-555-{i % 10000:04d}; " for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        t = time.time()
        r = pii.find_pii(df, F.col("doc_id"), F.col("text")).select(F.size("email").alias("n"), F.element_at("email", -1)["end"].alias("e")).first()
        assert r.n == n and text[:r.e].endswith("@mail.example.com")
        return time.time() - t
    took(100)
    assert took(20_000) < 15


def test_query_counts(spark, tmp_path):
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts())], "doc_id long, text string, email string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op1_pii"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts()):
        assert [got[i][f"n_{k}"] for k in BASE] == [len(v) for v in spans(t).values()]
