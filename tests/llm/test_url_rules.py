"""Mined URL rules by enumeration of all combinations of tokens."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from wideloom.llm import url_rules
from wideloom.llm.common import Scratch


def tokens(host, path):
    labels = [x for x in host.split(".") if x]
    out = ["h:" + ".".join(labels[-i:]) for i in range(1, len(labels) + 1)]
    parts = [x for x in path.split("/") if x]
    return set(out + [f"p{i}:{'#' if x.isdigit() else x}" for i, x in enumerate(parts)])


def urls():
    rng = random.Random(4)
    out = []
    for _ in range(400):
        host = rng.choice(["a.example.net", "b.example.net", "www.example.com", "example.com", "shop.example.org", "x.org"])
        path = "/".join(["", rng.choice(["en", "fr", "es", "de"]), str(rng.randrange(9)), *rng.choices(["p", "q"], k=rng.randrange(3))])
        out.append((host, path))
    return sorted(set(out)) + [("deep.net", "/" + "/".join(f"s{i}" for i in range(14)))]


def enumerated(rows, min_support, min_confidence):
    """(antecedent, verdict) -> (confidence, support), without those that a shorter rule makes needless."""
    sets = [(tokens(h, p), v) for h, p, v in rows]
    rules = {}
    for items in {c for s, _ in sets for k in range(1, len(s) + 1) for c in combinations(sorted(s), k)}:
        have = [v for s, v in sets if s.issuperset(items)]
        for v in set(have):
            n = have.count(v)
            if n >= min_support * len(sets) and n / len(have) >= min_confidence:
                rules[items, v] = (n / len(have), n / len(sets))
    return {(a, v): c for (a, v), c in rules.items()
            if not any((tuple(x for x in a if x != t), v) in rules and rules[tuple(x for x in a if x != t), v][0] >= c[0] for t in a)}


def test_mined_rules_and_their_verdicts(spark):
    rng = random.Random(2)
    judged = [(h, p, "block" if "net" in h and "/fr" in p or rng.random() < 0.1 else "allow") for h, p in urls()[:-1]]
    df = spark.createDataFrame(judged, "host string, path string, verdict string")
    df = df.withColumn("tokens", url_rules.tokens(F.col("host"), F.col("path")))
    assert {(r.host, r.path): set(r.tokens) for r in df.collect()} == {(h, p): tokens(h, p) for h, p, _ in judged}
    found = url_rules.mine(Scratch(spark, "test"), df, 0.02, 0.8)
    want = enumerated(judged, 0.02, 0.8)
    assert {(tuple(r.antecedent), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in found.collect()} == \
        {k: (round(c, 9), round(s, 9)) for k, (c, s) in want.items()}
    assert any(v == "block" for _, v in want)
    others = spark.createDataFrame(urls(), "host string, path string")
    others = others.withColumn("tokens", url_rules.tokens(F.col("host"), F.col("path")))
    got = {(r.host, r.path): r.verdict for r in url_rules.match(Scratch(spark, "test"), others, found).collect()}
    for h, p in urls():
        fits = [(c, s, v, list(a)) for (a, v), (c, s) in want.items() if tokens(h, p).issuperset(a)]
        assert got.get((h, p)) == (max(fits)[2] if fits else None)


def test_every_segment_has_its_place(spark):
    df = spark.createDataFrame([urls()[-1]], "host string, path string")
    got = df.select(url_rules.tokens(F.col("host"), F.col("path")).alias("t")).first().t
    assert {f"p{i}:s{i}" for i in range(14)} <= set(got)


def test_clashing_columns_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://x.net/fr/1", "h", "allow", 5), (None, None, "h", "allow", 5)],
                                  "page_id long, url string, host string, verdict string, path int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(Scratch(spark, "t"), pages, F.col("page_id"), F.col("url")).collect()}
    assert got == {1: ("x.net", "/fr/1", "net/fr/", "block"), None: ("", "", None, "allow")}
