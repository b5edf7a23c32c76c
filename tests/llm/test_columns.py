"""Operators that SQL can check: parity on the tables, brute force and edge rows (1, 9, 10)."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from quarry.llm import mixing, secrets, topk
from quarry.llm.queries import ORACLE, QUERIES
from quarry.oracle.check import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity(spark, duck_small, name):
    r = compare(QUERIES[name](spark, SMALL), duck_small, ORACLE[name])
    assert r["ok"], r


def spans(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    return secrets.scan(df).select(secrets.joined(F.col("secrets")).alias("s")).first()["s"]


def test_scan_edges(spark):
    assert spans(spark, None) == "" and spans(spark, "") == ""
    # a short value consumes what it matched, so the second key inside it is not found
    assert spans(spark, "secret:token: abcdefgh") == ""
    assert spans(spark, "ü PassWord = 'abc123'") == "assign:2:20"
    assert spans(spark, "AKIA" + "A1" * 8) == "access:0:20"
    assert "entropy" not in spans(spark, "incomprehensibilitiesandmore " * 3)
    hidden = "Zk8Q2vX9mT4bL7nR1cW6yH3s"
    assert spans(spark, f"so {hidden} ends") == f"entropy_base64:3:{3 + len(hidden)}"
    assert "entropy" not in spans(spark, "EXAMPLE" + hidden)


def test_allow_list_hides_no_secret_beside_it(spark):
    import random
    import string
    rng = random.Random(8)
    keys = ["".join(rng.sample(string.ascii_letters, 24)) for _ in range(100)]
    hidden = "Zk8Q2vX9mT4bL7nR1cW6yH3s"
    keys += [f"docs/example/{hidden}", f"{hidden}-xxxxxx-end", f"a_0123456789_{hidden}_abcdefg", f"example-example2/{hidden}", "Ab-" + "w" * 5_000 + "/EXAMPLE/" + hidden]
    plain = ["getElementsForName/SomeMoreWords-HERE_too", "docs/example/incomprehensible/words-and-More", "incomprehensible/words/example/" + "ab-" * 2_000 + "cd",
             "docs/EXAMPLE" + hidden + "/end", "Abcdefghijklmnopqrstuvwxyz", "the-quick-brown-fox/" * 2_000 + "jumps"]
    df = spark.createDataFrame([(i, f"so {k} ends") for i, k in enumerate(keys + plain)], "id int, text string")
    got = {r["id"]: r["text"] for r in secrets.redact(df).collect()}
    assert [k for i, k in enumerate(keys) if got[i] != "so [SECRET] ends"] == []
    assert [k for i, k in enumerate(plain, len(keys)) if got[i] != f"so {k} ends"] == []


def test_entropy_matches_direct_formula(spark):
    import random
    rng = random.Random(5)
    rows = ["".join(rng.choices("0123456789abcdef"[: rng.randint(2, 16)], k=rng.randint(20, 90))) for _ in range(200)]
    w, limit = secrets.WINDOW, secrets.HEX.threshold

    def entropy(x):
        return -sum(c / len(x) * math.log2(c / len(x)) for c in Counter(x).values())

    want = [max(entropy(r[i:i + w]) for i in range(len(r) - w + 1)) >= limit for r in rows]
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    got = [r[0] for r in df.select(secrets.reaches_entropy(F.col("x"), w, limit)).collect()]
    assert got == want and 20 < sum(want) < 180


def test_sql_states_the_allow_list(spark):
    """The SQL and the scan on candidates with allow-listed pieces at the head, in the middle and at the end."""
    import duckdb
    import pandas as pd
    from quarry.llm.queries import _secrets_sql
    import random
    rng = random.Random(12)
    key = lambda n: "".join(rng.choices("ABCDEFGHJKabcdefghk23456789", k=n))
    pieces = ["example", "EXAMPLE", "xxxxxx", "0123456789", "abcdefg", "words", "SomeMoreWords", "aBc", "-", "_-", "+", "/"]
    texts = [f"so {'/'.join(rng.choice([key(24), key(12), rng.choice(pieces), rng.choice(pieces) + key(22), key(22) + rng.choice(pieces)]) for _ in range(rng.randint(1, 4)))} ends"
             for _ in range(400)]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})  # noqa: F841
    want = {r[0]: r[5] for r in duckdb.sql(_secrets_sql()).fetchall()}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in secrets.scan(df).select("doc_id", secrets.joined(F.col("secrets")).alias("s")).collect()}
    assert got == want and 100 < sum(1 for x in got.values() if x) < 400


def test_long_runs_take_seconds(spark):
    """A megabyte of four symbols, one of random symbols, and 100 kB of many symbols in windows of few."""
    import random
    import time
    rng = random.Random(3)
    every = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnop0123456789"
    slow = "".join(rng.choice("GHIJKLMNOPQRSTUVWXYZghijklmnopq") * 5 for _ in range(20_000))
    for body, hit in (("".join(rng.choices("ABab", k=1_000_000)), False), ("".join(rng.choices(every, k=1_000_000)), True), (slow, False)):
        df = spark.createDataFrame([(body,)], "text string")
        secrets.scan(df.limit(0)).collect()
        since = time.monotonic()
        out = secrets.scan(df).select(F.size("secrets").alias("n")).first()["n"]
        assert (out > 0) == hit
        assert time.monotonic() - since < 20


def test_scan_long_text_and_clashing_columns(spark):
    text = "word " * 100_000 + "password=hunter22 " + "f" * 24
    df = spark.createDataFrame([(text, 1)], "text string, start int")
    got = secrets.redact(df).first()
    assert got["start"] == 1 and got["text"].endswith("[SECRET] [SECRET]")
    empty = spark.createDataFrame([], "text string")
    assert secrets.redact(empty).count() == 0


def test_mix_meets_targets(spark):
    rows = [(i, f"s{i % 3 if i % 2 else 0}", ["en", "fr", None][i // 6 % 3], "t", 1 + i % 7) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    targets = {"source": {"s0": 1, "s1": 1, "s2": 2}, "lang": {"en": 0.5, "fr": 0.25, "": 0.25}}
    got = mixing.mix(df, targets).collect()
    total = sum(r["rate"] * r["n_tokens"] for r in got)
    for dim, want in targets.items():
        for value, w in want.items():
            share = sum(r["rate"] * r["n_tokens"] for r in got if (r[dim] or "") == value) / total
            assert abs(share - w / sum(want.values())) < 1e-6
    assert max(r["rate"] for r in got) == pytest.approx(1.0) and all(r["sampled"] for r in got if r["rate"] >= 1)


def test_mix_edges(spark):
    schema = "doc_id long, text string, source string, lang string, rate string, topic int"
    rows = [(1, None, "a", "x", "keep", 1), (2, "", "a", "x", "keep", 1), (3, "one two", None, None, "keep", 1), (3, "one two", None, None, "k", 1)]
    docs = mixing.measured(spark.createDataFrame(rows, schema))
    got = mixing.mix(docs).orderBy("doc_id").collect()
    assert [r["rate"] for r in got] == [0, 0, 1, 1] and not got[0]["sampled"] and got[2]["sampled"] == got[3]["sampled"]
    assert mixing.mix(mixing.measured(spark.createDataFrame([], schema))).count() == 0


def test_top_k_against_brute_force(spark):
    import random
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(20)]  # ties
    rows += [(300, None), (301, [None] + [0.1] * 5), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [0.1] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.exact_top_k(
        df, df.filter("vec_id % 50 = 0"), query_block=2, candidate_block=40).collect()}
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows[:140]}
    want = {}
    for q in (i for i in ints if i % 50 == 0):
        best = sorted(((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q))[:5]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want


def test_top_k_few_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0])], schema)
    got = topk.exact_top_k(few, few.filter("vec_id = 0")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 256 * 512)]
    none = spark.createDataFrame([], schema)
    assert topk.exact_top_k(none, none).count() == 0
