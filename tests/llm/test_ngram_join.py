"""The n-gram join against brute force on whole tables and hand-made groups (3)."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from quarry.llm import ngram_join as nj
from quarry.llm.components import components
from quarry.llm.queries import QUERIES
from quarry.sources.tables import load


def slow_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().split()
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def slow_join(rows, threshold=0.8):
    """row position -> (class_id, n_links)."""
    sets = slow_sets([t for _, t in rows])
    by_token, parent = defaultdict(list), list(range(len(rows)))
    for i, s in enumerate(sets):
        for g in s:
            by_token[g].append(i)

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in by_token[g]:
                shared[j] += 1
        for j, n in shared.items():
            if j != i and n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), d), d)
    return [(smallest[find(i)], links[i]) for i in range(len(rows))]


def variants(rng, base, n, edits):
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
        yield " ".join(w)


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in nj.near_duplicates(df, **settings).collect())
    assert got == sorted((d, c, n) for (d, _), (c, n) in zip(rows, slow_join(rows)))


def test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in load(spark, "/root/testdata/sf0.01", "documents").collect()]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in QUERIES["op3_ngram_jaccard_join"](spark, "/root/testdata/sf0.01").collect()}
    assert got == {d: x for (d, _), x in zip(rows, slow_join(rows))}


def test_large_groups_split_and_block(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    texts = list(variants(rng, rng.choices(words, k=120), 90, 3)) + list(variants(rng, rng.choices(words, k=60), 60, 6))
    texts += [" ".join(rng.choices(words, k=80)) for _ in range(60)] + [texts[0]] * 15
    check(spark, list(enumerate(texts)), brute=8, block=16)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "a b c d e"), (7, "a b c d e f"), (8, "x " * 100_000),
            (9, "x " * 100_001), (9, "y y y y y z"), (9, "y y y y y z"), (10, "y y y y y z")]
    check(spark, rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("n")).withColumn("row", F.lit(0))
    got = nj.near_duplicates(df).collect()
    assert sum(r["keeper"] for r in got) == 8 and sum(r["keeper"] for r in got if r["doc_id"] == 9) == 1
    assert nj.near_duplicates(df.limit(0)).count() == 0


def test_runs_reach_recall():
    q = nj.runs_needed(0.8, 0.9999, 3)
    assert 15 <= q <= 25 and nj.runs_needed(0.8, 0.99, 1) < q


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_similar(threshold):
    import numpy as np
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 40))).astype(np.uint64) for _ in range(30)]
    got = nj.similar(sets, None, threshold)
    cross = nj.similar(sets[:10], sets[10:], threshold)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            want = len(set(a) & set(b)) >= threshold * len(set(a) | set(b))
            assert got[i, j] == want and (i >= 10 or j < 10 or cross[i, j - 10] == want)
