"""The signature join against brute force: whole tables, groups cut into blocks, edge rows (11)."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from quarry.llm import minhash_join as mj
from quarry.llm.queries import QUERIES
from quarry.sources.tables import load

SMALL = "/root/testdata/sf0.001"


def slow_sets(texts, n=4):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append(frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset())
    return out


def slow(rows, threshold=80):
    """Sorted (doc_id, n_shingles, component_id, kept) of (doc_id, text)."""
    sets, by, parent = slow_sets([t for _, t in rows]), defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in by[g]:
                shared[j] += 1
            by[g].append(i)
        for j, k in shared.items():
            if 100 * k >= threshold * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        ids = [x for x in (low.get(find(i)), d) if x is not None]
        low[find(i)] = min(ids) if ids else None
    return sorted(((d, len(sets[i]), low[find(i)], low[find(i)] == d) for i, (d, _) in enumerate(rows)), key=repr)


def found(df, **settings):
    out = mj.near_duplicates(df, **settings).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out), key=repr)


def edited(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
    return " ".join(w)


def test_query_is_exact_on_the_tables(spark):
    rows = [(r[0], r[1]) for r in load(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                  for r in QUERIES["op11_minhash_near_dedup"](spark, SMALL).collect()), key=repr)
    assert got == slow(rows) and sum(not r[3] for r in got) > 5


@pytest.mark.parametrize("block", [7, 512])
def test_groups_of_any_size(spark, block):
    """One group holds a third of the rows, another is a chain, a third has much in common but no links."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    hot, rest = [word() for _ in range(120)], [word() for _ in range(200)]
    texts = [edited(rng, hot, rng.randint(0, 4)) for _ in range(120)]
    texts += [" ".join(hot[:96] + [word() for _ in range(24)]) for _ in range(60)]
    chain = [word() for _ in range(200)]
    for _ in range(25):
        chain = chain[5:] + [word() for _ in range(5)]
        texts.append(" ".join(chain))
    texts += [edited(rng, rest, 3) for _ in range(2)] * 5 + [" ".join(word() for _ in range(rng.randint(1, 150))) for _ in range(120)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = slow(rows)
    assert len({r[2] for r in want}) < len(rows) - 120
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), block=block) == want


def test_blocks_meet_outside_the_largest_component(spark, monkeypatch):
    """Members are numbers, linked where they differ by one: no hub sees them all."""
    rng = random.Random(6)
    values = {g: rng.sample(range(200), 120) for g in (1, 2)}

    def near(payloads, mine, others, least, root):
        v = np.array([int(p) for p in payloads])
        i, j = np.nonzero(np.abs(v[mine][:, None] - v[others][None, :]) == 1)
        return mj.forest(len(v), mine[i], others[j], root)

    rows = [(g, 1000 * g + v, str(v).encode()) for g, vs in values.items() for v in vs]
    members = spark.createDataFrame(rows, "grp long, node long, payload binary")
    got = {r["node"]: r["root"] for r in mj.connected(members, near, 1, block=10).collect()}
    for g, vs in values.items():
        root = None
        for v in range(200):
            if v not in vs:
                root = None
                continue
            root = 1000 * g + v if root is None else root
            assert got.get(1000 * g + v, 1000 * g + v) == root


def test_edge_rows(spark):
    long = " ".join(f"w{i % 90_001}" for i in range(400_000))
    rows = [(3, None), (1, ""), (2, " \n\t"), (4, "one"), (5, "ONE"), (6, "two words"), (6, "two  words "), (None, "a b c d e"), (7, "a b c d e"),
            (None, "nowhere else found"), (8, "É b c"), (9, "é b c"), (10, long), (11, long + " tail"), (-1, "one"), (12, None)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, row int, component_id string")
    assert found(df) == slow(rows)
    assert mj.near_duplicates(df.limit(0)).count() == 0


def test_other_thresholds(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = list(enumerate(edited(rng, base, rng.randint(0, 8)) for _ in range(60)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (60, 90, 100):
        assert found(df, threshold=threshold) == slow(rows, threshold)


def test_forest_is_connectivity():
    rng = np.random.default_rng(3)
    for _ in range(100):
        n, m = int(rng.integers(1, 60)), int(rng.integers(0, 80))
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        half = mj.forest(n, a[:m // 2], b[:m // 2])
        assert (mj.forest(n, a[m // 2:], b[m // 2:], half) == mj.forest(n, a, b)).all()
        label = mj.forest(n, a, b)
        assert (label <= np.arange(n)).all() and (label[label] == label).all() and (label[a] == label[b]).all()


def test_prefixes_leave_common_lists_out(spark):
    """A passage in half of all texts makes no list: its postings come last in everyone's order."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    texts = [" ".join(passage + [f"x{rng.randrange(10**9)}" for _ in range(60)]) for _ in range(100)]
    sigs = mj.signed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4).withColumnRenamed("row", "node")
    assert sigs.filter(F.size("posts") == mj.COORDINATES).count() == 100
    assert mj.prefix_lists(sigs, mj.needed()).count() == 0
