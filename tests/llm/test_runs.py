"""Runs of words against brute force: symbols, hand-made texts and whole tables (12)."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from quarry.llm import runs
from quarry.llm.queries import QUERIES
from quarry.sources.tables import load

SMALL = "/root/testdata/sf0.001"


def slow_runs(w):
    """Sorted (start, length, smallest period)."""
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        equal = np.append(w[:-q] == w[q:], False)
        at = np.flatnonzero(equal & ~np.append(False, equal[:-1]))
        to = np.flatnonzero(~equal & np.append(False, equal[:-1]))
        for i, j in zip(at.tolist(), to.tolist(), strict=True):
            if j - i + q >= max(24, 3 * q):
                out.setdefault((i, j - i + q), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def numbers(words):
    ids = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repeating(rng):
    k, n = rng.randint(1, 4), rng.randint(0, 300)
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 5) if n else 0):
        a, p = rng.randrange(n), rng.randint(1, 60)
        for i in range(a + p, min(n, a + rng.randint(1, 300))):
            w[i] = w[i - p]
    return w


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_symbols_against_brute_force():
    rng, total = random.Random(1), 0
    for _ in range(150):
        docs = [repeating(rng) for _ in range(rng.randint(1, 6))]
        docs += [fibonacci(rng.randint(0, 200)), docs[0] * 3, docs[0], [0] * rng.randint(0, 200), (list(range(70)) * 5)[:rng.randint(100, 350)]]
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        _, sym = np.unique(owner * 1000 + np.array([x for d in docs for x in d], dtype=np.int64), return_inverse=True)
        got = sorted((s, e - s, q) for s, e, q in zip(*(x.tolist() for x in runs.word_runs(sym, owner)), strict=True))
        want, at = [], 0
        for d in docs:
            want += [(s + at, n, q) for s, n, q in slow_runs(np.array(d, dtype=np.int64))]
            at += len(d)
        assert got == sorted(want)
        total += len(want)
    assert total > 500


def test_grammar_derives_the_text():
    rng = random.Random(2)
    for _ in range(50):
        w = np.array(repeating(rng) + [9] * rng.randint(1, 40), dtype=np.int64)
        g = runs.Grammar(w, np.zeros(len(w), dtype=np.int64))
        assert g.start.tolist() == (np.cumsum(g.size) - g.size).tolist() and g.size.sum() == len(w)
        for r, at in zip(g.rule.tolist(), g.at.tolist(), strict=True):
            assert (w[at:at + g.total[r]] == w[g.first[r]:g.first[r] + g.total[r]]).all()
        # no pair of the start sequence occurs twice
        parts = g.symbols.tolist()
        pairs = [x for i, x in enumerate(zip(parts, parts[1:], strict=False)) if not (i and x == (parts[i - 1], parts[i]))]
        assert len(pairs) == len(set(pairs))


@pytest.mark.parametrize("kind", ["one", "long period", "distinct", "steps"])
def test_long_texts_take_seconds(kind):
    import time
    n = 300_000
    w = {"one": np.zeros(n, dtype=np.int64), "long period": np.arange(n) % 70_001, "distinct": np.arange(n),
         "steps": np.where(np.arange(n) % 50 == 49, np.arange(n) + 5, 0)}[kind]
    since = time.monotonic()
    found = runs.word_runs(np.unique(w, return_inverse=True)[1], np.zeros(n, dtype=np.int64))
    assert len(found[0]) == {"one": 1, "long period": 1, "distinct": 0, "steps": n // 50}[kind]
    assert time.monotonic() - since < 20


def test_edge_rows(spark):
    unit = "a b c d e f g h "
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, unit * 3), (4, unit * 3), (4, unit * 2), (None, "x " * 23), (5, "é " + " é" * 30),
            (6, "A a " * 20), (7, "pre " + unit * 4 + "a b post"), (8, "w " * 300_000)]
    df = spark.createDataFrame([(7, t, d) for d, t in rows], "runs int, text string, doc_id long")
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.find_runs(df).collect()), key=repr)
    want = []
    for d, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = [(0, 300_000, 1)] if d == 8 else slow_runs(numbers(words))
        want.append((d, len(words), found, collapsed(words, found)))
    assert got == sorted(want, key=repr)
    assert runs.find_runs(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want, repeated = {}, 0
    for r in load(spark, SMALL, "documents").select("doc_id", "text").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            repeated += 1
        found = slow_runs(numbers(w))
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        want[r["doc_id"]] = (len(found), *best, 1000 * best[1] // best[2] if found else None,
                             sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(w, found)))
    cols = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {r["doc_id"]: tuple(r[c] for c in cols) for r in QUERIES["op12_word_runs"](spark, SMALL).collect()}
    assert got == want and repeated > 5 and sum(v[0] for v in want.values()) > 5
