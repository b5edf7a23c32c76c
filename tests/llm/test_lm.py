"""Language-model scoring: exact counts by brute force, normalisation, held-out gain, edge rows (4)."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from quarry.llm import lm
from quarry.sources.tables import load

MEDIUM = "/root/testdata/sf0.01"


def slow_tokens(text):
    return [w for w in (text or "").encode().lower().split()] + [lm.END]


def check_base(rows, docs):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(t for i, x in docs if not held(i) for t in slow_tokens(x))
    n, v = sum(count.values()), len(count)
    want = sorted(((i if i is not None else -1), held(i), len(t := slow_tokens(x)), sum(count[w] > 0 for w in t), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 6)) for i, x in docs)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-5)


def test_counts_and_held_out_gain(spark):
    docs = [(r["doc_id"], r["text"]) for r in load(spark, MEDIUM, "documents").collect()]
    # few frequent words: most go by the shuffle join
    rows = lm.score_documents(load(spark, MEDIUM, "documents"), frequent=3000).collect()
    check_base(rows, docs)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) * 0.99
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_frequent_words_only_change_the_path(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    counts = lm._word_counts(docs.select("text"))
    a, b = lm.lexicon(counts, 200), lm.lexicon(counts, 100_000)
    assert len(a.hashes) <= 200 < len(b.hashes) and (a.tokens, a.distinct) == (b.tokens, b.distinct)
    assert len(b.hashes) == b.distinct


def test_model_is_normalised(spark):
    rng = np.random.default_rng(2)
    bigrams = rng.poisson(0.3, (lm.SLOTS, lm.SLOTS))
    model = lm.train_model(spark, bigrams, rng.poisson(0.3, (lm.SLOTS, lm.SLOTS)), 0, updates=3)
    for b1, b2 in ((0, 0), (5, 900), (1023, 7)):
        p = np.exp(model.step[b1].astype(float) + model.skip[b2, model.classes] - model.norm[b1, b2])
        assert p.sum() == pytest.approx(1.0, abs=1e-4)


def test_updates_raise_the_likelihood(spark):
    rng = np.random.default_rng(4)
    group = np.arange(lm.SLOTS) % 4
    bigrams = rng.poisson(np.where(group[:, None] == group[None, :], 2.0, 0.02))

    def likelihood(m):
        p = m.step[:, :].astype(float) + 0.0
        z = p - np.log(np.exp(p).sum(axis=1, keepdims=True))
        return float((bigrams * z).sum())

    a, b = (lm.train_model(spark, bigrams, bigrams, 0, updates=k) for k in (1, 12))
    assert likelihood(b) > likelihood(a)


def test_edges(spark):
    rows = [(None, "Ab aB\x0bÄ"), (1, None), (1, ""), (2, "x " * 50_000), (3, "x y"), (6, "never seen " * 3)]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    check_base(lm.score_documents(df, updates=1).collect(), rows)
    assert lm.score_documents(df.limit(0), updates=1).count() == 0


def test_score_by_hand(spark):
    """Scores of whole documents, token by token from the trained tables and counts."""
    df = load(spark, "/root/testdata/sf0.001", "documents")
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    train = df.select("text").filter(df.doc_id.isin([i for i in docs if not held(i)]))
    lex = lm.lexicon(lm._word_counts(train), lm.FREQUENT)
    bigrams, skips = lm._slot_counts(train, lex)
    model = lm.train_model(spark, bigrams, skips, lex.end_slot, 2)
    count = Counter(t for i, x in docs.items() if not held(i) for t in slow_tokens(x))
    own = {w: int(lex.slots[np.searchsorted(lex.hashes, lm.word_hash(w))]) for w in count}
    own = {w: s for w, s in own.items() if s < lm.OWN_SLOTS}
    slot = lambda w: own.get(w, lm.ending_slot(w))
    tokens, words = Counter(), Counter()
    for w, c in count.items():
        tokens[slot(w)] += c
        words[slot(w)] += 1

    def score(text):
        total, b1, b2 = 0.0, slot(lm.END), slot(lm.END)
        for w in slow_tokens(text):
            s = slot(w)
            total += float(model.step[b1, s]) + float(model.skip[b2, model.classes[s]]) - float(model.norm[b1, b2])
            total += 0.0 if s < lm.OWN_SLOTS else math.log((count[w] + 1) / (tokens[s] + words[s] + 1))
            b1, b2 = s, b1
        return total / math.log(10)

    got = {r["doc_id"]: r["score"] for r in lm.score_documents(df, updates=2).collect()}
    assert len(own) == lm.OWN_SLOTS and got.keys() == docs.keys()
    for i, text in docs.items():
        assert got[i] == pytest.approx(score(text), rel=1e-5, abs=1e-3)
