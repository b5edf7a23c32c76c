"""Suffix-array dedup against brute force over all windows (8)."""

import hashlib
import random

import pytest
from quarry.llm import suffix
from quarry.llm.queries import QUERIES
from quarry.sources.tables import load


def slow_removed(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha) of rows in reading order; ids are distinct."""
    first = {}
    out = {}
    for i, t in sorted(rows, key=lambda x: x[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            w = data[p:p + length]
            if w in first:
                gone[p:p + length] = b"\x01" * length
            else:
                first[w] = i
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.removed(df, **settings).collect()}
    want = slow_removed(rows, settings.get("length", 100))
    assert got == want, [(k, got.get(k), want[k]) for k in want if got.get(k) != want[k]][:3]


def test_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in load(spark, sf, "documents").collect()]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op8_suffix_dedup"](spark, sf).collect()}
    assert got == slow_removed(rows) and sum(x[1] for x in got.values()) > 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    alphabet = ["ab", "aé\x00", "abcdefghij "][seed - 1]
    word = lambda n: "".join(rng.choices(alphabet, k=n))
    pool = [word(rng.randint(60, 260)) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(pool)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            parts += [p if rng.random() < 0.4 else p[a:b], word(rng.randint(0, 30))]
        rows.append((i * 3 - 20, "".join(parts)))
    rows += [(1000 + i, rows[i][1]) for i in range(5)] + [(2000, "z" * 350), (2001, "z" * 180), (2002, "yz" * 200)]
    check(spark, rows)


def test_edges(spark):
    rng = random.Random(9)
    base = "".join(rng.choices("abcdefgh ", k=400))
    rows = [(1, None), (2, ""), (3, base[:99]), (4, base[:100]), (5, base[1:101]), (6, base), (7, base + "!"), (8, "x" + base[:250]), (9, base[:99])]
    check(spark, rows)
    twice = spark.createDataFrame([(4, base, 1), (4, base, 2), (4, base[50:] + "other", 3), (None, base[:150], 4)],
                                  "doc_id long, text string, pos int")
    got = sorted((r["n_bytes"], r["n_removed"]) for r in suffix.removed(twice).collect())
    assert got[0] == (150, 0) and got[2] == got[3] and got[2][1] >= 150
    assert suffix.removed(twice.limit(0)).count() == 0


def test_long_text_in_chunks(spark, monkeypatch):
    rng = random.Random(5)
    part = "".join(rng.choices("abcdefghijklmnop ", k=700))
    data = ("".join(rng.choices("abcdefghijklmnop ", k=3000)) + part + "--" + part).encode()
    whole = suffix.anchors(data)
    monkeypatch.setattr(suffix, "CHUNK", 512)
    cut = suffix.anchors(data)
    assert set(zip(whole[0].tolist(), whole[1].tolist())) == set(zip(cut[0].tolist(), cut[1].tolist()))
    for _, a, first, last in zip(*(x.tolist() for x in cut)):
        assert first <= a <= first + 68 and last >= first


def test_intervals_list_every_repeat():
    rng = random.Random(2)
    s = sorted("".join(rng.choices("ab", k=8)) for _ in range(40))
    lcp = [0] + [next((k for k in range(8) if a[k] != b[k]), 8) for a, b in zip(s, s[1:])]
    got = set(suffix.intervals(lcp, 1))
    want = set()
    for v in set(lcp[1:]) - {0}:
        i = 0
        while i < len(s):
            j = i
            while j + 1 < len(s) and lcp[j + 1] >= v:
                j += 1
            if j > i and min(lcp[i + 1:j + 1]) == v:
                want.add((v, i, j))
            i = j + 1
    assert got == want
