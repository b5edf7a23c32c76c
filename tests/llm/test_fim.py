"""Fill-in-middle: brute force on odd texts, edge rows and the round trip (13)."""

import hashlib
import random
import re

from pyspark.sql import functions as F
from quarry.llm import fim


def slow(doc_id, text, rate=100, spm_share=50):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_share:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.fill_in_middle(df, **settings).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(rows)
    got = sorted(((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out), key=repr)
    assert got == sorted(((d, t, *slow(d, t, **settings)) for d, t in rows), key=repr)
    assert all(r["back"] == (r["text"] or "") for r in out)
    return out


def test_brute_force(spark):
    rng = random.Random(3)
    pieces = ["a", "\n", "\n\n", "é ", "字\n", "<", "<P", ">", "S>", "<M", "\r\n", " ", "😀\n", "\t"]
    rows = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 30)))) for i in range(600)]
    rows += [(i, "x\n" * 3 + rng.choice(["<P>", "<S>", "<M>"]) + "y") for i in range(600, 640)]
    assert {r["form"] for r in check(spark, rows)} == {"plain", "psm", "spm"}
    shares = [r["form"] for r in check(spark, rows, rate=40, spm_share=100)]
    assert "psm" not in shares and shares.count("spm") < len(rows) * 0.6


def test_edges(spark):
    long = "line of words\n" * 300_000 + "tail"
    rows = [(1, None), (2, ""), (3, "\n"), (4, "one"), (4, "one"), (4, "one\ntwo\nthree"), (None, "a\nb\nc"), (None, None), (-5, "x\n\n\ny"), (6, long)]
    check(spark, rows)
    empty = fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_clashing_columns_are_replaced_and_others_come_along(spark):
    df = spark.createDataFrame([("a\nb\nc", 7, "old", [1, 2], 5)], "body string, key int, output string, tags array<int>, _q_h0 int")
    r = fim.fill_in_middle(df, doc_id="key", text="body").first()
    assert r["output"] == slow(7, "a\nb\nc")[4] and r["tags"] == [1, 2] and r["_q_h0"] == 5 and r["body"] == "a\nb\nc"


def test_slices_do_not_show(spark, monkeypatch):
    rows = [(i, "ab\n" * (i % 7)) for i in range(50)]
    monkeypatch.setattr(fim, "SLICE_BYTES", 10)
    assert [b - a for a, b in fim._slices(__import__("numpy").array([4, 6, 1, 30, 2]))] == [2, 1, 1, 1]
    check(spark, rows)
