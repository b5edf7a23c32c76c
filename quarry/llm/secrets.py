"""Secret scan: fixed patterns plus sliding-window entropy over candidate strings.

Only DataFrame functions. A pattern's spans come from the strings between its
matches: ``split`` and ``regexp_extract_all`` cut a text at the same places, so
running lengths of both give every match's position in code points. A pattern
is applied only to texts that contain it.

The entropy method looks at candidate strings of each character class (runs of
``min_run`` or more of the class). A window of ``window`` characters slides over
a candidate; one count per symbol is kept and changed by the entering and the
leaving character, and with it the sum of c*log2(c), from which the window's
Shannon entropy follows. A candidate whose highest window entropy reaches the
class threshold is a span, unless it is plain words or a number. Parts (between
/ _ + -) that hold a placeholder or a running alphabet are cut out first, and what
is left on either side is judged by itself. Words are of one case or capitalised
(further humps have three letters or more), so letters of mixed case are not words.

Defined results: null text is read as empty and has no spans; ends are
exclusive; spans of all kinds are kept even where they overlap; repeated rows
are scanned alike; an empty table gives no rows. Columns that a caller passes
along are untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.util import need

# The contract's patterns, in listed order. name, pattern, group measured, least length.
ASSIGN = (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
          r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
BASE = (("assign", ASSIGN, 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))
# The same matches, found without stopping at every short run (a maximal run of the
# length asked for starts where the maximal run starts).
SEARCH = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}


@dataclass(frozen=True)
class CharClass:
    """A character class of the entropy method."""

    name: str
    pattern: str
    threshold: float


HEX = CharClass("entropy_hex", r"[0-9A-Fa-f]{20,}", 3.05)
BASE64 = CharClass("entropy_base64", r"[A-Za-z0-9+/_-]{20,}", 3.62)
CLASSES = (HEX, BASE64)
WINDOW = 20
# The allow-list: plain words, numbers, and pieces that mark a placeholder or a running alphabet.
PLAIN = (r"^[A-Za-z]?[a-z]+$", r"^[A-Z]+$", r"^[0-9]+$")
# Possessive, so long candidates neither backtrack nor recurse.
_WORD = r"(?>[A-Z]++(?=[_/+-]|$)|[A-Z]?+[a-z]++(?:[A-Z][a-z]{2,}+)*+)"
WORDS = (*PLAIN, rf"^{_WORD}(?:[_/+-]{_WORD})*+$")
PIECES = r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[xX]{6}|0123456789|[aA][bB][cC][dD][eE][fF][gG]"

SPAN = "struct<start:bigint,ord:int,kind:string,stop:bigint>"


def _spans(text: Column, kind: str, order: int, pattern: str, kept) -> Column:
    """Spans of one pattern; ``kept(matches)`` is a boolean array beside the matches."""
    search = f"({pattern})"
    found = F.regexp_extract_all(text, F.lit(search), F.lit(1))
    between = F.split(text, search, -1)
    lengths = F.zip_with(between, F.concat(found, F.array(F.lit(""))),
                         lambda b, m: F.struct(F.length(b).cast("long").alias("b"), F.length(m).cast("long").alias("m")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("out"))
    walked = F.aggregate(lengths, start, lambda acc, x: F.struct(
        (acc["at"] + x["b"] + x["m"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + x["b"]).alias("start"),
                                              (acc["at"] + x["b"] + x["m"]).alias("stop")))).alias("out")))["out"]
    tagged = F.zip_with(F.slice(walked, F.lit(1), F.size(found)), kept(found),
                        lambda s, ok: F.struct(s["start"].alias("start"), F.lit(order).alias("ord"),
                                               F.lit(kind).alias("kind"), s["stop"].alias("stop"), ok.alias("ok")))
    good = F.transform(F.filter(tagged, lambda s: s["ok"]),
                       lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"),
                                          s["kind"].alias("kind"), s["stop"].alias("stop")))
    return F.when(text.rlike(pattern), good).otherwise(F.array().cast(f"array<{SPAN}>"))


def _base_spans(text: Column, order: int, kind: str, pattern: str, group: int, least: int) -> Column:
    if group == 0:
        return _spans(text, kind, order, SEARCH[kind], lambda m: F.transform(m, lambda x: F.length(x) >= least))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return _spans(text, kind, order, pattern, lambda m: F.transform(measured, lambda x: F.length(x) >= least))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once; named inside another fold it would be made anew for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _changed(counts: Column, at: Column, by: int) -> Column:
    return F.concat(F.slice(counts, F.lit(1), at - 1), F.array(F.element_at(counts, at) + by),
                    F.slice(counts, at + 1, F.size(counts)))


def reaches_entropy(candidate: Column, window: int, threshold: float) -> Column:
    """True when some window of ``candidate`` has at least ``threshold`` bits a character.

    One fold over the characters, each beside the one that leaves the window;
    counts are kept for the characters that occur, and once a window has reached
    the threshold the rest is passed over. A candidate of fewer different
    characters than a window of that entropy needs is not walked at all.
    """
    limit = window * (math.log2(window) - threshold)  # H = log2(window) - total / window
    part = [0.0, 0.0, *(c * math.log2(c) for c in range(2, window + 2))]
    steps = F.array(*[F.lit(b - a) for a, b in zip(part, part[1:], strict=False)])  # what one more adds to c * log2(c)

    def slide(acc: Column, x: Column) -> Column:
        counts, total, came, gone = acc["counts"], acc["total"], x["came"], x["gone"]
        here = F.element_at(counts, came)
        there = F.element_at(counts, F.greatest(gone, F.lit(1)))
        same = came == gone
        gain = F.element_at(steps, here + 1)
        now = F.when(same, total).when(gone > 0, total + gain - F.element_at(steps, there)).otherwise(total + gain)
        kept = F.when(same, counts).when(gone > 0, _changed(_changed(counts, came, 1), gone, -1)) \
                .otherwise(_changed(counts, came, 1))
        moved = F.struct(kept.alias("counts"), now.alias("total"),
                         F.when(gone >= 0, F.least(acc["least"], now)).otherwise(acc["least"]).alias("least"))
        return F.when(acc["least"] <= limit, acc).otherwise(moved)

    def walk(codes: Column, symbols: Column) -> Column:
        # -1 until the first window is full, 0 where nothing leaves yet
        leaving = F.concat(F.array_repeat(F.lit(-1), window - 1), F.array(F.lit(0)),
                           F.slice(codes, F.lit(1), F.greatest(F.size(codes) - window, F.lit(0))))
        pairs = F.zip_with(codes, F.slice(leaving, F.lit(1), F.size(codes)), lambda c, g: F.struct(c.alias("came"), g.alias("gone")))
        start = F.struct(F.array_repeat(F.lit(0), symbols).alias("counts"), F.lit(0.0).alias("total"), F.lit(float("inf")).alias("least"))
        return F.when(symbols < math.ceil(2 ** threshold - 1e-9), F.lit(False)).otherwise(F.aggregate(pairs, start, slide)["least"] <= F.lit(limit))

    chars = F.slice(F.split(candidate, ""), F.lit(1), F.length(candidate))
    return _bound(chars, lambda ch: _bound(F.struct(ch.alias("ch"), F.array_distinct(ch).alias("held")), lambda s: _bound(
        F.struct(F.transform(s["ch"], lambda c: F.array_position(s["held"], c).cast("int")).alias("codes"), F.size(s["held"]).alias("n")),
        lambda t: walk(t["codes"], t["n"]))))


def _entropy_spans(text: Column, order: int, cls: CharClass, window: int, allow: tuple[str, ...], pieces: str) -> Column:
    def secret(x: Column, bare: Column) -> Column:
        allowed = F.lit(False)
        for a in allow:
            allowed = allowed | bare.rlike(a)
        return F.when(allowed | (F.length(x) < window), F.lit(False)).otherwise(
            reaches_entropy(x, window, cls.threshold))

    def kept(found: Column) -> Column:
        def ok(x: Column) -> Column:
            cut = F.regexp_replace(x, f"(?<![A-Za-z0-9])[A-Za-z0-9]*?(?:{pieces})[A-Za-z0-9]*+", " ")
            return F.when(x.rlike(pieces), F.exists(
                F.split(cut, " "), lambda p: secret(p, F.btrim(p, F.lit("/_+-"))))).otherwise(secret(x, x))
        return F.transform(found, ok)

    return _spans(text, cls.name, order, cls.pattern, kept)


def secret_spans(text: Column, classes: tuple[CharClass, ...] = CLASSES, window: int = WINDOW,
                 allow: tuple[str, ...] = WORDS, pieces: str = PIECES) -> tuple[Column, Column]:
    """(base spans, method spans): arrays of (start, ord, kind, stop) in pattern order."""
    text = F.coalesce(text, F.lit(""))
    base = F.concat(*[_base_spans(text, i, *spec) for i, spec in enumerate(BASE)])
    more = F.concat(*[_entropy_spans(text, len(BASE) + i, c, window, allow, pieces) for i, c in enumerate(classes)])
    return base, more


def scan(df: DataFrame, text: str = "text", name: str = "secrets", **settings) -> DataFrame:
    """Add ``name``: all spans of a text, sorted by start, then kind."""
    need(df, text)
    base, more = secret_spans(F.col(text), **settings)
    return df.withColumn(name, F.array_sort(F.concat(base, more)))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]", **settings) -> DataFrame:
    """Replace every span (overlapping ones as one) by ``mark``; other texts, null included, stay as they are."""
    found = scan(df, text, "_q_spans", **settings)
    spans, body = F.col("_q_spans"), F.col(text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    cut = F.aggregate(spans, start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["stop"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(
            F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                     F.lit(mark))).alias("out")))
    tail = F.substring(body, (cut["at"] + 1).cast("int"), F.length(body))
    return found.withColumn(text, F.when(F.size(spans) > 0, F.concat(cut["out"], tail)).otherwise(body)).drop("_q_spans")
