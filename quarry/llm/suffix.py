"""Suffix-array dedup: maximal repeat groups by a stack scan of common-prefix intervals.

Every ``length``-byte window of a text is owned by its anchor, the window's
K-byte gram of smallest hash (leftmost of equals). Equal windows own equal
anchors, so two texts can share ``length`` bytes only where an anchor occurs
twice, and only such anchors' surroundings are compared.

The suffixes at equal anchors are sorted by the bytes that follow: an enhanced
suffix array with its common-prefix lengths. A stack scan lists the array's
common-prefix intervals (right-maximal repeats). The members of an interval are
ordered by the bytes that precede, and a second stack scan over their common
left extensions finds where extensions differ: each node (left, right) with
left + right >= ``length`` is a maximal repeat, with all occurrences. In each
group every occurrence but the earliest (smaller id, then earlier start) is a
removed span. Spans are judged on the input texts.

Exact copies of an earlier text are found by their digest and never reach the
array. Equal surroundings are collapsed to their earliest occurrence while
anchors stream by, so a task holds the distinct surroundings of one anchor.

Defined results: null text is empty; texts under ``length`` bytes lose nothing;
matches never cross texts; rows that repeat (id, text) are one document, with
equal results; different texts of one id count as documents in the order of a
checksum; a null id is smaller than any other; texts are used whole; an empty
table gives no rows. Extra columns are ignored. The input is read several times
and must give the same rows, as files do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.ngram_join import mixed
from quarry.llm.util import bounds, need, pinned, sent_if_small, texts_of, whole_groups
from quarry.session import shuffle_partitions

LENGTH, GRAM = 100, 32
CHUNK = 1 << 20
LEAST_ID = -(1 << 63)
U = np.uint64
_FACTORS = tuple(map(U, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)))
_POSITION = U((1 << 31) - 1)


def gram_hashes(data: bytes) -> np.ndarray:
    """Hash of the GRAM bytes at every position."""
    n = len(data)
    word = np.empty(n - 7, dtype=np.uint64)
    for o in range(8):
        m = (n - o) // 8
        word[o::8] = np.frombuffer(data, dtype="<u8", count=m, offset=o)
    end = n - GRAM + 1
    h = word[:end] * _FACTORS[0]
    for i in range(1, GRAM // 8):
        h += word[8 * i:end + 8 * i] * _FACTORS[i]
    return mixed(h)


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first owned window, last owned window) of a text's anchors."""
    out = []
    span = length - GRAM + 1
    for at in range(0, len(data) - length + 1, CHUNK):
        part = data[at:at + CHUNK + length - 1]
        h = gram_hashes(part)
        low = h & ~_POSITION | np.arange(len(h), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:width - span], low[span - width:])
        pos = (low & _POSITION).astype(np.int64)
        cuts = bounds(pos)
        a = pos[cuts[:-1]]
        out.append((h[a].view(np.int64), a + at, cuts[:-1] + at, cuts[1:] - 1 + at))
    if not out:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _same_as_neighbour(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a stream sorted by ``h`` whose h occurs more than once."""
    held, held_same = None, False  # the last row so far and whether it equals the one before it
    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        h = b.column("h").to_numpy()
        same = h[1:] == h[:-1]
        keep = np.zeros(len(h), dtype=bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= held_same if held is not None else False
        if len(h) > 1:
            yield b.slice(0, len(h) - 1).filter(pa.array(keep[:-1]))
            held, held_same = b.slice(len(h) - 1), bool(same[-1])
        else:
            held, held_same = b, held_same if held is not None else False
    if held is not None and held_same:
        yield held


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval with a prefix >= least, inner ones first."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(lcp) + 1):
        here = lcp[i] if i < len(lcp) else -1
        first = i - 1
        while stack and stack[-1][0] > here:
            value, first = stack.pop()
            yield value, first, i - 1
        if here >= least and (not stack or stack[-1][0] < here):
            stack.append((here, first))


def maximal_repeats(right: list[int], rank: list[int], left: list[int], age: list[int], length: int,
                    least: int = GRAM) -> Iterator[tuple[int, int, int, list[int]]]:
    """(left, right, earliest member, later members that no longer left extension has listed for this right).

    ``right``: common prefix of each suffix with the one before it; ``rank``: a
    suffix's place in the order of left extensions; ``left``: common left
    extension of each place with the one before it; ``age``: order of occurrence.
    """
    for value, first, last in intervals(right, least):
        short = length - value
        members = sorted(range(first, last + 1), key=rank.__getitem__)
        common = [0] + [min(left[rank[a] + 1:rank[b] + 1]) for a, b in zip(members, members[1:], strict=False)]
        listed: set[int] = set()
        for extension, lo, hi in intervals(common, max(short, 0)):
            group = members[lo:hi + 1]
            head = min(group, key=age.__getitem__)
            later = [m for m in group if m != head and m not in listed]
            listed.update(later)
            if later:
                yield extension, value, head, later


def _padded(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of ``width`` bytes from ``start`` on, forwards or backwards, zero behind their size."""
    at = np.arange(width)
    inside = at[None, :] < size[:, None]
    where = np.where(inside, start[:, None] + step * at[None, :], 0)
    return np.where(inside, data[where] if len(data) else 0, 0).astype(np.uint8)


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """Big-endian words of byte rows, so that numbers sort as bytes do."""
    pad = -rows.shape[1] % 8
    full = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad))))
    return list(full.view(">u8").astype(np.uint64).T)


def _common(a: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Common prefix of every row with the row before it (0 for the first)."""
    out = np.zeros(len(a), dtype=np.int64)
    if len(a) > 1:
        differ = a[1:] != a[:-1]
        n = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
        out[1:] = np.minimum(n, np.minimum(size[1:], size[:-1]))
    return out


SPANS = "oid long, tie int, start long, stop long, first_oid long, first_start long"


def _repeat_spans(table: pa.Table, length: int) -> pa.RecordBatch | None:
    """Removed spans of whole anchor groups (h, oid, tie, pos, o, ctx)."""
    table = table.combine_chunks()
    h, oid, tie, pos, o = (table.column(c).to_numpy().astype(np.int64) for c in ("h", "oid", "tie", "pos", "o"))
    ctx = table.column("ctx").combine_chunks()
    ctx = ctx.chunk(0) if isinstance(ctx, pa.ChunkedArray) else ctx
    offsets = np.frombuffer(ctx.buffers()[1], dtype=np.int32)[ctx.offset:ctx.offset + len(ctx) + 1].astype(np.int64)
    data = np.frombuffer(ctx.buffers()[2], dtype=np.uint8) if ctx.buffers()[2] is not None else np.zeros(0, np.uint8)
    size = np.diff(offsets)
    r = size - o
    ahead = _padded(data, offsets[:-1] + o, r, length, 1)
    behind = _padded(data, offsets[:-1] + o - 1, o, length - GRAM, -1)
    order = np.lexsort([pos, tie, oid, o, *_words(behind)[::-1], r, *_words(ahead)[::-1], h])
    h, oid, tie, pos, o, r, ahead, behind = (x[order] for x in (h, oid, tie, pos, o, r, ahead, behind))
    right = _common(ahead, r)
    right[1:][h[1:] != h[:-1]] = -1
    left = _common(behind, o)
    equal = np.zeros(len(h), dtype=bool)  # same surroundings as the row before
    equal[1:] = (h[1:] == h[:-1]) & (right[1:] == r[1:]) & (r[1:] == r[:-1]) & (left[1:] == o[1:]) & (o[1:] == o[:-1])
    again = equal.copy()  # the same occurrence, read twice
    again[1:] &= (oid[1:] == oid[:-1]) & (tie[1:] == tie[:-1]) & (pos[1:] == pos[:-1])
    head = np.maximum.accumulate(np.where(equal, 0, np.arange(len(h))))
    later = np.flatnonzero(equal & ~again & ((oid != oid[head]) | (tie != tie[head]) | (pos != pos[head])))
    spans = [(oid[later], tie[later], pos[later] - o[later], pos[later] + r[later], oid[head[later]], pos[head[later]] - o[later])]

    # distinct surroundings of every anchor; common prefixes over dropped rows are those of their heads
    kept = np.flatnonzero(~equal)
    h, oid, tie, pos, o, r, ahead, behind = (x[kept] for x in (h, oid, tie, pos, o, r, ahead, behind))
    right = _common(ahead, r)
    cuts = bounds(h)
    sizes = np.diff(cuts)
    two = cuts[:-1][sizes == 2]
    if len(two):
        a, b = two, two + 1
        differ = behind[a] != behind[b]
        shared = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), behind.shape[1]), np.minimum(o[a], o[b]))
        older = (oid[a] < oid[b]) | (oid[a] == oid[b]) & ((tie[a] < tie[b]) | (tie[a] == tie[b]) & (pos[a] < pos[b]))
        f, s = np.where(older, a, b), np.where(older, b, a)
        ok = shared + right[b] >= length
        f, s, shared, reach = f[ok], s[ok], shared[ok], right[b][ok]
        spans.append((oid[s], tie[s], pos[s] - shared, pos[s] + reach, oid[f], pos[f] - shared))
    for at in np.flatnonzero(sizes > 2):
        lo, hi = cuts[at], cuts[at + 1]
        n = hi - lo
        by_left = np.lexsort([o[lo:hi], *_words(behind[lo:hi])[::-1]])
        rank = np.empty(n, dtype=np.int64)
        rank[by_left] = np.arange(n)
        common_left = _common(behind[lo:hi][by_left], o[lo:hi][by_left])
        by_age = np.lexsort([pos[lo:hi], tie[lo:hi], oid[lo:hi]])
        age = np.empty(n, dtype=np.int64)
        age[by_age] = np.arange(n)
        rows = [(m, e, v, first) for e, v, first, group in maximal_repeats(
            [0, *right[lo + 1:hi].tolist()], rank.tolist(), common_left.tolist(), age.tolist(), length) for m in group]
        if rows:
            m, e, v, f = (np.array(x) for x in zip(*rows, strict=True))
            m, f = m + lo, f + lo
            spans.append((oid[m], tie[m], pos[m] - e, pos[m] + v, oid[f], pos[f] - e))
    cols = [np.concatenate(x) for x in zip(*spans, strict=True)]
    if not len(cols[0]):
        return None
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32 if i == 1 else np.int64)) for i, c in enumerate(cols)],
                                      names=[c.split()[0] for c in SPANS.split(", ")])


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_ID)).alias("oid"),
                       F.crc32(body.cast("binary")).bitwiseAND(F.lit(0xFFFFFF)).cast("int").alias("tie"), body.alias("text"))


def repeat_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans (start, stop in bytes) of (oid, tie, text) that repeat an earlier occurrence, group by group."""
    n = shuffle_partitions(texts.sparkSession)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for oid, tie, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2)), strict=True):
                h, a, _, _ = anchors(data, length)
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), oid)), pa.array(np.full(len(h), tie, dtype=np.int32)),
                                                      pa.array(a)], names=["h", "oid", "tie", "pos"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= 20_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    where = "h long, oid long, tie int, pos long"
    repeated = (texts.mapInArrow(lambda it: gathered(places(it)), where).repartition(n, "h").sortWithinPartitions("h")
                .mapInArrow(_same_as_neighbour, where))
    wanted = pinned(repeated.groupBy("oid", "tie").agg(F.collect_set("pos").alias("at")))
    wanted = wanted.select(F.col("oid").alias("_o"), F.col("tie").alias("_t"), "at")
    few = sent_if_small(wanted.select("_o", "_t"))
    on = (F.col("oid") == F.col("_o")) & (F.col("tie") == F.col("_t"))
    met = texts.join(few, on, "left_semi").join(wanted, on)

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for oid, tie, data, at in zip(b.column("oid").to_pylist(), b.column("tie").to_pylist(), texts_of(b.column("text")),
                                          b.column("at").to_pylist(), strict=True):
                h, a, first, last = anchors(data, length)
                pick = np.flatnonzero(np.isin(a, np.array(at, dtype=np.int64)))
                ctx = [data[first[i]:last[i] + length] for i in pick]
                yield pa.RecordBatch.from_arrays([
                    pa.array(h[pick]), pa.array(np.full(len(pick), oid)), pa.array(np.full(len(pick), tie, dtype=np.int32)),
                    pa.array(a[pick]), pa.array((a - first)[pick].astype(np.int32)), pa.array(ctx, pa.binary())],
                    names=["h", "oid", "tie", "pos", "o", "ctx"])

    near = "h long, oid long, tie int, pos long, o int, ctx binary"
    laid = (met.select("oid", "tie", "text", "at").mapInArrow(lambda it: gathered(surroundings(it)), near)
            .repartition(n, "h").sortWithinPartitions("h", "ctx", "o", "oid", "tie", "pos"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def collapsed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Only the first three of equal surroundings go on; the rest are spans at once."""
            last = None
            for b in it:
                if not b.num_rows:
                    continue
                h, o, ctx = b.column("h").to_pylist(), b.column("o").to_pylist(), b.column("ctx").to_pylist()
                where = list(zip(b.column("oid").to_pylist(), b.column("tie").to_pylist(), b.column("pos").to_pylist(), strict=True))
                keep, out = [], []
                for i, key in enumerate(zip(h, ctx, o, strict=True)):
                    if last is None or last[0] != key:
                        last = (key, where[i])
                        keep.append(i)
                    elif where[i] != last[1]:
                        x, t, p = where[i]
                        out.append((x, t, p - o[i], p - o[i] + len(ctx[i]), last[1][0], last[1][2] - o[i]))
                if out:
                    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
                    done.append(pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                           names=[c.split()[0] for c in SPANS.split(", ")]))
                yield b.take(pa.array(keep, pa.int64()))

        done: list[pa.RecordBatch] = []
        for t in whole_groups(collapsed(batches), "h"):
            found = _repeat_spans(t, length)
            if found is not None:
                done.append(found)
            while done:
                yield done.pop()
        while done:
            yield done.pop()

    return laid.mapInArrow(compare, SPANS)



def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    need(docs, doc_id, text)
    texts = _identified(docs, doc_id, text)
    known = pinned(texts.select("oid", "tie", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")))
    heads = (known.filter(F.col("n_bytes") >= length).groupBy("sha").agg(F.min("oid").alias("head"), F.max("oid").alias("top"))
             .filter("top > head").select("sha", "head"))
    copies = pinned(known.join(heads, "sha").filter("oid > head").select(F.col("oid").alias("_o"), F.col("tie").alias("_t")).distinct())
    on = (F.col("oid") == F.col("_o")) & (F.col("tie") == F.col("_t"))
    alive = texts.filter(F.octet_length("text") >= length).join(sent_if_small(copies), on, "left_anti")
    spans = (repeat_spans(alive, length).groupBy("oid", "tie")
             .agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    spans = pinned(spans).select(F.col("oid").alias("_o"), F.col("tie").alias("_t"), "spans")
    met = alive.join(sent_if_small(spans.select("_o", "_t")), on, "left_semi").join(spans, on)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for oid, tie, data, found in zip(b.column("oid").to_pylist(), b.column("tie").to_pylist(), texts_of(b.column("text")),
                                             b.column("spans").to_pylist(), strict=True):
                at, gone, runs, parts = 0, 0, 0, []
                reach = -1  # end of the open run
                for s in sorted((x["start"], x["stop"]) for x in found):
                    if s[0] > reach:
                        runs += 1
                        parts.append(data[at:s[0]])
                        gone += s[1] - s[0]
                        reach = s[1]
                    elif s[1] > reach:
                        gone += s[1] - reach
                        reach = s[1]
                    at = reach
                parts.append(data[at:])
                kept = b"".join(parts)
                rows.append((oid, tie, gone, runs, hashlib.sha256(kept).hexdigest()))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 names=["oid", "tie", "n_removed", "n_spans", "kept_sha256"])

    done = (met.select("oid", "tie", "text", "spans").mapInArrow(cut, "oid long, tie int, n_removed long, n_spans long, kept_sha256 string")
            .dropDuplicates(["oid", "tie"]).select(F.col("oid").alias("_o"), F.col("tie").alias("_t"), "n_removed", "n_spans", "kept_sha256"))
    whole = copies.select("_o", "_t", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                          F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256"))
    return (known.join(done.unionByName(whole), on, "left")
            .select(F.when(F.col("oid") != LEAST_ID, F.col("oid")).alias("doc_id"), "n_bytes",
                    F.coalesce("n_removed", F.when(F.col("n_spans").isNotNull(), F.col("n_bytes")).otherwise(0)).cast("long").alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")))
