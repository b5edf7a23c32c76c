"""Periodic runs of words, found on a Re-Pair grammar of every text.

A run is a stretch of words with smallest period q and a length of at least
max(24, 3q) that no neighbouring word extends. Each text's word ids are
compressed by Re-Pair: in rounds, pairs of neighbours that occur twice become
nonterminals, the more frequent pair winning where two overlap, until no pair
occurs twice. Texts of a batch are compressed side by side on symbols of their
own, so all steps are array operations over the batch.

Every run lies inside some smallest node of the derivation and crosses a
boundary between two of its children. So runs are computed once for each
nonterminal, around its boundary and inside its expansion, and around each
boundary of the start sequence inside the whole text; they are then translated
to all derivation positions of the nonterminal, and intervals contained in
another of the same period are merged into it.

Around a boundary, at least half of a run lies on one side, so for a period in
[2w, 4w) some w words beside the boundary occur again at that distance (w = 4
serves all periods below 16). Candidates are looked up among equal w-grams,
doubling w while grams still repeat; each is extended word by word, exactly. A
multiple of a period found around the same boundary is not extended again.

Defined results: words are parted by ASCII blanks and compared byte by byte;
null and blank texts have no words and no runs; rows that repeat an id are
handled each on its own; texts are used whole; an empty table gives no rows.
Nothing depends on another row, so there is no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.util import need, texts_of

LEAST, EXPONENT = 24, 3
# Words that are compressed side by side; a longer text goes alone.
SLICE_WORDS = 200_000
# Most candidates and most compared words held at once.
CANDIDATES, COMPARED = 1 << 20, 1 << 22

U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


class Grammar:
    """Re-Pair of the symbols ``sym``; pairs never join different ``owner``.

    ``symbols``, ``start``, ``size``: the start sequences with each symbol's place and length.
    Per nonterminal: ``left`` (length of its first child), ``total``, ``first``
    (one derivation position); ``rule``/``at``: all derivation positions.
    """

    def __init__(self, sym: np.ndarray, owner: np.ndarray):
        n = len(sym)
        base = int(sym.max()) + 1 if n else 0
        wide = base + n + 1  # symbols never outnumber this, so a pair is one integer
        seq, start, size = sym.astype(np.int64), np.arange(n), np.ones(n, dtype=np.int64)
        open_pair, again = owner[1:] == owner[:-1], False
        known, ids, uses = (np.zeros(0, dtype=np.int64) for _ in range(3))
        left, total, first, rules, places = [], [], [], [], []
        made = 0
        while True:
            if again and not open_pair.any():  # an earlier nonterminal made anew may repeat a pair that was closed
                open_pair, again = owner[start[1:]] == owner[start[:-1]], False
            at = np.flatnonzero(open_pair)
            if not len(at):
                break
            key = seq[at] * wide + seq[at + 1]
            pairs, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
            if len(known):  # an earlier nonterminal's uses count as well
                where = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                count = count + np.where(known[where] == pairs, uses[where], 0)
            open_pair[at[count[inverse] < 2]] = False
            if not open_pair.any():
                continue
            rank = np.zeros(len(seq) + 1, dtype=np.uint64)  # shifted by one: a zero on either side
            weight = np.minimum(count, 1 << 23).astype(U) << U(40) | _mixed(pairs.astype(U)) >> U(24)
            rank[1 + at] = np.where(count[inverse] < 2, U(0), weight[inverse])
            cuts = np.concatenate([[0], np.flatnonzero(rank[1:] != rank[:-1]) + 1, [len(rank)]])
            level = rank[cuts[:-1]]
            top = level > 0
            top[1:] &= level[1:] > level[:-1]
            top[:-1] &= level[:-1] > level[1:]
            group = np.repeat(np.arange(len(level)), np.diff(cuts))
            take = top[group] & ((np.arange(len(rank)) - cuts[group]) % 2 == 0)
            i = np.flatnonzero(take[1:])
            key = seq[i] * wide + seq[i + 1]
            pairs, one, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            where = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            old = known[where] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
            rule = np.where(old, ids[where] if len(ids) else 0, made + np.cumsum(~old) - 1)
            new = one[~old]
            again |= bool(old.any())
            left.append(size[i[new]])
            total.append(size[i[new]] + size[i[new] + 1])
            first.append(start[i[new]])
            if len(uses):
                uses[where[old]] += count[old]
            order = np.argsort(np.concatenate([known, pairs[~old]]), kind="stable")
            known = np.concatenate([known, pairs[~old]])[order]
            ids = np.concatenate([ids, rule[~old]])[order]
            uses = np.concatenate([uses, count[~old]])[order]
            made += len(new)
            rules.append(rule[inverse])
            places.append(start[i])
            # the pair's first symbol becomes the nonterminal, the second goes
            seq[i] = base + rule[inverse]
            size[i] += size[i + 1]
            fresh = np.zeros(len(seq), dtype=bool)
            fresh[i] = True
            keep = np.ones(len(seq), dtype=bool)
            keep[i + 1] = False
            was = np.append(open_pair, False)[keep]
            seq, start, size, fresh = seq[keep], start[keep], size[keep], fresh[keep]
            own = owner[start]
            open_pair = (was[:-1] & ~fresh[:-1] | fresh[:-1] | fresh[1:]) & (own[1:] == own[:-1])
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64)
        self.symbols, self.start, self.size = seq, start, size
        self.left, self.total, self.first = join(left), join(total), join(first)
        self.rule, self.at = join(rules), join(places)


def _matches(sym: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from a and b on (``step`` 1 or -1) are equal, at most ``room``."""
    out = np.zeros(len(a), dtype=np.int64)
    todo, width = np.flatnonzero(room > 0), 8
    while len(todo):
        more = []
        for part in np.array_split(todo, max(1, len(todo) * width // COMPARED)):
            t = out[part][:, None] + np.arange(width)
            inside = t < room[part][:, None]
            t = np.where(inside, t, 0) * step
            same = (sym[a[part][:, None] + t] == sym[b[part][:, None] + t]) & inside
            n = np.where(same.all(axis=1), width, same.argmin(axis=1))
            out[part] += n
            more.append(part[n == width])
        todo = np.concatenate(more)
        width = min(2 * width, 4096)
    return out


class _Found:
    """Runs found around boundaries, looked up when multiples of their period come by."""

    def __init__(self, boundaries: int):
        self.rows = np.zeros((4, 0), dtype=np.int64)  # boundary, period, start, stop
        self.n = boundaries

    def add(self, rows: np.ndarray) -> None:
        rows = np.unique(np.concatenate([self.rows, rows], axis=1), axis=1)
        self.rows = rows

    def covers(self, boundary: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a run of a period that divides q reaches from low - its period, or to high + its period."""
        b, period, start, stop = self.rows
        at, end = np.searchsorted(b, boundary), np.searchsorted(b, boundary, side="right")
        out = np.zeros(len(boundary), dtype=bool)
        todo = np.flatnonzero(at < end)
        while len(todo):
            k = at[todo]
            p = period[k]
            out[todo] |= (q[todo] % p == 0) & (start[k] <= low[todo]) & (stop[k] >= high[todo]) & (
                (stop[k] >= high[todo] + p) | (start[k] <= low[todo] - p))
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
        return out


def _grams(h: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places whose gram repeats, class of every place or -1, sorted class * n + place)."""
    order = np.argsort(h, kind="stable")
    value = h[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = value[1:] != value[:-1]
    single = new & np.append(new[1:], True)
    order, new = order[~single], new[~single]
    cls = np.cumsum(new) - 1
    place = at[order]
    of = np.full(n, -1, dtype=np.int64)
    of[place] = cls
    return np.sort(place), of, cls * n + place


def _boundary_runs(sym: np.ndarray, cut: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(boundary index, period, start, stop) of the runs inside [low, high) around each cut."""
    n = len(sym)
    found = _Found(len(cut))
    widest = int((high - low).max()) if len(cut) else 0
    h = _mixed(sym.astype(U) + U(0x9E3779B97F4A7C15))
    h = _mixed(h[:-1] * U(3) + h[1:]) if n > 1 else h[:0]
    h = _mixed(h[:-2] * U(5) + h[2:]) if n > 3 else h[:0]
    w, at, levels = 4, np.arange(len(h)), [(1, 2), (2, 4), (4, 8), (8, 16)]
    while len(at):
        kept, of, keys = _grams(h, at, n)
        for q_from, q_to in levels:
            for right in (True, False):
                base = cut if right else cut - w
                some = np.flatnonzero((base >= low) & (base + w <= high) & (EXPONENT * q_from <= high - low))
                some = some[of[base[some]] >= 0]
                key = of[base[some]] * n + base[some]
                # places of the same gram at a distance of q_from .. q_to - 1
                lo = np.searchsorted(keys, key + q_from if right else key - q_to + 1)
                hi = np.searchsorted(keys, key + q_to if right else key - q_from + 1)
                # a neighbouring class may begin in that range of keys
                lo = np.where(right, lo, np.maximum(lo, np.searchsorted(keys, of[base[some]] * n)))
                hi = np.where(right, np.minimum(hi, np.searchsorted(keys, (of[base[some]] + 1) * n)), hi)
                size = np.maximum(hi - lo, 0)
                ends = np.cumsum(size)
                done = 0
                while done < len(some):
                    behind = ends[done - 1] if done else 0
                    to = max(done + 1, int(np.searchsorted(ends, behind + CANDIDATES, side="right")))
                    part = np.arange(done, to)
                    done = to
                    row = np.repeat(part, size[part])
                    if not len(row):
                        continue
                    other = keys[lo[row] + np.arange(len(row)) - (ends[row] - size[row] - behind)] % n
                    b = some[row]
                    here = base[b]
                    q = np.abs(other - here)
                    i = np.minimum(other, here)
                    ok = (i >= low[b]) & (i + q + w <= high[b]) & (EXPONENT * q <= high[b] - low[b])
                    b, q, i = b[ok], q[ok], i[ok]
                    ok = ~found.covers(b, q, cut[b] if right else cut[b] - q, cut[b] + q if right else cut[b])
                    b, q, i = b[ok], q[ok], i[ok]
                    ahead = _matches(sym, i, i + q, high[b] - i - q, 1)
                    back = _matches(sym, i - 1, i + q - 1, i - low[b], -1)
                    long = ahead + back + q >= np.maximum(LEAST, EXPONENT * q)
                    found.add(np.stack([b, q, i - back, i + ahead + q])[:, long])
        if EXPONENT * 4 * w > widest:
            break
        # grams of twice the width, where both halves repeat
        both = kept[kept + w < n]
        both = both[of[both + w] >= 0]
        h = _mixed(of[both].astype(U) * U(0x9E3779B97F4A7C15) + of[both + w].astype(U))
        w, at, levels = 2 * w, both, [(4 * w, 8 * w)]
    return found.rows


def maximal(period: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) sorted: intervals not contained in another of their period, each with its smallest period."""
    order = np.lexsort([-stop, start, period])
    period, start, stop = period[order], start[order], stop[order]
    far = np.zeros(len(stop), dtype=bool)
    if len(stop):
        wide = int(stop.max()) + 1
        reach = np.maximum.accumulate(stop + wide * period)
        far = np.ones(len(stop), dtype=bool)
        far[1:] = (stop + wide * period)[1:] > reach[:-1]
    period, start, stop = period[far], start[far], stop[far]
    order = np.lexsort([period, stop, start])
    period, start, stop = period[order], start[order], stop[order]
    one = np.ones(len(stop), dtype=bool)
    one[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return start[one], stop[one], period[one]


def word_runs(sym: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of all runs of the texts laid end to end; equal symbols belong to one owner."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    if not len(sym):
        return none
    g = Grammar(sym, owner)
    opens = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    text = np.cumsum(np.append(True, owner[1:] != owner[:-1])) - 1
    closes = np.append(opens[1:], len(sym))
    inner = g.start[g.start != opens[text[g.start]]]
    inner = inner[(closes - opens)[text[inner]] >= LEAST]
    wide = np.flatnonzero(g.total >= LEAST)
    cut = np.concatenate([inner, g.first[wide] + g.left[wide]])
    low = np.concatenate([opens[text[inner]], g.first[wide]])
    high = np.concatenate([closes[text[inner]], g.first[wide] + g.total[wide]])
    if not len(cut):
        return none
    b, q, start, stop = _boundary_runs(sym, cut, low, high)
    top = b < len(inner)
    parts = [(q[top], start[top], stop[top])]
    # a nonterminal's runs at each of its derivation positions
    order = np.argsort(g.rule, kind="stable")
    rule, at = g.rule[order], g.at[order]
    r = wide[b[~top] - len(inner)]
    lo, hi = np.searchsorted(rule, r), np.searchsorted(rule, r, side="right")
    each = np.repeat(np.arange(len(r)), hi - lo)
    shift = at[np.arange(len(each)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[each]] - g.first[r[each]]
    parts.append((q[~top][each], start[~top][each] + shift, stop[~top][each] + shift))
    return maximal(*(np.concatenate(x) for x in zip(*parts, strict=True)))


RESULTS = "n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _slice_runs(words: list[list[bytes]]) -> list[pa.Array]:
    """The result columns of some texts."""
    sizes = np.array([len(x) for x in words], dtype=np.int64)
    ids: defaultdict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    flat = np.fromiter((ids[w] for x in words for w in x), dtype=np.int64, count=int(sizes.sum()))
    owner = np.repeat(np.arange(len(words)), sizes)
    _, sym = np.unique(owner * max(len(ids), 1) + flat, return_inverse=True)
    start, stop, period = word_runs(sym, owner)
    opens = np.cumsum(sizes) - sizes
    edge = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, stop, -1)
    gone = np.cumsum(edge[:-1]) > 0
    text = owner[start]
    count = np.bincount(text, minlength=len(words))
    collapsed = []
    for k, x in enumerate(words):
        if count[k]:
            x = [x[i] for i in np.flatnonzero(~gone[opens[k]:opens[k] + sizes[k]]).tolist()]
        collapsed.append(b" ".join(x))
    fields = pa.StructArray.from_arrays([pa.array(c) for c in (start - opens[text], stop - start, period)], names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), fields)
    return [pa.array(sizes), lists, pa.array(collapsed, pa.binary()).cast(pa.string())]


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): ``collapsed`` keeps the first period of every run, its words joined by blanks."""
    need(docs, doc_id, text)
    sent = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, held, words = 0, [], 0
            texts = texts_of(b.column(1))
            for i, t in enumerate(texts):
                held.append(t.split())
                texts[i] = b""
                words += len(held[-1])
                if words >= SLICE_WORDS or i == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(held)), *_slice_runs(held)],
                                                     names=["doc_id", "n_words", "runs", "collapsed"])
                    at, held, words = i + 1, [], 0

    return sent.mapInArrow(run, f"doc_id long, {RESULTS}")
