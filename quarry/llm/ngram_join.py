"""N-gram Jaccard self-join by chosen paths.

Each text is the set of its five-word shingles. Texts with equal sets become one
node. A node is embedded by TOKENS min-hash values; in every run a tree of
splits is walked: at a tree position a few coordinates are drawn (1/threshold
expected), and nodes that agree on a drawn coordinate go on together. A bucket
of at most ``brute`` nodes is compared by brute force on small sketches; in
larger ones nodes are linked to leaders near them, all that is not close to a
leader is split again, and what is left at the last level counts as linked.
Two nodes of similarity ``threshold`` meet in one run with probability q, so
runs are repeated until 1 - (1 - q)^runs reaches the target recall.

What met is a candidate, not a result. Candidate links join nodes to groups
(connected components); every group is then compared exactly: shingle sets are
sent to their group once, large groups are cut into blocks and every pair of
blocks is a task, where intersections are counted as matrix products. Tasks
return, for each node, its number of links and a spanning link, never the
pairs. Classes are the components of the exact links.

Defined results: words are parted by ASCII blanks; a text of one to four words
is one shingle; null and blank texts have none and stand alone without links;
``class_id`` is the smallest doc_id of a class, ``n_links`` the number of other
rows (copies included) with similarity >= threshold; of each class exactly one
row, the first by (doc_id, row), has ``keeper``; rows that repeat an id count as
rows of their own; texts are used whole; an empty table gives no rows. The
input is read twice and must give the same rows both times, as files do; without
a column named by ``row`` the rows are numbered at the first reading, and
those numbers hold for the result only, not for another reading of the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.util import bounds, cut_batches, need, pinned, sent_if_small, texts_of, whole_groups
from quarry.session import shuffle_partitions

N_WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
TOKENS, LEVELS, BRUTE = 64, 3, 512
BLOCK = 512
# Words whose hashes a task keeps.
WORDS = 200_000
# Least share of agreeing 4-bit sketch places: five deviations below what the threshold gives.
SKETCH_BITS, DEVIATIONS = 4, 5.0
# Share of agreeing places from which a node needs no split beside its leader.
CORE = 0.8

U = np.uint64
_MULT = np.random.default_rng(11).integers(1, 1 << 63, TOKENS, dtype=np.uint64) * U(2) + U(1)
_XOR = np.random.default_rng(12).integers(0, 1 << 63, TOKENS, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: bytes, words: _Words, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    parts = text.split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), dtype=np.uint64, count=len(parts))
    k = min(n, len(h))
    acc = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        acc = acc * U(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i]
    return np.unique(mixed(acc))


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a set."""
    a, b = mixed(s * U(0x9FB21C651E98DF25)).sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(s ^ U(0xD6E8FEB86659FD93)), initial=U(0))
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def min_hashes(s: np.ndarray) -> np.ndarray:
    """TOKENS min-hash values of a set (uint32)."""
    out = np.full(TOKENS, 0xFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(s), 8192):
        x = (s[at:at + 8192, None] ^ _XOR) * _MULT
        out = np.minimum(out, ((x ^ (x >> U(29))) >> U(32) ^ (x & U(0xFFFFFFFF))).min(axis=0))
    return out.astype(np.uint32)


def sketch(sig: np.ndarray) -> np.ndarray:
    """4 bits of every value: (rows x TOKENS) -> (rows x TOKENS / 2) bytes."""
    four = (mixed(sig.astype(np.uint64)) & U(15)).astype(np.uint8)
    return four[:, ::2] << 4 | four[:, 1::2]


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places of sketches along the last axis."""
    x = a ^ b
    return (((x & 15) == 0).sum(axis=-1) + ((x >> 4) == 0).sum(axis=-1)) / TOKENS


def sketch_floor(threshold: float) -> float:
    spread = DEVIATIONS * math.sqrt(threshold * (1 - threshold) / TOKENS)
    low = max(0.0, threshold - spread)
    return low + (1 - low) / (1 << SKETCH_BITS) - 1e-9


def runs_needed(threshold: float, recall: float, levels: int) -> int:
    """Repetitions until a pair at the threshold has met with probability ``recall``."""
    q = 1.0
    for _ in range(levels):
        q = 1 - (1 - q / TOKENS) ** TOKENS  # threshold / (threshold * TOKENS) a coordinate
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


SIGS = "doc_id long, n long, k1 long, k2 long, sig binary"


def signatures(docs: DataFrame, n_words: int) -> DataFrame:
    """(row, doc_id, n, k1, k2, sig) of every document (doc_id, text and perhaps row); pinned, so row numbers stay."""
    numbered = "row" in docs.columns

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in cut_batches(batches):
            rows = []
            for t in texts_of(b.column(1)):
                s = shingles(t, words, n_words)
                rows.append((len(s), *set_key(s), min_hashes(s).tobytes() if len(s) else None))
            if len(words) > WORDS:
                words = _Words()
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            made = [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            given = [b.column(2)] if numbered else []
            yield pa.RecordBatch.from_arrays([b.column(0), *made, *given], names=["doc_id", "n", "k1", "k2", "sig", "row"][:5 + len(given)])

    sigs = docs.mapInArrow(sign, SIGS + (", row long" if numbered else ""))
    return pinned(sigs if numbered else sigs.withColumn("row", F.monotonically_increasing_id()))


def _paths(paths: np.ndarray, sig: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of the input, child path) of every drawn coordinate: depends on the path, not on the node."""
    draw = mixed(paths[:, None] + np.arange(TOKENS, dtype=np.uint64)[None, :] * U(0x9E3779B97F4A7C15))
    row, place = np.nonzero(draw < U(int(2.0 ** 64 / (threshold * TOKENS))))
    return row, mixed(draw[row, place] ^ mixed(sig[row, place].astype(np.uint64) + U(0x632BE59BD9B4E019)))


BUCKET = "path long, node long, sketch binary"


def _emitted(path: np.ndarray, node: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    width = rows.shape[1]
    flat = pa.array(np.arange(0, len(rows) * width + 1, width, dtype=np.int32))
    sk = pa.Array.from_buffers(pa.binary(), len(rows), [None, flat.buffers()[1], pa.py_buffer(np.ascontiguousarray(rows))])
    return pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(node), sk], names=["path", "node", "sketch"])


def _sig_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, TOKENS)


def _roots(nodes: DataFrame, runs: int, threshold: float) -> DataFrame:
    """First-level buckets of all runs."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mixed(np.arange(1, runs + 1, dtype=np.uint64) * U(0xA0761D6478BD642F))
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                if not part.num_rows:
                    continue
                sig, node = _sig_matrix(part.column("sig")), part.column("node").to_numpy()
                sk = sketch(sig)
                for r in roots:
                    # at a root all nodes draw the same coordinates
                    draw = mixed(r + np.arange(TOKENS, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
                    for place in np.flatnonzero(draw < U(int(2.0 ** 64 / (threshold * TOKENS)))):
                        yield _emitted(mixed(draw[place] ^ mixed(sig[:, place].astype(np.uint64) + U(0x632BE59BD9B4E019))), node, sk)

    return nodes.select("node", "sig").mapInArrow(split, BUCKET)


def _deeper(large: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Split the nodes of large buckets again."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                if part.num_rows:
                    sig, node = _sig_matrix(part.column("sig")), part.column("node").to_numpy()
                    row, child = _paths(part.column("path").to_numpy().view(np.uint64), sig, threshold)
                    yield _emitted(child, node[row], sketch(sig)[row])

    return large.join(nodes.select("node", "sig"), "node").select("path", "node", "sig").mapInArrow(split, BUCKET)


def _local_roots(near: np.ndarray) -> np.ndarray:
    """Smallest member position of each member's component in an adjacency matrix."""
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(axis=1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Leaders:
    """A large bucket in one pass: nodes near a leader by their sketches are linked to it.

    A node that is no leader's neighbour becomes a leader (``most`` at most). A
    node close to a leader (CORE) needs no further split: Jaccard distance is a
    metric, so whatever is similar to it is near that leader as well. Leaders
    and all other nodes are split again.
    """

    def __init__(self, floor: float, most: int):
        self.floor, self.most = floor, most
        self.nodes: list[int] = []
        self.rows = np.zeros((0, TOKENS // 2), dtype=np.uint8)
        self.root: list[int] = []  # leaders already connected

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            i = self.root[i]
        return i

    def take(self, node: np.ndarray, sk: np.ndarray, last: bool) -> tuple[list[tuple[int, int]], list[int]]:
        """(links, nodes to be split again); at the last level every node is linked to the first."""
        linked, going = [], []
        for at in range(0, len(node), 256):
            ids, rows = node[at:at + 256], sk[at:at + 256]
            near = agreeing(rows[:, None, :], self.rows[None, :, :])
            while len(self.nodes) < self.most:
                lost = np.flatnonzero(~(near >= self.floor).any(axis=1))
                if not len(lost):
                    break
                self.root.append(len(self.nodes))
                self.nodes.append(int(ids[lost[0]]))
                self.rows = np.concatenate([self.rows, rows[lost[:1]]])
                near = np.concatenate([near, agreeing(rows, self.rows[-1])[:, None]], axis=1)
            for i in range(len(ids)):
                best = int(near[i].argmax())
                mine = self.nodes[best]
                if near[i, best] >= self.floor:
                    if mine != ids[i]:
                        linked.append((int(ids[i]), mine))
                    for j in np.flatnonzero(near[i] >= self.floor):
                        x, y = self._find(int(j)), self._find(best)
                        if x != y:
                            self.root[max(x, y)] = min(x, y)
                            linked.append((self.nodes[x], self.nodes[y]))
                if near[i, best] < CORE or mine == ids[i]:
                    going.append(int(ids[i]))
        if last:
            return [*linked, *((x, self.nodes[0]) for x in going if x != self.nodes[0])], []
        return linked, going


def _brute_force(buckets: DataFrame, threshold: float, brute: int, last: bool) -> DataFrame:
    """(a, b, path): candidate links (path null), and nodes of large buckets to be split again (b null)."""
    floor = sketch_floor(max(0.0, threshold - 0.1))  # also what is similar to a close neighbour
    n = shuffle_partitions(buckets.sparkSession)

    def links(node: np.ndarray, sk: np.ndarray) -> Iterator[tuple[int, int]]:
        if len(node) == 2:
            if agreeing(sk[0], sk[1]) >= floor:
                yield node[1], node[0]
            return
        near = np.zeros((len(node), len(node)), dtype=bool)
        for at in range(0, len(node), 64):
            near[at:at + 64] = agreeing(sk[at:at + 64, None, :], sk[None, :, :]) >= floor
        for i, r in enumerate(_local_roots(near)):
            if r != i:
                yield node[i], node[r]

    def out(a: list, b: list, path: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, path)], names=["a", "b", "path"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_path, held_node, held_sk, large = None, [], [], None  # the open bucket, and its leaders once it is large

        def close() -> list[tuple[int, int]]:
            if large is None and held_node and sum(map(len, held_node)) > 1:
                return list(links(np.concatenate(held_node), np.concatenate(held_sk)))
            return []

        for batch in batches:
            if not batch.num_rows:
                continue
            path, node = batch.column("path").to_numpy(), batch.column("node").to_numpy()
            sk = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, TOKENS // 2)
            cuts = bounds(path)
            a, b, p = [], [], []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if path[s] != held_path:
                    for x, y in close():
                        a.append(x), b.append(y), p.append(None)
                    held_path, held_node, held_sk, large = path[s], [], [], None
                held_node.append(node[s:e])
                held_sk.append(sk[s:e])
                if large is None and sum(map(len, held_node)) > brute:
                    large = _Leaders(floor, brute)
                if large is not None:
                    joined, open_nodes = large.take(np.concatenate(held_node), np.concatenate(held_sk), last)
                    held_node, held_sk = [], []
                    for x, y in joined:
                        a.append(x), b.append(y), p.append(None)
                    for x in open_nodes:
                        a.append(x), b.append(None), p.append(int(path[s]))
            if a:
                yield out(a, b, p)
        rest = close()
        if rest:
            yield out([x for x, _ in rest], [y for _, y in rest], [None] * len(rest))

    laid = buckets.repartition(n, "path").sortWithinPartitions("path", "node")
    return laid.mapInArrow(compare, "a long, b long, path long")


def candidate_links(nodes: DataFrame, threshold: float, recall: float, levels: int, brute: int) -> DataFrame:
    """Links (a, b) that connect every pair of similar nodes, with probability at least ``recall`` each."""
    buckets = _roots(nodes, runs_needed(threshold, recall, levels), threshold)
    found = None
    for level in range(1, levels + 1):
        met = pinned(_brute_force(buckets, threshold, brute, level == levels))
        links = met.filter(F.col("b").isNotNull()).select("a", "b")
        found = links if found is None else found.unionByName(links)
        large = met.filter(F.col("b").isNull()).select("path", F.col("a").alias("node"))
        if level == levels or not large.take(1):
            break
        buckets = _deeper(large, nodes, threshold)
    return found


def _member_sets(docs: DataFrame, members: DataFrame, n_words: int) -> DataFrame:
    """(node, copies, root, set) of the nodes of ``members`` (node, doc_id, k1, k2, copies, root)."""
    wanted = members.select(F.col("doc_id").alias("_d"), "node", "copies", "root", "k1", "k2")
    met = docs.join(sent_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("_d")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in cut_batches(batches):
            k1, k2 = b.column("k1").to_pylist(), b.column("k2").to_pylist()
            s = [shingles(t, words, n_words) for t in texts_of(b.column("text"))]
            ok = [i for i, x in enumerate(s) if set_key(x) == (k1[i], k2[i])]  # another row may repeat the id
            if len(words) > WORDS:
                words = _Words()
            pick = pa.array(ok, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(c).take(pick) for c in ("node", "copies", "root")]
                                             + [pa.array([s[i].tobytes() for i in ok], pa.binary())], names=["node", "copies", "root", "s"])

    return met.select("node", "copies", "root", "k1", "k2", "text").mapInArrow(sets, "node long, copies long, root long, s binary")


def similar(sets_a: list[np.ndarray], sets_b: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Boolean matrix: Jaccard >= threshold, intersections counted as products of token columns."""
    every = sets_a if sets_b is None else [*sets_a, *sets_b]
    sizes = np.array([len(s) for s in every])
    tokens, which = np.unique(np.concatenate(every), return_inverse=True)
    owner = np.repeat(np.arange(len(every)), sizes)
    order = np.argsort(which, kind="stable")
    which, owner = which[order], owner[order]
    na = len(sets_a)
    inter = np.zeros((na, len(every) - (0 if sets_b is None else na)), dtype=np.float32)
    starts = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(tokens)))])
    for at in range(0, len(tokens), 4096):
        lo, hi = starts[at], starts[min(at + 4096, len(tokens))]
        x = np.zeros((len(every), min(4096, len(tokens) - at)), dtype=np.float32)
        x[owner[lo:hi], which[lo:hi] - at] = 1.0
        inter += x[:na] @ (x if sets_b is None else x[na:]).T
    other = sizes if sets_b is None else sizes[na:]
    union = sizes[:na, None] + other[None, :] - inter
    return inter >= threshold * union - 1e-6


def _exact(sets: DataFrame, sizes: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, links, other): a node's links inside one task and a spanning link."""
    spark = sets.sparkSession
    cut = sizes.withColumn("blocks", F.ceil(F.col("size") / F.lit(float(block))).cast("long"))
    placed = sets.join(cut.select("root", "blocks"), "root")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    # block i meets blocks i.. : every unordered pair of blocks is one task
    tasks = (placed.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
             .withColumn("task", F.xxhash64("root", "i", "j")))
    laid = (tasks.select("task", "root", "i", "j", "mine", "node", "copies", "s")
            .repartition(shuffle_partitions(spark), "task").sortWithinPartitions("task", "root", "i", "j", "node"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "task"):
            t = t.combine_chunks()
            cols = {c: t.column(c).to_numpy() for c in ("task", "i", "j", "mine", "node", "copies")}
            sets = [np.frombuffer(x, dtype=np.uint64) for x in t.column("s").to_pylist()]
            node, links, other = [], [], []
            cuts = bounds(cols["task"])
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                ids, copies, at = cols["node"][s:e], cols["copies"][s:e], cols["mine"][s:e]
                _, first = np.unique(ids, return_index=True)  # a text may have come twice with a repeated id
                if cols["i"][s] == cols["j"][s]:
                    near = similar([sets[s + k] for k in first], None, threshold)
                    np.fill_diagonal(near, False)
                    ids, copies = ids[first], copies[first]
                    weight = near @ copies
                    root = np.where(near.any(axis=1), ids[near.argmax(axis=1)], ids)
                    root = np.minimum(ids[_local_roots(near)], root)
                else:
                    a, b = [k for k in first if at[k] == cols["i"][s]], [k for k in first if at[k] == cols["j"][s]]
                    if not a or not b:
                        continue
                    near = similar([sets[s + k] for k in a], [sets[s + k] for k in b], threshold)
                    weight = np.concatenate([near @ copies[b], near.T @ copies[a]])
                    full = np.zeros((len(a) + len(b),) * 2, dtype=bool)
                    full[:len(a), len(a):], full[len(a):, :len(a)] = near, near.T
                    ids = ids[[*a, *b]]
                    root = ids[_local_roots(full)]
                node.append(ids), links.append(weight), other.append(root)
            if node:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (node, links, other)],
                                                 names=["node", "links", "other"])

    return laid.mapInArrow(compare, "node long, links long, other long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    n_words: int = N_WORDS, recall: float = RECALL, levels: int = LEVELS, brute: int = BRUTE,
                    block: int = BLOCK, row: str | None = None) -> DataFrame:
    """(row, doc_id, class_id, n_links, keeper); ``row`` names a column of distinct numbers, else rows are numbered as read."""
    need(docs, doc_id, text, *([row] if row else []))
    given = [F.col(row).cast("long").alias("row")] if row else []
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *given)
    sigs = signatures(docs, n_words)
    key = ["k1", "k2", "n"]
    nodes = pinned(sigs.filter("n > 0").groupBy(*key).agg(
        F.min("row").alias("node"), F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("copies"),
        F.first("sig").alias("sig")))
    groups = pinned(components(candidate_links(nodes, threshold, recall, levels, brute)))
    owners = sigs.select(F.col("row").alias("node"), "doc_id")
    members = pinned(groups.join(nodes.select("node", *key, "copies"), "node").join(owners, "node"))
    exact = pinned(_exact(_member_sets(docs, members, n_words),
                          groups.groupBy("root").agg(F.count(F.lit(1)).alias("size")), threshold, block))
    links = exact.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(exact.filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    flat = pinned(nodes.select(*key, "node", "first", "copies").join(links, "node", "left").join(classes, "node", "left")
                  .withColumn("root", F.coalesce("root", "node")))
    heads = flat.groupBy("root").agg(F.min("first").alias("head"))
    named = flat.join(heads, "root").select(
        *[F.col(k).alias(f"_{k}") for k in key], "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    met = sigs.select("row", "doc_id", *key).join(
        named, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("n") == F.col("_n")), "left")
    alone = F.col("head").isNull()
    return met.select("row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      (alone | (F.col("row") == F.col("head.row"))).alias("keeper"))
