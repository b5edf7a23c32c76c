"""MinHash near-duplicates by an inverted join over signature coordinates.

Each text is the set of its word shingles; texts of equal sets become one node.
A node's signature has COORDINATES minimum values, and the node is posted under
every (coordinate, value) pair. Two nodes of similarity ``threshold`` agree on
at least ``needed`` coordinates (five deviations below the expectation), so:

- prefix: postings are ordered by how many nodes they have, a rule that is the
  same for all nodes. Nodes that agree on ``needed`` coordinates share one of
  each other's first COORDINATES - needed + 1 postings, so a node is sent to
  those lists only, its rarest ones; postings of one node need no list at all,
  and frequent ones (a licence text, a menu) hardly ever lie in a prefix;
- skip: lists of the same members are merged once, and collisions are counted
  only for pairs that nothing has connected yet.

Pairs of at least ``needed`` collisions are candidates; they connect nodes to
groups, and inside a group candidates are confirmed on the full sets, again
only where nothing has connected the pair yet, which is all that components
need. Lists and groups of any size are worked off alike (:func:`connected`):
in blocks, each with the group's first node; what the blocks connect is left
alone, and the members outside the group's largest component then meet all
others block by block. So a group of copies costs its size, not its square, no
pair is left out, and no task holds more than two blocks. Tasks return spanning
links only, never the pairs.

Defined results: A-Z are lower-cased; words are parted by ASCII blanks; a text
of fewer words than a shingle is one shingle; null and blank texts have an empty
set and stand alone; a class is named by its smallest doc_id; rows that repeat
an id are documents of their own; a null id takes part, but names a class only
if all its members' ids are null; texts are used whole; an empty table gives no
rows. The input is read twice and must give the same rows, as files do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.components import components
from quarry.llm.util import bounds, need, pinned, sent_if_small, texts_of, whole_groups
from quarry.session import shuffle_partitions

N_WORDS, THRESHOLD = 4, 80  # of 100
COORDINATES, DEVIATIONS = 64, 5.0
# Most members of a block, and bytes of their sets.
BLOCK, BLOCK_BYTES = 512, 48 << 20
SLICE_SHINGLES, CACHED_WORDS = 200_000, 100_000

U = np.uint64
_A = np.random.default_rng(21).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * U(2) + U(1)
_B = np.random.default_rng(22).integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def needed(threshold: int = THRESHOLD) -> int:
    """Coordinates that a pair at the threshold agrees on, but for five deviations."""
    p = threshold / 100
    return max(1, math.floor(COORDINATES * p - DEVIATIONS * math.sqrt(COORDINATES * p * (1 - p))))


def _finished(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = h
        return h


def shingle_set(text: bytes, hashes: dict[bytes, int], n_words: int = N_WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=U)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=U, count=len(words))
    k = min(n_words, len(h))
    rolled = np.full(len(h) - k + 1, k, dtype=U)
    for i in range(k):
        rolled = (rolled ^ h[i:len(h) - k + 1 + i]) * U(0x9E3779B97F4A7C15) + (rolled >> U(29))
    return np.unique(_finished(rolled))


def set_keys(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a set."""
    a, b = _finished(s + U(0xA24BAED4963EE407)), _finished(s ^ U(0x9FB21C651E98DF25))
    return int(a.sum(dtype=U).astype(np.int64)), int(np.bitwise_xor.reduce(b, initial=U(0)).astype(np.int64))


def postings(sets: list[np.ndarray]) -> np.ndarray:
    """(sets x COORDINATES) keys of the (coordinate, minimum value) pairs of sets that are not empty."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), dtype=U)
    for c in range(COORDINATES):
        out[:, c] = _finished(np.minimum.reduceat(flat * _A[c] + _B[c], at) + _B[c])
    return out


def sketches(posts: np.ndarray) -> np.ndarray:
    """One byte of every coordinate."""
    return (posts >> U(40)).astype(np.uint8)


SIGNED = "doc_id long, n long, k1 long, k2 long, posts array<bigint>, sketch binary"


def signed(docs: DataFrame, n_words: int) -> DataFrame:
    """SIGNED and a row number for every document (doc_id, text); written once, so numbers stay."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for b in batches:
            texts = texts_of(b.column(1))
            at, held, size = 0, [], 0
            for i, t in enumerate(texts):
                held.append(shingle_set(t, hashes, n_words))
                size += len(held[-1])
                if size < SLICE_SHINGLES and i < len(texts) - 1:
                    continue
                full = [s for s in held if len(s)]
                posts = postings(full) if full else np.zeros((0, COORDINATES), dtype=U)
                sketch = iter(sketches(posts))
                has = np.array([len(s) > 0 for s in held])
                keys = [set_keys(s) for s in held]
                ends = np.cumsum(np.where(has, COORDINATES, 0))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(posts.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(held)), pa.array([len(s) for s in held], pa.int64()), pa.array([k for k, _ in keys], pa.int64()),
                     pa.array([k for _, k in keys], pa.int64()), lists, pa.array([next(sketch).tobytes() if x else None for x in has], pa.binary())],
                    names=[f.split()[0] for f in SIGNED.split(", ")])
                at, held, size = i + 1, [], 0

    return pinned(docs.mapInArrow(sign, SIGNED).withColumn("row", F.monotonically_increasing_id()))


def prefix_lists(reps: DataFrame, least: int) -> DataFrame:
    """(grp, node): members of every prefix list of two or more, lists of equal members once."""
    posted = reps.select("node", F.explode("posts").alias("post"))
    counts = posted.groupBy("post").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ordered = (posted.join(counts, "post").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "post"))).alias("shared"))
               .filter(F.size("shared") >= least))
    # postings of this node alone come first of all, so what is left of the prefix is size - least + 1
    prefix = pinned(ordered.select("node", F.explode(F.slice("shared", F.lit(1), F.size("shared") - least + 1)["post"]).alias("grp")))
    lists = prefix.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                      F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).filter("size > 1")
    once = lists.groupBy("size", "x", "y").agg(F.min("grp").alias("grp"))
    return prefix.join(once.select("grp"), "grp", "left_semi")


def forest(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest position of every position's component under links (a, b) and earlier roots."""
    label = np.arange(n) if root is None else root.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        np.minimum.at(new, label, new)  # a component follows its root
        new = np.minimum(new, new[label])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def collisions(mine: np.ndarray, others: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of mine, row of others, equal coordinates) of at least ``least``, some rows of mine at a time."""
    for at in range(0, len(mine), 64):
        same = (mine[at:at + 64, None, :] == others[None, :, :]).sum(axis=2)
        i, j = np.nonzero(same >= least)
        yield i + at, j, same[i, j]


# (payloads, rows of one side, rows of the other, least collisions, component so far) -> component
Connect = Callable[[list[bytes], np.ndarray, np.ndarray, int, np.ndarray], np.ndarray]


def _sketch_matrix(payloads: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(p[:COORDINATES] for p in payloads), dtype=np.uint8).reshape(-1, COORDINATES)


def by_sketch(payloads: list[bytes], mine: np.ndarray, others: np.ndarray, least: int, root: np.ndarray) -> np.ndarray:
    """Connect what collides."""
    rows = _sketch_matrix(payloads)
    for i, j, _ in collisions(rows[mine], rows[others], least):
        a, b = mine[i], others[j]
        new = root[a] != root[b]
        if new.any():
            root = forest(len(root), a[new], b[new], root)
    return root


def by_sets(threshold: int) -> Connect:
    """Connect what collides and is confirmed on the full sets; pairs connected already are skipped."""
    def connect(payloads: list[bytes], mine: np.ndarray, others: np.ndarray, least: int, root: np.ndarray) -> np.ndarray:
        rows = _sketch_matrix(payloads)
        sets = [np.frombuffer(p, dtype=U, offset=COORDINATES) for p in payloads]
        size = np.array([len(s) for s in sets])
        root = root.tolist()

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j, same in collisions(rows[mine], rows[others], least):
            a, b = mine[i], others[j]
            small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            ok = np.flatnonzero((a != b) & (100 * small >= threshold * large))
            for k in ok[np.argsort(-same[ok], kind="stable")].tolist():
                x, y = find(int(a[k])), find(int(b[k]))
                if x == y:
                    continue
                s, t = sets[a[k]], sets[b[k]]
                shared = len(s) + len(t) - len(np.unique(np.concatenate([s, t])))
                if 100 * shared >= threshold * (len(s) + len(t) - shared):
                    root[max(x, y)] = min(x, y)
        return np.array([find(x) for x in range(len(root))])

    return connect


LINKS = "a long, b long"


def _met(tasks: DataFrame, connect: Connect, least: int) -> DataFrame:
    """Spanning links of every task (task, side, node, comp, payload): all members meet, or side 0 meets side 1."""
    laid = (tasks.select("task", "side", "node", "comp", "payload").repartition(shuffle_partitions(tasks.sparkSession), "task")
            .sortWithinPartitions("task", "side", "node"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "task"):
            task, side, node, comp = (t.column(c).to_numpy() for c in ("task", "side", "node", "comp"))
            payload = t.column("payload")
            a, b = [], []
            cuts = bounds(task)
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                ids, first, position = np.unique(node[s:e], return_index=True, return_inverse=True)
                if len(ids) < 2:
                    continue
                # sides, and components so far, by the place of a member in ``ids``
                sides = [np.unique(position[side[s:e] == k]) for k in (0, 1)]
                mine, others = sides if len(sides[1]) else (sides[0], sides[0])
                _, start = np.unique(comp[s:e][first], return_inverse=True)
                root = np.full(int(start.max()) + 1, len(ids))
                np.minimum.at(root, start, np.arange(len(ids)))
                root = connect(payload.slice(s, e - s).take(pa.array(first)).to_pylist(), mine, others, least, root[start])
                out = np.flatnonzero(root != np.arange(len(ids)))
                a.append(ids[out])
                b.append(ids[root[out]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

    return laid.mapInArrow(meet, LINKS)


def connected(members: DataFrame, connect: Connect, least: int, block: int = BLOCK) -> DataFrame:
    """(node, root) over all members (grp, node, payload) that ``connect`` links inside a group, in blocks."""
    sizes = pinned(members.groupBy("grp").agg(
        F.count(F.lit(1)).alias("size"), F.min("node").alias("hub"),
        F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum(F.length("payload").cast("long")) / BLOCK_BYTES)).alias("blocks"))
        .filter("size > 1"))
    placed = members.join(sizes, "grp")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    first = (placed.withColumn("block", F.explode(F.when(F.col("node") == F.col("hub"), every).otherwise(F.array(mine))))
             .select(F.xxhash64("grp", "block").alias("task"), F.lit(0).alias("side"), "node", F.col("node").alias("comp"), "payload"))
    links = pinned(_met(first, connect, least))
    roots = pinned(components(links))
    if not sizes.filter("blocks > 1").take(1):
        return roots
    # groups of several blocks: members outside the largest component meet the rest
    large = placed.filter("blocks > 1").join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node"))
    parts = pinned(large.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("n")))
    top = parts.groupBy("grp").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all")).select(
        "grp", F.col("top.comp").alias("top"), F.ceil((F.col("all") - F.col("top.n")) / block).alias("rest")).filter("rest > 0")
    if not top.take(1):
        return roots
    left = large.join(top, "grp")
    outside = left.filter("comp <> top").select("grp", F.lit(0).alias("side"), "node", "comp", "payload",
                                                F.pmod(F.xxhash64("node", F.lit(1)), F.col("rest")).alias("i"), F.explode(every).alias("j"))
    against = left.select("grp", F.lit(1).alias("side"), "node", "comp", "payload",
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)).alias("i"), mine.alias("j"))
    second = outside.unionByName(against).withColumn("task", F.xxhash64("grp", "i", "j"))
    return pinned(components(links.unionByName(_met(second, connect, least))))


def _with_sets(docs: DataFrame, wanted: DataFrame, n_words: int) -> DataFrame:
    """(grp, node, payload: sketch and set) of ``wanted`` (grp, node, doc_id, k1, k2, sketch)."""
    met = docs.join(sent_if_small(wanted.withColumnRenamed("doc_id", "_d")), F.col("doc_id").eqNullSafe(F.col("_d")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for b in batches:
            k1, k2, sketch = (b.column(c).to_pylist() for c in ("k1", "k2", "sketch"))
            made = [shingle_set(t, hashes, n_words) for t in texts_of(b.column("text"))]
            ok = [i for i, s in enumerate(made) if set_keys(s) == (k1[i], k2[i])]  # another row may repeat the id
            pick = pa.array(ok, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("grp").take(pick), b.column("node").take(pick),
                                              pa.array([sketch[i] + made[i].tobytes() for i in ok], pa.binary())], names=["grp", "node", "payload"])

    return met.select("grp", "node", "k1", "k2", "sketch", "text").mapInArrow(sets, "grp long, node long, payload binary")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD,
                    n_words: int = N_WORDS, block: int = BLOCK) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept) of every document; linked: 100 * intersection >= threshold * union."""
    need(docs, doc_id, text)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    least, key = needed(threshold), ["k1", "k2", "n"]
    sigs = signed(docs, n_words)
    nodes = pinned(sigs.filter("n > 0").groupBy(*key).agg(F.min("row").alias("node"), F.min("doc_id").alias("low")))
    reps = sigs.join(sent_if_small(nodes.select(F.col("node").alias("row"))), "row", "left_semi").withColumnRenamed("row", "node")
    lists = pinned(prefix_lists(reps, least).join(reps.select("node", F.col("sketch").alias("payload")), "node"))
    groups = connected(lists, by_sketch, least, block)
    wanted = groups.select("node", F.col("root").alias("grp")).join(reps.select("node", "doc_id", "k1", "k2", "sketch"), "node")
    roots = connected(pinned(_with_sets(docs, wanted, n_words)), by_sets(threshold), least, block)
    flat = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = flat.join(flat.groupBy("root").agg(F.min("low").alias("component_id")), "root")
    met = sigs.select("row", "doc_id", *key).join(
        named.select(*[F.col(k).alias(f"_{k}") for k in key], "component_id"),
        (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("n") == F.col("_n")), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return met.select("row", "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
