"""Hashed maximum-entropy language model with a class-factored softmax.

Words map to slots: the most frequent words have a slot of their own, all
others share slots by a hash of their ending. The model is

    P(word | context) = P(class | b1, b2) * P(slot | class, b1) * P(word | slot)

with b1, b2 the slots of the two words before (n-gram and skip features), each
weight found by hashing (feature, outcome) into one table. The word inside its
slot follows add-one counts of all training tokens. Classes are groups of slots
that follow alike words.

Training gathers from all training documents: exact word counts, and the slot
bigram and skip counts, which are the sufficient statistics of the likelihood.
They are summed by Spark in two levels into tables whose size is fixed by SLOTS.
Each update is a Spark job: tasks take blocks of contexts, return partial
gradients of the hashed table, and the weights step along their sum.

Scoring streams documents in numpy batches: words of the frequent table (its
size is bounded by FREQUENT) are looked up in place; every other word of a
document is joined with its exact count by a shuffle, so no vocabulary is ever
broadcast whole.

Defined results: null text is empty and still has its end token; rows that
repeat an id are scored each, and all of them train; a null id trains; without
training documents all counts are 0; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.util import bounds, need, pinned, texts_of
from quarry.session import shuffle_partitions

FOLDS, HELD_OUT = 7, 2
END = b"\n"  # holds white space, so no word equals it
SLOTS, CLASSES = 1024, 32
OWN_SLOTS = 512
TABLE = 1 << 18
FREQUENT = 1 << 18
BLOCKS = 12
# Tasks of an update; each adds up its blocks' gradients and sends one table to the driver.
GRADIENT_TASKS = 4
UPDATES, RATE, L2 = 24, 0.25, 1e-7
FIRST_LEVEL = 16
WORDS_HELD = 500_000
# Text bytes that a task turns into token arrays at once.
SLICE_BYTES = 4 << 20


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def word_hash(word: bytes) -> int:
    return _signed(xxhash.xxh64_intdigest(word))


def ending_slot(word: bytes) -> int:
    """Shared slot of a word: its last three bytes, hashed."""
    return OWN_SLOTS + zlib.crc32(word[-3:]) % (SLOTS - OWN_SLOTS)


class Vocabulary(dict):
    """Numbers words as they come; a task's words since ``reset``."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n


def _tokens(text: bytes) -> list[bytes]:
    """Lower-cased words and the end; bytes.lower and bytes.split know only A-Z and the six ASCII blanks."""
    words = text.lower().split()
    words.append(END)
    return words


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows in runs of about SLICE_BYTES of text (one row at least)."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = (np.cumsum(sizes) - sizes) // SLICE_BYTES
        cuts = bounds(run) if len(run) else [0]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            part = b.slice(s, e - s)
            yield part, texts_of(part.column(text))


def _numbered(texts: list[bytes], seen: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of all texts, tokens per text)."""
    get, parts, sizes = seen.__getitem__, [], []
    for t in texts:
        w = _tokens(t)
        sizes.append(len(w))
        parts.append(np.fromiter(map(get, w), dtype=np.int64, count=len(w)))
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.array(sizes, dtype=np.int64)


def _word_counts(train: DataFrame) -> DataFrame:
    """(h, slot, c) of every distinct training token."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, totals = Vocabulary(), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            n = len(seen.words)
            return pa.RecordBatch.from_arrays([
                pa.array(np.fromiter(map(word_hash, seen.words), np.int64, n)),
                pa.array(np.fromiter(map(ending_slot, seen.words), np.int32, n)), pa.array(totals[:n])], names=["h", "slot", "c"])

        for _, texts in _slices(batches, 0):
            ids, _ = _numbered(texts, seen)
            here = np.bincount(ids, minlength=len(seen.words))
            here[:len(totals)] += totals
            totals = here
            if len(seen.words) > WORDS_HELD:
                yield out()
                seen, totals = Vocabulary(), np.zeros(0, np.int64)
        if seen.words:
            yield out()

    return (train.select("text").mapInArrow(count, "h long, slot int, c long")
            .groupBy("h").agg(F.min("slot").alias("slot"), F.sum("c").alias("c")))


@dataclass(frozen=True)
class Lexicon:
    """Exact counts of the frequent words (sorted by hash), slot totals, and the corpus totals."""

    hashes: np.ndarray
    slots: np.ndarray
    counts: np.ndarray
    slot_tokens: np.ndarray
    slot_words: np.ndarray
    tokens: int
    distinct: int

    @property
    def end_slot(self) -> int:
        return int(self.find(np.array([word_hash(END)]), np.array([ending_slot(END)]))[0][0])

    def find(self, hashes: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, count) of words; count -1 where the word is not a frequent one."""
        if not len(self.hashes):
            return ending, np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        here = self.hashes[at] == hashes
        return np.where(here, self.slots[at], ending), np.where(here, self.counts[at], -1)


def lexicon(counts: DataFrame, frequent: int) -> Lexicon:
    """Frequent words by count (whole levels of count, at most ``frequent`` words) and totals of all words."""
    level = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    kept, cut = 0, None
    for lv in sorted(sizes, reverse=True):
        if kept + sizes[lv] > frequent:
            break
        kept, cut = kept + sizes[lv], lv
    # columns, not row objects: a few dozen bytes a word
    found = [np.zeros(0, np.int64)] * 3 if cut is None else [
        x.to_numpy() for x in counts.filter(level >= cut).select(*[F.col(c).cast("long") for c in ("h", "slot", "c")]).toArrow().columns]
    order = np.lexsort((found[0], -found[2]))
    hashes, slots, exact = (x[order] for x in found)
    top_slots, top_counts = slots[:OWN_SLOTS].copy(), exact[:OWN_SLOTS]
    slots[:OWN_SLOTS] = np.arange(len(top_slots))
    by_hash = np.argsort(hashes)
    hashes, slots, exact = hashes[by_hash], slots[by_hash], exact[by_hash]
    tokens, distinct = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for r in counts.groupBy("slot").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        tokens[r["slot"]], distinct[r["slot"]] = r["c"], r["n"]
    n, v = int(tokens.sum()), int(distinct.sum())
    # words with a slot of their own leave the shared one
    np.subtract.at(tokens, top_slots, top_counts)
    np.subtract.at(distinct, top_slots, 1)
    return Lexicon(hashes, slots, exact, tokens, distinct, n, v)


class _Slots:
    """Word number -> (slot, count) of a task's vocabulary, extended as words come."""

    def __init__(self, lex: Lexicon):
        self.lex = lex
        self.reset()

    def reset(self) -> None:
        self.seen = Vocabulary()
        self.hash = np.zeros(0, np.int64)
        self.slot = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def numbered(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.seen.words) > WORDS_HELD:
            self.reset()
        ids, sizes = _numbered(texts, self.seen)
        new = self.seen.words[len(self.hash):]
        h = np.fromiter(map(word_hash, new), np.int64, len(new))
        slot, count = self.lex.find(h, np.fromiter(map(ending_slot, new), np.int64, len(new)))
        self.hash = np.concatenate([self.hash, h])
        self.slot, self.count = np.concatenate([self.slot, slot]), np.concatenate([self.count, count])
        return ids, sizes


def _before(slots: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots one and two tokens back; before a text stands the end."""
    b1, b2 = np.roll(slots, 1), np.roll(slots, 2)
    first = np.cumsum(sizes) - sizes
    b1[first], b2[first] = end, end
    second = (first + 1)[sizes > 1]
    b2[second] = end
    return b1, b2


def _slot_counts(train: DataFrame, lex: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Bigram and skip counts (SLOTS x SLOTS), summed by Spark in two levels."""
    spark = train.sparkSession
    shared, end = spark.sparkContext.broadcast(lex), lex.end_slot
    step = -(-SLOTS // BLOCKS)

    def rows(tables: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        for kind, t in enumerate(tables):
            for block in range(BLOCKS):
                part = np.ascontiguousarray(t[block * step:(block + 1) * step])
                yield pa.RecordBatch.from_arrays([pa.array([kind * BLOCKS + block], pa.int32()), pa.array([pid % FIRST_LEVEL], pa.int32()),
                                                  pa.array([part.tobytes()], pa.binary())], names=["block", "salt", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tables = _Slots(shared.value), None
        for _, texts in _slices(batches, 0):
            ids, sizes = table.numbered(texts)
            s = table.slot[ids]
            b1, b2 = _before(s, sizes, end)
            here = [np.bincount(x * SLOTS + s, minlength=SLOTS * SLOTS).reshape(SLOTS, SLOTS) for x in (b1, b2)]
            tables = here if tables is None else [a + x for a, x in zip(tables, here, strict=True)]
        if tables is not None:
            yield from rows(tuple(tables))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for block, n in zip(b.column("block").to_pylist(), b.column("n").to_pylist(), strict=True):
                n = np.frombuffer(n, dtype=np.int64)
                sums[block] = sums[block] + n if block in sums else n
        for block, n in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([0], pa.int32()), pa.array([n.tobytes()], pa.binary())],
                                             names=["block", "salt", "n"])

    schema = "block int, salt int, n binary"
    parts = 2 * BLOCKS
    summed = (train.select("text").mapInArrow(count, schema).repartition(parts, "block", "salt").mapInArrow(added, schema)
              .repartition(parts, "block").mapInArrow(added, schema))
    out = np.zeros((2, SLOTS, SLOTS), dtype=np.int64)
    for r in summed.collect():  # 2 x SLOTS x SLOTS numbers, whatever the corpus
        kind, block = divmod(r["block"], BLOCKS)
        at = block * step
        out[kind, at:at + step] = np.frombuffer(r["n"], dtype=np.int64).reshape(-1, SLOTS)
    return out[0], out[1]


def slot_classes(bigrams: np.ndarray) -> np.ndarray:
    """Class of every slot: slots ordered by the words they follow and precede, cut into equal groups."""
    a = bigrams + bigrams.T + 0.1
    d = 1.0 / np.sqrt(a.sum(axis=1))
    _, vectors = np.linalg.eigh(a * d[:, None] * d[None, :])
    order = np.lexsort((np.arange(SLOTS), vectors[:, -3] > 0, np.round(vectors[:, -2] * d, 9)))
    out = np.empty(SLOTS, dtype=np.int64)
    out[order] = np.arange(SLOTS) * CLASSES // SLOTS
    return out


def _hashed(feature: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of (feature, context, outcome) in the weight table."""
    x = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
         + np.uint64(feature) * np.uint64(0x165667B19E3779F9))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (x % np.uint64(TABLE)).astype(np.int64)


def _places() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table places of (b1, class), (b2, class) and (b1, slot)."""
    s, c = np.arange(SLOTS)[:, None], np.arange(CLASSES)[None, :]
    return _hashed(1, s, c), _hashed(2, s, c), _hashed(3, s, np.arange(SLOTS)[None, :])


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=-1, keepdims=True)))[..., 0]


@dataclass(frozen=True)
class Model:
    """Weights as natural-log tables ready for look-up."""

    step: np.ndarray  # [b1, slot]: class and slot parts that need b1 only
    skip: np.ndarray  # [b2, class]
    norm: np.ndarray  # [b1, b2]
    classes: np.ndarray


def _block_gradient(theta: np.ndarray, bias_c: np.ndarray, bias_s: np.ndarray, members: np.ndarray, at: int,
                    contexts: np.ndarray, bigrams: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected counts of a block of b1 rows on the hashed table."""
    p1, p2, p3 = _places()
    p1, p3 = p1[at:at + len(contexts)], p3[at:at + len(contexts)]
    grad = np.zeros(TABLE)
    skip = theta[p2]
    back = np.zeros_like(skip)
    for i in range(len(contexts)):
        if not contexts[i].any():
            continue
        z = bias_c + theta[p1[i]] + skip
        p = np.exp(z - _logsum(z)[:, None]) * contexts[i][:, None]
        np.add.at(grad, p1[i], p.sum(axis=0))
        back += p
    np.add.at(grad, p2.ravel(), back.ravel())
    z = (bias_s + theta[p3])[:, members]  # rows x classes x slots of the class
    p = np.exp(z - _logsum(z)[..., None]) * bigrams[:, members].sum(axis=2)[..., None]
    grad += np.bincount(p3[:, members].ravel(), weights=p.ravel(), minlength=TABLE)
    return grad


def train_model(spark, bigrams: np.ndarray, skips: np.ndarray, end: int, updates: int = UPDATES) -> Model:
    """Gradient ascent on the regularised log likelihood; every update sums block gradients of a Spark job."""
    classes = slot_classes(bigrams)
    members = np.argsort(classes, kind="stable").reshape(CLASSES, SLOTS // CLASSES)
    total = max(1, int(bigrams.sum()))
    by_slot = bigrams.sum(axis=0) + 0.5
    bias_s = np.log(by_slot)
    bias_c = np.log(by_slot[members].sum(axis=1))
    # contexts (b1, b2): bigrams read backwards, with the start of a text in place of its end
    contexts = bigrams.T.copy()
    contexts[end] = 0
    contexts[end, end] = bigrams[:, end].sum()
    p1, p2, p3 = _places()
    one_hot = np.eye(CLASSES)[classes]
    seen = np.zeros(TABLE)
    np.add.at(seen, p1.ravel(), (bigrams @ one_hot).ravel())
    np.add.at(seen, p2.ravel(), (skips @ one_hot).ravel())
    seen += np.bincount(p3.ravel(), weights=bigrams.ravel().astype(float), minlength=TABLE)
    step = -(-SLOTS // BLOCKS)
    cuts = range(0, SLOTS, step)
    blocks = pinned(spark.createDataFrame(pa.table({
        "at": pa.array(cuts, pa.int32()), "contexts": pa.array([contexts[at:at + step].tobytes() for at in cuts], pa.binary()),
        "bigrams": pa.array([np.ascontiguousarray(bigrams[at:at + step]).tobytes() for at in cuts], pa.binary())})).repartition(GRADIENT_TASKS))
    del contexts
    theta, m, v = np.zeros(TABLE), np.zeros(TABLE), np.zeros(TABLE)
    for k in range(1, updates + 1):
        shared = spark.sparkContext.broadcast((theta.astype(np.float32), bias_c, bias_s, members))

        def partial(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            w, bc, bs, mem = shared.value
            g = np.zeros(TABLE)
            for b in batches:
                for r in b.to_pylist():
                    x, y = (np.frombuffer(r[n], dtype=np.int64).reshape(-1, SLOTS) for n in ("contexts", "bigrams"))
                    g += _block_gradient(w.astype(np.float64), bc, bs, mem, r["at"], x, y)
            yield pa.RecordBatch.from_arrays([pa.array([g.astype(np.float32).tobytes()], pa.binary())], names=["g"])

        grad = seen.copy()
        for r in blocks.mapInArrow(partial, "g binary").collect():  # GRADIENT_TASKS tables of TABLE numbers
            grad -= np.frombuffer(r["g"], dtype=np.float32)
        shared.destroy()
        grad = grad / total - L2 * theta
        m, v = 0.8 * m + 0.2 * grad, 0.98 * v + 0.02 * grad * grad
        theta = theta + RATE * (m / (1 - 0.8 ** k)) / (np.sqrt(v / (1 - 0.98 ** k)) + 1e-9)
    inside, norm = np.empty((SLOTS, SLOTS), np.float32), np.empty((SLOTS, SLOTS), np.float32)
    for i in range(SLOTS):  # a row at a time
        slot = bias_s + theta[p3[i]]
        inside[i] = slot - _logsum(slot[members])[classes] + (bias_c + theta[p1[i]])[classes]
        norm[i] = _logsum(bias_c + theta[p1[i]] + theta[p2])
    return Model(inside, theta[p2].astype(np.float32), norm, classes)


SCORED = "row long, h long, n long, doc_id long, held_out boolean, n_tokens long, n_known long, log_count double, rest double"


def _scored(docs: DataFrame, lex: Lexicon, model: Model) -> DataFrame:
    """A row per document (n = 0) with its part from frequent words, and a row per other word of it."""
    sc = docs.sparkSession.sparkContext
    shared, end = sc.broadcast((lex, model)), lex.end_slot

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, model = shared.value
        table, row = _Slots(lex), TaskContext.get().partitionId() << 36
        slot_part = -np.log10(lex.slot_tokens + lex.slot_words + 1.0)
        slot_part[:OWN_SLOTS] = 0.0
        for b, texts in _slices(batches, 2):
            ids, sizes = table.numbered(texts)
            s, count = table.slot[ids], table.count[ids]
            b1, b2 = _before(s, sizes, end)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            log_p = (model.step[b1, s].astype(np.float64) + model.skip[b2, model.classes[s]] - model.norm[b1, b2]) / math.log(10)
            per = lambda x: np.bincount(doc, weights=x, minlength=len(sizes))
            found = count >= 0
            frequent = np.where(found, np.log10(np.maximum(count, 0) + 1.0), 0.0)
            # inside its slot: own slots hold one word, others by add-one counts
            rest = log_p + slot_part[s] - np.where(s < OWN_SLOTS, frequent, 0.0)
            rare = np.flatnonzero(~found)
            pair, n = np.unique(doc[rare] * (1 << 32) + ids[rare], return_counts=True)
            k, m = len(sizes), len(pair)
            none = lambda t: pa.nulls(m, t)
            rows = row + np.arange(k)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(rows), pa.array(row + (pair >> 32))]),
                pa.concat_arrays([pa.array(rows * 0x9E3779B1), pa.array(table.hash[pair & 0xFFFFFFFF])]),
                pa.concat_arrays([pa.array(np.zeros(k, np.int64)), pa.array(n.astype(np.int64))]),
                pa.concat_arrays([b.column(0), none(pa.int64())]), pa.concat_arrays([b.column(1), none(pa.bool_())]),
                pa.concat_arrays([pa.array(sizes), none(pa.int64())]),
                pa.concat_arrays([pa.array(per((count > 0).astype(float)).astype(np.int64)), pa.array(np.zeros(m, np.int64))]),
                pa.concat_arrays([pa.array(per(frequent)), pa.array(np.zeros(m))]),
                pa.concat_arrays([pa.array(per(rest)), pa.array(np.zeros(m))])], names=[c.split()[0] for c in SCORED.split(", ")])
            row += k

    return docs.mapInArrow(score, SCORED)


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS,
                    held_out: int = HELD_OUT, updates: int = UPDATES,
                    frequent: int = FREQUENT) -> DataFrame:
    """Train on all documents outside the held-out fold and score every document."""
    need(docs, doc_id, text)
    spark = docs.sparkSession
    fold = F.crc32(F.col(doc_id).cast("string")) % folds
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
                       F.col(text).alias("text"))
    train = base.filter(~F.col("held_out"))
    counts = pinned(_word_counts(train))
    lex = lexicon(counts, frequent)
    bigrams, skips = _slot_counts(train, lex)
    model = train_model(spark, bigrams, skips, lex.end_slot, updates)
    met = _scored(base, lex, model).join(counts.select(F.col("h").alias("_h"), "c"), F.col("h") == F.col("_h"), "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    out = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("log_count") + F.col("n") * F.log10(c + 1.0)).alias("logs"), F.sum("rest").alias("rest"))
    # one add-one denominator per token; the logs of count + 1 are common to both scores
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(lex.tokens).cast("long").alias("train_tokens"),
                      (F.col("logs") - F.col("n_tokens") * math.log10(lex.tokens + lex.distinct + 1.0)).alias("base_score"),
                      (F.col("logs") + F.col("rest")).alias("score"))
