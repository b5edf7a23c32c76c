"""Quality rules by line labelling with a linear-chain conditional random field.

Every line of a text that holds a word gets a feature vector; Viterbi decoding
labels the lines content or boilerplate, and the share of words in content
lines decides whether a document stays. Two plain rules come first: at least
``min_words`` words, and at most ``max_repeat`` of the words inside three-word
windows that occur twice or more.

The field is trained on at most ``train_docs`` labelled documents (those with
the smallest hash of their id) and at most ``train_lines`` lines of each, in
chains of at most CHAIN lines: every line of a document takes the document's
quality label, by the exact gradient of the log likelihood (forward-backward
in numpy). Only those lines' features reach the driver. Without labels of both
kinds there is no field, and the plain rules decide alone.

Defined results: null and blank text have no words and fail the plain rules; a
text is labelled whole, however long; rows that repeat an id are judged each;
of repeated labels the largest counts, null labels are left out; an empty table
gives no rows. Extra columns pass through ``apply_rules`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.util import cut_batches, need

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
TRAIN_DOCS, TRAIN_LINES, CHAIN = 4000, 256, 64
ROUNDS, RATE, L2 = 200, 0.15, 1e-3
MIN_SHARE = 0.5
CONTENT = 1

WORDS_RE = re.compile(r"[^\x20\x09-\x0D]+")
FEATURES = ("bias", "words", "one_word", "word_length", "upper", "symbols", "marks", "digits", "ends", "variety",
            "again", "first", "long_word")


@dataclass(frozen=True)
class Field:
    """Weights: of content against boilerplate by feature, between labels [from, to], and at the start."""

    emit: np.ndarray
    step: np.ndarray
    start: np.ndarray


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[str]) -> int:
    """Words in three-word windows found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    pairs = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)[1]
    _, which, often = np.unique(pairs.astype(np.int64) * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = often[which] > 1
    hit = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        hit[shift:shift + len(again)] |= again
    return int(hit.sum())


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES, words per line) of the lines that hold a word."""
    seen: set[str] = set()
    rows, sizes = [], []
    for line in text.split("\n"):
        words = line.split()
        if not words:
            continue
        n, chars = len(words), len(line)
        letters = sum(map(len, words)) or 1
        upper = chars - sum(map(str.isupper, line)) if not line.islower() else chars
        symbols = sum(line.count(c) for c in SYMBOLS) if not line.isalnum() else 0
        rows.append((1.0, min(n, 60) / 20.0, float(n == 1), min(letters / n, 30.0) / 6.0, (chars - upper) / letters * 3.0,
                     min(symbols / n, 3.0) * 2.0, min(line.count("!") / n, 3.0) * 2.0,
                     sum(map(str.isdigit, line)) / letters * 3.0 if not line.isalpha() else 0.0,
                     float(words[-1][-1] in ".!?;:"), len(set(words)) / n * 2.0, float(line in seen),
                     float(not seen), min(max(map(len, words)), 60) / 20.0))
        seen.add(line)
        sizes.append(n)
    return np.array(rows, dtype=np.float64).reshape(-1, len(FEATURES)), np.array(sizes, dtype=np.int64)


def _padded(chains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Chains, longest first, as (steps, chains, ...) and how many chains each step has."""
    sizes = np.array([len(c) for c in chains])
    out = np.zeros((int(sizes.max(initial=0)), len(chains), *chains[0].shape[1:]))
    for i, c in enumerate(chains):
        out[: len(c), i] = c
    return out, (sizes[None, :] > np.arange(len(out))[:, None]).sum(axis=1)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis)
    return top + np.log(np.exp(a - np.expand_dims(top, axis)).sum(axis=axis))


def train(chains: list[np.ndarray], labels: list[int], rounds: int = ROUNDS) -> Field | None:
    """Adam on the exact conditional log likelihood; a chain's lines all carry its label."""
    kept = [(c[at:at + CHAIN], y) for c, y in zip(chains, labels, strict=True) for at in range(0, len(c), CHAIN)]
    if len({y for _, y in kept}) < 2:
        return None
    kept.sort(key=lambda x: -len(x[0]))
    x, active = _padded([c for c, _ in kept])
    gold = np.array([y for _, y in kept])
    mask = np.arange(len(gold))[None, :] < active[:, None]
    # either label weighs alike, whatever its share of the lines
    weight = np.where(gold == 1, 0.5 / max(1, mask[:, gold == 1].sum()), 0.5 / max(1, mask[:, gold == 0].sum()))
    steps, n, dims = x.shape
    theta = np.zeros(dims + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    ends = mask.sum(axis=0) - 1
    for k in range(1, rounds + 1):
        emit, step, start = theta[:dims], theta[dims:dims + 4].reshape(2, 2), theta[dims + 4:]
        score = np.stack([np.zeros((steps, n)), x @ emit], axis=-1)
        ahead, back = np.zeros((steps, n, 2)), np.zeros((steps, n, 2))
        ahead[0] = start + score[0]
        for t in range(1, steps):
            a = active[t]
            ahead[t, :a] = _logsum(ahead[t - 1, :a, :, None] + step[None], 1) + score[t, :a]
        z = _logsum(ahead[ends, np.arange(n)], 1)
        grad_step = np.zeros((2, 2))
        for t in range(steps - 2, -1, -1):
            a = active[t + 1]
            after = step[None] + (score[t + 1, :a] + back[t + 1, :a])[:, None, :]
            back[t, :a] = _logsum(after, 2)
            pair = np.exp(ahead[t, :a, :, None] + after - z[:a, None, None])
            grad_step -= (pair * weight[:a, None, None]).sum(axis=0)
            for y in (0, 1):
                grad_step[y, y] += weight[:a][gold[:a] == y].sum()
        p = np.exp(ahead + back - z[None, :, None]) * mask[..., None]
        miss = (mask * gold[None] - p[..., 1]) * weight
        grad = np.concatenate([np.einsum("tn,tnd->d", miss, x), grad_step.ravel(),
                               [(weight * ((gold == y) - p[0, :, y])).sum() for y in (0, 1)]]) - L2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    return Field(theta[:dims], theta[dims:dims + 4].reshape(2, 2), theta[dims + 4:])


def viterbi(chains: list[np.ndarray], field: Field) -> list[np.ndarray]:
    """Best label sequence of every chain (all chains step together, longest first)."""
    order = sorted((i for i, c in enumerate(chains) if len(c)), key=lambda i: -len(chains[i]))
    out = [np.zeros(0, dtype=np.int8)] * len(chains)
    if not order:
        return out
    sizes = np.array([len(chains[i]) for i in order])
    score = np.concatenate([chains[i] @ field.emit for i in order])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    best = np.zeros((len(order), 2)) + field.start
    best[:, 1] += score[first]
    came = np.zeros((len(score), 2), dtype=np.int8)
    for t in range(1, int(sizes[0])):
        a = int(np.searchsorted(-sizes, -t, side="left"))  # chains longer than t
        options = best[:a, :, None] + field.step[None]
        came[first[:a] + t] = options.argmax(axis=1)
        best[:a] = options.max(axis=1)
        best[:a, 1] += score[first[:a] + t]
    for i, n, at, b in zip(order, sizes, first, best, strict=True):
        path = np.zeros(n, dtype=np.int8)
        path[-1] = int(b.argmax())
        for t in range(n - 1, 0, -1):
            path[t - 1] = came[at + t, path[t]]
        out[i] = path
    return out


def learned_field(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality", train_docs: int = TRAIN_DOCS, train_lines: int = TRAIN_LINES) -> Field | None:
    """The field of a bounded sample of labelled documents."""
    need(docs, doc_id, text)
    need(labels, doc_id, label)
    ids = (labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
           .groupBy(F.col(doc_id).cast("long").alias("_q_id")).agg(F.max(label).cast("int").alias("_q_label"))
           .orderBy(F.xxhash64("_q_id"), "_q_id").limit(train_docs))
    picked = (docs.select(F.col(doc_id).cast("long").alias("_q_id"), F.col(text).alias("_q_text"))
              .join(F.broadcast(ids), "_q_id").dropDuplicates(["_q_id"]).select("_q_label", "_q_text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cut_batches(batches):
            x = [line_features(t or "")[0][:train_lines].astype(np.float32).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int32()), pa.array(x, pa.binary())], names=["label", "x"])

    rows = sorted((r["label"], bytes(r["x"])) for r in picked.mapInArrow(features, "label int, x binary").collect())
    chains = [np.frombuffer(x, dtype=np.float32).reshape(-1, len(FEATURES)).astype(np.float64) for _, x in rows]
    return train(chains, [y for y, _ in rows])


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "content_share double, kept boolean")


def apply_rules(docs: DataFrame, field: Field | None, text: str = "text", min_words: int = MIN_WORDS,
                max_repeat: int = MAX_REPEAT_PERCENT, min_share: float = MIN_SHARE) -> DataFrame:
    """Documents with the columns of VERDICT; columns of these names are replaced."""
    need(docs, text)
    names = [c.split()[0] for c in VERDICT.split(", ")]
    docs = docs.drop(*[n for n in names if n != text])
    schema = ", ".join([*(f"`{n}` {k}" for n, k in docs.dtypes), VERDICT])
    at = docs.columns.index(text)
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cut_batches(batches):
            rows, chains, sizes = [], [], []
            for t in b.column(at).to_pylist():
                t = t or ""
                words = WORDS_RE.findall(t)
                counts = base_counts(t, words)
                rows.append([len(words), *counts, len(words) < min_words or 100 * counts[3] > max_repeat * len(words)])
                x, n = line_features(t) if not rows[-1][5] else (np.zeros((0, len(FEATURES))), np.zeros(0))
                chains.append(x)
                sizes.append(n)
            paths = viterbi(chains, field) if field else [np.ones(len(n), dtype=np.int8) for n in sizes]
            for r, path, n in zip(rows, paths, sizes, strict=True):
                share = float(n[path == CONTENT].sum() / n.sum()) if len(n) else 0.0
                r += [share, not r[5] and share >= min_share]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                             names=[*b.schema.names, *names])

    return docs.mapInArrow(judge, schema)
