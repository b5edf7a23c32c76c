"""Best-fit packing of token pieces into sequences under several capacities.

Documents are tokenized in Arrow batches, cut at ``max_tokens`` and packed by
vector best-fit decreasing: pieces go, longest first, to the open sequence that
fits them in every dimension (tokens, documents, attention cost = sum of
squared lengths) and scores best, by the weighted norm of what would be left
(``rule="norm"``) or by the weighted dot product of demand and residual
(``rule="dot"``); if none fits, a new sequence opens.

Pieces are dealt by a hash of their row to groups of about ``group_pieces``
rows, each packed by one task, so groups are even however the corpus is skewed,
and each group leaves about one sequence part-filled.

Defined results: null text is the empty text, which still has its end id; rows
that repeat an id are packed each; a text of any length is cut, never
truncated; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.util import need, pinned

MAX_TOKENS = 4096
MAX_DOCS = 2048
# Least, a full-length piece must fit: max_tokens squared.
MAX_COST = MAX_TOKENS * MAX_TOKENS
WEIGHTS = (1.0, 0.02, 0.02)
GROUP_PIECES = 16_384
# Words of each kind that a worker keeps (see ChunkTokenizer); a word takes about 200 bytes.
CACHE_WORDS = 100_000
# The last letter that needs no look at its neighbours (see ChunkTokenizer.letters).
LAST = "\u00ff"
# Characters of text that are tokenized together, and rows that are taken from Arrow together.
SLICE_CHARS, SLICE_ROWS = 2 << 20, 256

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ChunkTokenizer:
    """Token ids of texts as little-endian uint32 bytes, through a cache of blank-separated words.

    The vocabulary's rules never join characters across white space, and a
    sentence mark after a letter up to U+00FF is a token run of its own (others may
    end in a combining mark once normalized, which joins it), so ids of words
    concatenate to the ids of the text. A run of texts is split and its words
    are numbered by Arrow, so each different word is looked up once a run; new
    words are encoded in one call, each as a piece of its own, and the ids of
    all words are then gathered by number. Sentence marks are taken off by Arrow
    too. Texts holding a special-token opener go to the tokenizer whole.

    A worker keeps its cache from task to task, and most different words of a
    corpus are rare, so a word is ``fresh`` until a second run of texts holds it;
    each kind is emptied when it has more than ``limit`` words.
    """

    MARKS = ".,!"
    BEFORE = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        # words of these letters have nothing to compose or to split, each letter is normalized by itself
        whole, pieces = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {k: "".join(p for p, _ in pieces(whole(chr(k)))) for k in range(ord(LAST) + 1) if chr(k).isalpha()}
        self._clear()

    def _clear(self) -> None:
        self.cache: dict[str, bytes] = {"": b""} | {m: self._encode(m) for m in self.MARKS}
        self.fresh: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learned(self, words: list[str]) -> list[bytes]:
        """Ids of new words, one entry a word."""
        model, letters = self.tokenizer.model, self.letters
        ids, cuts, other = [], [0], []
        for k, w in enumerate(words):
            if w.isalpha() and (w.isascii() or max(w) <= LAST):
                ids += [t.id for t in model.tokenize(w.lower() if w.isascii() else w.translate(letters))]
            else:
                other.append(k)
            cuts.append(len(ids))
        out = self._parts(ids, cuts)
        if other:
            found = self.tokenizer.encode([words[k] for k in other], is_pretokenized=True, add_special_tokens=False)
            cuts = np.searchsorted(np.array(found.word_ids, dtype=np.int64), np.arange(len(other) + 1)).tolist()
            for k, x in zip(other, self._parts(found.ids, cuts), strict=True):
                out[k] = x
        return out

    @staticmethod
    def _parts(ids: list[int], cuts: list[int]) -> list[bytes]:
        data = np.array(ids, dtype="<u4").tobytes()
        return [data[4 * x:4 * y] for x, y in zip(cuts, cuts[1:], strict=False)]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of different words."""
        cache, fresh = self.cache, self.fresh
        ids = list(map(cache.get, words))
        new = []
        for k in [k for k, x in enumerate(ids) if x is None]:
            known = fresh.pop(words[k], None)
            if known is None:
                new.append(k)
            else:
                ids[k] = cache[words[k]] = known
        if new:
            names = [words[k] for k in new]
            for k, w, x in zip(new, names, self._learned(names), strict=True):
                ids[k] = fresh[w] = x
        return ids

    def _table(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, ids by chunk); a sentence mark behind a letter of BEFORE is taken off, so both parts are cached alone."""
        marked = pc.match_substring_regex(chunks, f"[{self.BEFORE}][{self.MARKS}]$")
        parts = pc.if_else(marked, pc.utf8_slice_codeunits(chunks, 0, -1), chunks).dictionary_encode()
        last = pc.if_else(marked, pc.utf8_slice_codeunits(chunks, -1), "")
        place = pc.index_in(last, pa.array(["", *self.MARKS], last.type)).to_numpy()
        words = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [*self._ids_of(words), b"", *(self.cache[m] for m in self.MARKS)]
        numbers = np.stack([parts.indices.to_numpy().astype(np.int64), len(words) + place], axis=1)
        ids, ends = _gathered(np.frombuffer(b"".join(found), dtype="<u4"), np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4, numbers.ravel())
        return ids, np.diff(ends[::2])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.limit:
            self._clear()
        if len(self.fresh) > self.limit:
            self.fresh = {}
        special = {i: self._encode(t) for i, t in enumerate(texts) if "<|" in t}
        # ASCII texts in lower case, as the vocabulary has them
        plain = [(t.lower() if t.isascii() else t).replace("\n", " ") if i not in special else "" for i, t in enumerate(texts)]
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        chunks = split.flatten().dictionary_encode()
        ids, ends = _gathered(*self._table(chunks.dictionary), chunks.indices.to_numpy())
        cuts = ends[split.offsets.to_numpy()].tolist()
        return [special[i] if i in special else ids[a:b].tobytes() for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def _gathered(ids: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the numbered entries one after another, and where each entry begins (and the end)."""
    width = sizes[numbers]
    ends = np.concatenate([[0], np.cumsum(width)])
    return ids[np.repeat((np.cumsum(sizes) - sizes)[numbers] - ends[:-1], width) + np.arange(ends[-1])], ends


_TOKENIZERS: dict[str, ChunkTokenizer] = {}  # a worker keeps its cache from task to task


def chunk_tokenizer(vocabulary: str) -> ChunkTokenizer:
    import public_tokenizers

    if vocabulary not in _TOKENIZERS:
        _TOKENIZERS[vocabulary] = ChunkTokenizer(public_tokenizers.path(vocabulary))
    return _TOKENIZERS[vocabulary]


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows in runs of about SLICE_CHARS of text (one row at least), null as empty."""
    for b in batches:
        at, held, texts = 0, 0, []
        for begin in range(0, b.num_rows, SLICE_ROWS):
            for i, t in enumerate(b.column(text).slice(begin, SLICE_ROWS).to_pylist(), begin):
                texts.append(t or "")
                held += len(texts[-1])
                if held >= SLICE_CHARS or i == b.num_rows - 1:
                    yield b.slice(at, i + 1 - at), texts
                    at, held, texts = i + 1, 0, []


def token_pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", doc_id: str = "doc_id", text: str = "text",
                 end_id: int = 1, max_tokens: int = MAX_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every document, end id included."""
    need(docs, doc_id, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chunk_tokenizer(vocabulary)
        end = np.array([end_id], dtype="<u4").tobytes()
        width = 4 * max_tokens
        for b, texts in slices(batches, 1):
            rows: list[tuple] = []
            for i, ids in zip(b.column(0).to_pylist(), tokenizer.encode(texts), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), part))
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                n = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in list(zip(cols, kinds, strict=True))[:n]],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:n])

    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(cut, PIECES + (", ids binary" if with_ids else "")))


def best_fit(sizes: np.ndarray, caps: tuple[float, float, float], weights: tuple[float, float, float] = WEIGHTS,
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece: vector best-fit, longest first."""
    order = np.argsort(-sizes, kind="stable")
    cap = np.array(caps, dtype=float)
    w = np.array(weights, dtype=float)
    smallest = int(sizes.min()) if len(sizes) else 0
    left = np.empty((len(sizes), 3))
    number = np.empty(len(sizes), dtype=np.int64)  # of the open bins
    filled = np.zeros(len(sizes), dtype=np.int64)  # by bin
    bins, at = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    n_open = n_bins = closed = 0
    for i in order:
        size = int(sizes[i])
        item = np.array([size, 1.0, float(size) * size])
        rest = left[:n_open]
        ok = np.flatnonzero((rest[:, 0] >= item[0]) & (rest[:, 1] >= 1.0) & (rest[:, 2] >= item[2]))
        if len(ok):
            if rule == "norm":
                score = -((((rest[ok] - item) / cap) ** 2) * w).sum(axis=1)
            else:
                score = (rest[ok] / cap * (item / cap) * w).sum(axis=1)
            j = int(ok[np.argmax(score)])
        else:
            j, n_open = n_open, n_open + 1
            left[j], number[j] = cap, n_bins
            n_bins += 1
        b = number[j]
        bins[i], at[i] = b, filled[b]
        filled[b] += size
        left[j] -= item
        if left[j, 0] < smallest or left[j, 1] < 1.0:
            closed += 1
            if closed > 64 and closed * 4 > n_open:
                keep = np.flatnonzero((left[:n_open, 0] >= smallest) & (left[:n_open, 1] >= 1.0))
                left[:len(keep)], number[:len(keep)] = left[keep], number[keep]
                n_open, closed = len(keep), 0
    return bins, at


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, max_docs: int = MAX_DOCS, max_cost: float = MAX_COST,
         weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm",
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces that carry ``length``; other columns pass through."""
    need(pieces, "length")
    if max_docs < 1 or max_cost < float(max_tokens) ** 2:
        raise ValueError("a full-length piece must fit a sequence")
    pieces = pinned(pieces)
    groups = max(1, math.ceil(pieces.count() / group_pieces))
    dealt = pieces.withColumn("_q_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long"))
    schema = ", ".join([*(f"`{n}` {k}" for n, k in pieces.dtypes), "sequence_id long", "offset long"])

    def place(part: pd.DataFrame) -> pd.DataFrame:
        group = int(part["_q_group"].iloc[0])
        bins, at = best_fit(part["length"].to_numpy(), (max_tokens, max_docs, max_cost), weights, rule)
        return part.drop(columns="_q_group").assign(sequence_id=(group << 32) + bins, offset=at)

    return dealt.groupBy("_q_group").applyInPandas(place, schema)


def packed_documents(docs: DataFrame, **settings) -> DataFrame:
    """Every document's pieces with their place in a sequence."""
    return pack(token_pieces(docs), **settings)
