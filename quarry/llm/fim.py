"""Fill-in-middle transformation as a pyarrow.compute pipeline.

A batch of texts is split into units (lines, each with its line feed) as list
arrays; the lists are flattened with their parent indices, a unit's ordinal is
its place less its parent's offset, and its role (prefix, middle, suffix)
follows from two cuts of the parent. Units of each role are filtered, rebuilt
into lists and joined; the pieces are joined with the marks, batch by batch.
Nothing depends on another row, so there is no shuffle.

Cuts, and whether and how a text is rearranged, come from a digest of a seed and
the id: the same row gives the same output wherever and whenever it is read.

Defined results: null text is empty; empty texts, and texts that hold a mark,
are ``plain`` and stay as they are; a null id is hashed as an empty string; rows
that repeat an id are cut alike if their number of units agrees, each on its
own; texts are used whole, however long; columns of the input come along, and
those named like a result are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.util import need

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_SHARE = "7", 100, 50
# Bytes of text that are taken through the pipeline at once; a longer text goes alone.
SLICE_BYTES = 16 << 20

RESULTS = "n long, form string, prefix_chars long, middle_chars long, output string"


def digest_numbers(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers of 32 bits from the digest of a seed and an id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(lines with their line feeds, parent of each, ordinal of each, units of every parent)."""
    pieces = pc.split_pattern(texts, "\n")
    parent = pc.list_parent_indices(pieces).to_numpy()
    flat = pc.list_flatten(pieces)
    size = pc.list_value_length(pieces).to_numpy()
    ordinal = np.arange(len(flat)) - (np.cumsum(size) - size)[parent]
    last = ordinal == size[parent] - 1
    end = pc.if_else(pa.array(last), pa.scalar("", flat.type), pa.scalar("\n", flat.type))
    line = pc.binary_join_element_wise(flat, end, pa.scalar("", flat.type))
    real = ~last | (pc.binary_length(flat).to_numpy() > 0)
    return line.filter(pa.array(real)), parent[real], ordinal[real], np.bincount(parent[real], minlength=len(texts))


def rejoined(line: pa.Array, parent: np.ndarray, mask: np.ndarray, rows: int) -> pa.Array:
    """The masked units of every parent as one string."""
    ends = np.cumsum(np.bincount(parent[mask], minlength=rows))
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends])), line.filter(pa.array(mask)))
    return pc.binary_join(lists, pa.scalar("", line.type))


def _transformed(texts: pa.Array, h: list[np.ndarray], rate: int, spm_share: int) -> list[pa.Array]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    marked = pc.or_(pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)), pc.match_substring(texts, MIDDLE))
    plain = pc.or_(pc.or_(marked, pc.equal(pc.binary_length(texts), 0)), pa.array(h[2] % 100 >= rate))
    line, parent, ordinal, n = units(texts)
    cuts = h[0] % (n + 1), h[1] % (n + 1)
    low, high = np.minimum(*cuts), np.maximum(*cuts)
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent])
    prefix, middle, suffix = (rejoined(line, parent, role == r, len(texts)) for r in range(3))
    p, s, m, none = (pa.scalar(x, pa.large_string()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    spm = pa.array(h[3] % 100 < spm_share)
    moved = pc.if_else(spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none),
                       pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    return [pa.array(n, pa.int64()), form.cast(pa.string()), *chars, pc.if_else(plain, texts, moved).cast(pa.string())]


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most SLICE_BYTES, or of one row."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        base = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield at, to
        at = to


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = RATE,
                   spm_share: int = SPM_SHARE, seed: str = SEED, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all of them by default) with n, form, prefix_chars, middle_chars and output.

    ``rate`` of 100 texts are rearranged, ``spm_share`` of 100 of those with the
    suffix first; the others stay plain.
    """
    need(docs, doc_id, text)
    names = [f.split()[0] for f in RESULTS.split(", ")]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    sent = docs.select(*[c.alias(f"_{i}") for i, c in enumerate(  # by place, so that no name of the input can clash
        [F.col(text), *digest_numbers(F.col(doc_id), seed), *[F.col(f"`{c}`") for c in kept]])])
    schema = "".join(f"`{c}` {f.dataType.simpleString()}, " for c, f in zip(kept, sent.schema.fields[5:], strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(0)), 0).to_numpy(zero_copy_only=False)
            for at, to in _slices(sizes):
                part = b.slice(at, to - at)
                h = [part.column(1 + i).to_numpy() for i in range(4)]
                yield pa.RecordBatch.from_arrays([*part.columns[5:], *_transformed(part.column(0), h, rate, spm_share)], names=[*kept, *names])

    return sent.mapInArrow(run, schema + RESULTS)


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone: no mark occurs inside a piece."""
    def parts(first: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, len(first) + 1, 1 << 30)
        a = F.split(body, SUFFIX if first == PREFIX else PREFIX, 2)
        b = F.split(F.element_at(a, 2), MIDDLE, 2)
        return F.element_at(a, 1), F.element_at(b, 1), F.element_at(b, 2)

    prefix, suffix, middle = parts(PREFIX)
    spm_suffix, spm_prefix, spm_middle = parts(SUFFIX)
    return (F.when(form == "plain", output).when(form == "psm", F.concat(prefix, middle, suffix))
            .otherwise(F.concat(spm_prefix, spm_middle, spm_suffix)))
