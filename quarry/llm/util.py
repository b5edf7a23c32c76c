"""Helpers shared by the operators: table access, pinned intermediates, group streams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Most key rows that are sent to every task; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def sent_if_small(keys: DataFrame) -> DataFrame:
    """A narrow key table, broadcast only when its counted size is proven small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def need(df: DataFrame, *cols: str) -> None:
    """Fail early, by name, when a required column is missing or ambiguous."""
    for c in cols:
        if df.columns.count(c) != 1:
            raise ValueError(f"column {c!r} must occur exactly once in {df.columns}")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Re-cut a stream sorted by the integer column ``key`` so that no group spans two tables."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        if held and held[-1].column(key)[-1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        cuts = np.flatnonzero(k[1:] != k[:-1])
        if len(cuts):
            at = int(cuts[-1]) + 1
            yield pa.Table.from_batches([*held, b.slice(0, at)])
            held = [b.slice(at)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def bounds(keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal neighbours, and the length at the end."""
    if not len(keys):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


# Rows of texts that a task has as Python objects at once.
TEXT_ROWS = 1000


def cut_batches(batches: Iterator[pa.RecordBatch], rows: int = TEXT_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows; an empty batch comes as it is."""
    for b in batches:
        for at in range(0, max(1, b.num_rows), rows):
            yield b.slice(at, rows)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
