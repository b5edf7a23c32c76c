"""Tokenizer hook resolved from a ``package.module:Class`` name.

With no name the default tokenizer is pure column expressions (whitespace split,
md5 token ids; see ``text.default_token_ids``). A named class runs inside an
Arrow-batched pandas UDF: one instance per Python worker, ``encode`` called per
text in the batch. Any class with ``encode(str) -> list[int]`` fits.
"""

from __future__ import annotations

import hashlib
import importlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import default_token_ids

_CACHE: dict[str, object] = {}
_SPLIT = re.compile(r"[ \t\n\r]+")


def _resolve(name: str):
    if name not in _CACHE:
        mod, _, cls = name.partition(":")
        _CACHE[name] = getattr(importlib.import_module(mod), cls)()
    return _CACHE[name]


class WhitespaceMd5:
    """Python twin of the default tokenizer (for checking the hook path)."""

    def encode(self, text: str) -> list[int]:
        return [int(hashlib.md5(t.encode("utf-8")).hexdigest()[:8], 16) for t in _SPLIT.split(text) if t]


def token_ids(df: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Add ``ids array<bigint>`` (and ``h``, the content hash) using the named tokenizer."""
    if tokenizer is None:
        return default_token_ids(df, text)

    @F.pandas_udf("array<bigint>")
    def encode(s: pd.Series) -> pd.Series:
        tok = _resolve(tokenizer)
        return s.map(lambda t: [] if t is None else list(tok.encode(t)))

    from quarry.functions.hashing import hex_prefix_int

    return df.withColumn("ids", encode(F.col(text))).withColumn("h", hex_prefix_int(F.md5(F.col(text)), 15))
