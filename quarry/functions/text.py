"""Text and log-line expressions (X1-X7, X20, P1 default tokenizer).

All are JVM-side column expressions; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import hex_prefix_int

# Fixed patterns of the log formats being parsed.
ANSI_PATTERN = r"\x1b\[[0-9;]*m"
STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
REVISION_TRAILERS = ".,'\""
TOKEN_SPLIT = "[ \\t\\n\\r]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ansi(c) -> Column:
    """Remove ANSI colour codes."""
    return F.regexp_replace(_col(c), ANSI_PATTERN, "")


def line_timestamp(c) -> Column:
    """The first 19 characters as a UTC timestamp; anything else is NULL."""
    return F.try_to_timestamp(F.left(_col(c), F.lit(19)), F.lit(STAMP_FORMAT)).cast("timestamp_ntz")


def strip_revision(c) -> Column:
    """Drop trailing . , ' " from a revision token."""
    return F.regexp_replace(_col(c), "[.,'\"]+$", "")


def last_match(c, pattern: str, group: int = 1) -> Column:
    """Group of the last regex match, NULL when there is none."""
    return F.try_element_at(F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(group)), F.lit(-1))


def source_dir_name(path, name=None) -> Column:
    """``path[__name]`` with '/' replaced by '__'."""
    p = _col(path)
    full = p if name is None else F.when(_col(name).isNull() | (_col(name) == ""), p).otherwise(
        F.concat(p, F.lit("__"), _col(name)))
    return F.replace(full, F.lit("/"), F.lit("__"))


def step_from_name(c) -> Column:
    """Step from a trailing ``inneropt_<n>``, else -1."""
    s = F.regexp_extract(_col(c), r"inneropt_(\d+)$", 1)
    return F.coalesce(F.try_to_number(F.when(s != "", s), F.lit("9999999999999999999")).cast("long"),
                      F.lit(-1).cast("long"))


def layer_of(c) -> Column:
    """The token after ``layers`` in a dotted tensor name, else 'other'.

    A name ending in ``layers`` has no following token and is 'other'.
    """
    parts = F.split(_col(c), r"\.")
    at = F.array_position(parts, "layers")
    nxt = F.try_element_at(parts, (at + 1).cast("int"))
    return F.when((at > 0) & nxt.isNotNull(), nxt).otherwise(F.lit("other"))


def split_first_colon(c) -> tuple[Column, Column]:
    """``repo:rev`` -> (repo, rev) at the first colon; no colon gives (whole, NULL)."""
    s = _col(c)
    at = F.instr(s, ":")
    return (F.when(at > 0, F.substring_index(s, ":", 1)).otherwise(s),
            F.when(at > 0, F.substr(s, at + 1)))


def default_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """P1 default tokenizer, first half: whitespace tokens (``tokens``) and the
    content hash ``h`` used for window starts."""
    toks = F.filter(F.split(F.col(text), TOKEN_SPLIT), lambda t: t != "")
    return df.withColumn("tokens", toks).withColumn("h", hex_prefix_int(F.md5(F.col(text)), 15))


def ids_of(tokens) -> Column:
    """P1 default tokenizer, second half: token id = first 8 hex digits of md5."""
    return F.transform(_col(tokens), lambda t: hex_prefix_int(F.md5(t), 8))


def default_token_ids(df: DataFrame, text: str = "text") -> DataFrame:
    """P1 default tokenizer: adds ``ids array<bigint>`` and ``h``.

    When only a window of the ids is needed, window ``tokens`` from
    :func:`default_tokens` first and map just that slice with :func:`ids_of`.
    """
    return default_tokens(df, text).withColumn("ids", ids_of("tokens")).drop("tokens")
