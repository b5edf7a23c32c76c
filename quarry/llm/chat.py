"""Chat formatting of typed content parts.

A visitor renders each part by its type: a text part is escaped and inserted,
image, audio and document parts become placeholders in order, and their
references and expanded token counts are recorded beside the text. One row per
turn is formatted; a conversation's output is its segments in turn order, so a
conversation of any length is never held as one row. The loss mask of a segment
is a range of code points.

Template: ``<|im_start|>`` role newline body ``<|im_end|>`` newline. A control
string inside a text is any ``<``, backslashes and ``|`` in a row; it gets one
more backslash, and reading takes one away, so escaping is reversible and no
text can hold a control string. Newlines and backslashes in roles are escaped
too.

Defined results: null text and null role are empty; turns go by (turn, role,
segment) with null turns first, so ties have one order and repeated rows stay;
null conversation ids form one conversation; a part of unknown type, or null,
renders as nothing; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.util import need
from quarry.session import shuffle_partitions

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,size:bigint>"
# Expanded tokens: per 784 pixels, per 40 milliseconds, and per page.
PIXELS, MILLISECONDS, PAGE_TOKENS = 784, 40, 512

TURN_RE = re.compile(r"<\|im_start\|>([^\n]*)\n((?:[^<]++|<(?!\|))*+)<\|im_end\|>\n")
UNESCAPE_RE = re.compile(r"<(\\*)\\\|")
ROLE_RE = re.compile(r"\\(.)")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return UNESCAPE_RE.sub(r"<\1|", text)


def unescape_role(role: str) -> str:
    return ROLE_RE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class PartVisitor:
    """Renders a part: ``visit_<type>`` gives (rendered text, expanded tokens or None)."""

    def visit_text(self, part: Column) -> tuple[Column, Column | None]:
        return escape(F.coalesce(part["text"], F.lit(""))), None

    def visit_image(self, part: Column) -> tuple[Column, Column | None]:
        return F.lit("<|image|>"), self._units(part, PIXELS)

    def visit_audio(self, part: Column) -> tuple[Column, Column | None]:
        return F.lit("<|audio|>"), self._units(part, MILLISECONDS)

    def visit_document(self, part: Column) -> tuple[Column, Column | None]:
        return F.lit("<|document|>"), F.coalesce(part["size"], F.lit(0)) * PAGE_TOKENS

    @staticmethod
    def _units(part: Column, unit: int) -> Column:
        return F.ceil(F.coalesce(part["size"], F.lit(0)) / F.lit(float(unit))).cast("long")

    def types(self) -> dict[str, Callable]:
        return {n.removeprefix("visit_"): getattr(self, n) for n in dir(self) if n.startswith("visit_")}

    def rendered(self, part: Column) -> Column:
        out = F.lit("")
        for kind, visit in self.types().items():
            out = F.when(part["type"] == kind, visit(part)[0]).otherwise(out)
        return out

    def tokens(self, part: Column) -> Column:
        out = F.lit(None).cast("long")
        for kind, visit in self.types().items():
            counted = visit(part)[1]
            if counted is not None:
                out = F.when(part["type"] == kind, counted.cast("long")).otherwise(out)
        return out


def text_parts(text: Column) -> Column:
    """A plain text as its one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("size")))


def format_turns(turns: DataFrame, parts: str = "parts", conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", learned_role: str = "assistant", visitor: PartVisitor | None = None) -> DataFrame:
    """One row per turn: segment, loss range [mask_start, mask_stop), attachments, expanded_tokens."""
    need(turns, conv_id, turn, role, parts)
    visitor = visitor or PartVisitor()
    named = F.coalesce(F.col(role), F.lit(""))
    content = F.filter(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    seen = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), named.alias("role"),
                        content.alias("parts"))
    body = F.array_join(F.transform("parts", visitor.rendered), "")
    attached = F.filter(F.transform("parts", lambda p: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"), visitor.tokens(p).alias("tokens"))),
        lambda a: a["tokens"].isNotNull())
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    out = (seen.withColumn("head", head).withColumn("body", body).withColumn("attachments", attached)
           .withColumn("segment", F.concat("head", "body", F.lit(f"{CLOSE}\n"))))
    begin = F.length("head").cast("long")
    return out.select("conv_id", "turn", "role", "segment", begin.alias("mask_start"),
                      F.when(F.col("role") == learned_role, begin + F.length("body")).otherwise(begin).alias("mask_stop"),
                      "attachments", F.aggregate("attachments", F.lit(0).cast("long"),
                                                 lambda n, a: n + a["tokens"]).alias("expanded_tokens"))


def parse_segment(segment: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of formatted output; anything else in it is an error."""
    at, out = 0, []
    for m in TURN_RE.finditer(segment):
        if m.start() != at:
            break
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(segment):
        raise ValueError(f"not the template at {at}: {segment[at:at + 40]!r}")
    return out


class _Conversation:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss, self.n_loss, self.n_chars, self.n_turns = (
            conv_id, hashlib.sha256(), hashlib.sha256(), 0, 0, 0)

    def add(self, segment: str, start: int, stop: int) -> None:
        for role, text in parse_segment(segment):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        learned = unescape(segment[start:stop])
        self.loss.update(learned.encode())
        self.n_loss += len(learned)
        self.n_chars += len(segment)

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.n_loss, self.loss.hexdigest(), self.n_chars)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, parsed from its segments in order.

    Segments are dealt and sorted by conversation and streamed: a task holds one
    segment and two running digests, however long a conversation is.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        out = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        now: _Conversation | None = None
        for b in batches:
            rows = []
            for conv, segment, start, stop in zip(*(b.column(c).to_pylist() for c in (
                    "conv_id", "segment", "mask_start", "mask_stop")), strict=True):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        rows.append(now.row())
                    now = _Conversation(conv)
                now.add(segment, start, stop)
            if rows:
                yield out(rows)
        if now is not None:
            yield out([now.row()])

    n = shuffle_partitions(formatted.sparkSession)
    laid = (formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "segment", "mask_start", "mask_stop")
            .repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment"))
    return laid.select("conv_id", "segment", "mask_start", "mask_stop").mapInArrow(digest, DIGEST)
