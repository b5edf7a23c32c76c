"""Ordered scans per key on one plan at every size: numbering, running sums, last value, neighbours.

``Window.partitionBy(key).orderBy(t)`` puts every row of a key in one task. A
key that holds a third of the data (one miner's whole log, one repo's
history) then serialises the job. Here rows are cut into segments, contiguous
ranges of (key, order), so a hot key spreads over many of them:

1. cut points are taken once from a small sample of (key, order) and stand in
   the plan as literals. A row's segment is therefore a plain function of the
   row: every pass and every retry agrees, and nothing has to be written to
   keep it so. Any cut points give right results; the sample only balances;
2. what a segment takes over from earlier ones of its key (the carry) is
   composed from one-row summaries. Only keys named by a cut point can lie in
   two segments, so only their rows are summarised, and at most two carries a
   segment are sent to every task: bounded by the number of segments;
3. running columns are windows inside (segment, key): one shuffle of the rows,
   shared by all columns and all passes.

Later passes may read columns of earlier ones; they use the same layout. A
frame that keeps its segment column (``result(keep=True)``) is not laid out
again for the same keys, so operators on one series share one shuffle.
(keys, order) should be unique per row; rows with equal order lie in one
segment, and which comes first is arbitrary, as in a window.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import shuffle_partitions

# Sampled rows a segment, fewest rows of a segment, most segments.
SAMPLED, FEWEST, MOST_SEGMENTS = 32, 64, 1024
_SPAN = 1 << 40

Spec = tuple[str, str, object]


class Cuts(NamedTuple):
    """Cut points as text, field by field, and the hashes of their keys."""

    points: list[tuple[str | None, ...]]
    keys: list[int]


_KNOWN: OrderedDict[tuple, Cuts] = OrderedDict()


def cut_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], segments: int) -> Cuts:
    """At most ``segments - 1`` points that part the sorted (keys, order) into even ranges.

    A hash sample of the narrow columns, at a rate from the plan's size estimate;
    where that gave too few rows, a second one at a rate from the true count.
    Points are remembered per plan, since old ones are as right as new ones.
    """
    cols = [*keys, *order]
    narrow = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    mark = (df.sparkSession.sparkContext.applicationId, narrow.semanticHash(), len(keys), segments)
    if mark in _KNOWN:
        return _KNOWN[mark]
    wanted, names = segments * SAMPLED, narrow.columns

    def sample(n: int) -> tuple[list, float]:
        part = min(_SPAN, max(1, _SPAN * wanted // max(n, 1)))
        rows = narrow if part == _SPAN else narrow.filter(F.pmod(F.xxhash64(*names), F.lit(_SPAN)) < part)
        text = ", ".join(f"CAST(x.{c} AS STRING)" for c in names)
        key = f"xxhash64({', '.join(f'x.{c}' for c in names[:len(keys)])})" if keys else "0L"
        got = (rows.agg(F.array_sort(F.collect_list(F.struct(*names))).alias("s"))
               .select(F.expr(f"transform(s, x -> struct({key}, {text}))").alias("s")).first()["s"])
        return got, part / _SPAN

    stats = narrow._jdf.queryExecution().optimizedPlan().stats()
    rows, rate = sample(int(stats.sizeInBytes()) // (8 + 8 * len(cols)))
    if rate < 1 and len(rows) < wanted // 4:
        rows, rate = sample(narrow.count())
    segments = min(segments, int(len(rows) / rate) // FEWEST)
    at = sorted({len(rows) * i // segments for i in range(1, segments)} - {0}) if segments > 1 else []
    cuts = Cuts([tuple(rows[i])[1:] for i in at], sorted({rows[i][0] for i in at}))
    _KNOWN[mark] = cuts
    if len(_KNOWN) > 256:
        _KNOWN.popitem(last=False)
    return cuts


def _literal(value: str | None, kind: str) -> str:
    return f"CAST({'NULL' if value is None else chr(39) + value.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39)) + chr(39)} AS {kind})"


def segment_of(df: DataFrame, cols: Sequence[str], cuts: Cuts) -> Column:
    """Number of cut points at or below a row, as a balanced tree of comparisons (one expression text)."""
    kinds = [df.schema[c].dataType.simpleString() for c in cols]
    here = f"struct({', '.join(f'`{c}` AS c{i}' for i, c in enumerate(cols))})"
    points = [f"struct({', '.join(f'{_literal(v, k)} AS c{i}' for i, (v, k) in enumerate(zip(p, kinds, strict=True)))})" for p in cuts.points]

    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"IF({here} >= {points[mid]}, {search(mid + 1, high)}, {search(low, mid)})"

    return F.expr(search(0, len(points)))


def segment_column(keys: Sequence[str]) -> str:
    return "_seg_" + "_".join(keys)


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


class Running:
    """Adds running columns to ``df``, pass by pass.

    Kinds of a spec (name, kind, column): ``count`` (1-based row number in the
    key), ``sum`` (inclusive running sum), ``last`` (last non-null value at or
    before the row), ``lag``, ``lag2`` and ``lead`` (the neighbour's value),
    ``since`` (running sum that starts anew at marked rows; the column is a
    pair: value, mark). A frame that has the segment column of these keys must be
    ordered alike; ``cuts`` is None then. ``like`` is a frame with these keys and
    orders that is cheaper to sample, such as the raw rows behind a parsed log.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], segments: int | None = None, like: DataFrame | None = None):
        self.keys, self.order = list(keys), list(order)
        self.seg = segment_column(keys)
        self.cuts, self.df = None, df
        if self.seg not in df.columns:
            segments = min(segments or shuffle_partitions(df.sparkSession), MOST_SEGMENTS)
            self.cuts = cut_points(df if like is None else like, self.keys, self.order, segments)
            self.df = df.withColumn(self.seg, segment_of(df, [*self.keys, *self.order], self.cuts))

    def _local(self, df: DataFrame, specs: Sequence[Spec]) -> DataFrame:
        """Running columns inside a segment, as ``_l_<name>``."""
        w = Window.partitionBy(self.seg, *self.keys).orderBy(*self.order)
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = df.withColumns({"_rn": F.row_number().over(w).cast("long")} | {
            f"_l_{name}": F.sum(_column(col)).over(run) if kind == "sum" else
            F.last(_column(col), ignorenulls=True).over(run) if kind == "last" else
            F.sum(_column(col[0])).over(run) if kind == "since" else
            (F.lead if kind == "lead" else F.lag)(_column(col), 2 if kind == "lag2" else 1).over(w)
            for name, kind, col in specs if kind != "count"})
        reset = [(name, col) for name, kind, col in specs if kind == "since"]
        if reset:  # less the sum before the last marked row
            out = out.withColumns({f"_b_{name}": F.last(F.when(_column(mark), F.col(f"_l_{name}") - _column(value)), ignorenulls=True).over(run)
                                   for name, (value, mark) in reset})
            out = out.withColumns({f"_l_{name}": F.col(f"_l_{name}") - F.coalesce(F.col(f"_b_{name}"), F.lit(0)) for name, _ in reset})
        return out

    def _carries(self, specs: Sequence[Spec]) -> DataFrame | None:
        """(segment, keys, ``_c_<name>``): what earlier segments of a key hand over; at most one row a segment."""
        if self.cuts and not self.cuts.points:
            return None
        rows = self.df.filter(F.xxhash64(*self.keys).isin(self.cuts.keys)) if self.keys and self.cuts else self.df
        if any(kind in ("since", "lag2") for _, kind, _ in specs):
            rows = self._local(rows, [s for s in specs if s[1] == "since"] + [(f"{n}_1", "lag", c) for n, k, c in specs if k == "lag2"])
        order = F.struct(*self.order)
        at = lambda pick, **fields: pick(F.struct(order.alias("o"), *[c.alias(n) for n, c in fields.items()]))
        aggs = [F.count(F.lit(1)).alias("_n")]
        for name, kind, col in specs:
            if kind == "sum":
                aggs.append(F.sum(_column(col)).alias(f"_s_{name}"))
            elif kind == "last":
                c = _column(col)
                aggs.append(F.max(F.when(c.isNotNull(), F.struct(order.alias("o"), c.alias("v"))))["v"].alias(f"_s_{name}"))
            elif kind in ("lag", "lead"):
                aggs.append(at(F.max if kind == "lag" else F.min, v=_column(col))["v"].alias(f"_s_{name}"))
            elif kind == "lag2":
                aggs.append(at(F.max, v=_column(col), u=F.col(f"_l_{name}_1")).alias(f"_s_{name}"))
            elif kind == "since":
                aggs.append(at(F.max, v=F.col(f"_l_{name}"), b=F.col(f"_b_{name}").isNotNull()).alias(f"_s_{name}"))
            elif kind != "count":
                raise ValueError(f"unknown scan kind {kind!r}")
        summary = rows.groupBy(self.seg, *self.keys).agg(*aggs)
        if not self.cuts:  # keys in two segments only
            summary = summary.withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy(*self.keys))).filter("_m > 1")
        by = Window.partitionBy(*self.keys).orderBy(self.seg)
        before = by.rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*self.keys).orderBy(F.col(self.seg).desc())
        summed = {f"_t_{name}": F.sum(f"_s_{name}.v").over(by.rowsBetween(Window.unboundedPreceding, 0)) for name, kind, _ in specs if kind == "since"}
        if summed:
            summary = summary.withColumns(summed)
            summary = summary.withColumns({f"_u_{name[3:]}": F.last(F.when(F.col(f"_s_{name[3:]}.b"), F.col(name) - F.col(f"_s_{name[3:]}.v")),
                                                                    ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)) for name in summed})
        out = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_c__n")]
        for name, kind, _ in specs:
            s = F.col(f"_s_{name}")
            if kind == "sum":
                out.append(F.sum(s).over(before).alias(f"_c_{name}"))
            elif kind == "last":
                out.append(F.last(s, ignorenulls=True).over(before).alias(f"_c_{name}"))
            elif kind in ("lag", "lead"):
                out.append(F.lag(s).over(by if kind == "lag" else after).alias(f"_c_{name}"))
            elif kind == "lag2":
                two = F.when(F.lag("_n").over(by) > 1, F.lag(s["u"]).over(by)).otherwise(F.lag(s["v"], 2).over(by))
                out.append(F.struct(F.lag(s["v"]).over(by).alias("v"), two.alias("u")).alias(f"_c_{name}"))
            elif kind == "since":
                out.append(F.lag(F.col(f"_t_{name}") - F.coalesce(F.col(f"_u_{name}"), F.lit(0))).over(by).alias(f"_c_{name}"))
        return summary.select(F.col(self.seg).alias("_cseg"), *[F.col(k).alias(f"_ck_{k}") for k in self.keys], F.col("_n").alias("_cn"), *out)

    def add(self, specs: Sequence[Spec]) -> DataFrame:
        carries = self._carries(specs)
        df = self.df
        if carries is not None:
            on = [F.col(self.seg) == F.col("_cseg")] + [F.col(k).eqNullSafe(F.col(f"_ck_{k}")) for k in self.keys]
            df = df.join(F.broadcast(carries), on, "left")
        df = self._local(df, specs)
        values = {}
        for name, kind, _ in specs:
            here = F.col("_rn" if kind == "count" else f"_l_{name}")
            if carries is None:
                values[name] = here
                continue
            came = F.col("_c__n" if kind == "count" else f"_c_{name}")
            if kind == "count":
                value = here + F.coalesce(came, F.lit(0))
            elif kind == "sum":
                value = F.when(came.isNull(), here).otherwise(F.coalesce(here, F.lit(0)) + came)
            elif kind == "last":
                value = F.coalesce(here, came)
            elif kind == "lag":  # the first row of a segment takes the previous segment's last row
                value = F.when(F.col("_rn") == 1, came).otherwise(here)
            elif kind == "lead":
                value = F.when(F.col("_rn") == F.col("_cn"), came).otherwise(here)
            elif kind == "lag2":
                value = F.when(F.col("_rn") == 1, came["u"]).when(F.col("_rn") == 2, came["v"]).otherwise(here)
            else:
                value = F.when(F.col(f"_b_{name}").isNull(), here + F.coalesce(came, F.lit(0))).otherwise(here)
            values[name] = value
        df = df.withColumns(values)
        made = ("_l_", "_b_", "_c_", "_ck_")
        self.df = df.drop("_rn", "_cn", "_cseg", *[c for c in df.columns if c.startswith(made)])
        return self.df

    def with_column(self, name: str, col: Column) -> DataFrame:
        self.df = self.df.withColumn(name, col)
        return self.df

    def result(self, keep: bool = False) -> DataFrame:
        return self.df if keep else self.df.drop(self.seg)
