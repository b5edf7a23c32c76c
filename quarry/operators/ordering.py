"""Order-dependent primitives that stay parallel when one group is huge.

A ``row_number() OVER (PARTITION BY shard ORDER BY ...)`` sends a whole shard to
one task. :func:`sequence_within` gives the same numbers from the segmented scan
of :mod:`quarry.operators.scan`; :func:`first_n` keeps a literal number of rows
per key before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.scan import Running


def sequence_within(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    name: str = "pos", partitions: int | None = None, keep: bool = False) -> DataFrame:
    """``row_number() - 1`` over (PARTITION BY keys ORDER BY order), in segments: one shuffle of the rows.

    ``keep`` leaves the segment column, so that a later scan in the same order needs no shuffle.
    """
    r = Running(df, keys, order, partitions)
    r.add([(name, "count", None)])
    return r.result(keep).withColumn(name, F.col(name) - 1)


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
            name: str | None = None) -> DataFrame:
    """Top-n rows per key for a literal n.

    ``row_number() <= n`` is planned with WindowGroupLimit, which keeps at most n
    rows per key in every map task before the shuffle, so a hot key ships at most
    ``n x tasks`` rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = name or "_q_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if name else out.drop(rn)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str, accuracy: int = 10_000) -> DataFrame:
    """(keys, ``name``): the median of each group's non-null values, by selection.

    A sketch bounds the middle of every group between two values; one pass counts
    what lies below and how often each value between them occurs, both combined
    map-side. Only those few values are ordered per group, so no task holds a
    group, however large it is or however often a value repeats.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    reach = 4 / accuracy  # the sketch is off by 1 / accuracy of the rows at most
    sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(
        "_v", [max(0.0, 0.5 - reach), min(1.0, 0.5 + reach)], accuracy).alias("_q"))
    sketch = sketch.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n", F.col("_q")[0].alias("_low"), F.col("_q")[1].alias("_high"))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    near = rows.join(sketch, on).filter(F.col("_v") <= F.col("_high"))
    counts = near.groupBy(*keys, "_n", F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_m")).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.col("_m").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    middle = counts.withColumn("_upto", upto)
    at = lambda k: F.min(F.when(F.col("_upto") > k, F.col("_m")))
    found = middle.groupBy(*keys, "_n").agg(at(F.expr("(_n - 1) div 2")).alias("_a"), at(F.expr("_n div 2")).alias("_b"))
    return found.select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias(name))
