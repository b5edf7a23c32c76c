"""Mixing sources to target weights by iterative proportional fitting.

Token counts are aggregated to cells (source, language, topic). Raking scales
the cells to one marginal after another (windows over the cell table, never
over documents) until every marginal meets its target; a cell's rate is its
fitted share over its own share, scaled so that the largest rate is 1, so all
targets hold in expectation and no document is wanted more than once. A
document is sampled when a seeded hash of its id, in [0, 1), is below its rate.

Targets are, per marginal, either a temperature a (share of value v in
proportion to tokens(v)^a) or a mapping of value to weight (normalised; values
not named have weight 0).

Defined results: a null marginal is the value ''; null text has no words; a
document without words has rate 0 and is never sampled, as has one whose value
has target 0; rows that repeat an id get the same decision; an empty table
gives no rows. If targets contradict empty cells the fit stops after
``max_rounds`` and the last marginal fitted holds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import seeded_int
from quarry.llm.util import need, pinned

WORD = r"[^\x20\x09-\x0D]+"
DIMS = ("source", "lang", "topic")
TEMPERATURE = {"source": 0.5, "lang": 0.7, "topic": 0.8}
ROUNDS_AT_ONCE = 6
TOLERANCE = 1e-13
# Most cells that are sent to every task and raked in one; larger cell tables are joined by key and raked by shuffles.
BROADCAST_CELLS = 100_000


def topic_of(text: Column, words: Column) -> Column:
    """Topic by form: tables, then notes, articles and books by length."""
    return (F.when(F.contains(F.coalesce(text, F.lit("")), F.lit(" | ")), "table")
            .when(words < 100, "note").when(words < 1000, "article").otherwise("book"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns ``n_tokens`` (words) and ``topic``; columns of these names are replaced."""
    need(docs, text)
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    return docs.withColumn("n_tokens", words).withColumn("topic", topic_of(F.col(text), F.col("n_tokens")))


def _kept(cells: DataFrame, small: bool) -> DataFrame:
    """Pinned; a small table as one partition, where windows need no shuffle each."""
    return pinned(cells).coalesce(1) if small else pinned(cells)


def _with_targets(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]], small: bool) -> DataFrame:
    """Add t_<dim>: the target share of the cell's value."""
    of = {d: F.sum("tokens").over(Window.partitionBy(d)) for d in targets}
    cells = _kept(cells.select("*", *[of[d].alias(f"m_{d}") for d in targets]), small)
    sums = cells.agg(*[F.sum(F.col("tokens") / F.col(f"m_{d}") * F.pow(F.col(f"m_{d}").cast("double"), F.lit(float(t))))
                       .alias(d) for d, t in targets.items() if not isinstance(t, Mapping)]
                     or [F.lit(0).alias("none")]).first()
    for d, t in targets.items():
        if isinstance(t, Mapping):
            total = float(sum(t.values()))
            share = F.lit(0.0)
            for value, weight in t.items():
                share = F.when(F.col(d) == value, F.lit(weight / total)).otherwise(share)
        else:
            share = F.pow(F.col(f"m_{d}").cast("double"), F.lit(float(t))) / F.lit(float(sums[d] or 1.0))
        cells = cells.withColumn(f"t_{d}", share)
    return cells


def fitted_rates(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]],
                 max_rounds: int = 40, tolerance: float = TOLERANCE) -> DataFrame:
    """Rake ``cells`` (dims..., tokens > 0) to the targets; adds ``rate`` in [0, 1]."""
    dims = list(targets)
    cells = pinned(cells)
    small = cells.count() <= BROADCAST_CELLS
    cells = _with_targets(cells.coalesce(1) if small else cells, targets, small).withColumn("w", F.col("tokens").cast("double"))
    done = 0
    while True:
        for _ in range(ROUNDS_AT_ONCE):
            for d in dims:
                here = F.sum("w").over(Window.partitionBy(d))
                cells = cells.withColumn("w", F.when(here > 0, F.col("w") * F.col(f"t_{d}") / here).otherwise(0.0))
            if small:  # one task sorts for every window of its plan, and holds a page of memory for each sort
                cells = _kept(cells, small)
        cells = cells if small else _kept(cells, small)
        done += ROUNDS_AT_ONCE
        off = cells.select(*[F.abs(F.sum("w").over(Window.partitionBy(d)) - F.col(f"t_{d}")).alias(d) for d in dims])
        worst = off.agg(F.max(F.greatest(*dims) if len(dims) > 1 else F.col(dims[0]))).first()[0]
        if worst is None or worst <= tolerance or done >= max_rounds:
            break
    top = cells.agg(F.max(F.col("w") / F.col("tokens"))).first()[0]
    return cells.select(*dims, (F.col("w") / F.col("tokens") / F.lit(float(top or 1.0))).alias("rate"))


def mix(docs: DataFrame, targets: Mapping[str, float | Mapping[str, float]] = TEMPERATURE, seed: str = "mix",
        doc_id: str = "doc_id", max_rounds: int = 40) -> DataFrame:
    """Add ``rate`` and ``sampled`` to documents that carry ``n_tokens`` and the marginals of ``targets``."""
    need(docs, doc_id, "n_tokens", *targets)
    dims = list(targets)
    key = {d: F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dims}
    cells = (docs.select(*[key[d].alias(d) for d in dims], "n_tokens").filter(F.col("n_tokens") > 0)
             .groupBy(*dims).agg(F.sum("n_tokens").alias("tokens")))
    rates = fitted_rates(cells, targets, max_rounds)
    rates = rates.select(*[F.col(d).alias(f"_q_{d}") for d in dims], F.col("rate").alias("_q_rate"))
    if rates.count() <= BROADCAST_CELLS:
        rates = F.broadcast(rates)
    on = [key[d] == F.col(f"_q_{d}") for d in dims]
    met = docs.drop("rate", "sampled").join(rates, on, "left").drop(*[f"_q_{d}" for d in dims])
    rate = F.when(F.col("n_tokens") > 0, F.coalesce(F.col("_q_rate"), F.lit(0.0))).otherwise(F.lit(0.0))
    chance = seeded_int(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("double") / F.lit(float(1 << 60))
    return met.withColumn("rate", rate).withColumn("sampled", chance < F.col("rate")).drop("_q_rate")
