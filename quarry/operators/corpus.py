"""Corpus operators: gates, stripes, stride sampling, quotas, profiles, dedup.

All are ``DataFrame -> DataFrame`` over rows shaped like the ``docs`` view
(``shard``, ``ord``, ``pos``, ``text`` ...). Per-shard numbering uses
:func:`sequence_within`, never a one-task-per-shard window.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import exact_median, first_n, sequence_within

# Fixed value: the validator's data-quality gate is 200 characters, and a
# configured 0 or None also means 200.
DEFAULT_MIN_CHARS = 200


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# ---------------------------------------------------------------- F1, F2, F9-F12
def min_chars_gate(df: DataFrame, n: int | None = DEFAULT_MIN_CHARS, col: str = "text",
                   length_col: str | None = "chars") -> DataFrame:
    """keep rows whose text has at least ``n`` code points.

    When the rows carry a precomputed code-point length (``chars``, computed in
    the scan stage) the gate uses it, so wide text need not travel through
    shuffles that precede the gate.
    """
    n = n or DEFAULT_MIN_CHARS
    if length_col and length_col in df.columns:
        return df.filter(F.col(length_col) >= n)
    return df.filter(F.length(F.col(col)) >= n)


def non_empty(df: DataFrame, col: str = "text") -> DataFrame:
    """drop NULL and empty text (apply after striping)."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


def stride_sample(df: DataFrame, stride, pos: str = "pos") -> DataFrame:
    """keep physical lines whose index is a multiple of ``stride``.

    The index is the physical line number, counted before any parse or length
    filter, so apply this first.
    """
    return df.filter(F.col(pos) % _c(stride) == 0)


def rank_stripe(df: DataFrame, rank: int, world: int, pos: str = "pos") -> DataFrame:
    """rows rank, rank+world, ... of each block."""
    if world < 1 or not 0 <= rank < world:
        raise ValueError(f"rank must satisfy 0 <= rank < world, got rank={rank} world={world}")
    return df.filter((F.pmod(F.col(pos), F.lit(world)) == rank) & (F.col(pos) >= rank))


def nested_stripe(df: DataFrame, worker: int, n_workers: int, index: str = "mix_idx") -> DataFrame:
    """second-level stripe over an already mixed stream."""
    if n_workers <= 1:
        return df
    if not 0 <= worker < n_workers:
        raise ValueError("worker must satisfy 0 <= worker < n_workers")
    return df.filter(F.pmod(F.col(index), F.lit(n_workers)) == worker)


def spread_shards(catalog: DataFrame, k: int, total: int | None = None, ord_col: str = "ord") -> DataFrame:
    """shards 0, step, 2*step, ... (first k), step = max(1, total // k).

    ``total`` defaults to the catalogue size. A filter on the ordinal, no sort.
    """
    tot = F.lit(total) if total is not None else F.count(F.lit(1)).over(Window.partitionBy())
    step = F.greatest(F.lit(1), F.floor(tot / F.lit(k)).cast("long"))
    return (catalog.withColumn("_step", step)
            .filter((F.col(ord_col) % F.col("_step") == 0) & (F.floor(F.col(ord_col) / F.col("_step")) < k))
            .drop("_step"))


# ---------------------------------------------------------------- catalogue, A18
def shard_catalog(docs: DataFrame, shard: str = "shard", ord_col: str = "ord") -> DataFrame:
    """Per-shard verified row counts (one row per shard; partial aggregation)."""
    return docs.groupBy(shard, ord_col).agg(F.count(F.lit(1)).alias("n_rows"))


def allocate_quotas(catalog: DataFrame, rows: int, cap: str = "n_rows", ord_col: str = "ord") -> DataFrame:
    """Uniform per-shard quotas, capped at each shard's rows, excess levelled.

    Closed form of the water-fill: sort caps ascending (ties by ordinal); the
    first shard r with ``cap_r * (n - r + 1) + S_{r-1} > R`` starts the uncapped
    set; those get ``L = (R - S_{r-1}) div (n - r + 1)`` and the remainder goes +1
    to the first uncapped shards in catalogue order. Window over the catalogue
    (one row per shard), so it stays small.
    """
    every = Window.partitionBy()
    asc = Window.partitionBy().orderBy(F.col(cap), F.col(ord_col))
    by_ord = Window.partitionBy().orderBy(F.col(ord_col))
    c = (catalog
         .withColumn("_n", F.count(F.lit(1)).over(every))
         .withColumn("_want", F.least(F.lit(rows).cast("long"), F.sum(cap).over(every)))
         .withColumn("_r", F.row_number().over(asc))
         .withColumn("_sprev", F.coalesce(F.sum(cap).over(asc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    c = c.withColumn("_fr", F.min(F.when(F.col(cap) * (F.col("_n") - F.col("_r") + 1) + F.col("_sprev") > F.col("_want"),
                                         F.col("_r"))).over(every))
    c = c.withColumn("_sk", F.max(F.when(F.col("_r") == F.col("_fr"), F.col("_sprev"))).over(every))
    width = F.col("_n") - F.col("_fr") + 1
    c = c.withColumn("_lvl", F.expr("(_want - _sk) div (_n - _fr + 1)"))
    c = c.withColumn("_rem", F.col("_want") - F.col("_sk") - F.col("_lvl") * width)
    uncapped = F.col("_fr").isNotNull() & (F.col("_r") >= F.col("_fr"))
    c = c.withColumn("_unc", uncapped)
    c = c.withColumn("_urank", F.sum(F.col("_unc").cast("int")).over(by_ord.rowsBetween(Window.unboundedPreceding, 0)))
    quota = (F.when(~F.col("_unc"), F.col(cap))
             .otherwise(F.col("_lvl") + F.when(F.col("_urank") <= F.col("_rem"), 1).otherwise(0)))
    return c.withColumn("quota", quota.cast("long")).drop(*[x for x in c.columns if x.startswith("_")])


def first_quota_survivors(df: DataFrame, quota: str = "quota", shard: str = "shard",
                          pos: str = "pos") -> DataFrame:
    """The first ``quota`` surviving rows of each shard in physical order.

    Rows of a view that keeps its segments are counted where they lie, without another shuffle."""
    numbered = sequence_within(df, [shard], [pos], "_surv")
    return numbered.filter(F.col("_surv") < F.col(quota)).drop("_surv")


# ---------------------------------------------------------------- C1, C2
def uniform_shard_sample(docs: DataFrame, rows: int, min_chars: int | None = DEFAULT_MIN_CHARS) -> DataFrame:
    """Uniform-per-shard sample of ``rows`` rows (A18 -> J13 -> F9 -> F1 -> W15).

    Stride counts physical lines including ones the gate later drops; a shard
    that falls short of its quota is not topped up. A quota of 0 yields nothing.
    """
    q = allocate_quotas(shard_catalog(docs), rows)
    q = q.filter(F.col("quota") > 0).select(
        "shard", "quota", F.greatest(F.lit(1), F.expr("n_rows div quota")).alias("stride"))
    cand = docs.join(q, "shard")  # one row per shard
    cand = min_chars_gate(stride_sample(cand, F.col("stride")), min_chars)
    return first_quota_survivors(cand).drop("stride")


def spread_sample(docs: DataFrame, rows: int, shards: int, nominal_shard_rows: int,
                  total_shards: int | None = None,
                  min_chars: int | None = DEFAULT_MIN_CHARS) -> DataFrame:
    """Sample ``shards`` shards spread over the index space (F12), then a
    stride computed from a nominal shard size (a parameter, not the real count)."""
    picks = spread_shards(shard_catalog(docs), shards, total_shards)
    n_picks = F.count(F.lit(1)).over(Window.partitionBy())
    per = F.greatest(F.lit(1), F.floor(F.lit(rows) / n_picks).cast("long"))
    picks = (picks.withColumn("quota", per)
             .withColumn("stride", F.greatest(F.lit(1), F.floor(F.lit(nominal_shard_rows) / F.col("quota")).cast("long")))
             .select("shard", "quota", "stride"))
    cand = docs.join(picks, "shard")
    cand = min_chars_gate(stride_sample(cand, F.col("stride")), min_chars)
    return first_quota_survivors(cand).drop("stride")


# ---------------------------------------------------------------- W13, W14, O7
def prefix_dedup(df: DataFrame, n: int = DEFAULT_MIN_CHARS, group: Sequence[str] = ("shard",),
                 order: Sequence[str] = ("pos",), col: str = "text") -> DataFrame:
    """Keep the first row (by ``order``) per (group, first n characters).

    Expressed as ``min`` of the order key per prefix plus a semi join: partial
    aggregation collapses duplicates map-side, so a prefix shared by a third of
    the corpus ships one row per task, never the whole group.
    """
    keyed = df.withColumn("_pfx", F.left(F.col(col), F.lit(n)))
    order = list(order)
    if len(order) == 1:
        firsts = keyed.groupBy(*group, "_pfx").agg(F.min(order[0]).alias(order[0]))
    else:
        firsts = (keyed.groupBy(*group, "_pfx").agg(F.min(F.struct(*order)).alias("_o"))
                  .select(*group, "_pfx", *[F.col(f"_o.{o}").alias(o) for o in order]))
    return keyed.join(firsts, [*group, "_pfx", *order], "left_semi").drop("_pfx")


def file_offsets(rows: DataFrame, file_col: str = "file_name", group: Sequence[str] = ()) -> DataFrame:
    """Per-file row counts and the running offset in file-name order within
    ``group`` (one row per file, so the window is over a small table)."""
    group = list(group)
    counts = rows.groupBy(*group, file_col).agg(F.count(F.lit(1)).alias("file_rows"))
    w = Window.partitionBy(*group).orderBy(file_col).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("file_offset", F.coalesce(F.sum("file_rows").over(w), F.lit(0)))


def global_index(rows: DataFrame, file_col: str = "file_name", row_col: str = "row_index",
                 name: str = "gidx", group: Sequence[str] = ()) -> DataFrame:
    """Contiguous index over (file, row) = file offset + physical row index,
    optionally restarting per ``group`` (e.g. per source).

    Only the per-file count table (one row per file) goes through a window and a
    broadcast; the rows themselves are never sorted or moved.
    """
    group = list(group)
    offs = file_offsets(rows, file_col, group).select(*group, file_col, "file_offset")
    return (rows.join(offs, [*group, file_col])
            .withColumn(name, F.col("file_offset") + F.col(row_col)).drop("file_offset"))


def head_of_stream(df: DataFrame, n: int, group: str = "shard", pos: str = "pos") -> DataFrame:
    """First n rows per source in stream order (the biased baseline)."""
    return first_n(df, [group], [F.col(pos)], n)


# ---------------------------------------------------------------- A15-A17, A19
def composition_audit(df: DataFrame, group: str, shard: str = "shard") -> DataFrame:
    """Share of rows and of shards by group, and their ratio.

    Two aggregations: (group, shard) counts, then per group. The shard total is
    a dense rank over the small (group, shard) table.
    """
    gs = df.groupBy(group, shard).agg(F.count(F.lit(1)).alias("_c"))
    gs = gs.withColumn("_sr", F.dense_rank().over(Window.partitionBy().orderBy(shard)))
    gs = gs.withColumn("_ts", F.max("_sr").over(Window.partitionBy()))
    g = gs.groupBy(group).agg(F.sum("_c").alias("rows"), F.count(F.lit(1)).alias("shards"),
                              F.first("_ts").alias("_ts"))
    every = Window.partitionBy()
    return (g.withColumn("row_share", F.col("rows") / F.sum("rows").over(every))
             .withColumn("shard_share", F.col("shards") / F.col("_ts"))
             .withColumn("ratio", F.try_divide(F.col("row_share"), F.col("shard_share")))
             .drop("_ts"))


def quality_profile(df: DataFrame, group: str = "shard", n: int = DEFAULT_MIN_CHARS,
                    col: str = "text") -> DataFrame:
    """Per group, % empty, % under n chars, % of rows sharing an n-char prefix.

    The prefix count is a two-level aggregation (prefix, then group); no row
    list is ever built.
    """
    t = F.col(col)
    base = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.avg((t.isNull() | (t == "")).cast("double")) * 100).alias("pct_empty"),
        (F.avg((F.coalesce(F.length(t), F.lit(0)) < n).cast("double")) * 100).alias("pct_short"))
    pref = (df.filter(t.isNotNull() & (t != ""))
              .groupBy(group, F.left(t, F.lit(n)).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
              .groupBy(group).agg(F.sum(F.when(F.col("_c") > 1, F.col("_c")).otherwise(0)).alias("_dup")))
    return (base.join(pref, group, "left")
            .withColumn("pct_dup_prefix", F.coalesce(F.col("_dup"), F.lit(0)) * 100.0 / F.col("rows"))
            .drop("_dup"))


def length_profile(df: DataFrame, group: str = "shard", col: str = "text") -> DataFrame:
    """Median, min and max length per group."""
    df = df.select(group, F.length(F.col(col)).cast("long").alias("_len"))
    rest = df.groupBy(group).agg(F.min("_len").alias("min_chars"), F.max("_len").alias("max_chars"), F.count(F.lit(1)).alias("rows"))
    return rest.join(exact_median(df, [group], "_len", "median_chars"), group, "left").select(
        group, "median_chars", "min_chars", "max_chars", "rows")


def repack_plan(rows: DataFrame, n_files: int, index: str = "gidx", strict: bool = False) -> DataFrame:
    """Contiguous order-preserving assignment of rows to exactly n files.

    ``per = ceil(rows / n)``; file id ``= index div per``. The row total is one
    count (Parquet footers when ``rows`` is a plain scan), not a window over
    all rows. With ``strict`` a packing that cannot open n files (e.g. 5 rows
    into 4) is refused before anything is written.
    """
    total = rows.count()
    if strict:
        check_repack(total, n_files)
    per = max(1, -(-total // n_files))
    return rows.withColumn("file_id", F.expr(f"{index} div {per}"))


def repack_files_opened(total_rows: int, n_files: int) -> int:
    """Files the sequential packer opens: min(n, rows div per + 1)."""
    per = -(-total_rows // n_files) if total_rows else 1
    return min(n_files, total_rows // per + 1)


def check_repack(total_rows: int, n_files: int) -> None:
    if total_rows <= 0:
        raise ValueError("nothing to repack")
    got = repack_files_opened(total_rows, n_files)
    if got != n_files:
        raise ValueError(f"packing {total_rows} rows opens {got} files but exactly {n_files} are needed")


# ---------------------------------------------------------------- C3, C4
def weighted_mixture(streams: DataFrame, weights: DataFrame, n: int) -> DataFrame:
    """First ``n`` draws of a deterministic weighted interleave.

    ``streams(src, k, ...)`` numbers each source's rows 0..n_s-1; ``weights(src,
    weight, sord)`` is the source table (one row a source). Draw j of source s sits
    at key ``(j + 0.5) / weight`` (ties by source ordinal); sources repeat
    endlessly. A source without rows gives no draws.

    No draw is sorted or numbered: its place in the mixture is its rank, the
    number of draws of all sources below its key, which each source's weight
    gives in closed form (two draws either way are tested on the keys
    themselves, so rounding decides as a sort would). Places run over a range,
    cut into the sources' draws; one join fetches row ``j mod n_s``.
    """
    sizes = {r["src"]: r["_ns"] for r in streams.groupBy("src").agg(F.count(F.lit(1)).alias("_ns")).collect()}  # one row a source
    every = sorted(weights.collect(), key=lambda r: r["sord"])
    total = sum(r["weight"] for r in every)
    if not total > 0:
        raise ValueError("source weights must have a positive sum")
    used = [(r["src"], float(r["weight"]), r["sord"]) for r in every if r["src"] in sizes and r["weight"] > 0]
    counts = [math.ceil(n * (w / total)) + 2 for _, w, _ in used]
    if len(used) < len(every):  # what the missing ones leave goes to the others
        left = sum(w for _, w, _ in used)
        counts = [math.ceil(n * (w / left)) + 2 for _, w, _ in used] if left else []
    ends = list(itertools.accumulate(counts))
    key = lambda j, w: (j + 0.5) / F.lit(w)

    def below(w: float, sord: int) -> Column:
        """Draws of a source in front of the draw at ``_key``."""
        guess = F.greatest(F.lit(0), F.ceil(F.col("_key") * w - 0.5) - 2).cast("long")
        first = lambda j: (key(j, w) < F.col("_key")) | ((key(j, w) == F.col("_key")) & (F.lit(sord) < F.col("sord")))
        return guess + functools.reduce(lambda a, b: a + b, [F.when(first(guess + i), 1).otherwise(0) for i in range(5)])

    def by_source(values: Sequence, kind: str) -> Column:
        return functools.reduce(lambda rest, i: F.when(F.col("id") < ends[i], F.lit(values[i])).otherwise(rest),
                                reversed(range(len(used))), F.lit(None)).cast(kind)

    draws = streams.sparkSession.range(ends[-1] if ends else 0)
    starts = [e - c for e, c in zip(ends, counts, strict=True)]
    draws = draws.select(by_source([s for s, _, _ in used], streams.schema["src"].dataType.simpleString()).alias("src"),
                         by_source([s for _, _, s in used], "int").alias("sord"), by_source([w for _, w, _ in used], "double").alias("_w"),
                         by_source([sizes[s] for s, _, _ in used], "long").alias("_ns"), (F.col("id") - by_source(starts, "long")).alias("j"))
    draws = draws.withColumn("_key", (F.col("j") + 0.5) / F.col("_w"))
    rank = functools.reduce(lambda a, b: a + b, [F.when(F.col("sord") == s, F.col("j")).otherwise(below(w, s)) for _, w, s in used], F.lit(0))
    draws = draws.withColumn("mix_idx", rank.cast("long")).filter(F.col("mix_idx") < n)
    return draws.withColumn("k", F.col("j") % F.col("_ns")).drop("_ns", "_key", "_w").join(streams, ["src", "k"])


def stripe_overlap(df: DataFrame, configs: Sequence[tuple[int, int]], pos: str = "pos") -> DataFrame:
    """C4: rows per (rank, world) stripe and how many of them another stripe also takes.

    Each row tests the literal config list in one expression (no join).
    """
    for r, wld in configs:
        if wld < 1 or not 0 <= r < wld:
            raise ValueError(f"invalid stripe rank={r} world={wld}")
    cfg = F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(wld).alias("world")) for r, wld in configs])
    p = F.col(pos)
    sel = F.filter(cfg, lambda c: (F.pmod(p, c["world"]) == c["rank"]) & (p >= c["rank"]))
    per_row = df.select(F.explode(sel).alias("c"), F.size(sel).alias("_n"))
    return per_row.groupBy(F.col("c.rank").alias("rank"), F.col("c.world").alias("world")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("_n") > 1, 1)).alias("overlap_rows"))


# ---------------------------------------------------------------- C5, C6
def token_window(df: DataFrame, seq_len: int, ids: str = "ids", content_hash: str = "h") -> DataFrame:
    """Long text yields a seq_len window whose start is a hash of the content."""
    n = F.size(F.col(ids)).cast("long")
    start = F.when(n > seq_len, F.pmod(F.col(content_hash), n - seq_len + 1)).otherwise(F.lit(0).cast("long"))
    return (df.withColumn("n_tokens", n).withColumn("start", start)
            .withColumn("window", F.when(n > seq_len, F.slice(F.col(ids), F.col("start") + 1, F.lit(seq_len)))
                        .otherwise(F.col(ids))))


def pad_truncate(df: DataFrame, seq_len: int, ids: str = "window", pad_id: int = 0) -> DataFrame:
    """pad/truncate to seq_len, attention mask, labels -100 on padding."""
    cut = F.slice(F.col(ids), 1, seq_len)
    pad = F.greatest(F.lit(0), F.lit(seq_len) - F.size(cut))
    return (df.withColumn("input_ids", F.concat(cut, F.array_repeat(F.lit(pad_id).cast("long"), pad)))
            .withColumn("attention_mask", F.concat(F.transform(cut, lambda x: F.lit(1)),
                                                   F.array_repeat(F.lit(0), pad)))
            .withColumn("labels", F.concat(cut, F.array_repeat(F.lit(-100).cast("long"), pad))))


# ---------------------------------------------------------------- C7, C8, C9
def seeded_eval_slice(docs: DataFrame, seed: str, m: int, source: str = "source",
                      shard: str = "shard", pos: str = "pos") -> DataFrame:
    """One shard per source drawn by a seeded hash, then m rows from a seeded offset."""
    from quarry.functions.hashing import seeded_int

    sh = docs.groupBy(source, shard).agg(F.count(F.lit(1)).alias("n_rows"))
    per_src = Window.partitionBy(source)
    sh = (sh.withColumn("_si", F.row_number().over(per_src.orderBy(shard)) - 1)
            .withColumn("_ns", F.count(F.lit(1)).over(per_src)))
    pick = sh.filter(F.col("_si") == F.pmod(seeded_int("eval_shard_pick", F.col(source), F.lit(seed)), F.col("_ns")))
    rows = docs.join(pick.select(source, shard, "n_rows"), [source, shard])
    rows = sequence_within(rows, [source, shard], [pos], "_k")
    off = F.pmod(seeded_int("eval_offset", F.col(shard), F.lit(seed)), F.col("n_rows"))
    rows = rows.withColumn("slice_pos", F.pmod(F.col("_k") - off, F.col("n_rows")))
    return rows.filter(F.col("slice_pos") < m).drop("_k")


def seeded_shard_order(catalog: DataFrame, seed: str, passes: int, shard: str = "shard") -> DataFrame:
    """Per pass, shards ordered by sha256(seed:pass:shard)."""
    p = catalog.select(shard, F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass"))
    key = F.sha2(F.concat(F.lit(seed), F.lit(":"), F.col("pass").cast("string"), F.lit(":"), F.col(shard)), 256)
    w = Window.partitionBy("pass").orderBy(key, F.col(shard))
    return p.select(F.col("pass").cast("long").alias("pass"), shard, (F.row_number().over(w) - 1).cast("long").alias("rank"))


def pin_check(rows: DataFrame, pins: DataFrame, shard: str = "shard") -> DataFrame:
    """Each shard has a pinned revision and every row carries it."""
    j = rows.join(pins, shard, "left")
    bad = F.col("pin").isNull() | ~F.col("revision").eqNullSafe(F.col("pin"))
    return j.groupBy(shard, "pin").agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("bad_rows"),
        F.count(F.when(~F.col("revision").eqNullSafe(F.col("pin")), 1)).alias("_mis")
    ).select(shard, F.col("pin").isNotNull().alias("pinned"), "rows", "bad_rows",
             (F.col("pin").isNotNull() & (F.col("_mis") == 0)).alias("ok"))


# ---------------------------------------------------------------- S11, S12
def build_manifest(sample: DataFrame, group: str, min_chars: int, sampling: str,
                   shard: str = "shard") -> DataFrame:
    """One manifest entry per source: rows, shards, gate and sampling rule."""
    return sample.groupBy(F.col(group).alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(shard).alias("shards")
    ).withColumn("min_chars", F.lit(min_chars)).withColumn("sampling", F.lit(sampling))


def update_manifest(old: DataFrame, new: DataFrame, key: str = "path") -> DataFrame:
    """Replace the fields of re-sampled sources, keep others; reset ``seconds``."""
    n = new.select(key, *[F.col(c).alias(f"_n_{c}") for c in new.columns if c != key],
                   F.lit(True).alias("_n_hit"))
    j = old.join(n, key, "left")
    out = [F.col(key)]
    for c in old.columns:
        if c == key:
            continue
        if c == "seconds":
            out.append(F.when(F.col("_n_hit").isNull(), F.col(c)).alias(c))
        elif c in new.columns:
            out.append(F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)
