"""Trial, eval-curve and train-record analytics.

(S15 upsert, W5 stable checkpoint, W6 retention, W16 latest drift, J6
checkpoint match, X6/X11/X14 formulas, F5 finiteness, F8 scope, A3-A7.)
Per-uid windows run over one miner's own series (bounded by its cycles or its
eval points); cross-uid facts are aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import seeded_int
from quarry.functions.numeric import clamp
from quarry.operators.ordering import sequence_within
from quarry.operators.scan import Running

# Fixed values of the learning-rate tuner.
LR_GRID = [2e-5, 3e-5, 5e-5, 7e-5, 1e-4, 1.4e-4, 2e-4, 3e-4, 4e-4, 6e-4]
WARMUP_GRID = [0.0, 0.03, 0.10]
MIN_LR_FRAC_GRID = [0.02, 0.10]
EXPLORE_CYCLES = 12
EPSILON = 0.2
START = (3e-4, 0.03, 0.02)
DRIFT_DEFAULTS = (0.03, 0.02)
DRIFT_LR_MIN, DRIFT_LR_MAX = 1e-6, 1e-3
DRIFT_GAIN, DRIFT_MAX_STEP = 1.0, 2.0
# Parameters: the recorded sources disagree on these values (see README).
TARGET_DRIFT = 0.0119
RETAIN_NEWEST = 3


# ---------------------------------------------------------------- S15
def upsert_trials(table: DataFrame, starts: DataFrame, updates: DataFrame,
                  key: Sequence[str] = ("uid", "cycle")) -> DataFrame:
    """Insert-or-ignore start rows (the existing row wins), then apply updates
    by key; an update of a missing key is a no-op. Per-key aggregation only."""
    key = list(key)
    cols = [c for c in table.columns if c not in key]
    both = (table.select(*key, F.lit(0).alias("_src"), *cols)
            .unionByName(starts.select(*key, F.lit(1).alias("_src"), *cols), allowMissingColumns=True))
    kept = both.groupBy(*key).agg(F.min(F.struct("_src", *cols)).alias("_r")).select(
        *key, *[F.col(f"_r.{c}").alias(c) for c in cols])
    ucols = [c for c in updates.columns if c not in key]
    u = updates.select(*key, *[F.col(c).alias(f"_u_{c}") for c in ucols], F.lit(True).alias("_hit"))
    j = kept.join(u, key, "left")
    return j.select(*key, *[F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in ucols
                            else F.col(c) for c in cols])


# ---------------------------------------------------------------- W16, X11, X14
def latest_drift(trials: DataFrame) -> DataFrame:
    """The newest (peak_lr, drift) per uid with a measured drift; a drift of 0 gives none."""
    m = trials.filter(F.col("drift").isNotNull()).groupBy("uid").agg(
        F.max(F.struct("cycle", "peak_lr", "drift")).alias("_m"))
    return (m.select("uid", F.col("_m.cycle").alias("drift_cycle"), F.col("_m.peak_lr").alias("lr"),
                     F.col("_m.drift").alias("drift"))
             .filter(F.col("drift") != 0))


def drift_correction(lr: Column, drift: Column, target: float = TARGET_DRIFT) -> Column:
    """X11: lr * clamp((target / drift)^gain, 1/2, 2), clamped to [1e-6, 1e-3]; NULL if drift <= 0."""
    ratio = clamp(F.pow(F.lit(target) / drift, F.lit(DRIFT_GAIN)), 1.0 / DRIFT_MAX_STEP, DRIFT_MAX_STEP)
    return F.when(drift > 0, clamp(lr * ratio, DRIFT_LR_MIN, DRIFT_LR_MAX))


def _grid(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def nearest_log_index(lr: Column) -> Column:
    """0-based index of the grid value nearest to lr in log space (first on ties)."""
    cells = F.transform(F.sequence(F.lit(0), F.lit(len(LR_GRID) - 1)),
                        lambda k: F.struct(F.abs(F.log(F.element_at(_grid(LR_GRID), k + 1)) - F.log(lr)).alias("d"),
                                           k.alias("k")))
    return F.array_min(cells)["k"]


def next_trial(trials: DataFrame, next_cycle: Column, target: float = TARGET_DRIFT) -> DataFrame:
    """The next (peak_lr, warmup, min_frac) per uid.

    Drift control first when it yields a value; otherwise no scored trial ->
    the start value; fewer than 12 scored -> grid sweep cell ``n + uid``;
    else exploit the best trial's nearest log-grid cell with a jitter (its warm-up
    and floor kept), or explore a random cell with probability 0.2. The random branches are driven
    by a seeded sha256 of (uid, cycle) instead of a process RNG.
    """
    scored = trials.filter(F.col("val_loss").isNotNull())
    s = scored.groupBy("uid").agg(F.count(F.lit(1)).alias("n_scored"),
                                  F.min(F.struct("val_loss", "cycle", "peak_lr", "warmup", "min_frac")).alias("_best"))
    uids = trials.select("uid").distinct()
    d = latest_drift(trials).select("uid", "lr", "drift")
    b = uids.join(s, "uid", "left").join(d, "uid", "left").withColumn("next_cycle", next_cycle)
    n = F.coalesce(F.col("n_scored"), F.lit(0))
    i = n + F.col("uid")
    h = lambda tag: seeded_int(tag, F.col("uid"), F.col("next_cycle"))
    explore = F.pmod(h("explore"), F.lit(1000)) < int(EPSILON * 1000)
    jitter = F.element_at(F.array(F.lit(-1), F.lit(0), F.lit(0), F.lit(1)), (F.pmod(h("jitter"), F.lit(4)) + 1).cast("int"))
    best_idx = clamp(nearest_log_index(F.col("_best.peak_lr")) + jitter, 0, len(LR_GRID) - 1)
    at = lambda grid, idx: F.element_at(_grid(grid), (idx + 1).cast("int"))
    corr = drift_correction(F.col("lr"), F.col("drift"), target)
    src = (F.when(corr.isNotNull(), "drift").when(n == 0, "start").when(n < EXPLORE_CYCLES, "sweep")
           .when(explore, "explore").otherwise("exploit"))
    lr = (F.when(src == "drift", corr).when(src == "start", F.lit(START[0]))
          .when(src == "sweep", at(LR_GRID, F.pmod(i, F.lit(len(LR_GRID)))))
          .when(src == "explore", at(LR_GRID, F.pmod(h("lr"), F.lit(len(LR_GRID)))))
          .otherwise(at(LR_GRID, best_idx)))
    warm = (F.when(src == "drift", F.lit(DRIFT_DEFAULTS[0])).when(src == "start", F.lit(START[1]))
            .when(src == "sweep", at(WARMUP_GRID, F.pmod(F.floor(i / len(LR_GRID)), F.lit(len(WARMUP_GRID)))))
            .when(src == "explore", at(WARMUP_GRID, F.pmod(h("warmup"), F.lit(len(WARMUP_GRID)))))
            .otherwise(F.col("_best.warmup")))
    mfr = (F.when(src == "drift", F.lit(DRIFT_DEFAULTS[1])).when(src == "start", F.lit(START[2]))
           .when(src == "sweep", at(MIN_LR_FRAC_GRID, F.pmod(i, F.lit(len(MIN_LR_FRAC_GRID)))))
           .when(src == "explore", at(MIN_LR_FRAC_GRID, F.pmod(h("min_frac"), F.lit(len(MIN_LR_FRAC_GRID)))))
           .otherwise(F.col("_best.min_frac")))
    return b.select("uid", "next_cycle", n.alias("n_scored"), src.alias("source"), lr.alias("peak_lr"),
                    warm.alias("warmup"), mfr.alias("min_frac"))


# ---------------------------------------------------------------- curves: F5, F8, X6, J6, W5, W6
def step_of(name: Column) -> Column:
    """Step parsed from a trailing ``inneropt_<n>``, else -1."""
    s = F.regexp_extract(name, r"inneropt_(\d+)$", 1)
    return F.coalesce(F.when(s != "", s).cast("long"), F.lit(-1).cast("long"))


def scope(df: DataFrame, groups: Sequence[str] | None = None, uids: Sequence[int] | None = None) -> DataFrame:
    """F8: allow-lists applied before any retention decision."""
    if groups is not None:
        df = df.filter(F.col("grp").isin(list(groups)))
    if uids is not None:
        df = df.filter(F.col("uid").isin(list(uids)))
    return df


def retention(ckpts: DataFrame, keep: int = RETAIN_NEWEST) -> DataFrame:
    """Rows beyond the newest ``keep`` by parsed step per (uid, group): the delete list.

    ``age_rank`` (1 = newest) is the group size minus the skew-safe ascending
    position, so no group is sorted in one task.
    """
    pos = sequence_within(ckpts, ["uid", "grp"], ["step", "name"], "_asc")
    n = ckpts.groupBy("uid", "grp").agg(F.count(F.lit(1)).alias("_n"))
    r = pos.join(n, ["uid", "grp"]).withColumn("age_rank", F.col("_n") - F.col("_asc"))
    return r.filter(F.col("age_rank") > keep).drop("_asc", "_n")


def scored_checkpoints(curve: DataFrame) -> DataFrame:
    """Eval points whose step has a saved checkpoint (inner join on step)."""
    saved = curve.filter("saved").groupBy("uid", "step").agg(F.max("name").alias("name"))
    evals = curve.groupBy("uid", "step").agg(F.max_by("loss", "loss_pos").alias("loss")) \
        if "loss_pos" in curve.columns else curve.select("uid", "step", "loss")
    return saved.join(evals, ["uid", "step"])


def stable_checkpoint(curve: DataFrame, mode: str = "stable") -> DataFrame:
    """Per uid, the checkpoint with the lowest centred 3-point mean (ends use 2
    points) over scored checkpoints; needs >= 3, else the plain argmin; ties go to
    the lowest step. A uid with no scored checkpoint falls back to its newest.

    Neighbours come from one segmented scan; the mean adds (prev + cur) + next
    like a running frame does.
    """
    r = Running(scored_checkpoints(curve), ["uid"], ["step"])
    sc = r.add([("_prev", "lag", "loss"), ("_next", "lead", "loss")])
    cnt = 1 + F.col("_prev").isNotNull().cast("int") + F.col("_next").isNotNull().cast("int")
    sc = sc.withColumn("smoothed", (F.coalesce(F.col("_prev"), F.lit(0.0)) + F.col("loss")
                                    + F.coalesce(F.col("_next"), F.lit(0.0))) / cnt)
    n = sc.groupBy("uid").agg(F.count(F.lit(1)).alias("n_cands"))
    sc = sc.join(n, "uid")
    use_smooth = F.lit(mode == "stable") & (F.col("n_cands") >= 3)
    sc = sc.withColumn("score", F.when(use_smooth, F.col("smoothed")).otherwise(F.col("loss")))
    pick = sc.groupBy("uid").agg(F.min(F.struct("score", "step", "loss", "smoothed", "n_cands")).alias("_p"))
    pick = pick.select("uid", F.col("_p.step").alias("step"), F.col("_p.loss").alias("raw"),
                       F.col("_p.smoothed").alias("smoothed"), F.col("_p.n_cands").alias("n_cands"),
                       F.when((F.col("_p.n_cands") >= 3) & F.lit(mode == "stable"), "stable").otherwise("best").alias("rule"))
    newest = curve.filter("saved").groupBy("uid").agg(F.max("step").alias("_newest"))
    allu = curve.select("uid").distinct()
    out = allu.join(pick, "uid", "left").join(newest, "uid", "left")
    return out.select("uid", F.coalesce(F.col("step"), F.col("_newest")).alias("step"), "raw", "smoothed",
                      F.coalesce(F.col("n_cands"), F.lit(0)).alias("n_cands"),
                      F.coalesce(F.col("rule"), F.lit("newest")).alias("rule"))


# ---------------------------------------------------------------- A3, A4, A5, A6, A7
def setting_effect(records: DataFrame, fields: Sequence[str], loss: str = "validator_val_loss") -> DataFrame:
    """A3: mean loss and n per (field, value) over scored records; NULL values are
    skipped and fields with fewer than two values are dropped."""
    scored_r = records.filter(F.col(loss).isNotNull())
    stacked = scored_r.select(loss, F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("s"))
    g = (stacked.filter(F.col("s.value").isNotNull())
         .groupBy(F.col("s.field").alias("field"), F.col("s.value").alias("value"))
         .agg(F.avg(loss).alias("mean_loss"), F.count(F.lit(1)).alias("n")))
    return g.withColumn("_vals", F.count(F.lit(1)).over(Window.partitionBy("field"))).filter(F.col("_vals") >= 2).drop("_vals")


def best_record(records: DataFrame, settings: Sequence[str], loss: str = "validator_val_loss") -> DataFrame:
    """A4: per uid, the lowest-loss record (first by position on ties) and the scored count."""
    s = records.filter(F.col(loss).isNotNull())
    g = s.groupBy("uid").agg(F.count(F.lit(1)).alias("n_scored"),
                             F.min(F.struct(F.col(loss), F.col("pos"), *[F.col(c) for c in settings])).alias("_b"))
    return g.select("uid", "n_scored", F.col(f"_b.{loss}").alias("best_loss"),
                    *[F.col(f"_b.{c}").alias(c) for c in settings])


def local_gap(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A5: mean of (validator - local eval) over records that have both."""
    r = records.filter(F.col("validator_val_loss").isNotNull() & F.col("local_eval").isNotNull())
    r = r.withColumn("gap", F.col("validator_val_loss") - F.col("local_eval"))
    return r.groupBy(*by).agg(F.avg("gap").alias("mean_gap"), F.count(F.lit(1)).alias("n"))


def shard_loss(batches: DataFrame) -> DataFrame:
    """A6 per shard: mean of finite batch losses and batch count (F5 strict form)."""
    from quarry.functions.numeric import finite

    f = batches.filter(finite("loss"))
    return f.groupBy("shard").agg(F.avg("loss").alias("mean"), F.count(F.lit(1)).alias("n_batches"))


def shard_loss_summary(per_shard: DataFrame) -> DataFrame:
    """A6 across shards: mean, median, spread, population stdev."""
    return per_shard.agg(F.count(F.lit(1)).alias("shards"), F.avg("mean").alias("mean"),
                         F.median("mean").alias("median"), (F.max("mean") - F.min("mean")).alias("spread"),
                         F.stddev_pop("mean").alias("stdev"))


def ab_verdict(points: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Per arm pre/post/improvement; gap = post(arm 0) - post(arm 1); the
    verdict says whether precision is the cause; a missing arm forces arm 0."""
    g = points.groupBy("arm").agg(
        F.avg(F.when(F.col("phase") == "pre", F.col("loss"))).alias("pre"),
        F.avg(F.when(F.col("phase") == "post", F.col("loss"))).alias("post"))
    g = g.withColumn("improvement", F.col("pre") - F.col("post"))
    every = Window.partitionBy()
    arms = F.count(F.lit(1)).over(every)
    p0 = F.max(F.when(F.col("arm") == 0, F.col("post"))).over(every)
    p1 = F.max(F.when(F.col("arm") == 1, F.col("post"))).over(every)
    gap = p0 - p1
    verdict = (F.when(arms < 2, "forced: only one arm ran")
               .when(F.abs(gap) < threshold, "precision is not the problem")
               .otherwise("precision matters"))
    return g.withColumn("gap", F.when(arms >= 2, gap)).withColumn("verdict", verdict)
