"""Leaderboard analytics over validator samples (one row per sample).

Sample rows look like the ``board`` view: (cycle, uid, slot, pos, val_loss,
sample_cycle, status, age, incentive, cohort, repo, baseline). Picks of one
row per group are ``max(struct(...))`` aggregates, which combine map-side; a
miner's per-cycle series is bounded by the number of cycles, so per-uid
windows stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import exact_median, first_n, sequence_within

# Fixed values used by the scoring rules.
COHORT_RANK = {"A": 4, "B": 3, "C": 2, "tail": 1, "none": 0}
TOP3_REWARD = (2.25, 1.5, 1.0)
SCORE_EXPONENT = 1.2
AGE_MISSING = 1 << 30
OUR_UIDS = (1, 2, 3)


def cohort_rank(c) -> Column:
    """A4 B3 C2 tail1; none, NULL and unknown are 0."""
    col = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[x for k, v in COHORT_RANK.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, col), F.lit(0))


def freshness_key() -> Column:
    """W1 order: newest sample cycle, then status ok, then youngest, then first slot."""
    return F.struct(
        F.coalesce(F.col("sample_cycle"), F.lit(-1)).alias("k_cycle"),
        F.when(F.col("status") == "ok", 1).otherwise(0).alias("k_ok"),
        (-F.coalesce(F.col("age"), F.lit(AGE_MISSING))).alias("k_age"),
        (-F.col("pos")).alias("k_pos"),
        F.col("val_loss"), F.col("slot"), F.col("sample_cycle"))


def miner_rows(samples: DataFrame, keys: Sequence[str] = ("cycle", "uid")) -> DataFrame:
    """Collapse samples to one row per (cycle, uid): W1 loss, A2 spread, miner fields.

    Two aggregation levels: per slot (last duplicate of a slot wins), then per
    miner. Both are hash aggregates with partial combine.
    """
    keys = list(keys)
    fresh = F.max(F.when(F.col("val_loss").isNotNull(), freshness_key()))
    per_slot = samples.groupBy(*keys, "slot").agg(
        F.max(F.struct("pos", "val_loss")).alias("_last"),
        fresh.alias("_fresh"),
        F.min(F.struct("pos", "cohort", "repo")).alias("_first"),
        F.max("incentive").alias("_inc"), F.max("baseline").alias("_base"), F.max("age").alias("_age"),
        F.count(F.when(F.col("val_loss").isNotNull(), 1)).alias("_scored"))
    slot_loss = F.col("_last.val_loss")
    m = per_slot.groupBy(*keys).agg(
        F.max("_fresh").alias("_fresh"), F.min("_first").alias("_first"),
        F.max("_inc").alias("incentive"), F.max("_base").alias("baseline"),
        F.count(slot_loss).alias("n_slots_scored"), F.count(F.lit(1)).alias("n_slots"),
        F.sum("_scored").alias("n_records"), F.max("_age").alias("max_age"),
        F.when(F.count(slot_loss) > 1, F.max(slot_loss) - F.min(slot_loss)).alias("slot_spread"))
    return m.select(*keys, F.col("_fresh.val_loss").alias("val_loss"),
                    F.col("_fresh.slot").alias("fresh_slot"),
                    F.col("_fresh.sample_cycle").alias("sample_cycle"),
                    "slot_spread", "n_slots", "n_slots_scored", "n_records",
                    F.col("_first.cohort").alias("cohort"), F.col("_first.repo").alias("repo"),
                    "incentive", "baseline", "max_age")


def slot_map(samples: DataFrame, keys: Sequence[str] = ("cycle", "uid")) -> DataFrame:
    """Slot map per miner: slot -> loss of that slot's last sample (a later
    duplicate of a slot overwrites an earlier one), entries in slot order."""
    keys = list(keys)
    last = samples.groupBy(*keys, "slot").agg(F.max(F.struct("pos", "val_loss")).alias("_l"))
    g = last.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("slot"), F.col("_l.val_loss")))).alias("_e"))
    return g.select(*keys, F.map_from_entries("_e").alias("slots"))


# ---------------------------------------------------------------- F3
def is_scored() -> Column:
    return F.col("val_loss").isNotNull()


def is_earner() -> Column:
    return F.col("incentive") > 0


def is_ours(uids: Sequence[int] = OUR_UIDS) -> Column:
    return F.col("uid").isin(list(uids))


def is_rival_with_repo(uids: Sequence[int] = OUR_UIDS) -> Column:
    return ~F.col("uid").isin(list(uids)) & F.col("repo").isNotNull()


def scored(m: DataFrame) -> DataFrame:
    return m.filter(is_scored())


def earners(m: DataFrame) -> DataFrame:
    return m.filter(is_earner())


def ours(m: DataFrame, uids: Sequence[int] = OUR_UIDS) -> DataFrame:
    return m.filter(is_ours(uids))


def rivals_with_repo(m: DataFrame, uids: Sequence[int] = OUR_UIDS) -> DataFrame:
    return m.filter(is_rival_with_repo(uids))


# ---------------------------------------------------------------- W4, A1, O1
def rank_scored(m: DataFrame, by: str = "cycle") -> DataFrame:
    """1-based position among scored miners, ascending loss, uid breaks ties
    (size-checked numbering: a huge field is ranked in parallel)."""
    r = sequence_within(scored(m), [by], ["val_loss", "uid"], "_r")
    return r.withColumn("rank", (F.col("_r") + 1).cast("int")).drop("_r")


def round_summary(m: DataFrame, by: str = "cycle") -> DataFrame:
    """A1: field size, best loss, third-best (NULL under 3 scored)."""
    s = scored(m)
    size = s.groupBy(by).agg(F.count(F.lit(1)).alias("field_size"), F.min("val_loss").alias("best"))
    top3 = first_n(s, [by], [F.col("val_loss"), F.col("uid")], 3, "_rn")
    third = top3.groupBy(by).agg(F.max(F.when(F.col("_rn") == 3, F.col("val_loss"))).alias("third_best"))
    return size.join(third, by, "left")


def loss_leaders(m: DataFrame, k: int, by: str = "cycle") -> DataFrame:
    """O1: top-k by loss per snapshot (top-k keeps k rows per task before the shuffle)."""
    return first_n(scored(m), [by], [F.col("val_loss"), F.col("uid")], k, "rank")


# ---------------------------------------------------------------- W2, O2
def trends(m: DataFrame, n: int = 6) -> DataFrame:
    """Per uid, the last n non-null losses and the last n cohorts of the series.

    The series keeps rows that were scored or earning. Both lists are built from
    at most n rows per uid (row_number <= n), sorted by cycle.
    """
    series = m.filter(F.col("val_loss").isNotNull() | (F.col("incentive") > 0))
    losses = first_n(series.filter(F.col("val_loss").isNotNull()), ["uid"], [F.col("cycle").desc()], n)
    cohorts = first_n(series, ["uid"], [F.col("cycle").desc()], n)
    lt = losses.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("cycle", "val_loss"))).alias("_l"))
    ct = cohorts.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("cycle", "cohort"))).alias("_c"))
    return (ct.join(lt, "uid", "left")
            .select("uid", F.coalesce(F.transform("_l", lambda x: x["val_loss"]),
                                      F.array().cast("array<double>")).alias("loss_trend"),
                    F.transform("_c", lambda x: x["cohort"]).alias("cohort_trend")))


def latest_snapshot(m: DataFrame, by: str = "cycle") -> DataFrame:
    """Rows of the newest snapshot (semi join with the max; no sort)."""
    last = m.agg(F.max(by).alias(by))
    return m.join(F.broadcast(last), by, "left_semi")


def earners_by_incentive(m: DataFrame, trend: DataFrame) -> DataFrame:
    """O2: earners of the latest snapshot, incentive descending, with their trend."""
    e = earners(latest_snapshot(m)).withColumn("_neg", -F.col("incentive"))
    e = sequence_within(e, [], ["_neg", "uid"], "_p").withColumn("place", F.col("_p") + 1).drop("_neg", "_p")
    return e.join(trend, "uid", "left")


# ---------------------------------------------------------------- A9, A10, O5
def gap_to_worst_earner(m: DataFrame, by: str = "cycle", uids: Sequence[int] = OUR_UIDS) -> DataFrame:
    """Best own loss minus the worst loss among earners, per snapshot."""
    is_ours = F.col("uid").isin(list(uids))
    g = m.groupBy(by).agg(
        F.min(F.when(is_ours, F.col("val_loss"))).alias("best_ours"),
        F.max(F.when(F.col("incentive") > 0, F.col("val_loss"))).alias("worst_earner"))
    return g.withColumn("gap", F.col("best_ours") - F.col("worst_earner"))


def cohort_moves(m: DataFrame, by: str = "cycle") -> DataFrame:
    """Cohort in the first vs last snapshot per uid of the last snapshot.

    A uid absent from the first snapshot counts as moving up from rank 0.
    """
    bounds = m.agg(F.min(by).alias("_first"), F.max(by).alias("_last"))
    first = m.join(F.broadcast(bounds.select(F.col("_first").alias(by))), by, "left_semi").select(
        "uid", F.col("cohort").alias("from_cohort"))
    last = m.join(F.broadcast(bounds.select(F.col("_last").alias(by))), by, "left_semi").select(
        "uid", F.col("cohort").alias("to_cohort"))
    j = last.join(first, "uid", "left")
    return (j.withColumn("from_rank", cohort_rank("from_cohort"))
             .withColumn("to_rank", cohort_rank("to_cohort"))
             .filter(F.col("from_rank") != F.col("to_rank"))
             .withColumn("promoted", F.col("to_rank") > F.col("from_rank")))


# ---------------------------------------------------------------- A11, A12, A13, A14
def recency_gate(m: DataFrame, window_cycles: int = 5, min_rounds: int = 3, min_records: int = 3) -> DataFrame:
    """Rounds scored and records within the last ``window_cycles`` cycles."""
    w = Window.partitionBy("uid").orderBy("cycle").rangeBetween(-(window_cycles - 1), 0)
    s = m.withColumn("_sc", F.col("val_loss").isNotNull().cast("int"))
    s = (s.withColumn("rounds_in_window", F.sum("_sc").over(w))
          .withColumn("records_in_window", F.sum(F.when(F.col("_sc") == 1, F.col("n_records")).otherwise(0)).over(w)))
    return s.select("uid", "cycle", "rounds_in_window", "records_in_window",
                    ((F.col("rounds_in_window") >= min_rounds) & (F.col("records_in_window") >= min_records)).alias("group1"),
                    (F.col("records_in_window") >= 1).alias("group2"))


def exact_ties(m: DataFrame, by: str = "cycle") -> DataFrame:
    """Miners whose loss exactly equals another's in the same round.

    Count per (round, loss) with an aggregate, then a semi join back.
    """
    s = scored(m)
    dup = s.groupBy(by, "val_loss").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n")
    return s.join(dup, [by, "val_loss"], "left_semi")


def scoring(m: DataFrame, by: str = "cycle") -> DataFrame:
    """Delta, score = delta^1.2, exact ties zeroed first, top 3 rewarded."""
    s = scored(m)
    tied = s.groupBy(by, "val_loss").agg((F.count(F.lit(1)) > 1).alias("tied"))
    s = s.join(tied, [by, "val_loss"], "left")
    delta = F.greatest(F.lit(0.0), F.col("baseline") - F.col("val_loss"))
    s = (s.withColumn("delta", delta)
          .withColumn("score", F.when(F.col("tied"), F.lit(0.0)).otherwise(F.pow(F.col("delta"), SCORE_EXPONENT))))
    pos = s.filter(F.col("score") > 0)
    ranked = first_n(pos, [by], [F.col("score").desc(), F.col("uid")], len(TOP3_REWARD), "place")
    reward = F.when(F.col("place") == 1, TOP3_REWARD[0]).when(F.col("place") == 2, TOP3_REWARD[1]) \
        .when(F.col("place") == 3, TOP3_REWARD[2])
    ranked = ranked.select(by, "uid", "place", reward.alias("reward"))
    return (s.join(ranked, [by, "uid"], "left")
             .select(by, "uid", "val_loss", "delta", "tied", "score", "place",
                     F.coalesce(F.col("reward"), F.lit(0.0)).alias("reward")))


def consistency(m: DataFrame, by: str = "cycle") -> DataFrame:
    """Per uid, population stdev of (loss - round median), mean loss, best."""
    s = scored(m)
    med = exact_median(s, [by], "val_loss", "_med")
    d = s.join(med, by).withColumn("_dev", F.col("val_loss") - F.col("_med"))
    return d.groupBy("uid").agg(F.stddev_pop("_dev").alias("dev_stdev"), F.avg("val_loss").alias("mean_loss"),
                                F.min("val_loss").alias("best_loss"), F.count(F.lit(1)).alias("rounds"))


# ---------------------------------------------------------------- A8 / J11
def factor_verdicts(m: DataFrame, factors: DataFrame, by: str = "cycle",
                    lever_ratio: float = 1.5) -> DataFrame:
    """Per factor (control a, arm b) the gap vb - va and which is better;
    then per snapshot whether one factor is the lever (ratio >= 1.5, smaller > 0).

    On equal values the control a is better; a pair with a missing score is
    'pending' and the comparison needs every factor scored.
    """
    loss = m.select(by, "uid", "val_loss")
    a = loss.select(by, F.col("uid").alias("a"), F.col("val_loss").alias("va"))
    b = loss.select(by, F.col("uid").alias("b"), F.col("val_loss").alias("vb"))
    pairs = (a.join(F.broadcast(factors), "a").join(b, [by, "b"], "left"))
    pairs = pairs.withColumn("gap", F.col("vb") - F.col("va"))
    pairs = pairs.withColumn("better", F.when(F.col("gap").isNull(), F.lit(None).cast("long"))
                             .when(F.col("gap") < 0, F.col("b")).otherwise(F.col("a")))
    pairs = pairs.withColumn("effect", F.abs("gap"))
    w = Window.partitionBy(by)
    pairs = (pairs.withColumn("_pending", F.max(F.col("gap").isNull().cast("int")).over(w))
                  .withColumn("_nf", F.count(F.lit(1)).over(w))
                  .withColumn("_top", F.max("effect").over(w))
                  .withColumn("_low", F.min("effect").over(w)))
    lever = (F.col("_low") > 0) & (F.col("_top") / F.col("_low") >= lever_ratio)
    verdict = (F.when(F.col("gap").isNull(), "pending")
               .when(F.col("_pending") == 1, "incomplete")
               .when(lever & (F.col("effect") == F.col("_top")), "lever")
               .when(lever, "minor")
               .otherwise("comparable"))
    return pairs.select(by, "factor", "a", "b", "va", "vb", "gap", "better", verdict.alias("verdict"))


# ---------------------------------------------------------------- X16, X21, X22, X23
def delta_versus(loss: Column, baseline: Column) -> Column:
    """X16 (versus form): baseline - loss, NULL if either is NULL or baseline is 0."""
    return F.when(baseline.isNull() | (baseline == 0) | loss.isNull(), F.lit(None).cast("double")) \
        .otherwise(baseline - loss)


def delta_plain(loss: Column, baseline: Column) -> Column:
    """X16 (record form): NULL only when an input is NULL."""
    return baseline - loss


def status_note(loss: Column, baseline: Column, rank3: Column, best: Column, stale: Column) -> Column:
    """Stale first (and no delta claims), then no gain, then outside top 3."""
    fmt5 = lambda c: F.format_string("%.5f", c)
    return (F.when(stale, F.lit("gauge not refreshed: its delta and rank say nothing"))
            .when(loss.isNull() | baseline.isNull(), F.lit(None).cast("string"))
            .when(loss >= baseline, F.concat(F.lit("loss "), fmt5(loss), F.lit(" is no better than the baseline "), fmt5(baseline),
                                             F.lit(": nothing to score")))
            .when(rank3.isNotNull() & (loss > rank3),
                  F.concat(F.lit("better than the baseline, "), F.format_string("%.6f", loss - best),
                           F.lit(" behind the first and not among three"))))


def slot_detail(samples: DataFrame, keys: Sequence[str] = ("cycle", "uid")) -> DataFrame:
    """``slot<s>=<loss .4f | status | ->@c<cycle>[(stale)]`` per sample, slot order kept."""
    loss_txt = F.when(F.col("val_loss").isNotNull(), F.format_string("%.4f", F.col("val_loss"))) \
        .otherwise(F.coalesce(F.col("status"), F.lit("-")))
    item = F.concat(F.lit("slot"), F.col("slot"), F.lit("="), loss_txt, F.lit("@c"),
                    F.coalesce(F.col("sample_cycle").cast("string"), F.lit("None")),
                    F.when(F.col("status") == "ok", F.lit("")).otherwise(F.lit("(stale)")))
    g = samples.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("pos"), item.alias("t")))).alias("_d"))
    return g.select(*keys, F.array_join(F.transform("_d", lambda x: x["t"]), "  ").alias("detail"))


def carried_uploads(m: DataFrame, uploads: DataFrame, clock: DataFrame, by: str = "cycle") -> DataFrame:
    """Add what is known of each miner's uploads at every snapshot.

    ``uploads(by, uid, uploaded_at, upload_rev, chain_rev)`` holds the last ones
    made in a snapshot, ``clock(by, now)`` its time. ``committed``: made in this
    snapshot; the rest is carried forward from earlier ones. A miner has one row
    a snapshot, so its window is as long as the calendar.
    """
    w = Window.partitionBy("uid").orderBy(by)
    seconds = lambda c: c.cast("timestamp").cast("long")
    j = m.join(uploads, [by, "uid"], "left").join(clock, by, "left")
    last = {c: F.last(c, ignorenulls=True).over(w) for c in ("uploaded_at", "upload_rev", "chain_rev")}
    return (j.select(*m.columns, "now", F.col("uploaded_at").isNotNull().alias("committed"),
                     *[e.alias(c) for c, e in last.items()])
            .withColumn("upload_minutes", F.floor((seconds(F.col("now")) - seconds(F.col("uploaded_at"))) / 60))
            .drop("now", "uploaded_at"))


def status_notes(m: DataFrame, age_limit: int = 600, upload_limit: int = 210) -> DataFrame:
    """List of notes per miner, NULLs removed: cohort outside A/B, nothing
    committed this cycle, old score, last upload too long ago, chain and uploaded
    revision neither a prefix of the other, no commit registered.

    ``m`` comes from :func:`carried_uploads`; a miner that never uploaded has no
    upload age and no revisions to compare.
    """
    chain, sent = F.col("chain_rev"), F.col("upload_rev")
    notes = F.array(
        F.when(F.col("cohort").isNull() | F.col("cohort").isin("none", "tail"),
               F.concat(F.lit("cohort "), F.coalesce(F.col("cohort"), F.lit("None")), F.lit(" has no weight"))),
        F.when(~F.col("committed"), F.lit("nothing committed this cycle")),
        F.when(F.col("max_age") > age_limit,
               F.concat(F.lit("score age "), F.col("max_age").cast("string"), F.lit(" blocks"))),
        F.when(F.col("upload_minutes") > upload_limit,
               F.concat(F.lit("last upload "), F.col("upload_minutes").cast("string"), F.lit(" minutes ago"))),
        F.when(~(chain.startswith(F.substring(sent, 1, 7)) | sent.startswith(F.substring(chain, 1, 7))),
               F.concat(F.lit("revision on chain "), chain, F.lit(", uploaded "), sent)),
        F.when(F.col("repo").isNull(), F.lit("no commit on chain")))
    return m.withColumn("notes", F.filter(notes, lambda x: x.isNotNull()))
