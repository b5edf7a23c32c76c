"""Per-uid poll series: stale gauge, CRIT streaks, alert suppression, schedule values.

(W7, W8, T3 batch twin, X12, X13, X19.) Poll rows look like the ``polls`` view
(uid, poll, ts, round_id, val_loss, log_age, crit, msg). Islands are built with
change flags and running sums over one miner's own series.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import logs as L
from quarry.operators.scan import Running

# Alert key prefix length and the re-notification interval.
ALERT_KEY_CHARS = 60
ALERT_REPEAT_S = 3600


def gauge_state(polls: DataFrame, by: str = "uid", order: Sequence[str] = ("poll",)) -> DataFrame:
    """W7 state of the polls that have both a loss and a round: (by, order, first_round, rounds, stale).

    An island is a run of equal losses (compared by exact text, so NaN equals NaN
    and 0.0 differs from -0.0). ``first_round`` is the island's first round;
    ``stale`` is true from its second poll when the round differs from the first;
    ``rounds`` counts round changes between consecutive polls from the third
    poll on (the second poll never increments it).

    Two passes of one segmented scan: the first takes the values of the two polls
    before and the round before; the second carries the island's first round and
    adds up the round changes of its third poll on.
    """
    live = polls.filter(F.col("val_loss").isNotNull() & F.col("round_id").isNotNull()).select(
        by, *order, "round_id", F.col("val_loss").cast("string").alias("_v"))
    r = Running(live, [by], order)
    r.add([("_v1", "lag", "_v"), ("_v2", "lag2", "_v"), ("_pr", "lag", "round_id")])
    r.with_column("_chg", ~F.col("_v1").eqNullSafe(F.col("_v")))
    third = ~F.col("_chg") & F.col("_v2").eqNullSafe(F.col("_v1"))  # neither this poll nor the one before opens an island
    r.with_column("_rc", (third & (F.col("round_id") != F.col("_pr"))).cast("long"))
    p = r.add([("first_round", "last", F.when(F.col("_chg"), F.col("round_id"))), ("rounds", "since", ("_rc", "_chg"))])
    return p.select(by, *order, "first_round", "rounds", (~F.col("_chg") & (F.col("round_id") != F.col("first_round"))).alias("stale"))


def stale_gauge(polls: DataFrame, by: str = "uid", order: Sequence[str] = ("poll",), series: DataFrame | None = None) -> DataFrame:
    """A val_loss unchanged across rounds is a stale gauge (see :func:`gauge_state`).

    ``series`` holds the same polls without what was added to ``polls`` since, so
    that the state is not computed on top of it. Polls without a state are not stale.
    """
    state = gauge_state(polls if series is None else series, by, order)
    out = polls.join(state, [by, *order], "left")
    return out.withColumn("stale", F.coalesce(F.col("stale"), F.lit(False)))


def streak_of(crit: Column) -> tuple[str, str, tuple[Column, Column]]:
    """W8 as a scan column: consecutive CRIT polls, a sum since the last other poll."""
    return "streak", "since", (crit.cast("long"), ~crit)


def crit_streak(polls: DataFrame, by: str = "uid", order: str = "poll", confirm: int = 2) -> DataFrame:
    """Consecutive CRIT polls; an action is confirmed at ``confirm`` in a row."""
    r = Running(polls, [by], [order])
    r.add([streak_of(F.col("crit"))])
    return r.result().withColumn("confirmed", F.col("streak") >= confirm)


def health_series(polls: DataFrame, lines: DataFrame, minutes: int = 30, like: DataFrame | None = None) -> DataFrame:
    """``polls`` (uid, ts, event_id, crit, ...) with their number, CRIT streak, the age and
    cadence of the last upload, and the failure signatures of the last ``minutes``.

    ``lines`` (uid, pos, ts_filled, clean) are stamped log lines; those that name an
    upload or a signature join the polls in one series per uid, a line before a
    poll of the same time, and all columns are running ones of one pass over it.
    A signature is recent when the last line that holds it is.
    """
    sigs = L.signature_flags(F.col("clean"))
    upload = F.col("clean").contains(L.UPLOAD_MARKER) & F.col("ts").isNotNull() & (F.regexp_extract("clean", L.REPO_REV, 1) != "")
    marks = (lines.filter(F.col("ts_filled").isNotNull()).select("uid", F.col("ts_filled").alias("ts"), F.lit(0).alias("_side"), F.col("pos").alias("event_id"),
                                                                 upload.alias("_up"), sigs.alias("_sigs"))
             .filter(F.col("_up") | (F.size("_sigs") > 0)))
    both = polls.withColumn("_side", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    poll = F.col("_side") == 1
    crit = poll & F.col("crit")
    held = [(f"_h{i}", "last", F.when(F.array_contains("_sigs", i), F.col("ts"))) for i in range(len(L.SIGNATURES))]
    if like is not None:
        like = like.select("uid", "ts", F.lit(1).alias("_side"), "event_id")
    r = Running(both, ["uid"], ["ts", "_side", "event_id"], like=like)
    r.add([("poll", "sum", poll.cast("long")), ("streak", "since", (crit.cast("long"), poll & ~F.col("crit"))),
           ("_sent", "last", F.when(F.col("_up"), F.col("ts"))), *held])
    since = F.col("ts") - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    recent = [F.col(f"_h{i}") >= since for i in range(len(L.SIGNATURES))]
    number = functools.reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(False)).cast("long") for x in recent])
    worst = functools.reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x, (_, sev, _) in zip(recent, L.SIGNATURES, strict=True) if sev == "CRIT"])
    age = F.unix_timestamp("ts") - F.unix_timestamp("_sent")
    out = r.result().filter(poll).withColumns({"upload_age_s": age, "cadence": L.cadence_of(age), "n_signatures": number, "any_crit_signature": worst,
                                               "confirmed": F.col("streak") >= 2})
    return out.drop("_side", "_up", "_sigs", "_sent", *[n for n, *_ in held])


def alert_message() -> Column:
    """Text of a log-age alert: the age in minutes."""
    return (F.when(F.col("log_age").isNull(), F.concat(F.col("msg"), F.lit(" has no log")))
            .otherwise(F.concat(F.col("msg"), F.lit(" wrote no log line for "), F.round(F.col("log_age") / 60).cast("long").cast("string"), F.lit(" minutes"))))


def alert_rows(polls: DataFrame) -> DataFrame:
    """Alerts raised by a poll: the log-age tier and its text."""
    tier = L.severity_tier(F.col("log_age"))
    return (polls.withColumn("severity", tier).filter(F.col("severity") != "OK")
            .select("uid", *[c for c in ("poll", "event_id") if c in polls.columns], "ts", "severity", alert_message().alias("message")))


def alert_key(stable_rule: bool = False) -> Column:
    """T3 key: uid:severity:first 60 chars of the message (or a stable rule id)."""
    body = F.col("msg") if stable_rule else F.left(F.col("message"), F.lit(ALERT_KEY_CHARS))
    return F.concat_ws(":", F.col("uid").cast("string"), F.col("severity"), body)


def suppress_alerts(alerts: DataFrame, repeat_s: int = ALERT_REPEAT_S, tie: str = "poll") -> DataFrame:
    """T3 batch twin: emit an alert when >= repeat_s passed since the key's last
    *emission* (not its last occurrence), so ``lag`` cannot express it.

    A key's alerts are cut into segments. What a segment makes of the last
    emission before it is a step function: only alerts up to ``repeat_s`` behind
    the segment's first, and the one after, can be emitted first, and each leads
    to one last emission. The functions of a key's segments are composed in
    order (one row a segment), which gives every segment its last emission
    before; then all segments emit in parallel. Keys that lie in one segment
    need no function. ``tie`` orders alerts of one time.
    """
    keyed = alerts.withColumn("key", alert_key()).withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
    r = Running(keyed, ["key"], ["_t", tie])
    gap = repeat_s * 1_000_000
    item = F.struct("_t", tie, "uid", "ts", "severity", "message")
    held = r.df.groupBy(r.seg, "key").agg(F.array_sort(F.collect_list(item)).alias("_a"))
    if r.cuts.points:
        hot = r.df.filter(F.xxhash64("key").isin(r.cuts.keys)).groupBy(r.seg, "key").agg(F.array_sort(F.collect_set("_t")).alias("_ts"))
        steps = hot.select("key", F.struct(F.col(r.seg).alias("seg"), _last_emissions(F.col("_ts"), gap).alias("steps")).alias("s"))
        chain = steps.groupBy("key").agg(F.array_sort(F.collect_list("s")).alias("c"))
        carry = chain.select("key", F.explode(_composed(F.col("c"))).alias("b")).select(
            F.col("key").alias("_k"), F.col("b.seg").alias("_s"), F.col("b.last").alias("_before"))
        held = held.join(F.broadcast(carry), (F.col("key") == F.col("_k")) & (F.col(r.seg) == F.col("_s")), "left")
    else:
        held = held.withColumn("_before", F.lit(None).cast("long"))
    out = held.select("key", F.explode(_emitted(F.col("_a"), F.col("_before"), gap, keyed.select(item.alias("x")).schema["x"].dataType)).alias("e"))
    return out.select("key", "e.uid", f"e.{tie}", "e.ts", "e.severity", "e.message")


def _emitted(items: Column, before: Column, gap: int, item_type: T.DataType) -> Column:
    """The emitted ones of sorted alerts; emissions are a repeat apart, so the list that grows is short."""
    init = F.struct(before.alias("last"), F.array().cast(T.ArrayType(item_type)).alias("out"))
    return F.aggregate(items, init, lambda acc, x: F.when(
        acc["last"].isNull() | (x["_t"] - acc["last"] >= gap),
        F.struct(x["_t"].alias("last"), F.concat(acc["out"], F.array(x)).alias("out"))).otherwise(acc))["out"]


_STEPS = "array<struct<upto:bigint,last:bigint>>"


def _last_emissions(times: Column, gap: int) -> Column:
    """Steps (upto, last): a last emission before the segment of at most ``upto``, and above the step before, leads to ``last``."""
    first = F.element_at(times, 1)
    init = F.struct(F.lit(None).cast("long").alias("prev"), F.lit(None).cast("long").alias("oldest"), F.array().cast(_STEPS).alias("steps"))

    def step(acc: Column, t: Column) -> Column:
        fires = acc["oldest"] <= t - gap
        moved = F.when(fires, F.transform(acc["steps"], lambda s: F.struct(
            s["upto"].alias("upto"), F.when(s["last"] <= t - gap, t).otherwise(s["last"]).alias("last")))).otherwise(acc["steps"])
        opens = acc["prev"].isNull() | (acc["prev"] < first + gap)  # may be the first emission of the segment
        steps = F.when(opens, F.concat(moved, F.array(F.struct((t - gap).alias("upto"), t.alias("last"))))).otherwise(moved)
        oldest = F.when(fires | acc["oldest"].isNull(), F.array_min(F.transform(steps, lambda s: s["last"]))).otherwise(acc["oldest"])
        return F.struct(t.alias("prev"), oldest.alias("oldest"), steps.alias("steps"))

    return F.aggregate(times, init, step)["steps"]


def _composed(chain: Column) -> Column:
    """(seg, last emission before it) of a key's segments (seg, steps) in order."""
    init = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast("array<struct<seg:int,last:bigint>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        taken = F.filter(s["steps"], lambda x: acc["last"].isNull() | (acc["last"] <= x["upto"]))
        return F.struct(F.coalesce(F.get(taken, F.lit(0))["last"], acc["last"]).alias("last"),
                        F.concat(acc["out"], F.array(F.struct(s["seg"].alias("seg"), acc["last"].alias("last")))).alias("out"))

    return F.aggregate(chain, init, step)["out"]
