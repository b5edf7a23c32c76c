"""Keyed streams that take their rows in event-time order.

Micro-batches bring a key's rows in any order, and files may come late or
shuffled. Rows therefore wait in list state until the watermark has passed them;
an event-time timer then releases them, sorted by (time, id), to the operator's
fold. Each fold is a small function of (state, sorted rows), so its result does
not depend on how rows were dealt to batches: it equals the batch twin as long
as no row is later than the watermark's delay. State of a key that stays silent
for ``expire`` is dropped by the same timer.

Keys of few rows each (T3) share a group: every call of the state store from
Python has its price, and a group of many keys needs few of them
(:class:`SlotsInOrder`).

The newest rows of an idle source would wait for ever: a clock stream
(:func:`with_clock`) moves the watermark without bringing rows for any key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quarry.operators import gauges as G
from quarry.operators import logs as L
from quarry.sources.fixtures import poll_rows_from
from quarry.streaming.core import ROCKSDB, STATE_STORE

# (state or None, released rows in order) -> (state, rows to put out)
Fold = Callable[[tuple | None, list[Row]], tuple[tuple, list[tuple]]]
DELAY, EXPIRE_MS = "1 hour", 400 * 86_400_000
# Groups of a stream whose keys share groups: fixed, for a checkpoint holds their numbers.
SLOTS = 1024
# Waiting rows that are sent to the state store at once.
PUT_ROWS = 10_000


class InOrder(StatefulProcessor):
    """Buffers rows (``t`` in microseconds, ``id``, ...) and folds them in order behind the watermark."""

    def __init__(self, fold: Fold, waiting: str, state: str, out: list[str], expire_ms: int = EXPIRE_MS):
        self.fold, self.waiting_schema, self.out, self.expire_ms = fold, waiting, out, expire_ms
        self.state_schema = f"timer long, held long, seen long, fold struct<{', '.join(f.replace(' ', ':', 1) for f in state.split(', '))}>"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waiting_schema)
        self.state = handle.getValueState("state", self.state_schema)

    def close(self) -> None:
        pass

    def _release(self, key: tuple, now: int, came: list[Row]) -> Iterator[Row]:
        timer, held, seen, folded = self.state.get() or (None, 0, None, None)
        rows = [*(self.waiting.get() if held else []), *came]
        ready = sorted((r for r in rows if r[0] <= now * 1000), key=lambda r: r[:2])
        rest = [tuple(r) for r in rows if r[0] > now * 1000]
        out: list[tuple] = []
        if ready:
            folded, out = self.fold(tuple(folded) if folded else None, ready)
            seen = max(seen or 0, ready[-1][0] // 1000)
        if rest:
            self.waiting.put(rest)
        elif held:
            self.waiting.clear()
        # woken for the oldest row that waits, or to expire
        due = -(-min(r[0] for r in rest) // 1000) if rest else (seen or now) + self.expire_ms
        if timer is not None and timer > now and timer != due:
            self.handle.deleteTimer(timer)
        if not rest and due <= now:
            self.state.clear()
        else:
            if timer != due:
                self.handle.registerTimer(due)
            self.state.update((due, len(rest), seen, folded))
        for r in out:
            yield Row(**dict(zip(self.out, (*key, *r), strict=True)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return self._release(key, timerValues.getCurrentWatermarkInMs(), [Row(*r[1:]) for r in rows])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._release(key, timerValues.getCurrentWatermarkInMs(), [])


class SlotsInOrder(InOrder):
    """:class:`InOrder` for groups of many keys; the rows are (``t``, ``id``, key, ...).

    The waiting rows of a slot are one list, read only when the first of them is
    due, with one timer; a key that is released costs a read and a write in map
    state. States of silent keys are dropped by sweeps over a slot, a hundredth of
    ``expire`` apart at least.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        key = self.waiting_schema.split(", ")[2]
        self.waiting = handle.getListState("waiting", self.waiting_schema)
        self.state = handle.getValueState("state", "timer long, first long, oldest long")
        self.folds = handle.getMapState("folds", key, self.state_schema.split(", ", 2)[2])  # seen, fold

    def _release(self, key: tuple, now: int, came: list[Row]) -> Iterator[Row]:
        # first: time of the first row that waits; oldest: no key was seen last before
        timer, first, oldest = self.state.get() or (None, None, None)
        held = first is not None
        read = held and first <= now * 1000
        rows = [*(self.waiting.get() if read else []), *came]
        by_key: dict = {}
        for r in sorted((r for r in rows if r[0] <= now * 1000), key=lambda r: r[:2]):
            by_key.setdefault(r[2], []).append((*r[:2], *r[3:]))
        rest = [tuple(r) for r in rows if r[0] > now * 1000]
        if read and not rest:
            self.waiting.clear()
        for at in range(0, len(rest), PUT_ROWS):
            (self.waiting.put if at == 0 and (read or not held) else self.waiting.appendList)(rest[at:at + PUT_ROWS])
        first = min([r[0] for r in rest] + ([first] if held and not read else []), default=None)
        out: list[tuple] = []
        any_folds = oldest is not None
        for k, ready in by_key.items():
            seen, folded = (self.folds.getValue((k,)) if any_folds else None) or (None, None)
            folded, more = self.fold(tuple(folded) if folded else None, ready)
            seen = max(seen or 0, ready[-1][0] // 1000)
            self.folds.updateValue((k,), (seen, folded))
            oldest = seen if oldest is None else min(oldest, seen)
            out += [(k, *r) for r in more]
        late = self.expire_ms + self.expire_ms // 100
        if oldest is not None and oldest + late <= now:
            oldest = self._sweep(now)
        wakes = [] if first is None else [-(-first // 1000)]
        wakes += [] if oldest is None else [oldest + late]
        due = min(wakes, default=None)
        if timer is not None and timer > now and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.state.clear()
        else:
            if timer != due:
                self.handle.registerTimer(due)
            self.state.update((due, first, oldest))
        for r in out:
            yield Row(**dict(zip(self.out, r, strict=True)))

    def _sweep(self, now: int) -> int | None:
        """Drop the states of silent keys; when the first of the others was seen."""
        left, gone = None, []
        for k, (seen, _) in self.folds.iterator():
            if seen + self.expire_ms <= now:
                gone.append(k)
            else:
                left = seen if left is None else min(left, seen)
        for k in gone:
            self.folds.removeKey(k)
        return left


def with_clock(rows: DataFrame, clock: DataFrame, ts: str = "ts") -> DataFrame:
    """``rows`` and a stream of times (``ts``) that only move the watermark."""
    return rows.withColumn("_tick", F.lit(False)).unionByName(clock.select(ts, F.lit(True).alias("_tick")), allowMissingColumns=True)


def in_order(rows: DataFrame, key: str, waiting: str, fold: Fold, state: str, out: str, ts: str = "ts", delay: str = DELAY,
             where: Column | None = None, slots: int | None = None) -> DataFrame:
    """Fold ``rows`` per ``key`` in (``ts``, ``event_id``) order; ``waiting`` lists the further columns a fold reads.

    All rows move the watermark, those that meet ``where`` are folded. With ``slots``, keys (not null) share that many groups."""
    rows.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    names = [f.split()[0] for f in waiting.split(", ")]
    late = rows.withColumn("et", F.col(ts).cast("timestamp")).withWatermark("et", delay)
    kept = ~F.col("_tick") if "_tick" in rows.columns else F.lit(True)
    # one condition that names the event time, so that it is not moved in front of the watermark
    late = late.filter(F.when(F.col("et").isNotNull(), kept if where is None else kept & where))
    sent = late.select(key, F.unix_micros("et").alias("t"), F.col("event_id").alias("id"), *names)
    typed = f"{key} {rows.schema[key].dataType.simpleString()}"
    result = f"{typed}, {out}"
    columns = [f.split()[0] for f in result.split(", ")]
    if slots:
        op = SlotsInOrder(fold, f"t long, id long, {typed}, {waiting}", state, columns)
        sent = sent.select(F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("slot"), "t", "id", key, *names)
        return sent.groupBy("slot").transformWithState(op, result, "append", "eventtime")
    op = InOrder(fold, f"t long, id long, {waiting}", state, columns)
    return sent.groupBy(key).transformWithState(op, result, "append", "eventtime")


# ---------------------------------------------------------------- T2
def gauge_fold(state: tuple | None, rows: list[Row]) -> tuple[tuple, list[tuple]]:
    """Islands of equal values; the state is the open island: value, first round, changes, last round, polls."""
    value, first, changes, last, polls = state or (None, None, 0, None, 0)
    out = []
    for _, event_id, rnd, val, missing in rows:
        if missing or rnd is None:  # no loss or no round: not a poll
            out.append((event_id, False, None, None))
            continue
        text = repr(float(val))  # NaN equals NaN, 0.0 differs from -0.0
        if polls and text == value:
            polls += 1
            changes += polls >= 3 and rnd != last  # counts from the third poll on
        else:
            value, first, changes, polls = text, rnd, 0, 1
        last = rnd
        out.append((event_id, polls > 1 and rnd != first, first, changes))
    return (value, first, changes, last, polls), out


def stale_gauge_stream(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Stale-gauge state per uid across micro-batches and restarts (twin: W7)."""
    p = poll_rows_from(events, keep=("_tick",)).withColumn("vnull", F.col("val_loss").isNull())
    return in_order(p, "uid", "round_id int, val_loss double, vnull boolean", gauge_fold,
                    "v string, first int, changes long, last int, polls long",
                    "event_id long, stale boolean, first_round int, rounds long", delay=delay)


# ---------------------------------------------------------------- T3
def suppress_fold(state: tuple | None, rows: list[Row]) -> tuple[tuple, list[tuple]]:
    """Alerts at least a repeat after the key's last emission."""
    last = state[0] if state else None
    out = []
    for t, event_id, uid, severity, message in rows:
        if last is None or t - last >= G.ALERT_REPEAT_S * 1_000_000:
            last = t
            out.append((uid, event_id, severity, message))
    return (last,), out


def alert_suppression_stream(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Re-emit a key only after 3600 s since its last emission (twin: T3 batch)."""
    p = poll_rows_from(events, keep=("_tick",))
    a = (p.withColumn("severity", L.severity_tier(F.col("log_age")))
         .withColumn("message", G.alert_message()).withColumn("key", G.alert_key()))
    return in_order(a, "key", "uid long, severity string, message string", suppress_fold, "last long",
                    "uid long, event_id long, severity string, message string", delay=delay,
                    where=F.col("severity") != "OK", slots=SLOTS)


# ---------------------------------------------------------------- T4
def streak_fold(state: tuple | None, rows: list[Row]) -> tuple[tuple, list[tuple]]:
    streak = state[0] if state else 0
    out = []
    for _, event_id, crit in rows:
        streak = streak + 1 if crit else 0
        out.append((event_id, streak, streak >= 2))
    return (streak,), out


def crit_streak_stream(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """T4: consecutive-CRIT streak per uid, confirmed at 2 (twin: W8)."""
    return in_order(poll_rows_from(events, keep=("_tick",)), "uid", "crit boolean", streak_fold, "streak long",
                    "event_id long, streak long, confirmed boolean", delay=delay)
