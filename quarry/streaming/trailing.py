"""T5: failure signatures of each miner's newest minutes, kept as the log comes in.

Hits lie in keyed state per (uid, kind) until the watermark, which trails the
newest line of all miners by the window, has passed them; an event-time timer
drops them then, also where a miner has fallen silent. A late line counts as
long as it is inside the window. Every batch puts out the signatures whose
window changed, with a version that grows per (uid, kind), and a row without
hits when a signature has left the window; :func:`current_signatures` keeps the
newest of them.

All lines move the watermark, only lines with a signature reach the state, and
only hits inside the window stay there, counted per second. A line without a
stamp is as old as its arrival.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quarry.operators import logs as L
from quarry.streaming.core import ROCKSDB, STATE_STORE

RESULT = ("uid long, kind string, version long, sig int, pattern string, severity string, "
          "first_at timestamp_ntz, last_at timestamp_ntz, hits long")
STATE = "version long, timer long, hits array<struct<sig:int,at:bigint,n:bigint>>"
# The watermark trails by this much more than the window, so lines on its edge are not late.
SLACK_MS = 1000


def _spans(hits: dict[tuple[int, int], int]) -> dict[int, tuple[int, int, int]]:
    """(first, last, number) of every signature."""
    by = defaultdict(list)
    for (sig, at), n in hits.items():
        by[sig].append((at, n))
    return {sig: (min(x)[0], max(x)[0], sum(n for _, n in x)) for sig, x in by.items()}


class _Trailing(StatefulProcessor):
    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("window", STATE)

    def close(self) -> None:
        pass

    def _moved(self, key: tuple, timers, came: list[tuple[int, int]]) -> Iterator[Row]:
        """Take in hits (sig, at), drop those behind the window, and give the signatures that changed."""
        held = self.state.get()
        version, timer, old = (held[0], held[1], {(h[0], h[1]): h[2] for h in held[2]}) if held else (0, None, {})
        # the newest line of all miners is at least as new as this one's
        since = max([timers.getCurrentWatermarkInMs() + SLACK_MS, *(at - self.window_ms for _, at in came)])
        new = defaultdict(int, old)
        for hit in came:
            new[hit] += 1
        new = {h: n for h, n in new.items() if h[1] >= since}
        due = min((at for _, at in new), default=None)
        due = None if due is None else due + 1 - SLACK_MS
        if due != timer:
            if timer is not None and timer > timers.getCurrentWatermarkInMs():
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.state.update((version + 1, due, [(sig, at, n) for (sig, at), n in sorted(new.items())]))
        was, now = _spans(old), _spans(new)
        time = lambda ms: datetime.fromtimestamp(ms / 1000, UTC).replace(tzinfo=None)
        for sig in sorted(was.keys() | now.keys()):
            if was.get(sig) != now.get(sig):
                first, last, n = now.get(sig, (None, None, 0))
                yield Row(uid=key[0], kind=key[1], version=version + 1, sig=sig, pattern=L.SIGNATURES[sig][0], severity=L.SIGNATURES[sig][1],
                          first_at=time(first) if n else None, last_at=time(last) if n else None, hits=n)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return self._moved(key, timerValues, [(sig, r["at"]) for r in rows for sig in r["sigs"]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._moved(key, timerValues, [])


def trailing_signatures(lines: DataFrame, seen: str = "seen", minutes: int = 30) -> DataFrame:
    """T5 over a stream of parsed lines (uid, kind, clean, ts); ``seen``: when a line came."""
    lines.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    cut = (lines.withColumn("et", F.coalesce("ts", seen).cast("timestamp")).withWatermark("et", f"{minutes * 60_000 + SLACK_MS} milliseconds")
           .select("uid", "kind", "et", F.unix_millis("et").alias("at"), L.signature_flags(F.col("clean")).alias("sigs"))
           # one condition that names the event time, so that it is not moved in front of the watermark
           .filter(F.when(F.col("et").isNotNull(), F.size("sigs") > 0)))
    return cut.groupBy("uid", "kind").transformWithState(_Trailing(minutes * 60_000), RESULT, "append", "eventtime")


def current_signatures(changes: DataFrame) -> DataFrame:
    """The signatures inside the window, from the change rows so far."""
    newest = changes.groupBy("uid", "kind", "sig", "pattern", "severity").agg(
        F.max(F.struct("version", "first_at", "last_at", "hits")).alias("m"))
    return newest.filter("m.hits > 0").select("uid", "kind", "sig", "pattern", "severity", "m.first_at", "m.last_at", "m.hits")
