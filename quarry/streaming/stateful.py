"""Streaming operators T1, T6, T7, T8 (T2 to T4: ``ordered``, T5: ``trailing``).

Keyed state is checkpointed with the query, so a restart resumes it. Every key is
one miner, so state per key stays small.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.operators import board as B
from quarry.operators import logs as L
from quarry.sources.fixtures import board_from, logs_from
from quarry.sources.files import current_version, replace_version
from quarry.sources.snapshots import flatten_snapshot
from quarry.streaming.core import ROCKSDB, STATE_STORE

MISSED_S = 9600  # a gap over 160 minutes is a missed round


# ---------------------------------------------------------------- T1
def ingest_snapshots(json_lines: DataFrame) -> DataFrame:
    """Snapshot JSON lines -> flattened sample rows, appended to history."""
    return flatten_snapshot(json_lines.select(F.col("value").alias("json")))


# ---------------------------------------------------------------- T6
class _Recorder(StatefulProcessor):
    """The kept points of a uid and a version; puts out points that came, changed or went."""

    def __init__(self, bound: int):
        self.bound = bound

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("points", "version long, steps array<bigint>, losses array<double>")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        version, steps, losses = self.state.get() or (0, [], [])
        old = dict(zip(steps, losses, strict=True))
        book = old | {r["step"]: r["loss"] for r in sorted(rows, key=lambda r: r["step"])}  # the newest value of a step wins
        kept = sorted(book)[-self.bound:]  # the lowest steps go
        self.state.update((version + 1, kept, [book[s] for s in kept]))
        for s in kept:
            if s not in old or old[s] != book[s]:
                yield Row(uid=key[0], version=version + 1, step=s, loss=book[s], kept=True)
        for s in sorted(old.keys() - set(kept)):
            yield Row(uid=key[0], version=version + 1, step=s, loss=None, kept=False)


def eval_recorder_stream(events: DataFrame, bound: int = 200) -> DataFrame:
    """Bounded last-N eval points per uid, upserted by step (twin: newest N by step).

    Every batch puts out only the points it changed."""
    events.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    c = events.select(F.col("user_id").alias("uid"), F.col("event_id").alias("step"), (F.col("value") / 100).alias("loss"))
    return c.groupBy("uid").transformWithState(_Recorder(bound), "uid long, version long, step long, loss double, kept boolean", "append", "none")


def latest_recorder_state(out: DataFrame) -> DataFrame:
    """The points kept now: the newest word on every step."""
    v = out.groupBy("uid", "step").agg(F.max(F.struct("version", "kept", "loss")).alias("m"))
    return v.filter("m.kept").select("uid", "step", "m.loss")


# ---------------------------------------------------------------- T7
def freshest_batch_writer(batch: DataFrame, batch_id: int, out: str) -> None:
    """T7 foreachBatch: per (cycle, uid) the freshest sample so far.

    The winners of a batch are merged with the stored ones into a new version,
    the pointer is renamed over the old one, and the version before is removed,
    so storage follows the keys, not the batches. A replayed batch whose version
    is live already is left alone; otherwise the merge is repeated, which takes
    the same winners again without harm. An older sample never displaces a newer one.
    """
    spark = batch.sparkSession
    won = batch.groupBy("cycle", "uid").agg(F.max(F.when(F.col("val_loss").isNotNull(), B.freshness_key())).alias("f")).filter(F.col("f").isNotNull())
    replace_version(spark, out, f"batch-{batch_id}", lambda live: won if live is None else
                    spark.read.parquet(live).unionByName(won).groupBy("cycle", "uid").agg(F.max("f").alias("f")))


def late_samples_stream(events: DataFrame) -> DataFrame:
    """T7 input: board samples as they come. No watermark: a sample may be late by any
    time, and the merge of the per-batch winners takes redelivered rows without harm."""
    return board_from(events)


def merged_freshest(spark: SparkSession, out: str) -> DataFrame:
    """The stored winners."""
    m = spark.read.parquet(current_version(out, spark))
    return m.select("cycle", "uid", F.col("f.val_loss").alias("val_loss"), F.col("f.slot").alias("fresh_slot"),
                    F.col("f.sample_cycle").alias("sample_cycle"))


# ---------------------------------------------------------------- T8
def _missed(key, pdfs, state: GroupState):
    if state.hasTimedOut:
        last = state.get[0]  # kept: a later submission ends a gap from here
        yield pd.DataFrame({"uid": [key[0]], "prev_ts": [pd.Timestamp(last, unit="us")], "ts": [pd.NaT],
                            "gap_s": [None], "kind": ["no submission"]})
        return
    frames = list(pdfs)
    if not frames:
        return
    pdf = pd.concat(frames).sort_values(["t_us", "pos"], kind="mergesort")
    last = state.get[0] if state.exists else None
    rows = []
    for r in pdf.itertuples(index=False):
        if last is not None and r.t_us - last > MISSED_S * 1_000_000:
            rows.append((key[0], pd.Timestamp(last, unit="us"), pd.Timestamp(int(r.t_us), unit="us"),
                         (int(r.t_us) - last) // 1_000_000, "gap"))
        last = int(r.t_us)
    state.update((last,))
    state.setTimeoutTimestamp(last // 1000 + MISSED_S * 1000)
    if rows:
        yield pd.DataFrame(rows, columns=["uid", "prev_ts", "ts", "gap_s", "kind"])


def missed_windows_stream(events: DataFrame) -> DataFrame:
    """A gap over 160 minutes between submissions, and an event-time timer that
    flags a uid whose last submission is 160 minutes behind the watermark (twin: W9).
    State is one number per uid and stays after the flag."""
    lg = L.parsed_lines(logs_from(events))
    up = L.log_events(lg, L.UPLOAD_MARKER).withColumn("et", F.col("ts").cast("timestamp"))
    up = up.withWatermark("et", "1 hour").withColumn("t_us", F.unix_micros("et"))
    return up.select("uid", "pos", "et", "t_us").groupBy("uid").applyInPandasWithState(
        _missed, "uid long, prev_ts timestamp_ntz, ts timestamp_ntz, gap_s long, kind string",
        "last long", "append", GroupStateTimeout.EventTimeTimeout)
