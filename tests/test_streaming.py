"""Streams over time-split files (several micro-batches) equal their batch twins."""

import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quarry.plans.catalog import QUERIES
from quarry.streaming import ordered as O
from quarry.streaming import stateful as S
from quarry.streaming.core import clock_stream, drain, drain_batches, table_stream, tick
from quarry.streaming.ordered import with_clock

from conftest import SMALL


@pytest.fixture(scope="module")
def split_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("events_split")
    t = pq.read_table(f"{SMALL}/events.parquet").to_pandas().sort_values(["ts", "event_id"])
    days = t["ts"].dt.day
    for i, lo in enumerate(range(1, 31, 6)):
        part = t[(days >= lo) & (days < lo + 6)]
        pq.write_table(__import__("pyarrow").Table.from_pandas(part, preserve_index=False), d / f"events_{i}.parquet")
    return str(d)


def _stream(spark, folder):
    return table_stream(spark, folder, "events", max_files=1)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _in_order(spark, build, files, folder, tmp_path, name):
    """Feed the files in the order given, a batch each, then move the clock on; the rows put out."""
    live, clock, base = tmp_path / f"{name}-live", str(tmp_path / f"{name}-clock"), str(tmp_path / name)
    live.mkdir()
    tick(spark, clock, "2024-01-01 00:00:00")
    for f in files:
        shutil.copy(f"{folder}/{f}", live / f)
        st = build(with_clock(_stream(spark, str(live)), clock_stream(spark, clock)), delay="60 days")
        drain(st, name, path=base)
    tick(spark, clock, "2024-12-31 00:00:00")
    return spark.read.schema(st.schema).parquet(drain(build(with_clock(_stream(spark, str(live)), clock_stream(spark, clock)), delay="60 days"), name, path=base))


@pytest.mark.parametrize("name, build, cols", [
    ("t2_stale_gauge_stream", O.stale_gauge_stream, ["uid", "event_id", "stale", "first_round", "rounds"]),
    ("t3_alert_suppression_stream", O.alert_suppression_stream, ["key", "uid", "event_id", "severity", "message"]),
    ("t4_crit_streak_stream", O.crit_streak_stream, ["uid", "event_id", "streak", "confirmed"])])
def test_shuffled_files_and_restarts_equal_batch(spark, split_dir, tmp_path, name, build, cols):
    """Files out of order, every one in a run of its own: state and waiting rows survive the restarts."""
    files = sorted(f for f in os.listdir(split_dir) if f.endswith(".parquet"))
    got = _in_order(spark, build, [files[i] for i in (3, 0, 4, 1, 2)], split_dir, tmp_path, name)
    assert _rows(got, cols) == _rows(QUERIES[name](spark, SMALL), cols)


def test_rows_wait_for_the_watermark_and_state_expires():
    """The buffer by itself: nothing comes out before its time, order is by (time, id), and silent keys are dropped."""
    class Box:
        def __init__(self):
            self.v = None

        def get(self):
            return self.v

        def put(self, v):
            self.v = v

        def update(self, v):
            self.v = v

        def clear(self):
            self.v = None

    class Handle:
        def __init__(self):
            self.timers = set()

        def registerTimer(self, t):
            self.timers.add(t)

        def deleteTimer(self, t):
            self.timers.remove(t)

    op = O.InOrder(lambda state, rows: (((state or (0,))[0] + len(rows),), [(r[1],) for r in rows]), "x long", "n long", ["key", "id"], expire_ms=100)
    op.handle, op.waiting, op.state = Handle(), Box(), Box()

    def play(now, *rows):
        fired = {t for t in op.handle.timers if t <= now}
        op.handle.timers -= fired
        return [r[1] for r in op._release((7,), now, list(rows))]

    assert play(0, (5000, 2), (5000, 1), (1500, 3)) == [] and op.handle.timers == {2}
    assert play(1, (900, 4)) == [4] and op.handle.timers == {2}
    assert play(4, (4500, 6), (3000, 5)) == [3, 5] and op.handle.timers == {5}
    assert play(5) == [6, 1, 2] and op.handle.timers == {105} and op.state.get()[3] == (6,)
    assert play(105) == [] and op.state.get() is None and not op.handle.timers


def test_trailing_window_keeps_late_lines_and_clears_silent_miners(spark, tmp_path):
    """Lines of 30 minutes, late ones inside the window, a miner that falls silent."""
    from quarry.streaming.trailing import current_signatures, trailing_signatures

    def line(uid, minute, text):
        at = f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00"
        return (uid, "train", text, at if "frame" not in text else None, at)

    batches = [[line(1, 600, "x OutOfMemoryError"), line(1, 601, "ok"), line(2, 602, "HTTP 429"), line(2, 603, "at frame HTTP 429")],
               [line(1, 610, "ok"), line(1, 595, "late non-finite"), line(3, 560, "too late HTTP 429")],
               [line(3, 631, "ok"), line(3, 602, "late on the edge HTTP 429")],
               [line(3, 632, "ok")], [line(3, 650, "fine")]]
    live, base = tmp_path / "in", str(tmp_path / "run")
    schema = "uid long, kind string, clean string, ts timestamp_ntz, seen timestamp_ntz"
    out = []
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "uid long, kind string, clean string, ts string, seen string").withColumns(
            {c: F.to_timestamp_ntz(F.col(c)) for c in ("ts", "seen")})
        df.coalesce(1).write.mode("append").parquet(str(live))
        st = trailing_signatures(spark.readStream.schema(schema).parquet(str(live)))
        got = current_signatures(spark.read.schema(st.schema).parquet(drain(st, "trailing", path=base)))
        out.append(sorted((r["uid"], r["sig"], r["hits"], r["first_at"].minute) for r in got.collect()))
    assert out[0] == [(1, 0, 1, 0), (2, 1, 2, 2)]
    assert out[1] == [(1, 0, 1, 0), (1, 5, 1, 55), (2, 1, 2, 2)]
    assert out[2] == [(2, 1, 2, 2), (3, 1, 1, 2)]  # 10:31: what came before 10:01 has left the window
    assert out[3] == [(2, 1, 2, 2), (3, 1, 1, 2)] and out[4] == []


def test_recorder_and_freshest_merge(spark, split_dir):
    st = S.eval_recorder_stream(_stream(spark, split_dir), 5)
    got = S.latest_recorder_state(spark.read.schema(st.schema).parquet(drain(st, "test-t6")))
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    from pyspark.sql import Window
    want = (ev.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("event_id").desc())))
              .filter("rn <= 5").select(F.col("user_id").alias("uid"), F.col("event_id").alias("step")))
    assert _rows(got, ["uid", "step"]) == _rows(want, ["uid", "step"])
    out = drain_batches(S.late_samples_stream(_stream(spark, split_dir)), "test-t7", S.freshest_batch_writer)
    merged = S.merged_freshest(spark, out)
    # five batches, one stored version
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == ["CURRENT", "batch-4"]
    want = QUERIES["w1_freshest_sample"](spark, SMALL)
    assert _rows(merged, ["cycle", "uid", "val_loss"]) == _rows(want, ["cycle", "uid", "val_loss"])


def test_missed_window_timer_fires(spark, split_dir):
    st = S.missed_windows_stream(_stream(spark, split_dir))
    out = spark.read.schema(st.schema).parquet(drain(st, "test-t8"))
    kinds = {r.kind for r in out.select("kind").distinct().collect()}
    assert "gap" in kinds and "no submission" in kinds


def test_gauge_fold_does_not_depend_on_the_cuts():
    """A uid whose first batch holds only null losses; then polls split over batches equal one batch."""
    vals = [None, None, 1.0, 1.0, 1.0, None, 1.0, 2.0, 2.0, 1.0, float("nan"), float("nan"), float("nan"), -0.0, 0.0]
    rounds = [1, 1, 1, 2, 3, 3, 3, 4, 4, 4, 5, 6, 7, 7, None]
    rows = [(i, i, r, v, v is None) for i, (v, r) in enumerate(zip(vals, rounds, strict=True))]

    def played(cuts):
        state, out = None, []
        for a, b in zip([0, *cuts], [*cuts, 15], strict=True):
            state, more = O.gauge_fold(state, rows[a:b])
            out += more
        return out

    whole = played([])
    assert [r[3] for r in whole[2:7]] == [0, 0, 1, None, 1] and [r[1] for r in whole[2:5]] == [False, True, True]
    assert all(played(c) == whole for c in ([1], [2], [3], [4, 6], [3, 5, 8, 11], list(range(1, 15))))


def test_keys_that_share_a_slot_equal_groups_of_their_own():
    """T3's grouping: the rows of 200 keys come out as with a group a key, for few calls of the state store."""
    import random

    class Box:
        def __init__(self, store, name):
            self.store, self.name = store, name

        def get(self):
            self.store.calls += 1
            return self.store.v.get(self.name)

        def put(self, v):
            self.store.calls += 1
            self.store.v[self.name] = v

        update = put

        def appendList(self, v):
            self.put([*self.store.v[self.name], *v])

        def clear(self):
            self.put(None)

        def getValue(self, k):
            self.store.calls += 1
            return self.store.folds.get(k)

        def updateValue(self, k, v):
            self.store.calls += 1
            self.store.folds[k] = v

        def removeKey(self, k):
            self.store.calls += 1
            del self.store.folds[k]

        def iterator(self):
            return iter(list(self.store.folds.items()))

    class Store:
        def __init__(self):
            self.v, self.folds, self.timers, self.calls = {}, {}, set(), 0
            self.getListState = self.getValueState = self.getMapState = lambda name, *schema: Box(self, name)

        def registerTimer(self, t):
            self.calls += 1
            self.timers.add(t)

        def deleteTimer(self, t):
            self.calls += 1
            self.timers.remove(t)

    def fold(state, rows):
        last, out = state[0] if state else None, []
        for t, i, x in rows:
            if last is None or t - last >= 3_000_000:
                last = t
                out.append((i, x))
        return (last,), out

    def op(kind, waiting):
        made = kind(fold, waiting, "last long", ["key", "id", "x"], expire_ms=50_000)
        store = Store()
        made.init(store)
        return made, store

    rng = random.Random(5)
    rows = [(rng.randrange(200_000_000), i, f"k{rng.randrange(200) if i % 4 else 0}", i % 7) for i in range(2000)]
    batches, now = [], 0
    for at in range(0, 2000, 250):
        batches.append((now, sorted(rows)[at:at + 250] if at % 500 else rng.sample(sorted(rows)[at:at + 250], 250)))
        now = max(0, max(r[0] for r in batches[-1][1]) // 1000 - 9_000)
    batches += [(now, []), (190_000, []), (200_000, []), (251_000, []), (300_000, [])]
    own, (slot, store) = {}, op(O.SlotsInOrder, "t long, id long, key string, x int")
    want, got = [], []
    for now, came in batches:
        mine: dict = {}
        for t, i, k, x in came:
            mine.setdefault(k, []).append((t, i, x))
        for k in mine.keys() - own.keys():
            own[k] = op(O.InOrder, "t long, id long, x int")
        for k, (o, s) in own.items():
            fired = {t for t in s.timers if t <= now}
            if k in mine or fired:
                want += [(now, *r) for r in o._release((k,), now, mine.get(k, []))]
            s.timers -= fired
        fired = {t for t in store.timers if t <= now}
        if came or fired:
            got += [(now, *r) for r in slot._release((0,), now, came)]
        store.timers -= fired
    assert len(want) > 500 and sorted(got) == sorted(want)
    assert store.calls * 3 < sum(s.calls for _, s in own.values())
    assert not store.folds and not store.timers and store.v["state"] is None and not store.v["waiting"]
