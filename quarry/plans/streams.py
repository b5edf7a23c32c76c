"""Streaming queries (T1-T8): each drains a Structured Streaming query over the
driver tables into the shared checkpoint folder and returns what it wrote.

Oracles are the batch twins' SQL; T8's timer rows are those due at the final
watermark.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quarry.operators import logs as L
from quarry.plans.gauges import ALERTS_SQL
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import fixtures as V
from quarry.sources.snapshots import snapshots_to_json
from quarry.sources.tables import load
from quarry.streaming import ordered as O
from quarry.streaming import stateful as S
from quarry.streaming.core import clock_stream, drain, drain_batches, table_stream, tick
from quarry.streaming.ordered import with_clock
from quarry.streaming.trailing import current_signatures, trailing_signatures

RECORDER_BOUND = 200


def _events(spark, sf):
    return table_stream(spark, sf, "events")


def _closed_events(spark, sf):
    """The event stream beside a clock that has moved on: all files lie there when the
    query starts and come in one batch, so no row is late, and all are released after it."""
    newest = load(spark, sf, "events").agg(F.max("ts")).first()[0]
    folder = scratch_path(spark, f"clock-{uuid.uuid4().hex[:10]}")
    tick(spark, folder, str((newest or datetime(2000, 1, 1)) + timedelta(days=1)))
    return with_clock(_events(spark, sf), clock_stream(spark, folder))


def _read(spark, path, stream):
    return spark.read.schema(stream.schema).parquet(path)


@register("t1_snapshot_ingest", """
SELECT cycle, uid, row_number() OVER (PARTITION BY cycle, uid ORDER BY pos) - 1 AS slot_pos, slot, val_loss,
       status, sample_cycle, age FROM board""")
def t1_snapshot_ingest(spark, sf):
    folder = scratch_path(spark, f"snapshots-{uuid.uuid4().hex[:10]}")
    snapshots_to_json(V.board(spark, sf)).write.mode("overwrite").text(folder)
    lines = spark.readStream.schema("value string").text(folder)
    st = S.ingest_snapshots(lines)
    out = _read(spark, drain(st, "t1"), st)
    return out.select("cycle", "uid", F.col("slot_pos").cast("long").alias("slot_pos"), "slot", "val_loss",
                      "status", "sample_cycle", "age")


_POLLS2 = """
p2 AS (SELECT user_id AS uid, event_id, ts, CAST(extract(day FROM ts) AS INT) AS round_id,
              CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(floor(value/150) AS DOUBLE) END AS val_loss,
              CASE WHEN event_id % 17 = 0 THEN NULL ELSE value*6 END AS log_age,
              event_type = 'error' AS crit, event_type AS msg FROM events)"""


@register("t2_stale_gauge_stream", f"""WITH {_POLLS2},
g0 AS (SELECT uid, event_id, ts, round_id, CAST(val_loss AS VARCHAR) AS v FROM p2 WHERE val_loss IS NOT NULL AND round_id IS NOT NULL),
g1 AS (SELECT *, CASE WHEN lag(v) OVER (PARTITION BY uid ORDER BY ts, event_id) IS NOT DISTINCT FROM v THEN 0 ELSE 1 END AS chg FROM g0),
g2 AS (SELECT *, sum(chg) OVER (PARTITION BY uid ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM g1),
g3 AS (SELECT *, row_number() OVER (PARTITION BY uid, isl ORDER BY ts, event_id) AS kk,
              first_value(round_id) OVER (PARTITION BY uid, isl ORDER BY ts, event_id) AS first_round,
              lag(round_id) OVER (PARTITION BY uid, isl ORDER BY ts, event_id) AS prev_round FROM g2),
g4 AS (SELECT uid, event_id, first_round,
              CAST(sum(CASE WHEN kk >= 3 AND round_id <> prev_round THEN 1 ELSE 0 END)
                   OVER (PARTITION BY uid, isl ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS rounds,
              kk >= 2 AND round_id <> first_round AS stale FROM g3)
SELECT p.uid, p.event_id, coalesce(g4.stale, false) AS stale, g4.first_round, g4.rounds
FROM p2 p LEFT JOIN g4 ON g4.uid = p.uid AND g4.event_id = p.event_id""")
def t2_stale_gauge_stream(spark, sf):
    st = O.stale_gauge_stream(_closed_events(spark, sf))
    return _read(spark, drain(st, "t2"), st)


@register("t3_alert_suppression_stream", f"""WITH RECURSIVE {_POLLS2},{ALERTS_SQL.replace("FROM polls", "FROM p2").replace("SELECT uid, poll, ts", "SELECT uid, event_id, ts")},
em(key, t) AS (SELECT key, min(t) FROM ak GROUP BY key
               UNION ALL
               SELECT e.key, (SELECT min(a.t) FROM ak a WHERE a.key = e.key AND a.t >= e.t + 3600000000)
               FROM em e WHERE e.t IS NOT NULL)
SELECT key, uid, event_id, severity, message FROM (
  SELECT ak.*, row_number() OVER (PARTITION BY ak.key, ak.t ORDER BY ak.event_id) AS rn
  FROM ak JOIN em ON em.key = ak.key AND em.t = ak.t) WHERE rn = 1""")
def t3_alert_suppression_stream(spark, sf):
    st = O.alert_suppression_stream(_closed_events(spark, sf))
    return _read(spark, drain(st, "t3"), st)


@register("t4_crit_streak_stream", f"""WITH {_POLLS2},
s0 AS (SELECT uid, event_id, ts, crit, sum(CASE WHEN crit THEN 0 ELSE 1 END) OVER (PARTITION BY uid ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS brk FROM p2),
s1 AS (SELECT uid, event_id, CAST(sum(CASE WHEN crit THEN 1 ELSE 0 END) OVER (PARTITION BY uid, brk ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM s0)
SELECT uid, event_id, streak, streak >= 2 AS confirmed FROM s1""")
def t4_crit_streak_stream(spark, sf):
    st = O.crit_streak_stream(_closed_events(spark, sf))
    return _read(spark, drain(st, "t4"), st)


@register("t5_signature_windows", r"""
WITH pl AS (SELECT uid, kind, pos, regexp_replace(line, '\x1b\[[0-9;]*m', '', 'g') AS clean FROM logs),
st AS (SELECT pl.*, coalesce(try_strptime(left(clean, 19), '%Y-%m-%d %H:%M:%S'), e.ts) AS ts FROM pl JOIN events e ON e.event_id = pl.pos),
newest AS (SELECT max(ts) AS t FROM st),
sig AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, '{p}', '{s}')" for i, (p, s, _) in enumerate(L.SIGNATURES)) + r""") t(sig, pattern, severity))
SELECT uid, kind, sig, pattern, severity, min(ts) AS first_at, max(ts) AS last_at, count(*) AS hits
FROM st JOIN sig s ON contains(st.clean, s.pattern), newest WHERE ts >= date_trunc('milliseconds', newest.t) - INTERVAL 30 MINUTE
GROUP BY uid, kind, sig, pattern, severity""")
def t5_signature_windows(spark, sf):
    """Signatures of the newest 30 minutes; a line without a stamp is as old as the event it came with."""
    lines = L.parsed_lines(V.logs_from(_events(spark, sf), (F.col("ts").alias("seen"),)))
    st = trailing_signatures(lines)
    return current_signatures(_read(spark, drain(st, "t5"), st))


@register("t6_eval_recorder", f"""
SELECT uid, step, loss FROM (SELECT user_id AS uid, event_id AS step, value / 100 AS loss,
       row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= {RECORDER_BOUND}""")
def t6_eval_recorder(spark, sf):
    st = S.eval_recorder_stream(_events(spark, sf), RECORDER_BOUND)
    return S.latest_recorder_state(_read(spark, drain(st, "t6"), st))


@register("t7_late_samples", """
WITH mr AS (SELECT *, row_number() OVER (PARTITION BY cycle, uid ORDER BY CASE WHEN val_loss IS NULL THEN 1 ELSE 0 END,
                 coalesce(sample_cycle, -1) DESC, CASE WHEN status = 'ok' THEN 1 ELSE 0 END DESC,
                 coalesce(age, 1073741824), pos) AS fresh_rn FROM board)
SELECT cycle, uid, val_loss, slot AS fresh_slot, sample_cycle FROM mr WHERE fresh_rn = 1 AND val_loss IS NOT NULL""")
def t7_late_samples(spark, sf):
    st = S.late_samples_stream(_events(spark, sf))
    out = drain_batches(st, "t7", S.freshest_batch_writer)
    return S.merged_freshest(spark, out)


@register("t8_missed_windows", r"""
WITH pl AS (SELECT uid, pos, regexp_replace(line, '\x1b\[[0-9;]*m', '', 'g') AS clean FROM logs),
up AS (SELECT uid, pos, try_strptime(left(clean, 19), '%Y-%m-%d %H:%M:%S') AS ts FROM pl
       WHERE contains(clean, 'MinerCommit2> committing') AND regexp_extract(clean, 'hf_repo_id=(\S+)\s+hf_revision=(\S+)', 1) <> ''),
g AS (SELECT uid, lag(ts) OVER (PARTITION BY uid ORDER BY ts, pos) AS prev_ts, ts FROM up WHERE ts IS NOT NULL)
SELECT uid, prev_ts, ts, CAST(epoch(ts) - epoch(prev_ts) AS BIGINT) AS gap_s, 'gap' AS kind FROM g
WHERE epoch(ts) - epoch(prev_ts) > 9600
UNION ALL
SELECT uid, max(ts), NULL, NULL, 'no submission' FROM up WHERE ts IS NOT NULL GROUP BY uid
HAVING epoch(max(ts)) + 9600 < (SELECT epoch(max(ts)) - 3600 FROM up)""")
def t8_missed_windows(spark, sf):
    st = S.missed_windows_stream(_events(spark, sf))
    return _read(spark, drain(st, "t8"), st)
