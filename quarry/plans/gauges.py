"""Poll-series queries (W7, W8, T3 batch twin, X12, X13, X19) and the health report."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from quarry.functions.numeric import age_units, one_cycle, phase_fraction
from quarry.operators import gauges as G
from quarry.operators import logs as L
from quarry.plans import board as PB
from quarry.plans.logs import DRIFT_SQL, EVENTS_SQL, PARSED_SQL, drift_rows, parsed, raw_series
from quarry.plans.registry import register
from quarry.sources import fixtures as V

PEAK, WARMUP, MIN_FRAC = 1e-4, 0.03, 0.02

W7_SQL = """
g0 AS (SELECT uid, poll, round_id, CAST(val_loss AS VARCHAR) AS v FROM polls WHERE val_loss IS NOT NULL AND round_id IS NOT NULL),
g1 AS (SELECT *, CASE WHEN lag(v) OVER (PARTITION BY uid ORDER BY poll) IS NOT DISTINCT FROM v THEN 0 ELSE 1 END AS chg FROM g0),
g2 AS (SELECT *, sum(chg) OVER (PARTITION BY uid ORDER BY poll ROWS UNBOUNDED PRECEDING) AS isl FROM g1),
g3 AS (SELECT *, row_number() OVER (PARTITION BY uid, isl ORDER BY poll) AS kk,
              first_value(round_id) OVER (PARTITION BY uid, isl ORDER BY poll) AS first_round,
              lag(round_id) OVER (PARTITION BY uid, isl ORDER BY poll) AS prev_round FROM g2),
g4 AS (SELECT uid, poll, first_round,
              CAST(sum(CASE WHEN kk >= 3 AND round_id <> prev_round THEN 1 ELSE 0 END)
                   OVER (PARTITION BY uid, isl ORDER BY poll ROWS UNBOUNDED PRECEDING) AS BIGINT) AS rounds,
              kk >= 2 AND round_id <> first_round AS stale FROM g3),
w7 AS (SELECT p.uid, p.poll, p.round_id, p.val_loss, coalesce(g4.stale, false) AS stale, g4.first_round, g4.rounds
       FROM polls p LEFT JOIN g4 ON g4.uid = p.uid AND g4.poll = p.poll)"""

W8_SQL = """
s0 AS (SELECT uid, poll, crit, sum(CASE WHEN crit THEN 0 ELSE 1 END) OVER (PARTITION BY uid ORDER BY poll ROWS UNBOUNDED PRECEDING) AS brk FROM polls),
w8 AS (SELECT uid, poll, crit, CAST(sum(CASE WHEN crit THEN 1 ELSE 0 END) OVER (PARTITION BY uid, brk ORDER BY poll ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM s0)"""


@register("w7_stale_gauge", f"WITH {W7_SQL}\nSELECT * FROM w7")
def w7_stale_gauge(spark, sf):
    p = G.stale_gauge(V.poll_series(spark, sf), order=V.POLL_ORDER, series=V.poll_rows(spark, sf))
    return p.select("uid", "poll", "round_id", "val_loss", "stale", "first_round", "rounds")


@register("w8_crit_streak", f"WITH {W8_SQL}\nSELECT uid, poll, crit, streak, streak >= 2 AS confirmed FROM w8")
def w8_crit_streak(spark, sf):
    p = V.poll_series(spark, sf, G.streak_of(F.col("crit")))
    return p.select("uid", "poll", "crit", "streak", (F.col("streak") >= 2).alias("confirmed"))


ALERTS_SQL = """
al AS (SELECT uid, poll, ts, tier AS severity,
              CASE WHEN log_age IS NULL THEN concat(msg, ' has no log')
                   ELSE concat(msg, ' wrote no log line for ', CAST(CAST(round(log_age / 60) AS BIGINT) AS VARCHAR), ' minutes') END AS message,
              epoch_us(ts) AS t
       FROM (SELECT *, CASE WHEN log_age IS NULL THEN 'CRIT' WHEN log_age > 1800 THEN 'CRIT'
                            WHEN log_age > 900 THEN 'WARN' ELSE 'OK' END AS tier FROM polls) WHERE tier <> 'OK'),
ak AS (SELECT *, concat_ws(':', CAST(uid AS VARCHAR), severity, left(message, 60)) AS key FROM al)"""


@register("t3_alert_suppression", f"""WITH RECURSIVE {ALERTS_SQL},
em(key, t) AS (SELECT key, min(t) FROM ak GROUP BY key
               UNION ALL
               SELECT e.key, (SELECT min(a.t) FROM ak a WHERE a.key = e.key AND a.t >= e.t + 3600000000)
               FROM em e WHERE e.t IS NOT NULL)
SELECT key, uid, poll, ts, severity, message FROM (
  SELECT ak.*, row_number() OVER (PARTITION BY ak.key, ak.t ORDER BY ak.poll) AS rn
  FROM ak JOIN em ON em.key = ak.key AND em.t = ak.t) WHERE rn = 1""")
def t3_alert_suppression(spark, sf):
    out = G.suppress_alerts(G.alert_rows(V.poll_rows(spark, sf)), tie="event_id")
    number = V.poll_series(spark, sf).select("uid", "event_id", "poll")
    return out.join(number, ["uid", "event_id"]).drop("event_id")


@register("x13_phase_fraction", """
SELECT uid, poll, minute(ts) * 60 + second(ts) AS into_s, 3600 - (minute(ts) * 60 + second(ts)) AS left_s,
       least(greatest(CAST(minute(ts) * 60 + second(ts) AS DOUBLE) / 3600, 0.0), 1.0) AS fraction FROM polls""")
def x13_phase_fraction(spark, sf):
    p = V.polls(spark, sf)
    into = (F.minute("ts") * 60 + F.second("ts")).cast("long")
    p = p.select("uid", "poll", into.alias("into_s"), (F.lit(3600) - into).alias("left_s"))
    return p.withColumn("fraction", phase_fraction(F.col("into_s").cast("double"), F.col("left_s").cast("double")))


@register("x12_one_cycle", f"""
WITH f AS (SELECT uid, poll, msg <> 'error' AS in_train,
                  least(greatest(CAST(minute(ts) * 60 + second(ts) AS DOUBLE) / 3600, 0.0), 1.0) AS frac FROM polls),
c AS (SELECT *, CAST({PEAK!r} AS DOUBLE) * CAST({MIN_FRAC!r} AS DOUBLE) AS fl,
             least(1.0, (frac - CAST({WARMUP!r} AS DOUBLE)) / greatest(CAST(1e-6 AS DOUBLE), 1.0 - CAST({WARMUP!r} AS DOUBLE))) AS q FROM f)
SELECT uid, poll, greatest(CAST(1e-6 AS DOUBLE), CASE WHEN NOT in_train THEN fl
         WHEN CAST({WARMUP!r} AS DOUBLE) > 0 AND frac < CAST({WARMUP!r} AS DOUBLE) THEN CAST({PEAK!r} AS DOUBLE) * (frac / CAST({WARMUP!r} AS DOUBLE))
         ELSE CAST({PEAK!r} AS DOUBLE) * (CAST({MIN_FRAC!r} AS DOUBLE) + (1.0 - CAST({MIN_FRAC!r} AS DOUBLE)) * (0.5 * (1.0 + cos({math.pi!r} * q)))) END) AS lr FROM c""")
def x12_one_cycle(spark, sf):
    p = V.polls(spark, sf)
    into = (F.minute("ts") * 60 + F.second("ts")).cast("double")
    frac = phase_fraction(into, F.lit(3600.0) - into)
    lr = one_cycle(frac, F.lit(PEAK), F.lit(WARMUP), F.lit(MIN_FRAC), F.col("msg") != "error")
    return p.select("uid", "poll", lr.alias("lr"))


@register("x19_age_units", """
SELECT uid, poll, log_age / 60.0 AS minutes, log_age / 3600.0 AS hours, CAST(floor(log_age / 12.0) AS BIGINT) AS blocks FROM polls""")
def x19_age_units(spark, sf):
    p = V.polls(spark, sf)
    m, h, b = age_units(F.col("log_age"))
    return p.select("uid", "poll", m.alias("minutes"), h.alias("hours"), b.alias("blocks"))


@register("c12_health_report", f"""WITH RECURSIVE {ALERTS_SQL},
em(key, t) AS (SELECT key, min(t) FROM ak GROUP BY key
               UNION ALL
               SELECT e.key, (SELECT min(a.t) FROM ak a WHERE a.key = e.key AND a.t >= e.t + 3600000000)
               FROM em e WHERE e.t IS NOT NULL),
emitted AS (SELECT DISTINCT uid, poll FROM (
  SELECT ak.*, row_number() OVER (PARTITION BY ak.key, ak.t ORDER BY ak.poll) AS rn
  FROM ak JOIN em ON em.key = ak.key AND em.t = ak.t) WHERE rn = 1),
{W7_SQL},{W8_SQL},{PB.MINERS_SQL},{PB.X21_SQL},{PB.X23_SQL},{PARSED_SQL},{EVENTS_SQL},{DRIFT_SQL},
g AS (SELECT round_id, min(log_age) AS mn, count(log_age) AS peers FROM polls GROUP BY round_id),
filled AS (SELECT uid, clean, last_value(ts IGNORE NULLS) OVER (PARTITION BY uid, kind ORDER BY pos ROWS UNBOUNDED PRECEDING) AS said FROM parsed),
sig AS (SELECT * FROM (VALUES {", ".join(f"('{p}', '{s}')" for p, s, _ in L.SIGNATURES)}) t(pattern, severity)),
hits AS (SELECT DISTINCT uid, said, pattern, s.severity FROM filled f JOIN sig s ON contains(f.clean, s.pattern) WHERE said IS NOT NULL),
recent AS (SELECT p.uid, p.poll, count(DISTINCT pattern) AS n, max(CASE WHEN h.severity = 'CRIT' THEN 1 ELSE 0 END) = 1 AS crit
           FROM polls p JOIN hits h ON h.uid = p.uid AND h.said <= p.ts AND h.said >= p.ts - INTERVAL 30 MINUTE GROUP BY p.uid, p.poll),
last_up AS (SELECT p.uid, p.poll, CAST(epoch(date_trunc('second', p.ts)) - epoch(max(u.ts)) AS BIGINT) AS age
         FROM polls p JOIN up u ON u.uid = p.uid AND u.ts <= p.ts GROUP BY p.uid, p.poll, p.ts)
SELECT p.uid, p.poll, CASE WHEN p.log_age IS NULL THEN 'CRIT' WHEN p.log_age > 1800 THEN 'CRIT' WHEN p.log_age > 900 THEN 'WARN' ELSE 'OK' END AS tier,
       CASE WHEN g.peers >= 2 THEN p.log_age - g.mn END AS peer_lag_s,
       w7.stale, w7.rounds, w8.streak, w8.streak >= 2 AS confirmed,
       last_up.age AS upload_age_s, CASE WHEN last_up.age > 9600 THEN 'missed' WHEN last_up.age > 7800 THEN 'late' WHEN last_up.age IS NOT NULL THEN 'ok' END AS cadence,
       coalesce(r.n, 0) AS n_signatures, coalesce(r.crit, false) AS any_crit_signature,
       d.group_severity, d.severity AS rank_severity,
       x21.note, x23.notes, al.message AS alert, em2.uid IS NOT NULL AS alert_emitted
FROM polls p JOIN g USING (round_id) JOIN w7 ON w7.uid = p.uid AND w7.poll = p.poll
JOIN w8 ON w8.uid = p.uid AND w8.poll = p.poll LEFT JOIN recent r ON r.uid = p.uid AND r.poll = p.poll
LEFT JOIN last_up ON last_up.uid = p.uid AND last_up.poll = p.poll LEFT JOIN drift d ON d.uid = p.uid
LEFT JOIN x21 ON x21.uid = p.uid AND x21.cycle = p.round_id LEFT JOIN x23 ON x23.uid = p.uid AND x23.cycle = p.round_id
LEFT JOIN al ON al.uid = p.uid AND al.poll = p.poll LEFT JOIN emitted em2 ON em2.uid = p.uid AND em2.poll = p.poll""")
def c12_health_report(spark, sf):
    """Per poll and uid -- log-age tier, peer lag, stale gauge, CRIT streak, age and
    cadence of the last upload, failure signatures of the last 30 minutes, settings drift,
    the round's status note and note list, the poll's alert and whether suppression let it through.

    Polls and the log lines that matter (uploads, lines with a signature) are one
    series per uid: number, streak, last upload and the last time of every
    signature are running columns of one pass over it.
    """
    rows, lines = V.poll_rows(spark, sf), parsed(spark, sf)
    p = G.health_series(rows, L.stamped_lines(lines, like=raw_series(spark, sf).withColumn("kind", F.lit("train"))), like=rows)
    p = L.peer_lag(p).withColumn("tier", L.severity_tier(F.col("log_age")))
    state = G.gauge_state(rows, order=V.POLL_ORDER).select("uid", "event_id", "stale", "rounds")
    alerts = G.alert_rows(rows)
    emitted = G.suppress_alerts(alerts, tie="event_id").select("uid", "event_id", F.lit(True).alias("_emitted"))
    m = PB.miners(spark, sf)
    notes = (PB.status_note_rows(m).select(F.col("cycle").alias("round_id"), "uid", "note")
             .join(PB.noted(m, lines).select(F.col("cycle").alias("round_id"), "uid", "notes"), ["round_id", "uid"]))
    drift = drift_rows(lines).select("uid", "group_severity", F.col("severity").alias("rank_severity"))
    at = ["uid", "event_id"]
    out = (p.join(state, at, "left").join(alerts.select(*at, F.col("message").alias("alert")), at, "left").join(emitted, at, "left")
           .join(drift, "uid", "left").join(notes, ["uid", "round_id"], "left"))
    return out.select("uid", "poll", "tier", "peer_lag_s", F.coalesce("stale", F.lit(False)).alias("stale"), "rounds", "streak", "confirmed",
                      "upload_age_s", "cadence", "n_signatures", "any_crit_signature", "group_severity", "rank_severity",
                      "note", "notes", "alert", F.coalesce("_emitted", F.lit(False)).alias("alert_emitted"))
