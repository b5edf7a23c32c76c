"""Log and publish queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import logs as L
from quarry.plans.registry import register
from quarry.sources import fixtures as V
from quarry.sources.tables import load

ASOF_PUBS = "1999-01-01 00:00:00"
ASOF_LOGS = "2024-01-31 00:00:00"
RECENT_ASOF, RECENT_MINUTES = "2024-01-30 12:00:00", 1440

PARSED_SQL = r"""
pl AS (SELECT uid, pos, kind, regexp_replace(line, '\x1b\[[0-9;]*m', '', 'g') AS clean FROM logs),
parsed AS (SELECT *, try_strptime(left(clean, 19), '%Y-%m-%d %H:%M:%S') AS ts FROM pl)"""

EVENTS_SQL = r"""
ev AS (SELECT uid, pos, ts, clean,
              regexp_extract(clean, 'hf_repo_id=(\S+)\s+hf_revision=(\S+)', 1) AS repo,
              regexp_replace(regexp_extract(clean, 'hf_repo_id=(\S+)\s+hf_revision=(\S+)', 2), '[.,''"]+$', '') AS rev
       FROM parsed WHERE ts IS NOT NULL),
dl AS (SELECT uid, pos, ts, repo, rev FROM ev WHERE contains(clean, 'Downloaded checkpoint (verified)') AND repo <> ''),
up AS (SELECT uid, pos, ts, repo, rev FROM ev WHERE contains(clean, 'MinerCommit2> committing') AND repo <> '')"""


def parsed(spark, sf):
    return L.parsed_lines(V.logs(spark, sf))


def raw_series(spark, sf):
    """The events behind the log lines: their order without parsing a line."""
    return load(spark, sf, "events").select(F.col("user_id").alias("uid"), "ts", F.col("event_id").alias("pos"))


@register("x1_parse_lines", f"WITH {PARSED_SQL}\nSELECT uid, pos, kind, clean, ts FROM parsed")
def x1_parse_lines(spark, sf):
    return parsed(spark, sf).select("uid", "pos", "kind", "clean", "ts")


@register("x4_last_match", rf"""WITH {PARSED_SQL}
SELECT uid, pos, regexp_extract_all(clean, '(\d+)', 1)[-1] AS last_number FROM parsed""")
def x4_last_match(spark, sf):
    return parsed(spark, sf).select("uid", "pos", X.last_match("clean", r"(\d+)", 1).alias("last_number"))


@register("f4_log_events", f"""WITH {PARSED_SQL},{EVENTS_SQL}
SELECT 'download' AS event, * FROM dl UNION ALL SELECT 'upload', * FROM up""")
def f4_log_events(spark, sf):
    p = parsed(spark, sf)
    d = L.log_events(p, L.DOWNLOAD_MARKER).select(F.lit("download").alias("event"), "*")
    u = L.log_events(p, L.UPLOAD_MARKER).select(F.lit("upload").alias("event"), "*")
    return d.unionByName(u)


@register("j1_asof_upload_download", f"""WITH {PARSED_SQL},{EVENTS_SQL},
pairs AS (SELECT u.uid, u.pos, u.ts, u.rev, d.ts AS d_ts, d.rev AS d_rev, d.pos AS d_pos,
                 row_number() OVER (PARTITION BY u.uid, u.pos ORDER BY d.ts DESC, d.pos DESC) AS rn
          FROM up u LEFT JOIN dl d ON d.uid = u.uid AND d.ts < u.ts)
SELECT uid, pos, ts, rev, d_ts, d_rev, d_pos, d_ts IS NOT NULL AS matched FROM pairs WHERE rn = 1""")
def j1_asof_upload_download(spark, sf):
    p = parsed(spark, sf)
    up = L.log_events(p, L.UPLOAD_MARKER).select("uid", "pos", "ts", "rev")
    dl = L.log_events(p, L.DOWNLOAD_MARKER).select("uid", "pos", "ts", "rev")
    return L.asof_backward(up, dl, like=raw_series(spark, sf)).select("uid", "pos", "ts", "rev", "d_ts", "d_rev", "d_pos", "matched")


_WIN_SQL = f"""
wins AS (SELECT repo, rev, t AS win_start,
                coalesce(lead(t) OVER (PARTITION BY repo ORDER BY t, rev), TIMESTAMP '{ASOF_PUBS}') AS win_end FROM pubs)"""


@register("w3_validity_window", f"WITH {_WIN_SQL}\nSELECT * FROM wins")
def w3_validity_window(spark, sf):
    w = L.validity_windows(V.pubs(spark, sf), ASOF_PUBS)
    return w.select("repo", "rev", F.col("start").alias("win_start"), F.col("end").alias("win_end"))


@register("j2_publish_window_commits", f"""WITH {_WIN_SQL},
hit AS (SELECT w.repo, w.rev, c.t AS ct, c.rev AS crev, c.owner,
               row_number() OVER (PARTITION BY w.repo, w.rev ORDER BY c.t DESC, c.rev DESC, c.owner DESC) AS rn,
               count(*) OVER (PARTITION BY w.repo, w.rev) AS n
        FROM wins w JOIN commits c ON c.repo = w.repo AND c.t >= w.win_start AND c.t < w.win_end)
SELECT w.repo, w.rev, w.win_start, w.win_end, coalesce(h.n, 0) AS n_commits, h.crev AS last_rev, h.ct AS last_t,
       h.owner AS last_owner
FROM wins w LEFT JOIN (SELECT * FROM hit WHERE rn = 1) h ON h.repo = w.repo AND h.rev = w.rev""")
def j2_publish_window_commits(spark, sf):
    w = L.validity_windows(V.pubs(spark, sf), ASOF_PUBS)
    out = L.commits_in_windows(w, V.commits(spark, sf))
    return out.select("repo", "rev", F.col("start").alias("win_start"), F.col("end").alias("win_end"),
                      "n_commits", "last_rev", "last_t", "last_owner")


@register("j3_prefix_match", f"""WITH {PARSED_SQL},{EVENTS_SQL}
SELECT u.uid, u.pos, u.rev AS up_rev, p.repo, p.rev AS pub_rev FROM up u JOIN pubs p
  ON left(u.rev, 7) = left(p.rev, 7) AND (starts_with(u.rev, p.rev) OR starts_with(p.rev, u.rev))""")
def j3_prefix_match(spark, sf):
    up = L.log_events(parsed(spark, sf), L.UPLOAD_MARKER).select("uid", "pos", F.col("rev").alias("up_rev"))
    pubs = V.pubs(spark, sf).select("repo", F.col("rev").alias("pub_rev"))
    return L.prefix_match(up, pubs, "up_rev", "pub_rev").select("uid", "pos", "up_rev", "repo", "pub_rev")


@register("w9_cadence", f"""WITH {PARSED_SQL},{EVENTS_SQL},
g AS (SELECT uid, pos, ts, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY uid ORDER BY ts, pos)) AS gap_s,
             lead(ts) OVER (PARTITION BY uid ORDER BY ts, pos) AS nxt FROM up)
SELECT uid, pos, ts, CAST(gap_s AS BIGINT) AS gap_s,
       CASE WHEN gap_s > 9600 THEN 'missed' WHEN gap_s > 7800 THEN 'late' WHEN gap_s IS NOT NULL THEN 'ok' END AS status,
       CASE WHEN nxt IS NULL THEN CAST(epoch(TIMESTAMP '{ASOF_LOGS}') - epoch(ts) AS BIGINT) END AS since_as_of,
       CASE WHEN nxt IS NULL THEN CASE WHEN epoch(TIMESTAMP '{ASOF_LOGS}') - epoch(ts) > 9600 THEN 'missed'
                                       WHEN epoch(TIMESTAMP '{ASOF_LOGS}') - epoch(ts) > 7800 THEN 'late' ELSE 'ok' END END AS as_of_status
FROM g""")
def w9_cadence(spark, sf):
    up = L.log_events(parsed(spark, sf), L.UPLOAD_MARKER)
    return L.cadence(up, ASOF_LOGS)


@register("w10_peer_lag", """
WITH g AS (SELECT round_id, min(log_age) AS mn, count(log_age) AS peers FROM polls GROUP BY round_id)
SELECT p.uid, p.poll, p.round_id, p.log_age, CASE WHEN g.peers >= 2 THEN p.log_age - g.mn END AS peer_lag_s,
       coalesce(CASE WHEN g.peers >= 2 THEN p.log_age - g.mn END > 3150, false) AS lagging
FROM polls p JOIN g USING (round_id)""")
def w10_peer_lag(spark, sf):
    return L.peer_lag(V.polls(spark, sf)).select("uid", "poll", "round_id", "log_age", "peer_lag_s", "lagging")


@register("w11_recent_lines", f"""WITH {PARSED_SQL},
f AS (SELECT uid, kind, pos, last_value(ts IGNORE NULLS) OVER (PARTITION BY uid, kind ORDER BY pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ts_filled FROM parsed)
SELECT * FROM f WHERE ts_filled >= TIMESTAMP '{RECENT_ASOF}' - INTERVAL {RECENT_MINUTES} MINUTE""")
def w11_recent_lines(spark, sf):
    r = L.recent_lines(parsed(spark, sf), RECENT_ASOF, RECENT_MINUTES)
    return r.select("uid", "kind", "pos", "ts_filled")


W12_PATTERNS = {"peak_lr": r"peak_lr=(\S+)", "rank": r"rank=(\d+)"}


@register("w12_last_values", rf"""WITH {PARSED_SQL},
m AS (SELECT uid, pos, 'peak_lr' AS key, regexp_extract(clean, 'peak_lr=(\S+)', 1) AS value FROM parsed
      UNION ALL SELECT uid, pos, 'rank', regexp_extract(clean, 'rank=(\d+)', 1) FROM parsed)
SELECT uid, key, arg_max(value, pos) AS value, max(pos) AS at_pos FROM m WHERE value <> '' GROUP BY uid, key""")
def w12_last_values(spark, sf):
    return L.last_values(parsed(spark, sf), W12_PATTERNS)


_SIG_VALUES = ", ".join(f"({i}, '{p}', '{s}', '{w}')" for i, (p, s, w) in enumerate(L.SIGNATURES))


@register("j9_signature_hits", f"""WITH {PARSED_SQL},
sig AS (SELECT * FROM (VALUES {_SIG_VALUES}) t(sig, pattern, severity, why))
SELECT p.uid, s.sig, s.pattern, s.severity, s.why, min(p.pos) AS first_pos
FROM parsed p JOIN sig s ON contains(p.clean, s.pattern) GROUP BY p.uid, s.sig, s.pattern, s.severity, s.why""")
def j9_signature_hits(spark, sf):
    return L.signature_hits(parsed(spark, sf))


DRIFT_SQL = r"""
obs AS (SELECT uid, arg_max(regexp_extract(clean, 'rank=(\d+)', 1), pos) AS rank FROM parsed
        WHERE regexp_extract(clean, 'rank=(\d+)', 1) <> '' GROUP BY uid),
grp AS (SELECT uid, arg_max(regexp_extract(clean, 'peak_lr=(\S+)', 1), pos) AS grp FROM parsed
        WHERE regexp_extract(clean, 'peak_lr=(\S+)', 1) <> '' GROUP BY uid),
exp AS (SELECT DISTINCT uid, CAST(uid % 4 AS INT) AS want_rank,
               CASE uid % 3 WHEN 0 THEN '3e-05' WHEN 1 THEN '5e-05' ELSE '0.0001' END AS want_group FROM parsed),
j AS (SELECT e.uid, e.want_group, g.grp, e.want_rank, o.rank FROM exp e LEFT JOIN obs o USING (uid) LEFT JOIN grp g USING (uid)),
drift AS (SELECT uid, want_group, grp, CASE WHEN grp <> want_group THEN 'CRIT' END AS group_severity,
       CASE WHEN grp <> want_group THEN concat('group is ', grp, ', expected ', want_group) END AS group_message, want_rank, rank,
       CASE WHEN grp IS NULL THEN NULL WHEN rank IS NULL THEN 'CRIT' WHEN rank IS DISTINCT FROM CAST(want_rank AS VARCHAR) THEN 'CRIT' END AS severity,
       CASE WHEN grp IS NULL THEN NULL WHEN rank IS NULL THEN 'the log names no rank, so the default one is in force'
            WHEN rank IS DISTINCT FROM CAST(want_rank AS VARCHAR) THEN concat('data rank is ', rank, ', expected ', CAST(want_rank AS VARCHAR)) END AS message
FROM j)"""


def drift_rows(p):
    """Last seen settings against the expected ones, per uid."""
    seen = L.last_values(p, {"rank": W12_PATTERNS["rank"], "grp": r"peak_lr=(\S+)"})
    observed = seen.groupBy("uid").agg(F.max(F.when(F.col("key") == "rank", F.col("value"))).alias("rank"),
                                       F.max(F.when(F.col("key") == "grp", F.col("value"))).alias("grp"))
    uid = F.col("uid")
    expected = p.select("uid").distinct().select(
        "uid", (uid % 4).cast("int").alias("want_rank"),
        F.when(uid % 3 == 0, "3e-05").when(uid % 3 == 1, "5e-05").otherwise("0.0001").alias("want_group"))
    return L.settings_drift(observed, expected)


@register("j14_settings_drift", f"WITH {PARSED_SQL},{DRIFT_SQL}\nSELECT * FROM drift")
def j14_settings_drift(spark, sf):
    """The learning-rate marker of the fixture's lines stands for the group name."""
    return drift_rows(parsed(spark, sf))


@register("x17_error_class", rf"""WITH {PARSED_SQL},
e AS (SELECT uid, clean, TRY_CAST(nullif(regexp_extract(clean, 'HTTP (\d{{3}})', 1), '') AS INT) AS code FROM parsed
      WHERE ts IS NOT NULL AND NOT contains(clean, 'peak_lr=') AND NOT contains(clean, 'hf_repo_id='))
SELECT uid, CASE WHEN code IS NOT NULL AND (code = 429 OR (code >= 500 AND code < 600)) THEN 'retryable'
            WHEN code IS NOT NULL THEN 'fatal'
            WHEN {' OR '.join(f"contains(lower(clean), '{k}')" for k in L.DENY_KEYWORDS)} THEN 'fatal'
            WHEN {' OR '.join(f"contains(lower(clean), '{k}')" for k in L.RETRY_KEYWORDS)} THEN 'retryable'
            ELSE 'fatal' END AS error_class, count(*) AS n
FROM e GROUP BY 1, 2""")
def x17_error_class(spark, sf):
    p = parsed(spark, sf)
    e = p.filter(F.col("ts").isNotNull() & ~F.col("clean").contains("peak_lr=") & ~F.col("clean").contains("hf_repo_id="))
    code = F.regexp_extract("clean", r"HTTP (\d{3})", 1)
    e = e.withColumn("code", F.when(code != "", code).cast("int"))
    return (e.withColumn("error_class", L.error_class(F.col("code"), F.col("clean")))
             .groupBy("uid", "error_class").agg(F.count(F.lit(1)).alias("n")))


@register("x18_severity_tier", """
SELECT uid, poll, log_age, CASE WHEN log_age IS NULL THEN 'CRIT' WHEN log_age > 1800 THEN 'CRIT'
                                WHEN log_age > 900 THEN 'WARN' ELSE 'OK' END AS tier FROM polls""")
def x18_severity_tier(spark, sf):
    p = V.polls(spark, sf)
    return p.select("uid", "poll", "log_age", L.severity_tier(F.col("log_age")).alias("tier"))


@register("a21_alert_counts", """
SELECT uid, tier AS severity, count(*) AS n FROM (
  SELECT uid, CASE WHEN log_age IS NULL THEN 'CRIT' WHEN log_age > 1800 THEN 'CRIT'
                   WHEN log_age > 900 THEN 'WARN' ELSE 'OK' END AS tier FROM polls) WHERE tier <> 'OK'
GROUP BY uid, tier""")
def a21_alert_counts(spark, sf):
    p = V.poll_rows(spark, sf).withColumn("severity", L.severity_tier(F.col("log_age")))
    return p.filter(F.col("severity") != "OK").groupBy("uid", "severity").agg(F.count(F.lit(1)).alias("n"))


@register("u4_union_kinds", """
SELECT uid, 0 AS kind_ord, pos FROM logs WHERE kind = 'train'
UNION ALL SELECT uid, 1, pos FROM logs WHERE kind = 'commit'""")
def u4_union_kinds(spark, sf):
    lg = V.logs(spark, sf)
    t = lg.filter(F.col("kind") == "train").select("uid", F.lit(0).alias("kind_ord"), "pos")
    c = lg.filter(F.col("kind") == "commit").select("uid", F.lit(1).alias("kind_ord"), "pos")
    return t.unionByName(c)


@register("a20_repo_history", """
WITH c AS (SELECT repo, count(*) AS n_commits, count(DISTINCT owner) AS n_owners FROM commits GROUP BY repo),
p AS (SELECT repo, count(*) AS n_publishes FROM pubs GROUP BY repo),
e AS (SELECT uid % 20 AS repo, sum(incentive) AS earned FROM board WHERE incentive > 0 GROUP BY 1)
SELECT c.repo, c.n_commits, c.n_owners, coalesce(p.n_publishes, 0) AS n_publishes, coalesce(e.earned, 0.0) AS earned
FROM c LEFT JOIN p USING (repo) LEFT JOIN e USING (repo)""")
def a20_repo_history(spark, sf):
    c = V.commits(spark, sf).groupBy("repo").agg(F.count(F.lit(1)).alias("n_commits"),
                                                  F.countDistinct("owner").alias("n_owners"))
    p = V.pubs(spark, sf).groupBy("repo").agg(F.count(F.lit(1)).alias("n_publishes"))
    e = (V.board(spark, sf).filter(F.col("incentive") > 0)
         .groupBy((F.col("uid") % 20).alias("repo")).agg(F.sum("incentive").alias("earned")))
    return (c.join(p, "repo", "left").join(e, "repo", "left")
             .select("repo", "n_commits", "n_owners", F.coalesce("n_publishes", F.lit(0)).alias("n_publishes"),
                     F.coalesce("earned", F.lit(0.0)).alias("earned")))
