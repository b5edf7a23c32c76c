"""Leaderboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import board as B
from quarry.operators import logs as L
from quarry.plans.registry import register
from quarry.session import reuse
from quarry.sources import fixtures as V
from quarry.sources.snapshots import flatten_snapshot, snapshots_to_json

FACTORS = [("LEARNING RATE", 1, 2), ("TRAINING DATA", 1, 3)]

# DuckDB text of ``miner_rows`` over the board view.
MINERS_SQL = """
mr AS (SELECT *,
         row_number() OVER (PARTITION BY cycle, uid, slot ORDER BY pos DESC) AS slot_last,
         row_number() OVER (PARTITION BY cycle, uid ORDER BY CASE WHEN val_loss IS NULL THEN 1 ELSE 0 END,
                            coalesce(sample_cycle, -1) DESC, CASE WHEN status = 'ok' THEN 1 ELSE 0 END DESC,
                            coalesce(age, 1073741824), pos) AS fresh_rn,
         row_number() OVER (PARTITION BY cycle, uid ORDER BY pos) AS first_rn
       FROM board),
miners AS (SELECT cycle, uid,
         max(CASE WHEN fresh_rn = 1 THEN val_loss END) AS val_loss,
         max(CASE WHEN fresh_rn = 1 AND val_loss IS NOT NULL THEN slot END) AS fresh_slot,
         max(CASE WHEN fresh_rn = 1 AND val_loss IS NOT NULL THEN sample_cycle END) AS sample_cycle,
         CASE WHEN count(CASE WHEN slot_last = 1 THEN val_loss END) > 1
              THEN max(CASE WHEN slot_last = 1 THEN val_loss END) - min(CASE WHEN slot_last = 1 THEN val_loss END) END AS slot_spread,
         count(DISTINCT slot) AS n_slots, count(CASE WHEN slot_last = 1 THEN val_loss END) AS n_slots_scored,
         count(val_loss) AS n_records, max(age) AS max_age,
         max(CASE WHEN first_rn = 1 THEN cohort END) AS cohort, max(CASE WHEN first_rn = 1 THEN repo END) AS repo,
         max(incentive) AS incentive, max(baseline) AS baseline
       FROM mr GROUP BY cycle, uid)"""


def miners(spark, sf, pin: bool = True) -> DataFrame:
    """Per-(cycle, uid) miner table. Queries that read it in several branches
    (ranks, ties, moves, trends) pin it once; single-branch queries do not."""
    m = B.miner_rows(V.board(spark, sf))
    return reuse(m) if pin else m


@register("s5_flatten_snapshot", """
SELECT cycle, uid, row_number() OVER (PARTITION BY cycle, uid ORDER BY pos) - 1 AS slot_pos, slot, val_loss,
       status, sample_cycle, age FROM board""")
def s5_flatten_snapshot(spark, sf):
    rows = flatten_snapshot(snapshots_to_json(V.board(spark, sf)))
    return rows.select("cycle", "uid", F.col("slot_pos").cast("long").alias("slot_pos"), "slot", "val_loss",
                       "status", "sample_cycle", "age")


@register("s5_slot_map", """
WITH l AS (SELECT cycle, uid, slot, val_loss, row_number() OVER (PARTITION BY cycle, uid, slot ORDER BY pos DESC) AS rn FROM board),
m AS (SELECT cycle, uid, map_from_entries(list(struct_pack(k := slot, v := val_loss) ORDER BY slot)) AS slots
      FROM l WHERE rn = 1 GROUP BY cycle, uid)
SELECT cycle, uid, map_keys(slots) AS slot_names, map_values(slots) AS slot_losses FROM m""")
def s5_slot_map(spark, sf):
    m = B.slot_map(V.board(spark, sf))
    return m.select("cycle", "uid", F.map_keys("slots").alias("slot_names"), F.map_values("slots").alias("slot_losses"))


@register("w1_freshest_sample", f"""WITH {MINERS_SQL}
SELECT cycle, uid, val_loss, fresh_slot, sample_cycle FROM miners WHERE val_loss IS NOT NULL""")
def w1_freshest_sample(spark, sf):
    return B.scored(miners(spark, sf, pin=False)).select("cycle", "uid", "val_loss", "fresh_slot", "sample_cycle")


@register("a2_slot_spread", f"""WITH {MINERS_SQL}
SELECT cycle, uid, n_slots, n_slots_scored, slot_spread FROM miners""")
def a2_slot_spread(spark, sf):
    return miners(spark, sf, pin=False).select("cycle", "uid", "n_slots", "n_slots_scored", "slot_spread")


@register("w4_rank_scored", f"""WITH {MINERS_SQL}
SELECT cycle, uid, val_loss, row_number() OVER (PARTITION BY cycle ORDER BY val_loss, uid) AS rank
FROM miners WHERE val_loss IS NOT NULL""")
def w4_rank_scored(spark, sf):
    return B.rank_scored(miners(spark, sf, pin=False)).select("cycle", "uid", "val_loss", F.col("rank").cast("long").alias("rank"))


@register("a1_round_summary", f"""WITH {MINERS_SQL},
s AS (SELECT *, row_number() OVER (PARTITION BY cycle ORDER BY val_loss, uid) AS rn FROM miners WHERE val_loss IS NOT NULL)
SELECT cycle, count(*) AS field_size, min(val_loss) AS best, max(CASE WHEN rn = 3 THEN val_loss END) AS third_best
FROM s GROUP BY cycle""")
def a1_round_summary(spark, sf):
    return B.round_summary(miners(spark, sf)).select("cycle", "field_size", "best", "third_best")


@register("f3_predicates", f"""WITH {MINERS_SQL}
SELECT cycle, count(val_loss) AS n_scored, count(CASE WHEN incentive > 0 THEN 1 END) AS n_earners,
       count(CASE WHEN uid IN (1, 2, 3) THEN 1 END) AS n_ours,
       count(CASE WHEN uid NOT IN (1, 2, 3) AND repo IS NOT NULL THEN 1 END) AS n_rivals_with_repo
FROM miners GROUP BY cycle""")
def f3_predicates(spark, sf):
    m = miners(spark, sf, pin=False)
    return m.groupBy("cycle").agg(*[F.count(F.when(p, 1)).alias(n) for n, p in (
        ("n_scored", B.is_scored()), ("n_earners", B.is_earner()), ("n_ours", B.is_ours()),
        ("n_rivals_with_repo", B.is_rival_with_repo()))])


@register("o1_loss_leaders", f"""WITH {MINERS_SQL}
SELECT * FROM (SELECT cycle, uid, val_loss, repo, row_number() OVER (PARTITION BY cycle ORDER BY val_loss, uid) AS rank
               FROM miners WHERE val_loss IS NOT NULL AND uid NOT IN (1, 2, 3) AND repo IS NOT NULL) WHERE rank <= 5""")
def o1_loss_leaders(spark, sf):
    return B.loss_leaders(B.rivals_with_repo(miners(spark, sf, pin=False)), 5).select(
        "cycle", "uid", "val_loss", "repo", F.col("rank").cast("long").alias("rank"))


_TREND_SQL = """
series AS (SELECT * FROM miners WHERE val_loss IS NOT NULL OR incentive > 0),
lt AS (SELECT uid, list(val_loss ORDER BY cycle) AS loss_trend FROM
        (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY cycle DESC) AS rn FROM series WHERE val_loss IS NOT NULL)
       WHERE rn <= 6 GROUP BY uid),
ct AS (SELECT uid, list(cohort ORDER BY cycle) AS cohort_trend FROM
        (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY cycle DESC) AS rn FROM series) WHERE rn <= 6 GROUP BY uid),
trend AS (SELECT ct.uid, coalesce(lt.loss_trend, CAST([] AS DOUBLE[])) AS loss_trend, ct.cohort_trend
          FROM ct LEFT JOIN lt USING (uid))"""


@register("w2_trend", f"WITH {MINERS_SQL},{_TREND_SQL}\nSELECT uid, loss_trend, cohort_trend FROM trend")
def w2_trend(spark, sf):
    return B.trends(miners(spark, sf), 6)


@register("o2_earners", f"""WITH {MINERS_SQL},{_TREND_SQL},
last AS (SELECT * FROM miners WHERE cycle = (SELECT max(cycle) FROM miners) AND incentive > 0)
SELECT l.uid, l.incentive, l.cohort, t.loss_trend, row_number() OVER (ORDER BY l.incentive DESC, l.uid) AS place
FROM last l LEFT JOIN trend t USING (uid)""")
def o2_earners(spark, sf):
    m = miners(spark, sf)
    return B.earners_by_incentive(m, B.trends(m, 6)).select(
        "uid", "incentive", "cohort", "loss_trend", F.col("place").cast("long").alias("place"))


@register("a9_gap_to_worst_earner", f"""WITH {MINERS_SQL}
SELECT cycle, min(CASE WHEN uid IN (1, 2, 3) THEN val_loss END) AS best_ours,
       max(CASE WHEN incentive > 0 THEN val_loss END) AS worst_earner,
       min(CASE WHEN uid IN (1, 2, 3) THEN val_loss END) - max(CASE WHEN incentive > 0 THEN val_loss END) AS gap
FROM miners GROUP BY cycle""")
def a9_gap_to_worst_earner(spark, sf):
    return B.gap_to_worst_earner(miners(spark, sf, pin=False))


_MOVES_SQL = """
lastc AS (SELECT uid, cohort AS to_cohort FROM miners WHERE cycle = (SELECT max(cycle) FROM miners)),
firstc AS (SELECT uid, cohort AS from_cohort FROM miners WHERE cycle = (SELECT min(cycle) FROM miners)),
rk AS (SELECT * FROM (VALUES ('A', 4), ('B', 3), ('C', 2), ('tail', 1), ('none', 0)) t(c, r)),
moves AS (SELECT l.uid, f.from_cohort, l.to_cohort, coalesce(r1.r, 0) AS from_rank, coalesce(r2.r, 0) AS to_rank
          FROM lastc l LEFT JOIN firstc f USING (uid) LEFT JOIN rk r1 ON r1.c = f.from_cohort
          LEFT JOIN rk r2 ON r2.c = l.to_cohort)"""


@register("a10_cohort_moves", f"""WITH {MINERS_SQL},{_MOVES_SQL}
SELECT from_cohort, to_cohort, count(*) AS moves, bool_and(to_rank > from_rank) AS promoted
FROM moves WHERE from_rank <> to_rank GROUP BY from_cohort, to_cohort""")
def a10_cohort_moves(spark, sf):
    mv = B.cohort_moves(miners(spark, sf))
    return mv.groupBy("from_cohort", "to_cohort").agg(F.count(F.lit(1)).alias("moves"),
                                                       F.bool_and("promoted").alias("promoted"))


@register("o5_top_promotions", f"""WITH {MINERS_SQL},{_MOVES_SQL}
SELECT * FROM (SELECT uid, from_cohort, to_cohort, row_number() OVER (ORDER BY to_rank DESC, uid) AS place
               FROM moves WHERE to_rank > from_rank) WHERE place <= 12""")
def o5_top_promotions(spark, sf):
    mv = B.cohort_moves(miners(spark, sf)).filter("promoted")
    w = Window.orderBy(F.col("to_rank").desc(), F.col("uid"))
    return (mv.withColumn("place", F.row_number().over(w).cast("long")).filter(F.col("place") <= 12)
              .select("uid", "from_cohort", "to_cohort", "place"))


@register("a11_recency_gate", f"""WITH {MINERS_SQL},
s AS (SELECT *, CASE WHEN val_loss IS NOT NULL THEN 1 ELSE 0 END AS sc FROM miners),
g AS (SELECT uid, cycle,
        sum(sc) OVER (PARTITION BY uid ORDER BY cycle RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS rounds_in_window,
        sum(CASE WHEN sc = 1 THEN n_records ELSE 0 END) OVER (PARTITION BY uid ORDER BY cycle RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS records_in_window
      FROM s)
SELECT uid, cycle, CAST(rounds_in_window AS BIGINT) AS rounds_in_window, CAST(records_in_window AS BIGINT) AS records_in_window,
       rounds_in_window >= 3 AND records_in_window >= 3 AS group1, records_in_window >= 1 AS group2 FROM g""")
def a11_recency_gate(spark, sf):
    g = B.recency_gate(miners(spark, sf, pin=False))
    return g.select("uid", "cycle", F.col("rounds_in_window").cast("long").alias("rounds_in_window"),
                    F.col("records_in_window").cast("long").alias("records_in_window"), "group1", "group2")


@register("a12_exact_ties", f"""WITH {MINERS_SQL}
SELECT cycle, uid, val_loss FROM (SELECT *, count(*) OVER (PARTITION BY cycle, val_loss) AS n FROM miners
                                  WHERE val_loss IS NOT NULL) WHERE n > 1""")
def a12_exact_ties(spark, sf):
    return B.exact_ties(miners(spark, sf)).select("cycle", "uid", "val_loss")


@register("a13_scoring", f"""WITH {MINERS_SQL},
s AS (SELECT cycle, uid, val_loss, greatest(0.0, baseline - val_loss) AS delta,
             count(*) OVER (PARTITION BY cycle, val_loss) > 1 AS tied FROM miners WHERE val_loss IS NOT NULL),
s2 AS (SELECT *, CASE WHEN tied THEN 0.0 ELSE pow(delta, 1.2) END AS score FROM s),
r AS (SELECT cycle, uid, row_number() OVER (PARTITION BY cycle ORDER BY score DESC, uid) AS place FROM s2 WHERE score > 0)
SELECT s2.cycle, s2.uid, s2.val_loss, s2.delta, s2.tied, s2.score, CASE WHEN r.place <= 3 THEN r.place END AS place,
       CAST(CASE r.place WHEN 1 THEN 2.25 WHEN 2 THEN 1.5 WHEN 3 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS reward
FROM s2 LEFT JOIN r ON r.cycle = s2.cycle AND r.uid = s2.uid""")
def a13_scoring(spark, sf):
    s = B.scoring(miners(spark, sf))
    return s.withColumn("place", F.col("place").cast("long"))


@register("a14_consistency", f"""WITH {MINERS_SQL},
s AS (SELECT * FROM miners WHERE val_loss IS NOT NULL),
med AS (SELECT cycle, median(val_loss) AS md FROM s GROUP BY cycle)
SELECT uid, stddev_pop(val_loss - md) AS dev_stdev,
       round(avg(val_loss), 9) AS mean_loss, min(val_loss) AS best_loss,
       count(*) AS rounds FROM s JOIN med USING (cycle) GROUP BY uid""")
def a14_consistency(spark, sf):
    # rounded, so that the last bit of the sum, which depends on the order of rows, does not show
    return B.consistency(miners(spark, sf)).withColumn("mean_loss", F.round("mean_loss", 9))


@register("a8_factor_verdict", f"""WITH {MINERS_SQL},
f AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {a}, {b})" for n, a, b in FACTORS)}) t(factor, a, b)),
p AS (SELECT ma.cycle, f.factor, f.a, f.b, ma.val_loss AS va, mb.val_loss AS vb, mb.val_loss - ma.val_loss AS gap
      FROM miners ma JOIN f ON ma.uid = f.a LEFT JOIN miners mb ON mb.cycle = ma.cycle AND mb.uid = f.b),
q AS (SELECT *, abs(gap) AS effect, max(CASE WHEN gap IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY cycle) AS pend,
             max(abs(gap)) OVER (PARTITION BY cycle) AS top, min(abs(gap)) OVER (PARTITION BY cycle) AS low FROM p)
SELECT cycle, factor, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b, va, vb, gap,
       CAST(CASE WHEN gap IS NULL THEN NULL WHEN gap < 0 THEN b ELSE a END AS BIGINT) AS better,
       CASE WHEN gap IS NULL THEN 'pending' WHEN pend = 1 THEN 'incomplete'
            WHEN low > 0 AND top / low >= 1.5 AND effect = top THEN 'lever'
            WHEN low > 0 AND top / low >= 1.5 THEN 'minor' ELSE 'comparable' END AS verdict
FROM q""")
def a8_factor_verdict(spark, sf):
    factors = spark.createDataFrame(FACTORS, "factor string, a long, b long")
    return B.factor_verdicts(miners(spark, sf), factors)


@register("x15_cohort_rank", f"""WITH {MINERS_SQL}
SELECT cycle, uid, cohort, CASE cohort WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'tail' THEN 1 ELSE 0 END AS cohort_rank
FROM miners""")
def x15_cohort_rank(spark, sf):
    return miners(spark, sf, pin=False).select("cycle", "uid", "cohort", B.cohort_rank("cohort").alias("cohort_rank"))


@register("x16_delta", f"""WITH {MINERS_SQL}
SELECT cycle, uid, CASE WHEN baseline IS NULL OR baseline = 0 OR val_loss IS NULL THEN NULL ELSE baseline - val_loss END AS delta_versus,
       baseline - val_loss AS delta_record FROM miners""")
def x16_delta(spark, sf):
    m = miners(spark, sf, pin=False)
    return m.select("cycle", "uid", B.delta_versus(F.col("val_loss"), F.col("baseline")).alias("delta_versus"),
                    B.delta_plain(F.col("val_loss"), F.col("baseline")).alias("delta_record"))


X21_SQL = """
s21 AS (SELECT *, row_number() OVER (PARTITION BY cycle ORDER BY val_loss, uid) AS rn FROM miners WHERE val_loss IS NOT NULL),
rs21 AS (SELECT cycle, min(val_loss) AS best, max(CASE WHEN rn = 3 THEN val_loss END) AS rank3 FROM s21 GROUP BY cycle),
st21 AS (SELECT *, val_loss IS NOT NULL AND val_loss IS NOT DISTINCT FROM lag(val_loss) OVER (PARTITION BY uid ORDER BY cycle) AS stale FROM miners),
x21 AS (SELECT st21.cycle, st21.uid, st21.stale,
  CASE WHEN st21.stale THEN 'gauge not refreshed: its delta and rank say nothing'
       WHEN st21.val_loss IS NULL OR st21.baseline IS NULL THEN NULL
       WHEN st21.val_loss >= st21.baseline THEN concat('loss ', format('{:.5f}', st21.val_loss), ' is no better than the baseline ', format('{:.5f}', st21.baseline), ': nothing to score')
       WHEN rs21.rank3 IS NOT NULL AND st21.val_loss > rs21.rank3 THEN concat('better than the baseline, ', format('{:.6f}', st21.val_loss - rs21.best), ' behind the first and not among three')
  END AS note,
  CASE WHEN st21.stale THEN NULL ELSE st21.baseline - st21.val_loss END AS delta
FROM st21 LEFT JOIN rs21 USING (cycle))"""


def status_note_rows(m: DataFrame) -> DataFrame:
    """X21 per (cycle, uid): stale flag, note and delta (nulled when stale)."""
    rs = B.round_summary(m).select("cycle", "best", F.col("third_best").alias("rank3"))
    prev = F.lag("val_loss").over(Window.partitionBy("uid").orderBy("cycle"))
    st = m.withColumn("stale", F.col("val_loss").isNotNull() & F.col("val_loss").eqNullSafe(prev))
    j = st.join(rs, "cycle", "left")
    note = B.status_note(F.col("val_loss"), F.col("baseline"), F.col("rank3"), F.col("best"), F.col("stale"))
    return j.select("cycle", "uid", "stale", note.alias("note"),
                    F.when(F.col("stale"), F.lit(None).cast("double"))
                     .otherwise(F.col("baseline") - F.col("val_loss")).alias("delta"))


@register("x21_status_note", f"WITH {MINERS_SQL},{X21_SQL}\nSELECT * FROM x21")
def x21_status_note(spark, sf):
    return status_note_rows(miners(spark, sf))


@register("x22_slot_detail", """
SELECT cycle, uid, string_agg(concat('slot', slot, '=',
         CASE WHEN val_loss IS NOT NULL THEN format('{:.4f}', val_loss) ELSE coalesce(status, '-') END,
         '@c', coalesce(CAST(sample_cycle AS VARCHAR), 'None'), CASE WHEN status = 'ok' THEN '' ELSE '(stale)' END),
       '  ' ORDER BY pos) AS detail
FROM board GROUP BY cycle, uid""")
def x22_slot_detail(spark, sf):
    return B.slot_detail(V.board(spark, sf))


UPLOADS_SQL = r"""
stamped AS (SELECT uid, pos, line, try_strptime(left(line, 19), '%Y-%m-%d %H:%M:%S') AS ts FROM logs),
sent AS (SELECT uid, pos, ts, CAST(extract(day FROM ts) AS INT) AS cycle, regexp_extract(line, 'hf_repo_id=(\S+)', 1) AS upload_repo,
                regexp_extract(line, 'hf_revision=(\S+)', 1) AS rev FROM stamped WHERE contains(line, 'MinerCommit2> committing')),
uploads AS (SELECT uid, cycle, max(ts) AS uploaded_at, arg_max(rev, (ts, pos)) AS upload_rev, arg_max(upload_repo, (ts, pos)) AS upload_repo,
                   arg_max(rev, (ts, pos)) FILTER (WHERE pos % 9 <> 0) AS chain_rev FROM sent GROUP BY uid, cycle)"""

X23_SQL = f"""{UPLOADS_SQL},
clock AS (SELECT CAST(extract(day FROM ts) AS INT) AS cycle, max(ts) AS now FROM stamped WHERE ts IS NOT NULL GROUP BY 1),
facts AS (SELECT m.*, now, u.uploaded_at IS NOT NULL AS committed,
   last_value(u.uploaded_at IGNORE NULLS) OVER w AS last_upload, last_value(u.upload_rev IGNORE NULLS) OVER w AS upload_rev,
   last_value(u.chain_rev IGNORE NULLS) OVER w AS chain_rev
   FROM miners m LEFT JOIN uploads u USING (cycle, uid) LEFT JOIN clock USING (cycle)
   WINDOW w AS (PARTITION BY m.uid ORDER BY m.cycle ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
aged AS (SELECT *, CAST(epoch(now) - epoch(last_upload) AS BIGINT) // 60 AS upload_minutes FROM facts),
x23 AS (SELECT cycle, uid, list_filter([
    CASE WHEN cohort IS NULL OR cohort IN ('none', 'tail') THEN concat('cohort ', coalesce(cohort, 'None'), ' has no weight') END,
    CASE WHEN NOT committed THEN 'nothing committed this cycle' END,
    CASE WHEN max_age > 600 THEN concat('score age ', CAST(max_age AS VARCHAR), ' blocks') END,
    CASE WHEN upload_minutes > 210 THEN concat('last upload ', CAST(upload_minutes AS VARCHAR), ' minutes ago') END,
    CASE WHEN NOT (starts_with(chain_rev, left(upload_rev, 7)) OR starts_with(upload_rev, left(chain_rev, 7)))
         THEN concat('revision on chain ', chain_rev, ', uploaded ', upload_rev) END,
    CASE WHEN repo IS NULL THEN 'no commit on chain' END], lambda x: x IS NOT NULL) AS notes
FROM aged)"""


def uploads_by_cycle(lines: DataFrame) -> DataFrame:
    """Last upload of each miner a cycle; every ninth one is taken as lost on the
    way to the chain, so the chain still names the upload before it."""
    up = L.log_events(lines, L.UPLOAD_MARKER).withColumn("_u", F.struct("ts", "pos", "rev", "repo"))
    g = up.groupBy("uid", F.dayofmonth("ts").alias("cycle")).agg(
        F.max("_u").alias("_u"), F.max(F.when(F.col("pos") % 9 != 0, F.col("_u"))).alias("_c"))
    return g.select("uid", "cycle", F.col("_u.ts").alias("uploaded_at"), F.col("_u.rev").alias("upload_rev"),
                    F.col("_u.repo").alias("upload_repo"), F.col("_c.rev").alias("chain_rev"))


def noted(m: DataFrame, lines: DataFrame) -> DataFrame:
    """X23 over the miner table and the parsed log lines."""
    clock = (lines.filter(F.col("ts").isNotNull()).groupBy(F.dayofmonth("ts").alias("cycle")).agg(F.max("ts").alias("now")))
    return B.status_notes(B.carried_uploads(m, uploads_by_cycle(lines).drop("upload_repo"), clock))


@register("x23_status_notes", f"WITH {MINERS_SQL},{X23_SQL}\nSELECT cycle, uid, notes FROM x23")
def x23_status_notes(spark, sf):
    return noted(miners(spark, sf, pin=False), L.parsed_lines(V.logs(spark, sf))).select("cycle", "uid", "notes")


@register("c14_history_report", f"""WITH {MINERS_SQL},{_TREND_SQL},{_MOVES_SQL},
last AS (SELECT * FROM miners WHERE cycle = (SELECT max(cycle) FROM miners) AND incentive > 0)
SELECT 'earner' AS section, l.uid, l.incentive, l.cohort AS to_cohort, CAST(NULL AS VARCHAR) AS from_cohort, t.loss_trend, t.cohort_trend
FROM last l LEFT JOIN trend t USING (uid)
UNION ALL
SELECT 'ours', t.uid, NULL, NULL, NULL, t.loss_trend, t.cohort_trend FROM trend t WHERE t.uid IN (1, 2, 3)
UNION ALL
SELECT 'promoted', uid, NULL, to_cohort, from_cohort, NULL, NULL FROM
  (SELECT *, row_number() OVER (ORDER BY to_rank DESC, uid) AS place FROM moves WHERE to_rank > from_rank) WHERE place <= 12""")
def c14_history_report(spark, sf):
    m = miners(spark, sf)
    tr = B.trends(m, 6)
    earn = (B.earners(B.latest_snapshot(m)).join(tr, "uid", "left")
            .select(F.lit("earner").alias("section"), "uid", "incentive", F.col("cohort").alias("to_cohort"),
                    F.lit(None).cast("string").alias("from_cohort"), "loss_trend", "cohort_trend"))
    own = (tr.filter(F.col("uid").isin(list(B.OUR_UIDS)))
           .select(F.lit("ours").alias("section"), "uid", F.lit(None).cast("double").alias("incentive"),
                   F.lit(None).cast("string").alias("to_cohort"), F.lit(None).cast("string").alias("from_cohort"),
                   "loss_trend", "cohort_trend"))
    mv = B.cohort_moves(m).filter("promoted")
    mv = (mv.withColumn("place", F.row_number().over(Window.orderBy(F.col("to_rank").desc(), F.col("uid"))))
            .filter(F.col("place") <= 12)
            .select(F.lit("promoted").alias("section"), "uid", F.lit(None).cast("double").alias("incentive"),
                    "to_cohort", "from_cohort", F.lit(None).cast("array<double>").alias("loss_trend"),
                    F.lit(None).cast("array<string>").alias("cohort_trend")))
    return earn.unionByName(own).unionByName(mv)


# ------------------------------------------------------------------ J4, J10, J11, C11
@register("j10_first_last_join", f"""WITH {MINERS_SQL},{_MOVES_SQL}
SELECT uid, from_cohort, to_cohort, from_rank, to_rank FROM moves""")
def j10_first_last_join(spark, sf):
    m = miners(spark, sf)
    first = B.latest_snapshot(m.withColumn("_neg", -F.col("cycle")), "_neg").select("uid", F.col("cohort").alias("from_cohort"))
    last = B.latest_snapshot(m).select("uid", F.col("cohort").alias("to_cohort"))
    j = last.join(first, "uid", "left")
    return j.select("uid", "from_cohort", "to_cohort", B.cohort_rank("from_cohort").alias("from_rank"),
                    B.cohort_rank("to_cohort").alias("to_rank"))


@register("j11_factor_pairs", f"""WITH {MINERS_SQL},
f AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {a}, {b})" for n, a, b in FACTORS)}) t(factor, a, b))
SELECT ma.cycle, f.factor, ma.val_loss AS va, mb.val_loss AS vb
FROM miners ma JOIN f ON ma.uid = f.a LEFT JOIN miners mb ON mb.cycle = ma.cycle AND mb.uid = f.b""")
def j11_factor_pairs(spark, sf):
    factors = spark.createDataFrame(FACTORS, "factor string, a long, b long")
    return B.factor_verdicts(miners(spark, sf), factors).select("cycle", "factor", "va", "vb")


@register("j4_local_board_join", f"""WITH {MINERS_SQL}
SELECT t.pos, t.uid, t.cycle, t.local_eval, m.val_loss AS validator_val_loss, m.cohort, m.incentive
FROM trainlog t LEFT JOIN miners m ON m.uid = t.uid AND m.cycle = t.cycle""")
def j4_local_board_join(spark, sf):
    m = miners(spark, sf, pin=False).select("uid", "cycle", F.col("val_loss").alias("validator_val_loss"), "cohort", "incentive")
    t = V.trainlog(spark, sf).select("pos", "uid", "cycle", "local_eval")
    return t.join(m, ["uid", "cycle"], "left").select("pos", "uid", "cycle", "local_eval", "validator_val_loss",
                                                      "cohort", "incentive")


@register("c11_versus_report", f"""WITH {MINERS_SQL},
last AS (SELECT * FROM miners WHERE cycle = (SELECT max(cycle) FROM miners)),
rk AS (SELECT uid, row_number() OVER (ORDER BY val_loss, uid) AS rank FROM last WHERE val_loss IS NOT NULL),
pu AS (SELECT uid, peak_lr FROM settings WHERE scope = 'uid'),
sh AS (SELECT max(peak_lr) AS peak_lr, count(*) AS n FROM settings WHERE scope = 'shared'),
roles AS (SELECT 'ours' AS role, uid FROM last WHERE uid IN (1, 2, 3)
          UNION ALL SELECT 'earner', uid FROM (SELECT uid, row_number() OVER (ORDER BY incentive DESC, uid) AS r
                                               FROM last WHERE incentive > 0) WHERE r <= 6
          UNION ALL SELECT 'leader', uid FROM rk WHERE rank <= 5),
gap AS (SELECT min(CASE WHEN uid IN (1, 2, 3) THEN val_loss END) - max(CASE WHEN incentive > 0 THEN val_loss END) AS g FROM last)
SELECT r.role, l.uid, l.val_loss, CASE WHEN l.baseline IS NULL OR l.baseline = 0 OR l.val_loss IS NULL THEN NULL
                                       ELSE l.baseline - l.val_loss END AS delta,
       rk.rank, l.cohort, l.incentive,
       CASE WHEN pu.uid IS NOT NULL THEN pu.peak_lr WHEN sh.n > 0 THEN sh.peak_lr ELSE CAST(3e-4 AS DOUBLE) END AS peak_lr,
       gap.g AS gap_to_worst_earner
FROM roles r JOIN last l USING (uid) LEFT JOIN rk USING (uid) LEFT JOIN pu USING (uid) JOIN sh ON true JOIN gap ON true""")
def c11_versus_report(spark, sf):
    from quarry.operators.candidates import layered_lookup

    m = miners(spark, sf)
    last = B.latest_snapshot(m)
    ranked = B.rank_scored(last).select("uid", F.col("rank").cast("long").alias("rank"))
    ours_r = B.ours(last).select(F.lit("ours").alias("role"), "uid")
    earn = (B.earners(last).withColumn("_r", F.row_number().over(Window.orderBy(F.col("incentive").desc(), F.col("uid"))))
            .filter(F.col("_r") <= 6).select(F.lit("earner").alias("role"), "uid"))
    lead = ranked.filter(F.col("rank") <= 5).select(F.lit("leader").alias("role"), "uid")
    roles = ours_r.unionByName(earn).unionByName(lead)
    gap = B.gap_to_worst_earner(last).select("cycle", F.col("gap").alias("gap_to_worst_earner"))
    cfg = layered_lookup(roles.select("uid").distinct(), V.settings(spark, sf), "peak_lr", 3e-4).select("uid", "peak_lr")
    j = (roles.join(last, "uid").join(ranked, "uid", "left").join(cfg, "uid", "left").join(gap, "cycle"))
    return j.select("role", "uid", "val_loss", B.delta_versus(F.col("val_loss"), F.col("baseline")).alias("delta"),
                    "rank", "cohort", "incentive", "peak_lr", "gap_to_worst_earner")
