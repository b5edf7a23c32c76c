"""Trial, eval-curve, train-record, candidate and settings queries.

(S8, S9, S15, W5, W6, W16, J5, J6, X6, X11, X14, F5, F6, F7, F8, O3, O6,
A3-A7, C10, C15.)
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.numeric import finite, finite_recorder
from quarry.operators import board as B
from quarry.operators import candidates as CD
from quarry.operators import logs as L
from quarry.operators import trials as T
from quarry.operators.ordering import first_n
from quarry.plans import board as PB
from quarry.plans.registry import register
from quarry.sources import fixtures as V
from quarry.sources.snapshots import read_eval_curves, read_settings


def _rounded(df, *cols: str):
    """Reported means to 9 places: the last bit of a sum depends on the order of rows."""
    return df.withColumns({c: F.round(c, 9) for c in cols})


def _hash_sql(tag: str, *parts: str) -> str:
    inner = ", ".join([f"'{tag}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"CAST(('0x' || substr(sha256(concat_ws(':', {inner})), 1, 15)) AS BIGINT)"


# ------------------------------------------------------------------ S15, W16, X11, X14
@register("s15_upsert_trials", """
WITH t0 AS (SELECT uid, cycle, peak_lr, CASE WHEN cycle % 2 = 0 THEN NULL ELSE val_loss END AS val_loss, drift FROM trials),
st AS (SELECT uid, cycle + 3 AS cycle, peak_lr * 2 AS peak_lr, CAST(NULL AS DOUBLE) AS val_loss, CAST(NULL AS DOUBLE) AS drift
       FROM trials),
up AS (SELECT uid, cycle + 5 AS cycle, val_loss FROM trials),
k AS (SELECT * FROM t0 UNION ALL
      SELECT * FROM st WHERE NOT EXISTS (SELECT 1 FROM t0 WHERE t0.uid = st.uid AND t0.cycle = st.cycle))
SELECT k.uid, k.cycle, k.peak_lr, CASE WHEN up.uid IS NOT NULL THEN up.val_loss ELSE k.val_loss END AS val_loss, k.drift
FROM k LEFT JOIN up ON up.uid = k.uid AND up.cycle = k.cycle""")
def s15_upsert_trials(spark, sf):
    """Whole table in every role: the existing table (even cycles unscored),
    start rows shifted 3 cycles (overlaps ignored, the last 3 per uid inserted)
    and result updates shifted 5 cycles (the last 2 per uid hit missing keys)."""
    t = V.trials(spark, sf).select("uid", "cycle", "peak_lr", "val_loss", "drift")
    table = t.withColumn("val_loss", F.when(F.col("cycle") % 2 == 0, F.lit(None).cast("double"))
                         .otherwise(F.col("val_loss")))
    starts = t.select("uid", (F.col("cycle") + 3).alias("cycle"), (F.col("peak_lr") * 2).alias("peak_lr"),
                      F.lit(None).cast("double").alias("val_loss"), F.lit(None).cast("double").alias("drift"))
    updates = t.select("uid", (F.col("cycle") + 5).alias("cycle"), "val_loss")
    return T.upsert_trials(table, starts, updates).select("uid", "cycle", "peak_lr", "val_loss", "drift")


_W16_SQL = """
ld AS (SELECT uid, cycle AS drift_cycle, peak_lr AS lr, drift FROM
         (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY cycle DESC) AS rn FROM trials WHERE drift IS NOT NULL)
       WHERE rn = 1 AND drift <> 0)"""


@register("w16_latest_drift", f"WITH {_W16_SQL}\nSELECT * FROM ld")
def w16_latest_drift(spark, sf):
    return T.latest_drift(V.trials(spark, sf))


_X11 = """CASE WHEN drift > 0 THEN least(greatest(lr * least(greatest(pow(CAST(0.0119 AS DOUBLE) / drift, CAST(1.0 AS DOUBLE)), 0.5), 2.0),
                                                 CAST(1e-6 AS DOUBLE)), CAST(1e-3 AS DOUBLE)) END"""


@register("x11_drift_correction", f"WITH {_W16_SQL}\nSELECT uid, lr, drift, {_X11} AS next_lr FROM ld")
def x11_drift_correction(spark, sf):
    d = T.latest_drift(V.trials(spark, sf))
    return d.select("uid", "lr", "drift", T.drift_correction(F.col("lr"), F.col("drift")).alias("next_lr"))


def _grid_values(name: str, values) -> str:
    return f"{name} AS (SELECT * FROM (VALUES {', '.join(f'({i}, CAST({v!r} AS DOUBLE))' for i, v in enumerate(values))}) t(k, v))"


_X14_SQL = f"""
{_grid_values('lrg', T.LR_GRID)}, {_grid_values('wg', T.WARMUP_GRID)}, {_grid_values('mg', T.MIN_LR_FRAC_GRID)},
sc AS (SELECT uid, count(*) AS n_scored, arg_min(peak_lr, (val_loss, cycle)) AS best_lr,
              arg_min(warmup, (val_loss, cycle)) AS best_warm, arg_min(min_frac, (val_loss, cycle)) AS best_floor FROM trials
       WHERE val_loss IS NOT NULL GROUP BY uid),
u AS (SELECT DISTINCT uid FROM trials),
b AS (SELECT u.uid, 1000 AS next_cycle, coalesce(sc.n_scored, 0) AS n, sc.best_lr, sc.best_warm, sc.best_floor FROM u LEFT JOIN sc USING (uid)),
near AS (SELECT uid, arg_min(k, (abs(ln(v) - ln(best_lr)), k)) AS bidx FROM b, lrg WHERE best_lr IS NOT NULL GROUP BY uid),
h AS (SELECT b.*, near.bidx, n + uid AS i,
             {_hash_sql('explore', 'uid', 'next_cycle')} % 1000 < 200 AS explore,
             [-1, 0, 0, 1][{_hash_sql('jitter', 'uid', 'next_cycle')} % 4 + 1] AS jit,
             {_hash_sql('lr', 'uid', 'next_cycle')} % 10 AS rl, {_hash_sql('warmup', 'uid', 'next_cycle')} % 3 AS rw,
             {_hash_sql('min_frac', 'uid', 'next_cycle')} % 2 AS rm
      FROM b LEFT JOIN near USING (uid)),
src AS (SELECT *, CASE WHEN n = 0 THEN 'start' WHEN n < 12 THEN 'sweep' WHEN explore THEN 'explore' ELSE 'exploit' END AS source,
               least(greatest(bidx + jit, 0), 9) AS eidx FROM h)
SELECT uid, next_cycle, n AS n_scored, source,
  CASE source WHEN 'start' THEN CAST(3e-4 AS DOUBLE) WHEN 'sweep' THEN (SELECT v FROM lrg WHERE k = i % 10)
              WHEN 'explore' THEN (SELECT v FROM lrg WHERE k = rl) ELSE (SELECT v FROM lrg WHERE k = eidx) END AS peak_lr,
  CASE source WHEN 'start' THEN CAST(0.03 AS DOUBLE) WHEN 'sweep' THEN (SELECT v FROM wg WHERE k = (i // 10) % 3)
              WHEN 'explore' THEN (SELECT v FROM wg WHERE k = rw) ELSE best_warm END AS warmup,
  CASE source WHEN 'start' THEN CAST(0.02 AS DOUBLE) WHEN 'sweep' THEN (SELECT v FROM mg WHERE k = i % 2)
              WHEN 'explore' THEN (SELECT v FROM mg WHERE k = rm) ELSE best_floor END AS min_frac
FROM src"""


@register("x14_next_trial", f"WITH {_X14_SQL}")
def x14_next_trial(spark, sf):
    t = V.trials(spark, sf).withColumn("drift", F.lit(None).cast("double"))  # grid path: drift control off
    return T.next_trial(t, F.lit(1000)).select("uid", "next_cycle", "n_scored", "source", "peak_lr",
                                               "warmup", "min_frac")


@register("x14_next_trial_drift_first", f"""WITH {_W16_SQL},{_X14_SQL.replace("FROM src", "FROM src0")}""".replace(
    "src AS (SELECT *,", "src0 AS (SELECT *,").replace(
    "SELECT uid, next_cycle, n AS n_scored, source,", ",\ngq AS (SELECT uid, next_cycle, n AS n_scored, source,") + """),
dr AS (SELECT uid, """ + _X11 + """ AS dlr FROM ld)
SELECT gq.uid, gq.next_cycle, gq.n_scored,
       CASE WHEN dr.dlr IS NOT NULL THEN 'drift' ELSE gq.source END AS source,
       CASE WHEN dr.dlr IS NOT NULL THEN dr.dlr ELSE gq.peak_lr END AS peak_lr,
       CASE WHEN dr.dlr IS NOT NULL THEN CAST(0.03 AS DOUBLE) ELSE gq.warmup END AS warmup,
       CASE WHEN dr.dlr IS NOT NULL THEN CAST(0.02 AS DOUBLE) ELSE gq.min_frac END AS min_frac
FROM gq LEFT JOIN dr USING (uid)""")
def x14_next_trial_drift_first(spark, sf):
    """X14 with drift control first: a uid whose latest non-zero drift yields a
    correction takes it (warm-up 0.03, floor 0.02); the others follow the grid."""
    return T.next_trial(V.trials(spark, sf), F.lit(1000)).select(
        "uid", "next_cycle", "n_scored", "source", "peak_lr", "warmup", "min_frac")


# ------------------------------------------------------------------ curves
@register("x6_step_of", r"""
SELECT uid, name, coalesce(TRY_CAST(nullif(regexp_extract(name, 'inneropt_(\d+)$', 1), '') AS BIGINT), -1) AS step FROM curve""")
def x6_step_of(spark, sf):
    c = V.curve(spark, sf)
    return c.select("uid", "name", T.step_of(F.col("name")).alias("step"))


@register("j6_checkpoint_match", """
SELECT uid, count(CASE WHEN saved THEN 1 END) AS n_scored_ckpts, max(CASE WHEN saved THEN step END) AS newest_saved
FROM curve GROUP BY uid""")
def j6_checkpoint_match(spark, sf):
    c = V.curve(spark, sf)
    sc = T.scored_checkpoints(c).groupBy("uid").agg(F.count(F.lit(1)).alias("n_scored_ckpts"))
    newest = c.filter("saved").groupBy("uid").agg(F.max("step").alias("newest_saved"))
    return (c.select("uid").distinct().join(sc, "uid", "left").join(newest, "uid", "left")
            .select("uid", F.coalesce("n_scored_ckpts", F.lit(0)).alias("n_scored_ckpts"), "newest_saved"))


@register("w5_stable_checkpoint", """
WITH sc AS (SELECT uid, step, loss FROM curve WHERE saved),
sm AS (SELECT *, avg(loss) OVER (PARTITION BY uid ORDER BY step ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smoothed,
              count(*) OVER (PARTITION BY uid) AS n_cands FROM sc),
pk AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY CASE WHEN n_cands >= 3 THEN smoothed ELSE loss END, step) AS rn FROM sm),
nw AS (SELECT uid, max(CASE WHEN saved THEN step END) AS newest FROM curve GROUP BY uid)
SELECT nw.uid, coalesce(p.step, nw.newest) AS step, p.loss AS raw, p.smoothed, coalesce(p.n_cands, 0) AS n_cands,
       CASE WHEN p.uid IS NULL THEN 'newest' WHEN p.n_cands >= 3 THEN 'stable' ELSE 'best' END AS rule
FROM nw LEFT JOIN (SELECT * FROM pk WHERE rn = 1) p ON p.uid = nw.uid""")
def w5_stable_checkpoint(spark, sf):
    return T.stable_checkpoint(V.curve(spark, sf))


W6_GROUPS = ["click", "view", "purchase"]


@register("w6_retention", r"""
WITH s AS (SELECT uid, grp, name, coalesce(TRY_CAST(nullif(regexp_extract(name, 'inneropt_(\d+)$', 1), '') AS BIGINT), -1) AS step
           FROM curve WHERE grp IN ('click', 'view', 'purchase')),
r AS (SELECT *, row_number() OVER (PARTITION BY uid, grp ORDER BY step DESC, name DESC) AS age_rank FROM s)
SELECT * FROM r WHERE age_rank > 3""")
def w6_retention(spark, sf):
    c = T.scope(V.curve(spark, sf), groups=W6_GROUPS).select("uid", "grp", "name")
    c = c.withColumn("step", T.step_of(F.col("name")))
    return T.retention(c, 3).select("uid", "grp", "name", "step", F.col("age_rank").cast("long").alias("age_rank"))


_F5_LOSS = """CASE WHEN step % 700 = 0 THEN CAST('NaN' AS DOUBLE) WHEN step % 1100 = 0 THEN CAST('Infinity' AS DOUBLE)
                   WHEN step % 1300 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE loss END"""


@register("f5_finite_only", f"""
WITH c AS (SELECT uid, {_F5_LOSS} AS l FROM curve)
SELECT uid, count(CASE WHEN l IS NOT NULL AND NOT isnan(l) AND NOT isinf(l) THEN 1 END) AS n_strict,
       count(CASE WHEN l IS NOT NULL AND NOT isnan(l) AND l <> CAST('Infinity' AS DOUBLE) THEN 1 END) AS n_recorder
FROM c GROUP BY uid""")
def f5_finite_only(spark, sf):
    c = V.curve(spark, sf)
    l = (F.when(F.col("step") % 700 == 0, F.lit(float("nan"))).when(F.col("step") % 1100 == 0, F.lit(float("inf")))
         .when(F.col("step") % 1300 == 0, F.lit(float("-inf"))).otherwise(F.col("loss")))
    c = c.withColumn("l", l)
    return c.groupBy("uid").agg(F.count(F.when(finite("l"), 1)).alias("n_strict"),
                                F.count(F.when(finite_recorder("l"), 1)).alias("n_recorder"))


@register("a7_ab_verdict", f"""
WITH p AS (SELECT uid % 2 AS arm, CASE WHEN step % 200 = 0 THEN 'pre' ELSE 'post' END AS phase, loss FROM curve),
g AS (SELECT arm, avg(CASE WHEN phase = 'pre' THEN loss END) AS pre,
             avg(CASE WHEN phase = 'post' THEN loss END) AS post FROM p GROUP BY arm),
h AS (SELECT *, pre - post AS improvement, count(*) OVER () AS arms,
             max(CASE WHEN arm = 0 THEN post END) OVER () - max(CASE WHEN arm = 1 THEN post END) OVER () AS gp FROM g)
SELECT arm, round(pre, 9) AS pre, round(post, 9) AS post, round(improvement, 9) AS improvement,
       round(CASE WHEN arms >= 2 THEN gp END, 9) AS gap,
       CASE WHEN arms < 2 THEN 'forced: only one arm ran' WHEN abs(gp) < 0.01 THEN 'precision is not the problem'
            ELSE 'precision matters' END AS verdict FROM h""")
def a7_ab_verdict(spark, sf):
    c = V.curve(spark, sf)
    pts = c.select((F.col("uid") % 2).alias("arm"),
                   F.when(F.col("step") % 200 == 0, "pre").otherwise("post").alias("phase"), "loss")
    return _rounded(T.ab_verdict(pts), "pre", "post", "improvement", "gap")


@register("s8_read_eval_curves", "SELECT uid, CAST(step AS BIGINT) AS step, loss FROM curve")
def s8_read_eval_curves(spark, sf):
    c = V.curve(spark, sf)
    js = c.groupBy("uid").agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct(F.col("step").cast("string"), F.col("loss"))))).alias("json"))
    return read_eval_curves(js)


# ------------------------------------------------------------------ A6, O3 (probe losses over corpus shards)
_BATCH_SQL = """
bt AS (SELECT shard, pos // 4 AS batch, min(n_chars) AS mn, avg(ln(1 + length(text)) / 4) AS l FROM docs GROUP BY shard, pos // 4),
bl AS (SELECT shard, batch, CASE WHEN mn < 40 THEN CAST('NaN' AS DOUBLE) ELSE l END AS loss FROM bt),
ps AS (SELECT shard, avg(loss) AS mean, count(*) AS n_batches FROM bl WHERE NOT isnan(loss) AND NOT isinf(loss) GROUP BY shard)"""


def _batches(spark, sf):
    d = V.docs(spark, sf)
    b = d.groupBy("shard", F.floor(F.col("pos") / 4).cast("long").alias("batch")).agg(
        F.min("n_chars").alias("_mn"), F.avg(F.log1p(F.length("text")) / 4).alias("_l"))
    return b.select("shard", "batch", F.when(F.col("_mn") < 40, F.lit(float("nan"))).otherwise(F.col("_l")).alias("loss"))


@register("a6_shard_loss", f"WITH {_BATCH_SQL}\nSELECT * FROM ps")
def a6_shard_loss(spark, sf):
    return T.shard_loss(_batches(spark, sf))


@register("a6_shard_loss_summary", f"""WITH {_BATCH_SQL}
SELECT count(*) AS shards, avg(mean) AS mean, median(mean) AS median, max(mean) - min(mean) AS spread,
       stddev_pop(mean) AS stdev FROM ps""")
def a6_shard_loss_summary(spark, sf):
    return T.shard_loss_summary(T.shard_loss(_batches(spark, sf)))


@register("o3_worst_best_shards", f"""WITH {_BATCH_SQL}
SELECT * FROM (SELECT 'worst' AS side, shard, mean, row_number() OVER (ORDER BY mean DESC, shard) AS place FROM ps) WHERE place <= 8
UNION ALL
SELECT * FROM (SELECT 'best', shard, mean, row_number() OVER (ORDER BY mean, shard) AS place FROM ps) WHERE place <= 5""")
def o3_worst_best_shards(spark, sf):
    ps = T.shard_loss(_batches(spark, sf)).withColumn("_g", F.lit(1))
    worst = first_n(ps, ["_g"], [F.col("mean").desc(), F.col("shard")], 8, "place").select(
        F.lit("worst").alias("side"), "shard", "mean", F.col("place").cast("long").alias("place"))
    best = first_n(ps, ["_g"], [F.col("mean"), F.col("shard")], 5, "place").select(
        F.lit("best").alias("side"), "shard", "mean", F.col("place").cast("long").alias("place"))
    return worst.unionByName(best)


# ------------------------------------------------------------------ A3, A4, A5, C10, C15
TRAIN_FIELDS = ["peak_lr", "data_rank", "dataset_class"]


_A3_SQL = """
s3 AS (SELECT * FROM trainlog WHERE validator_val_loss IS NOT NULL),
st3 AS (SELECT 'peak_lr' AS field, peak_lr AS value, validator_val_loss AS l FROM s3
        UNION ALL SELECT 'data_rank', data_rank, validator_val_loss FROM s3
        UNION ALL SELECT 'dataset_class', dataset_class, validator_val_loss FROM s3),
g3 AS (SELECT field, value, round(avg(l), 9) AS mean_loss, count(*) AS n FROM st3 WHERE value IS NOT NULL GROUP BY field, value),
a3 AS (SELECT * FROM g3 WHERE field IN (SELECT field FROM g3 GROUP BY field HAVING count(*) >= 2))"""


@register("a3_setting_effect", f"WITH {_A3_SQL}\nSELECT * FROM a3")
def a3_setting_effect(spark, sf):
    return _rounded(T.setting_effect(V.trainlog(spark, sf), TRAIN_FIELDS), "mean_loss")


_A4_SQL = """
a4 AS (SELECT uid, count(*) AS n_scored, min(validator_val_loss) AS best_loss,
              arg_min(peak_lr, (validator_val_loss, pos)) AS peak_lr, arg_min(data_rank, (validator_val_loss, pos)) AS data_rank
       FROM trainlog WHERE validator_val_loss IS NOT NULL GROUP BY uid)"""


@register("a4_best_record", f"WITH {_A4_SQL}\nSELECT * FROM a4")
def a4_best_record(spark, sf):
    return T.best_record(V.trainlog(spark, sf), ["peak_lr", "data_rank"])


@register("a5_local_gap", f"""
SELECT round(avg(validator_val_loss - local_eval), 9) AS mean_gap, count(*) AS n FROM trainlog
WHERE validator_val_loss IS NOT NULL AND local_eval IS NOT NULL""")
def a5_local_gap(spark, sf):
    return _rounded(T.local_gap(V.trainlog(spark, sf)), "mean_gap")


@register("c15_settings_report", f"""WITH {_A4_SQL},
gp AS (SELECT uid, round(avg(validator_val_loss - local_eval), 9) AS mean_gap FROM trainlog
       WHERE validator_val_loss IS NOT NULL AND local_eval IS NOT NULL GROUP BY uid),
{_A3_SQL}
SELECT 'best' AS section, uid, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS value, n_scored AS n,
       round(best_loss, 9) AS loss, peak_lr, data_rank, mean_gap FROM a4 LEFT JOIN gp USING (uid)
UNION ALL SELECT 'effect', NULL, field, value, n, mean_loss, NULL, NULL, NULL FROM a3
UNION ALL SELECT 'totals', NULL, 'records', NULL, count(*), NULL, NULL, NULL, NULL FROM trainlog
UNION ALL SELECT 'totals', NULL, 'scored', NULL, count(validator_val_loss), NULL, NULL, NULL, NULL FROM trainlog""")
def c15_settings_report(spark, sf):
    """Best record per uid with its mean gap, effect of each setting, record totals."""
    tl = V.trainlog(spark, sf)
    none = lambda kind: F.lit(None).cast(kind)
    gap = T.local_gap(tl, ["uid"]).select("uid", "mean_gap")
    best = T.best_record(tl, ["peak_lr", "data_rank"]).join(gap, "uid", "left").select(
        F.lit("best").alias("section"), "uid", none("string").alias("field"), none("string").alias("value"),
        F.col("n_scored").alias("n"), F.col("best_loss").alias("loss"), "peak_lr", "data_rank", "mean_gap")
    rest = [F.lit(None).cast(k).alias(c) for c, k in (("peak_lr", "string"), ("data_rank", "string"), ("mean_gap", "double"))]
    effect = T.setting_effect(tl, TRAIN_FIELDS).select(
        F.lit("effect").alias("section"), none("long").alias("uid"), "field", "value", "n",
        F.col("mean_loss").alias("loss"), *rest)
    sums = tl.agg(F.count(F.lit(1)).alias("records"), F.count("validator_val_loss").alias("scored"))
    totals = sums.select(F.explode(F.create_map(F.lit("records"), "records", F.lit("scored"), "scored")).alias("field", "n")).select(
        F.lit("totals").alias("section"), none("long").alias("uid"), "field", none("string").alias("value"), "n",
        none("double").alias("loss"), *rest)
    return _rounded(_rounded(best.unionByName(effect).unionByName(totals), "mean_gap"), "loss")


@register("c10_run_record", f"""
WITH {PB.UPLOADS_SQL},
last AS (SELECT uid, cycle, arg_max(peak_lr, pos) AS peak_lr, arg_max(data_rank, pos) AS data_rank,
                     arg_max(local_eval, pos) FILTER (WHERE local_eval IS NOT NULL) AS local_eval
              FROM trainlog GROUP BY uid, cycle),
mr AS (SELECT *, row_number() OVER (PARTITION BY cycle, uid ORDER BY CASE WHEN val_loss IS NULL THEN 1 ELSE 0 END,
                  coalesce(sample_cycle, -1) DESC, CASE WHEN status = 'ok' THEN 1 ELSE 0 END DESC,
                  coalesce(age, 1073741824), pos) AS fresh_rn,
              row_number() OVER (PARTITION BY cycle, uid ORDER BY pos) AS first_rn FROM board),
bd AS (SELECT cycle, uid, max(CASE WHEN fresh_rn = 1 THEN val_loss END) AS validator_val_loss, max(baseline) AS baseline,
              max(CASE WHEN first_rn = 1 THEN repo END) AS repo
       FROM mr GROUP BY cycle, uid),
ev AS (SELECT uid, max(step) AS eval_step, arg_max(loss, step) AS eval_loss FROM curve GROUP BY uid)
SELECT l.uid, l.cycle, l.peak_lr, l.data_rank, l.local_eval, b.validator_val_loss, b.baseline,
       b.baseline - b.validator_val_loss AS delta, b.validator_val_loss - l.local_eval AS local_vs_validator,
       ev.eval_step, ev.eval_loss, u.upload_repo, u.upload_rev, b.repo IS NOT NULL AS on_chain
FROM last l LEFT JOIN bd b ON b.uid = l.uid AND b.cycle = l.cycle LEFT JOIN ev ON ev.uid = l.uid
LEFT JOIN uploads u ON u.uid = l.uid AND u.cycle = l.cycle""")
def c10_run_record(spark, sf):
    tl = V.trainlog(spark, sf)
    last = tl.groupBy("uid", "cycle").agg(
        F.max_by("peak_lr", "pos").alias("peak_lr"), F.max_by("data_rank", "pos").alias("data_rank"),
        F.max(F.when(F.col("local_eval").isNotNull(), F.struct("pos", "local_eval")))["local_eval"].alias("local_eval"))
    m = B.miner_rows(V.board(spark, sf)).select("uid", "cycle", F.col("val_loss").alias("validator_val_loss"), "baseline", "repo")
    up = PB.uploads_by_cycle(L.parsed_lines(V.logs(spark, sf))).select("uid", "cycle", "upload_repo", "upload_rev")
    j = last.join(m, ["uid", "cycle"], "left").join(up, ["uid", "cycle"], "left").join(V.last_points(spark, sf), "uid", "left")
    return j.select("uid", "cycle", "peak_lr", "data_rank", "local_eval", "validator_val_loss", "baseline",
                    B.delta_plain(F.col("validator_val_loss"), F.col("baseline")).alias("delta"),
                    (F.col("validator_val_loss") - F.col("local_eval")).alias("local_vs_validator"),
                    "eval_step", "eval_loss", "upload_repo", "upload_rev", F.col("repo").isNotNull().alias("on_chain"))


# ------------------------------------------------------------------ J5, S9
DEFAULT_PEAK_LR = 3e-4


@register("j5_layered_lookup", """
WITH u AS (SELECT DISTINCT uid FROM board),
pu AS (SELECT uid, peak_lr FROM settings WHERE scope = 'uid'),
sh AS (SELECT peak_lr FROM settings WHERE scope = 'shared')
SELECT u.uid, CASE WHEN pu.uid IS NOT NULL THEN pu.peak_lr WHEN (SELECT count(*) FROM sh) > 0 THEN (SELECT max(peak_lr) FROM sh)
                   ELSE CAST(3e-4 AS DOUBLE) END AS peak_lr,
       CASE WHEN pu.uid IS NOT NULL THEN 'uid' WHEN (SELECT count(*) FROM sh) > 0 THEN 'shared' ELSE 'default' END AS level
FROM u LEFT JOIN pu ON pu.uid = u.uid""")
def j5_layered_lookup(spark, sf):
    uids = V.board(spark, sf).select("uid").distinct()
    return CD.layered_lookup(uids, V.settings(spark, sf), "peak_lr", DEFAULT_PEAK_LR)


@register("s9_read_settings", """
WITH s AS (SELECT uid, CASE WHEN uid % 7 = 0 THEN '{"peak_lr": ' || CAST(peak_lr AS VARCHAR)
                            ELSE '{"peak_lr": ' || CAST(peak_lr AS VARCHAR) || '}' END AS js
           FROM settings WHERE scope = 'uid')
SELECT uid, CASE WHEN json_valid(js) THEN CAST(json_extract(js, '$.peak_lr') AS DOUBLE) END AS peak_lr,
       json_valid(js) AS parsed FROM s""")
def s9_read_settings(spark, sf):
    s = V.settings(spark, sf).filter(F.col("scope") == "uid")
    body = F.concat(F.lit('{"peak_lr": '), F.col("peak_lr").cast("string"))
    js = s.select("uid", F.when(F.col("uid") % 7 == 0, body).otherwise(F.concat(body, F.lit("}"))).alias("json"))
    r = read_settings(js)
    return r.select("uid", F.col("settings.peak_lr").alias("peak_lr"), F.col("settings").isNotNull().alias("parsed"))


# ------------------------------------------------------------------ F6, F7, O6 (candidates)
CUR_VER, WANT_GROUP = 2, 2
CUR_REV_OF = 1  # the held revision is the one uid 1 advertises


@register("f6_eligible_candidates", f"""
WITH cur AS (SELECT substr(md5('{CUR_REV_OF}'), 1, 7) AS r),
s1 AS (SELECT c.* FROM cand c, cur WHERE c.ver > {CUR_VER} OR (c.rev IS NOT NULL AND c.rev <> cur.r)),
s2 AS (SELECT *, count(*) OVER () AS n FROM s1)
SELECT uid, ver, rev, grp FROM s2 WHERE n <= 1 OR grp IS NULL OR grp = {WANT_GROUP}""")
def f6_eligible_candidates(spark, sf):
    import hashlib

    cur_rev = hashlib.md5(str(CUR_REV_OF).encode()).hexdigest()[:7]
    return CD.eligible_candidates(V.cand(spark, sf), CUR_VER, cur_rev, WANT_GROUP).select("uid", "ver", "rev", "grp")


def _cand_files(spark, sf):
    c = V.cand(spark, sf).filter((F.col("uid") % 5 != 0) & (F.col("n_files") > 0))
    f = c.select("uid", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_files"))).alias("i"))
    return f.select("uid", ((F.col("i") == 1) & (F.col("uid") % 2 == 0)).alias("hidden"))


@register("f7_reject_empty_artifacts", """
WITH f AS (SELECT uid, unnest(range(1, n_files + 1)) AS i FROM cand WHERE uid % 5 <> 0 AND n_files > 0),
v AS (SELECT uid, count(CASE WHEN NOT (i = 1 AND uid % 2 = 0) THEN 1 END) > 0 AS has_payload FROM f GROUP BY uid)
SELECT c.uid, v.has_payload FROM cand c LEFT JOIN v USING (uid) WHERE coalesce(v.has_payload, true)""")
def f7_reject_empty_artifacts(spark, sf):
    return CD.reject_empty_artifacts(V.cand(spark, sf), _cand_files(spark, sf)).select("uid", "has_payload")


SUFFIX_PREFERENCE = [".safetensors", ".bin", ".pt"]


@register("o6_candidates_by_stake", """
WITH fs AS (SELECT uid, unnest(CASE uid % 3 WHEN 0 THEN ['.pt', '.bin'] WHEN 1 THEN ['.pt'] ELSE ['.bin', '.safetensors'] END) AS suffix FROM cand),
pr AS (SELECT * FROM (VALUES ('.safetensors', 0), ('.bin', 1), ('.pt', 2)) t(suffix, p)),
ch AS (SELECT uid, arg_min(suffix, p) AS chosen_suffix FROM fs JOIN pr USING (suffix) GROUP BY uid)
SELECT c.uid, row_number() OVER (ORDER BY coalesce(c.stake, 0) DESC, c.uid) AS stake_rank, ch.chosen_suffix
FROM cand c LEFT JOIN ch USING (uid)""")
def o6_candidates_by_stake(spark, sf):
    c = V.cand(spark, sf)
    sfx = F.when(F.col("uid") % 3 == 0, F.array(F.lit(".pt"), F.lit(".bin"))) \
        .when(F.col("uid") % 3 == 1, F.array(F.lit(".pt"))).otherwise(F.array(F.lit(".bin"), F.lit(".safetensors")))
    files = c.select("uid", F.explode(sfx).alias("suffix"))
    ch = CD.first_existing_suffix(files, SUFFIX_PREFERENCE)
    return (CD.rank_by_stake(c).join(ch, "uid", "left")
            .select("uid", F.col("stake_rank").cast("long").alias("stake_rank"), "chosen_suffix"))


@register("f8_scope", """
SELECT uid, grp, step FROM curve WHERE grp IN ('click', 'view', 'purchase') AND uid IN (SELECT DISTINCT uid FROM board WHERE repo IS NOT NULL)""")
def f8_scope(spark, sf):
    allowed = V.board(spark, sf).filter(F.col("repo").isNotNull()).select("uid").distinct()
    c = T.scope(V.curve(spark, sf), groups=W6_GROUPS)
    return c.join(allowed, "uid", "left_semi").select("uid", "grp", "step")
