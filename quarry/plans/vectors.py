"""Update-vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import board as B
from quarry.operators import vectors as VX
from quarry.plans.board import MINERS_SQL, miners
from quarry.plans.registry import register
from quarry.sources import fixtures as V

OURS = 1


def _dot(a: str, b: str) -> str:
    return f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i]), lambda acc, x: acc + x)"


def _sub(a: str, b: str) -> str:
    return f"list_transform(range(1, len({a}) + 1), lambda i: {a}[i] - {b}[i])"


TV_SQL = f"""
tv AS (SELECT party, k, name, CAST(vals AS DOUBLE[]) AS v FROM tensor),
base AS (SELECT k, v AS b FROM tv WHERE party = 0),
wb AS (SELECT t.party, t.k, t.name, t.v, b.b, len(t.v) = len(b.b) AS shape_ok FROM tv t JOIN base b USING (k) WHERE t.party <> 0),
wd AS (SELECT *, {_sub('v', 'b')} AS d FROM wb WHERE shape_ok)"""

LAYER_SQL = """CASE WHEN list_position(string_split(name, '.'), 'layers') > 0
                 AND list_position(string_split(name, '.'), 'layers') < len(string_split(name, '.'))
            THEN string_split(name, '.')[list_position(string_split(name, '.'), 'layers') + 1] ELSE 'other' END"""


def wb(spark, sf):
    return VX.with_base(V.tensor(spark, sf))


@register("v1_delta", f"WITH {TV_SQL}\nSELECT party, k, d AS delta FROM wd")
def v1_delta(spark, sf):
    return wb(spark, sf).filter("shape_ok").select("party", "k", "delta")


@register("v2_update_norms", f"""WITH {TV_SQL}
SELECT party, sum({_dot('d', 'd')}) AS norm2, count(*) AS n_keys FROM wd GROUP BY party""")
def v2_update_norms(spark, sf):
    return VX.update_norms(wb(spark, sf))


@register("j7_tensor_join", f"""WITH {TV_SQL}
SELECT w.party, count(*) AS n_keys, count(o.k) AS n_with_ours FROM wd w
LEFT JOIN (SELECT k FROM wd WHERE party = {OURS}) o ON o.k = w.k WHERE w.party <> {OURS} GROUP BY w.party""")
def j7_tensor_join(spark, sf):
    w = wb(spark, sf).filter("shape_ok")
    mine = w.filter(F.col("party") == OURS).select("k", F.lit(1).alias("_o"))
    return (w.filter(F.col("party") != OURS).join(mine, "k", "left").groupBy("party")
            .agg(F.count(F.lit(1)).alias("n_keys"), F.count("_o").alias("n_with_ours")))


@register("v3_pair_cosine", f"""WITH {TV_SQL},
p AS (SELECT x.d AS da, y.d AS db FROM wd x JOIN wd y ON x.k = y.k WHERE x.party = 2 AND y.party = {OURS}),
s AS (SELECT sum({_dot('da', 'db')}) AS dot, sum({_dot('da', 'da')}) AS a2, sum({_dot('db', 'db')}) AS b2 FROM p)
SELECT 2 AS a, {OURS} AS b, dot, CASE WHEN a2 > 0 AND b2 > 0 THEN dot / (sqrt(a2) * sqrt(b2)) END AS cosine FROM s""")
def v3_pair_cosine(spark, sf):
    return VX.pair_cosine(wb(spark, sf), 2, OURS)


_GRAM_SQL = f"""
ck AS (SELECT k FROM tv GROUP BY k HAVING count(DISTINCT party) = (SELECT count(DISTINCT party) FROM tv)),
dd AS (SELECT t.party, t.k, {_sub('t.v', 'b.b')} AS d FROM tv t JOIN base b USING (k)
       WHERE t.party <> 0 AND k IN (SELECT k FROM ck)),
g AS (SELECT x.party AS i, y.party AS j, sum({_dot('x.d', 'y.d')}) AS dot, count(*) AS n_keys
      FROM dd x JOIN dd y ON x.k = y.k AND x.party <= y.party GROUP BY 1, 2),
bn AS (SELECT sqrt(sum({_dot('b', 'b')})) AS base_norm FROM base WHERE k IN (SELECT k FROM ck)),
dg AS (SELECT i AS p, sqrt(greatest(0, dot)) AS norm FROM g WHERE i = j)"""


@register("v4_gram", f"""WITH {TV_SQL},{_GRAM_SQL}
SELECT g.i, g.j, g.dot, a.norm AS norm_i, c.norm AS norm_j, a.norm / bn.base_norm AS rel_i,
       CASE WHEN a.norm > 0 AND c.norm > 0 THEN g.dot / (a.norm * c.norm) ELSE CAST('NaN' AS DOUBLE) END AS cosine,
       bn.base_norm, g.n_keys
FROM g JOIN dg a ON a.p = g.i JOIN dg c ON c.p = g.j JOIN bn ON true""")
def v4_gram(spark, sf):
    return VX.gram(V.tensor(spark, sf))


@register("j8_self_pairs", f"""WITH {TV_SQL},{_GRAM_SQL}
SELECT i, j, n_keys FROM g""")
def j8_self_pairs(spark, sf):
    return VX.pair_keys(V.tensor(spark, sf))


@register("u1_common_keys", """
SELECT k FROM tensor GROUP BY k HAVING count(DISTINCT party) = (SELECT count(DISTINCT party) FROM tensor)""")
def u1_common_keys(spark, sf):
    return VX.common_keys(V.tensor(spark, sf))


@register("u2_key_difference", """
WITH b AS (SELECT DISTINCT k FROM tensor WHERE party = 0),
h AS (SELECT DISTINCT party, k FROM tensor WHERE party <> 0),
t AS (SELECT h.party, count(b.k) AS shared, count(*) - count(b.k) AS only_other FROM h LEFT JOIN b USING (k) GROUP BY h.party)
SELECT party, shared, (SELECT count(*) FROM b) - shared AS only_base, only_other FROM t""")
def u2_key_difference(spark, sf):
    return VX.key_difference(V.tensor(spark, sf))


_DIST_SQL = f"""
badt AS (SELECT DISTINCT party, name FROM wb WHERE NOT shape_ok),
pt AS (SELECT party, name, sum({_dot('d', 'd')}) AS sq, sum({_dot('b', 'b')}) AS rn, sum({_dot('b', 'v')}) AS ab,
              sum({_dot('v', 'v')}) AS bb, bool_and(v = b) AS same FROM wd ANTI JOIN badt USING (party, name) GROUP BY party, name),
pr AS (SELECT *, CASE WHEN rn > 0 THEN sqrt(sq / rn) ELSE 0.0 END AS rel,
              row_number() OVER (PARTITION BY party ORDER BY CASE WHEN rn > 0 THEN sqrt(sq / rn) ELSE 0.0 END DESC, name) AS rk FROM pt),
dist AS (SELECT party, count(*) AS tensors, count(CASE WHEN same THEN 1 END) AS identical,
                (SELECT count(*) FROM badt w WHERE w.party = pr.party) AS shape_mismatch,
                CASE WHEN sum(rn) > 0 THEN sqrt(sum(sq) / sum(rn)) ELSE CAST('NaN' AS DOUBLE) END AS rel_l2,
                CASE WHEN sum(rn) > 0 AND sum(bb) > 0 THEN sum(ab) / (sqrt(sum(rn)) * sqrt(sum(bb))) ELSE CAST('NaN' AS DOUBLE) END AS cosine,
                max(CASE WHEN rk = 1 THEN rel END) AS max_rel, max(CASE WHEN rk = 1 THEN name END) AS max_rel_tensor
         FROM pr GROUP BY party)"""


@register("v5_relative_l2", f"WITH {TV_SQL},{_DIST_SQL}\nSELECT party, rel_l2, cosine FROM dist")
def v5_relative_l2(spark, sf):
    return VX.distance(wb(spark, sf)).select("party", "rel_l2", "cosine")


@register("v6_identical_tensors", f"WITH {TV_SQL},{_DIST_SQL}\nSELECT party, tensors, identical, shape_mismatch FROM dist")
def v6_identical_tensors(spark, sf):
    return VX.distance(wb(spark, sf)).select("party", "tensors", "identical", "shape_mismatch")


@register("v7_largest_change", f"WITH {TV_SQL},{_DIST_SQL}\nSELECT party, max_rel, max_rel_tensor FROM dist")
def v7_largest_change(spark, sf):
    return VX.distance(wb(spark, sf)).select("party", "max_rel", "max_rel_tensor")


@register("c17_distance_report", f"""WITH {TV_SQL},{_DIST_SQL},
b0 AS (SELECT DISTINCT k FROM tensor WHERE party = 0),
h AS (SELECT DISTINCT party, k FROM tensor WHERE party <> 0),
u AS (SELECT h.party, count(b0.k) AS shared, count(*) - count(b0.k) AS only_other FROM h LEFT JOIN b0 USING (k) GROUP BY h.party)
SELECT d.*, u.shared, (SELECT count(*) FROM b0) - u.shared AS only_base, u.only_other FROM dist d JOIN u USING (party)""")
def c17_distance_report(spark, sf):
    t = V.tensor(spark, sf)
    return VX.distance(VX.with_base(t)).join(VX.key_difference(t), "party")


_LAYER_SQL = f"""
riv AS (SELECT w.party, {LAYER_SQL} AS layer, w.d, o.d AS od FROM wd w
        LEFT JOIN (SELECT k, d FROM wd WHERE party = {OURS}) o USING (k) WHERE w.party <> {OURS}),
ls AS (SELECT party, layer, sum({_dot('d', 'd')}) AS t2,
              sum(CASE WHEN od IS NOT NULL THEN {_dot('od', 'od')} END) AS o2,
              sum(CASE WHEN od IS NOT NULL THEN {_dot('d', 'od')} END) AS ldot,
              count(CASE WHEN {_dot('d', 'd')} > 0 THEN 1 END) AS changed, count(*) AS chunks FROM riv GROUP BY party, layer),
ls2 AS (SELECT *, CASE WHEN t2 > 0 AND o2 > 0 THEN ldot / (sqrt(t2) * sqrt(o2)) END AS layer_cos,
               row_number() OVER (PARTITION BY party ORDER BY t2 DESC, layer) AS by_magnitude FROM ls)"""


@register("v8_layer_stats", f"WITH {TV_SQL},{_LAYER_SQL}\nSELECT * FROM ls2")
def v8_layer_stats(spark, sf):
    return VX.layer_stats(wb(spark, sf), OURS)


_V9_SQL = """
v9 AS (SELECT party, CAST(sum(changed) AS BIGINT) AS n_changed, CAST(sum(chunks) AS BIGINT) AS n_chunks,
              count(CASE WHEN layer_cos > 0.1 THEN 1 END) AS aligned, count(CASE WHEN layer_cos < -0.1 THEN 1 END) AS opposed,
              count(layer_cos) AS layers_with_cos, min(layer_cos) AS cos_min, max(layer_cos) AS cos_max FROM ls2 GROUP BY party)"""


@register("v9_layer_summary", f"WITH {TV_SQL},{_LAYER_SQL},{_V9_SQL}\nSELECT * FROM v9")
def v9_layer_summary(spark, sf):
    return VX.layer_summary(VX.layer_stats(wb(spark, sf), OURS))


_O4_SQL = """
o4 AS (SELECT party, layer, t2 / CASE WHEN sum(t2) OVER (PARTITION BY party) > 0 THEN sum(t2) OVER (PARTITION BY party) ELSE 1.0 END AS share,
              row_number() OVER (PARTITION BY party ORDER BY t2 DESC, layer) AS place FROM ls2)"""


@register("o4_top_layers", f"WITH {TV_SQL},{_LAYER_SQL},{_O4_SQL}\nSELECT * FROM o4 WHERE place <= 6")
def o4_top_layers(spark, sf):
    return VX.top_layers(VX.layer_stats(wb(spark, sf), OURS), 6)


@register("a22_element_counts", """
WITH e AS (SELECT party, CASE WHEN name LIKE 'embed%' THEN 'bfloat16' ELSE 'float32' END AS dtype,
                  CAST(len(vals) AS BIGINT) AS n, name NOT LIKE 'embed%' AS tr FROM tensor)
SELECT party, dtype, count(*) AS chunks, CAST(sum(n) AS BIGINT) AS elements, CAST(sum(CASE WHEN tr THEN n ELSE 0 END) AS BIGINT) AS trainable,
       sum(CASE WHEN tr THEN n ELSE 0 END) / sum(n) AS trainable_share FROM e GROUP BY party, dtype""")
def a22_element_counts(spark, sf):
    t = V.tensor(spark, sf)
    emb = F.col("name").startswith("embed")
    shape = F.array(F.lit(1), F.size("vals"))
    out = VX.element_counts(t, F.when(emb, "bfloat16").otherwise("float32"), ~emb, shape)
    return out.select("party", "dtype", "chunks", "elements", "trainable", "trainable_share")


RIVALS = 6


@register("c13_compare_report", f"""WITH {MINERS_SQL},{TV_SQL},{_LAYER_SQL},{_V9_SQL},{_O4_SQL},
nrm AS (SELECT party, sqrt(sum({_dot('d', 'd')})) AS delta_norm FROM wd GROUP BY party),
cs AS (SELECT x.party, sum({_dot('x.d', 'y.d')}) / (sqrt(sum({_dot('x.d', 'x.d')})) * sqrt(sum({_dot('y.d', 'y.d')}))) AS cos_to_ours
       FROM wd x JOIN wd y ON x.k = y.k AND y.party = {OURS} WHERE x.party <> {OURS} GROUP BY x.party),
tl AS (SELECT party, list(layer ORDER BY place) AS top_layers FROM o4 WHERE place <= 6 GROUP BY party),
field AS (SELECT uid, val_loss, row_number() OVER (ORDER BY val_loss, uid) AS rank FROM miners
          WHERE cycle = (SELECT max(cycle) FROM miners) AND val_loss IS NOT NULL AND repo IS NOT NULL AND uid NOT IN (1, 2, 3)),
lead AS (SELECT *, CAST(uid % 2 + 2 AS INT) AS party FROM field WHERE rank <= {RIVALS})
SELECT lead.rank, lead.uid, lead.val_loss, lead.party, nrm.delta_norm, cs.cos_to_ours, v9.n_changed, v9.n_chunks, v9.aligned, v9.opposed,
       v9.cos_min, v9.cos_max, tl.top_layers
FROM lead LEFT JOIN v9 USING (party) LEFT JOIN nrm USING (party) LEFT JOIN cs USING (party) LEFT JOIN tl USING (party)""")
def c13_compare_report(spark, sf):
    """The board's loss leaders that are not ours and name a repo, each with its
    tensors (of the two rival parties by uid) against ours."""
    last = B.latest_snapshot(miners(spark, sf))
    field = last.filter(F.col("repo").isNotNull() & ~F.col("uid").isin(list(B.OUR_UIDS)))
    lead = B.loss_leaders(field, RIVALS).select(F.col("rank").cast("long").alias("rank"), "uid", "val_loss",
                                                (F.pmod("uid", F.lit(2)) + 2).cast("int").alias("party"))
    w = wb(spark, sf)
    ls = VX.layer_stats(w, OURS)
    v9 = VX.layer_summary(ls)
    nrm = VX.update_norms(w).select("party", F.sqrt("norm2").alias("delta_norm"))
    rivals = v9.select("party")
    cs = rivals.join(
        w.filter(F.col("party") != OURS).select("party", "k", F.col("delta").alias("da"))
         .join(w.filter(F.col("party") == OURS).select("k", F.col("delta").alias("db")), "k")
         .groupBy("party").agg(F.sum(VX.dot(F.col("da"), F.col("db"))).alias("_d"),
                               F.sum(VX.dot(F.col("da"), F.col("da"))).alias("_a"),
                               F.sum(VX.dot(F.col("db"), F.col("db"))).alias("_b"))
         .select("party", (F.col("_d") / (F.sqrt("_a") * F.sqrt("_b"))).alias("cos_to_ours")), "party", "left")
    tl = (VX.top_layers(ls, 6).groupBy("party")
          .agg(F.array_sort(F.collect_list(F.struct("place", "layer"))).alias("_t"))
          .select("party", F.transform("_t", lambda x: x["layer"]).alias("top_layers")))
    return (lead.join(v9, "party", "left").join(nrm, "party", "left").join(cs, "party", "left").join(tl, "party", "left")
              .select("rank", "uid", "val_loss", "party", "delta_norm", "cos_to_ours", "n_changed", "n_chunks", "aligned", "opposed",
                      "cos_min", "cos_max", "top_layers"))
