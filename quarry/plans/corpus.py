"""Corpus queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.operators import corpus as C
from quarry.operators.ordering import sequence_within
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import fixtures as V
from quarry.sources.files import current_version, read_corpus, repack
from quarry.sources.tables import load

# Query parameters: row budgets in thousandths of the corpus, so samples grow with it; the nominal
# shard of C2 is a little larger than the mean one, as an estimate would be.
C1_SHARE, A18_SHARE, C2_SHARE, C2_NOMINAL_SHARE = 300, 600, 200, 60
C2_SHARDS = 7
MIX_WEIGHTS = [("en", 0.5, 0), ("fr", 0.2, 1), ("de", 0.2, 2), ("es", 0.1, 3)]
SEQ_LEN = 64
SEED = "5eed"


def budget(spark: SparkSession, sf: str, share: int) -> int:
    """Rows of ``share`` thousandths of the corpus, from the file footers."""
    return load(spark, sf, "documents").count() * share // 1000


def budget_sql(share: int) -> str:
    return f"(SELECT count(*) * {share} // 1000 FROM documents)"


def quota_sql(cat: str, rows: int | str) -> str:
    """CTEs turning catalogue ``cat(ord, n_rows, ...)`` into ``quotas``."""
    return f"""
q0 AS (SELECT *, count(*) OVER () AS n_, least(CAST({rows} AS BIGINT), sum(n_rows) OVER ()) AS rr,
        row_number() OVER (ORDER BY n_rows, ord) AS r,
        coalesce(sum(n_rows) OVER (ORDER BY n_rows, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sprev
       FROM {cat}),
q1 AS (SELECT *, min(CASE WHEN n_rows * (n_ - r + 1) + sprev > rr THEN r END) OVER () AS fr FROM q0),
q2 AS (SELECT *, max(CASE WHEN r = fr THEN sprev END) OVER () AS sk FROM q1),
q3 AS (SELECT *, (rr - sk) // (n_ - fr + 1) AS lvl, coalesce(fr IS NOT NULL AND r >= fr, false) AS unc FROM q2),
q4 AS (SELECT *, rr - sk - lvl * (n_ - fr + 1) AS rem,
        sum(CAST(unc AS INT)) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS urank FROM q3),
quotas AS (SELECT * EXCLUDE (n_, rr, r, sprev, fr, sk, lvl, unc, rem, urank),
        CAST(CASE WHEN NOT unc THEN n_rows ELSE lvl + CASE WHEN urank <= rem THEN 1 ELSE 0 END END AS BIGINT) AS quota
        FROM q4)"""


# ------------------------------------------------------------------ sources
@register("s3_read_corpus", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index, length(text) AS n_chars FROM documents""")
def s3_read_corpus(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_corpus(spark, f"{sf}/documents.parquet", extra=["doc_id"])
    return rows.select("doc_id", "row_index", F.length("text").cast("long").alias("n_chars"))


@register("w14_global_index", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS gidx FROM documents""")
def w14_global_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_corpus(spark, f"{sf}/documents.parquet", extra=["doc_id"])
    return C.global_index(rows).select("doc_id", "gidx")


REPACK_FILES = 7


def _repacked(spark: SparkSession, sf: str) -> DataFrame:
    """The documents repacked, read back with the number of their file and their place in it."""
    root = scratch_path(spark, f"repack-{uuid.uuid4().hex[:10]}")
    repack(C.global_index(read_corpus(spark, f"{sf}/documents.parquet", extra=["doc_id"])).select("doc_id", "text", "gidx"),
           root, REPACK_FILES)
    return (spark.read.parquet(current_version(root, spark))
            .select("doc_id", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long").alias("file_id"),
                    F.col("_metadata.row_index").alias("pos")))


@register("s16_repack", f"""
WITH g AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS gidx, CAST(ceil(count(*) OVER () / {REPACK_FILES}) AS BIGINT) AS per
           FROM documents)
SELECT doc_id, gidx // per AS file_id, gidx % per AS pos FROM g""")
def s16_repack(spark: SparkSession, sf: str) -> DataFrame:
    return _repacked(spark, sf)


@register("a19_repack_totals", f"""
SELECT count(*) AS rows, count(DISTINCT shard) AS files_before, count(*) AS rows_after, CAST({REPACK_FILES} AS BIGINT) AS files_after,
       CAST(ceil(count(*) / {REPACK_FILES}) AS BIGINT) AS rows_per_file FROM docs""")
def a19_repack_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals by source before, and as read back from the repacked files."""
    before = load(spark, sf, "documents").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("source").alias("files_before"))
    after = (_repacked(spark, sf).groupBy("file_id").agg(F.count(F.lit(1)).alias("_n"))
             .agg(F.sum("_n").alias("rows_after"), F.count(F.lit(1)).alias("files_after"), F.max("_n").alias("rows_per_file")))
    both = before.unionByName(after, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


# ------------------------------------------------------------------ filters
@register("f1_min_chars_gate", "SELECT shard, pos, doc_id FROM docs WHERE length(text) >= 200")
def f1_min_chars_gate(spark, sf):
    return C.min_chars_gate(V.docs(spark, sf), 200).select("shard", "pos", "doc_id")


@register("f2_non_empty", """
SELECT shard, pos, doc_id FROM docs WHERE pos % 3 = 1 AND pos >= 1 AND text IS NOT NULL AND text <> ''""")
def f2_non_empty(spark, sf):
    return C.non_empty(C.rank_stripe(V.docs(spark, sf), 1, 3)).select("shard", "pos", "doc_id")


@register("f9_stride_sample", """
SELECT shard, pos, doc_id FROM docs WHERE pos % 4 = 0 AND length(text) >= 200""")
def f9_stride_sample(spark, sf):
    return C.min_chars_gate(C.stride_sample(V.docs(spark, sf), 4)).select("shard", "pos", "doc_id")


@register("f10_rank_stripe", "SELECT shard, pos, doc_id FROM docs WHERE pos % 3 = 2 AND pos >= 2")
def f10_rank_stripe(spark, sf):
    return C.rank_stripe(V.docs(spark, sf), 2, 3).select("shard", "pos", "doc_id")


@register("f12_spread_shards", """
WITH cat AS (SELECT shard, ord, count(*) AS n_rows FROM docs GROUP BY shard, ord)
SELECT shard, ord, n_rows FROM (SELECT *, greatest(1, count(*) OVER () // 7) AS step FROM cat)
WHERE ord % step = 0 AND ord // step < 7""")
def f12_spread_shards(spark, sf):
    return C.spread_shards(C.shard_catalog(V.docs(spark, sf, numbered=False)), 7).select("shard", "ord", "n_rows")


# ------------------------------------------------------------------ A18, C1, C2
@register("a18_quota_allocation", f"""
WITH cat AS (SELECT shard, lang, row_number() OVER (ORDER BY shard, lang) - 1 AS ord, count(*) AS n_rows
             FROM docs GROUP BY shard, lang),
{quota_sql('cat', budget_sql(A18_SHARE))}
SELECT shard, lang, ord, n_rows, quota FROM quotas""")
def a18_quota_allocation(spark, sf):
    cat = (V.docs(spark, sf, numbered=False).groupBy("shard", "lang").agg(F.count(F.lit(1)).alias("n_rows"))
           .withColumn("ord", (F.row_number().over(Window.orderBy("shard", "lang")) - 1).cast("long")))
    return C.allocate_quotas(cat, budget(spark, sf, A18_SHARE)).select("shard", "lang", "ord", "n_rows", "quota")


@register("c1_uniform_shard_sample", f"""
WITH cat AS (SELECT shard, ord, count(*) AS n_rows FROM docs GROUP BY shard, ord),
{quota_sql('cat', budget_sql(C1_SHARE))},
cnd AS (SELECT d.shard, d.pos, d.doc_id, d.n_chars, d.text, q.quota, greatest(1, q.n_rows // q.quota) AS stride
         FROM docs d JOIN quotas q ON d.shard = q.shard WHERE q.quota > 0),
surv AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS si
         FROM cnd WHERE pos % stride = 0 AND length(text) >= 200)
SELECT shard, pos, doc_id, n_chars, quota FROM surv WHERE si < quota""")
def c1_uniform_shard_sample(spark, sf):
    out = C.uniform_shard_sample(V.docs(spark, sf), budget(spark, sf, C1_SHARE), 200)
    return out.select("shard", "pos", "doc_id", "n_chars", "quota")


@register("w15_first_quota_survivors", """
WITH cnd AS (SELECT shard, pos, doc_id, CAST(5 + ord % 4 AS BIGINT) AS quota FROM docs WHERE length(text) >= 200),
surv AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS si FROM cnd)
SELECT shard, pos, doc_id, quota FROM surv WHERE si < quota""")
def w15_first_quota_survivors(spark, sf):
    d = C.min_chars_gate(V.docs(spark, sf)).withColumn("quota", (5 + F.col("ord") % 4).cast("long"))
    return C.first_quota_survivors(d).select("shard", "pos", "doc_id", "quota")


@register("c2_spread_sample", f"""
WITH cat AS (SELECT shard, ord, count(*) AS n_rows FROM docs GROUP BY shard, ord),
picks AS (SELECT shard FROM (SELECT *, greatest(1, count(*) OVER () // {C2_SHARDS}) AS step FROM cat)
          WHERE ord % step = 0 AND ord // step < {C2_SHARDS}),
pq AS (SELECT shard, greatest(1, {budget_sql(C2_SHARE)} // count(*) OVER ()) AS quota FROM picks),
cnd AS (SELECT d.shard, d.pos, d.doc_id, p.quota, greatest(1, {budget_sql(C2_NOMINAL_SHARE)} // p.quota) AS stride
         FROM docs d JOIN pq p ON d.shard = p.shard WHERE length(d.text) >= 200),
surv AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS si FROM cnd WHERE pos % stride = 0)
SELECT shard, pos, doc_id, quota FROM surv WHERE si < quota""")
def c2_spread_sample(spark, sf):
    out = C.spread_sample(V.docs(spark, sf), budget(spark, sf, C2_SHARE), C2_SHARDS, budget(spark, sf, C2_NOMINAL_SHARE))
    return out.select("shard", "pos", "doc_id", "quota")


# ------------------------------------------------------------------ W13, O7
@register("w13_prefix_dedup", """
SELECT shard, pos, doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY shard, left(text, 200) ORDER BY pos) AS rn FROM docs) WHERE rn = 1""")
def w13_prefix_dedup(spark, sf):
    return C.prefix_dedup(V.docs(spark, sf), 200).select("shard", "pos", "doc_id")


@register("o7_head_of_stream", """
SELECT shard, pos, doc_id FROM docs WHERE pos < 5""")
def o7_head_of_stream(spark, sf):
    return C.head_of_stream(V.docs(spark, sf), 5).select("shard", "pos", "doc_id")


# ------------------------------------------------------------------ profiles
@register("a15_composition_audit", """
WITH gs AS (SELECT lang, shard, count(*) AS c FROM docs GROUP BY lang, shard),
g AS (SELECT lang, sum(c) AS rows, count(*) AS shards FROM gs GROUP BY lang),
t AS (SELECT count(DISTINCT shard) AS ts FROM gs)
SELECT lang, CAST(rows AS BIGINT) AS rows, shards, rows / sum(rows) OVER () AS row_share,
       shards / ts AS shard_share, (rows / sum(rows) OVER ()) / (shards / ts) AS ratio
FROM g, t""")
def a15_composition_audit(spark, sf):
    return C.composition_audit(V.docs(spark, sf, numbered=False), "lang")


@register("a16_quality_profile", """
WITH base AS (SELECT shard, count(*) AS rows,
                     avg(CAST(text IS NULL OR text = '' AS DOUBLE)) * 100 AS pct_empty,
                     avg(CAST(coalesce(length(text), 0) < 200 AS DOUBLE)) * 100 AS pct_short
              FROM docs GROUP BY shard),
p AS (SELECT shard, left(text, 200) AS pf, count(*) AS c FROM docs WHERE text IS NOT NULL AND text <> '' GROUP BY 1, 2),
d AS (SELECT shard, sum(CASE WHEN c > 1 THEN c ELSE 0 END) AS dup FROM p GROUP BY shard)
SELECT base.*, coalesce(d.dup, 0) * 100.0 / rows AS pct_dup_prefix FROM base LEFT JOIN d USING (shard)""")
def a16_quality_profile(spark, sf):
    return C.quality_profile(V.docs(spark, sf, numbered=False), "shard", 200)


@register("a17_length_profile", """
SELECT shard, median(length(text)) AS median_chars, min(length(text)) AS min_chars,
       max(length(text)) AS max_chars, count(*) AS rows FROM docs GROUP BY shard""")
def a17_length_profile(spark, sf):
    return C.length_profile(V.docs(spark, sf, numbered=False), "shard")


# ------------------------------------------------------------------ C3, F11
def _mixture(spark, sf) -> DataFrame:
    # within a source a line's place follows its doc_id
    d = V.docs(spark, sf, numbered=False).select(F.col("lang").alias("src"), "ord", "doc_id")
    d = sequence_within(d, ["src"], ["ord", "doc_id"], "k")
    weights = spark.createDataFrame(MIX_WEIGHTS, "src string, weight double, sord int")
    return C.weighted_mixture(d, weights, load(spark, sf, "documents").count())


_MIX_SQL = f"""
w AS (SELECT * FROM (VALUES {", ".join(f"('{s}', CAST({w} AS DOUBLE), {o})" for s, w, o in MIX_WEIGHTS)}) t(src, weight, sord)),
wn AS (SELECT *, weight / sum(weight) OVER () AS wnorm, (SELECT count(*) FROM docs) AS n FROM w),
draws AS (SELECT src, sord, weight, unnest(range(0, CAST(ceil(n * wnorm) + 2 AS BIGINT))) AS j FROM wn),
ranked AS (SELECT *, row_number() OVER (ORDER BY (j + 0.5) / weight, sord) - 1 AS mix_idx FROM draws),
streams AS (SELECT lang AS src, doc_id, row_number() OVER (PARTITION BY lang ORDER BY ord, pos) - 1 AS k,
                   count(*) OVER (PARTITION BY lang) AS n_s FROM docs),
mix AS (SELECT r.mix_idx, r.src, r.j, s.doc_id FROM ranked r JOIN streams s ON s.src = r.src AND s.k = r.j % s.n_s
        WHERE r.mix_idx < (SELECT count(*) FROM docs))"""


@register("c3_weighted_mixture", f"WITH {_MIX_SQL}\nSELECT mix_idx, src, j, doc_id FROM mix")
def c3_weighted_mixture(spark, sf):
    return _mixture(spark, sf).select("mix_idx", "src", "j", "doc_id")


@register("f11_nested_stripe", f"WITH {_MIX_SQL}\nSELECT mix_idx, src, doc_id FROM mix WHERE mix_idx % 4 = 1")
def f11_nested_stripe(spark, sf):
    return C.nested_stripe(_mixture(spark, sf), 1, 4).select("mix_idx", "src", "doc_id")


# ------------------------------------------------------------------ C4
C4_CONFIGS = [(0, 3), (1, 3), (2, 3), (1, 4)]


@register("c4_striped_split", """
WITH cfg AS (SELECT * FROM (VALUES (0, 3), (1, 3), (2, 3), (1, 4)) t(rank, world)),
sel AS (SELECT d.doc_id, c.rank, c.world FROM docs d JOIN cfg c ON d.pos % c.world = c.rank AND d.pos >= c.rank),
cnt AS (SELECT doc_id, count(*) AS n_sel FROM sel GROUP BY doc_id)
SELECT rank, world, count(*) AS rows, count(CASE WHEN n_sel > 1 THEN 1 END) AS overlap_rows
FROM sel JOIN cnt USING (doc_id) GROUP BY rank, world""")
def c4_striped_split(spark, sf):
    return C.stripe_overlap(V.docs(spark, sf), C4_CONFIGS)


# ------------------------------------------------------------------ C5, C6
_TOK_SQL = f"""
toks AS (SELECT doc_id, list_transform(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda x: x <> ''),
                                       lambda t: CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT)) AS ids,
                CAST(('0x' || substr(md5(text), 1, 15)) AS BIGINT) AS h FROM docs),
win AS (SELECT doc_id, len(ids) AS n_tokens,
               CASE WHEN len(ids) > {SEQ_LEN} THEN h % (len(ids) - {SEQ_LEN} + 1) ELSE 0 END AS start, ids FROM toks),
win2 AS (SELECT doc_id, n_tokens, start, ids[start + 1 : start + {SEQ_LEN}] AS wnd FROM win)"""


@register("c5_token_window", f"""WITH {_TOK_SQL}
SELECT doc_id, n_tokens, start, len(wnd) AS window_len,
       md5(array_to_string(list_transform(wnd, lambda x: CAST(x AS VARCHAR)), ',')) AS window_md5 FROM win2""")
def c5_token_window(spark, sf):
    # window the token strings, then hash only the window's tokens to ids
    w = C.token_window(X.default_tokens(V.docs(spark, sf, numbered=False)), SEQ_LEN, ids="tokens")
    w = w.withColumn("window", X.ids_of("window"))
    return w.select("doc_id", "n_tokens", "start", F.size("window").cast("long").alias("window_len"),
                    F.md5(F.array_join(F.transform("window", lambda x: x.cast("string")), ",")).alias("window_md5"))


@register("c6_pad_truncate", f"""WITH {_TOK_SQL}
SELECT doc_id, list_resize(wnd[1:{SEQ_LEN}], {SEQ_LEN}, 0) AS input_ids,
       list_resize(list_transform(wnd[1:{SEQ_LEN}], lambda x: 1), {SEQ_LEN}, 0) AS attention_mask,
       list_resize(wnd[1:{SEQ_LEN}], {SEQ_LEN}, -100) AS labels FROM win2""")
def c6_pad_truncate(spark, sf):
    w = C.token_window(X.default_tokens(V.docs(spark, sf, numbered=False)), SEQ_LEN, ids="tokens")
    w = w.withColumn("window", X.ids_of("window"))
    return C.pad_truncate(w, SEQ_LEN, "window").select("doc_id", "input_ids", "attention_mask", "labels")


# ------------------------------------------------------------------ C7, C8, C9
@register("c7_seeded_eval_slice", f"""
WITH sh AS (SELECT lang, shard, count(*) AS n_rows FROM docs GROUP BY lang, shard),
shr AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY shard) - 1 AS si, count(*) OVER (PARTITION BY lang) AS ns FROM sh),
pick AS (SELECT lang, shard, n_rows FROM shr
         WHERE si = CAST(('0x' || substr(sha256(concat_ws(':', 'eval_shard_pick', lang, '{SEED}')), 1, 15)) AS BIGINT) % ns),
rowsin AS (SELECT d.lang, d.shard, d.doc_id, p.n_rows,
                  row_number() OVER (PARTITION BY d.lang, d.shard ORDER BY d.pos) - 1 AS k,
                  CAST(('0x' || substr(sha256(concat_ws(':', 'eval_offset', d.shard, '{SEED}')), 1, 15)) AS BIGINT) % p.n_rows AS off
           FROM docs d JOIN pick p ON d.lang = p.lang AND d.shard = p.shard)
SELECT lang, shard, doc_id, (k - off + n_rows) % n_rows AS slice_pos FROM rowsin
WHERE (k - off + n_rows) % n_rows < 8""")
def c7_seeded_eval_slice(spark, sf):
    return C.seeded_eval_slice(V.docs(spark, sf), SEED, 8, source="lang").select(
        "lang", "shard", "doc_id", "slice_pos")


@register("c8_seeded_shard_order", f"""
WITH cat AS (SELECT DISTINCT shard FROM docs), p AS (SELECT unnest(range(0, 3)) AS pass)
SELECT pass, shard, row_number() OVER (PARTITION BY pass ORDER BY sha256(concat('{SEED}', ':', CAST(pass AS VARCHAR), ':', shard)), shard) - 1 AS rank
FROM cat, p""")
def c8_seeded_shard_order(spark, sf):
    return C.seeded_shard_order(C.shard_catalog(V.docs(spark, sf, numbered=False)).select("shard"), SEED, 3)


@register("c9_pin_check", """
WITH pins AS (SELECT shard, CASE WHEN ord < 18 THEN concat('r', CAST(ord % 3 AS VARCHAR)) END AS pin
              FROM (SELECT DISTINCT shard, ord FROM docs)),
tagged AS (SELECT shard, CASE WHEN doc_id % 97 = 0 THEN 'stale' ELSE concat('r', CAST(ord % 3 AS VARCHAR)) END AS revision FROM docs)
SELECT t.shard, p.pin IS NOT NULL AS pinned, count(*) AS rows,
       count(CASE WHEN p.pin IS NULL OR t.revision IS DISTINCT FROM p.pin THEN 1 END) AS bad_rows,
       p.pin IS NOT NULL AND count(CASE WHEN t.revision IS DISTINCT FROM p.pin THEN 1 END) = 0 AS ok
FROM tagged t LEFT JOIN pins p USING (shard) GROUP BY t.shard, p.pin""")
def c9_pin_check(spark, sf):
    d = V.docs(spark, sf, numbered=False)
    pins = (d.select("shard", "ord").distinct()
            .select("shard", F.when(F.col("ord") < 18, F.concat(F.lit("r"), (F.col("ord") % 3).cast("string"))).alias("pin")))
    rows = d.select("shard", F.when(F.col("doc_id") % 97 == 0, F.lit("stale"))
                    .otherwise(F.concat(F.lit("r"), (F.col("ord") % 3).cast("string"))).alias("revision"))
    return C.pin_check(rows, pins)


# ------------------------------------------------------------------ S11, S12
_MANIFEST_SQL = f"""
cat AS (SELECT shard, ord, count(*) AS n_rows FROM docs GROUP BY shard, ord),
{quota_sql('cat', budget_sql(C1_SHARE))},
cnd AS (SELECT d.shard, d.lang, d.pos, d.text, q.quota, greatest(1, q.n_rows // q.quota) AS stride
         FROM docs d JOIN quotas q ON d.shard = q.shard WHERE q.quota > 0),
surv AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY pos) - 1 AS si
         FROM cnd WHERE pos % stride = 0 AND length(text) >= 200),
sample AS (SELECT * FROM surv WHERE si < quota),
new_m AS (SELECT lang AS path, count(*) AS rows, count(DISTINCT shard) AS shards, 200 AS min_chars,
                 'uniform-per-shard' AS sampling FROM sample GROUP BY lang),
old_m AS (SELECT lang AS path, count(*) AS rows, count(DISTINCT shard) AS shards, 0 AS min_chars,
                 'head' AS sampling, CAST(12.5 AS DOUBLE) AS seconds FROM docs GROUP BY lang)"""


@register("s11_build_manifest", f"WITH {_MANIFEST_SQL}\nSELECT * FROM new_m")
def s11_build_manifest(spark, sf):
    sample = C.uniform_shard_sample(V.docs(spark, sf), budget(spark, sf, C1_SHARE), 200)
    return C.build_manifest(sample, "lang", 200, "uniform-per-shard")


@register("s12_update_manifest", f"""WITH {_MANIFEST_SQL}
SELECT o.path, coalesce(n.rows, o.rows) AS rows, coalesce(n.shards, o.shards) AS shards,
       coalesce(n.min_chars, o.min_chars) AS min_chars, coalesce(n.sampling, o.sampling) AS sampling,
       CASE WHEN n.path IS NULL THEN o.seconds END AS seconds
FROM old_m o LEFT JOIN (SELECT * FROM new_m WHERE path = 'fr') n ON o.path = n.path""")
def s12_update_manifest(spark, sf):
    d = V.docs(spark, sf)
    old = (C.build_manifest(V.docs(spark, sf, numbered=False), "lang", 0, "head").withColumn("seconds", F.lit(12.5)))
    new = C.build_manifest(C.uniform_shard_sample(d, budget(spark, sf, C1_SHARE), 200), "lang", 200, "uniform-per-shard")
    return C.update_manifest(old, new.filter(F.col("path") == "fr"))


@register("j13_quota_join", f"""
WITH cat AS (SELECT shard, ord, count(*) AS n_rows FROM docs GROUP BY shard, ord),
{quota_sql('cat', budget_sql(C1_SHARE))}
SELECT d.shard, d.pos, d.doc_id, q.quota, greatest(1, q.n_rows // q.quota) AS stride
FROM docs d JOIN quotas q ON d.shard = q.shard WHERE q.quota > 0""")
def j13_quota_join(spark, sf):
    d = V.docs(spark, sf)
    q = C.allocate_quotas(C.shard_catalog(V.docs(spark, sf, numbered=False)), budget(spark, sf, C1_SHARE)).filter(F.col("quota") > 0).select(
        "shard", "quota", F.greatest(F.lit(1), F.expr("n_rows div quota")).alias("stride"))
    return d.join(q, "shard").select("shard", "pos", "doc_id", "quota", "stride")
