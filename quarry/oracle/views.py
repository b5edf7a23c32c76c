"""DuckDB text of the fixture views (FIXTURES.md §3), used as CTEs by the oracle."""

VIEW_SQL = {
    "docs": """SELECT source AS shard, CAST(substr(source,4) AS INT) AS ord, doc_id, text, lang, n_chars,
       row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos
FROM documents""",
    "board": """SELECT CAST(extract(day FROM ts) AS INT) AS cycle, user_id AS uid, event_type AS slot, event_id AS pos,
       CASE WHEN event_type='error' THEN NULL ELSE value/100 END AS val_loss,
       CASE WHEN event_id % 7 = 0 THEN NULL
            ELSE CAST(extract(day FROM ts) AS INT) - CAST(event_id % 3 AS INT) END AS sample_cycle,
       CASE WHEN event_id % 5 = 0 THEN 'stale' ELSE 'ok' END AS status,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % 1000 END AS age,
       CASE WHEN event_id % 11 = 0 THEN CAST(event_id % 100 AS DOUBLE)/100 ELSE CAST(0 AS DOUBLE) END AS incentive,
       CASE event_id % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'tail' END AS cohort,
       CASE WHEN user_id % 4 = 0 THEN NULL ELSE concat('org/u', CAST(user_id AS STRING)) END AS repo,
       CAST(1.5 AS DOUBLE) + extract(day FROM ts) * CAST(0.05 AS DOUBLE) AS baseline
FROM events""",
    "logs": """SELECT user_id AS uid, event_id AS pos,
       CASE WHEN event_type IN ('signup','purchase') THEN 'commit' ELSE 'train' END AS kind,
       CASE event_type
         WHEN 'signup'   THEN concat(CAST(date_trunc('second', ts) AS STRING), ' ', chr(27), '[36mDownloaded checkpoint (verified)', chr(27), '[0m hf_repo_id=org/base hf_revision=', substr(md5(CAST(event_id AS STRING)),1,7), ',')
         WHEN 'purchase' THEN concat(CAST(date_trunc('second', ts) AS STRING), ' MinerCommit2> committing hf_repo_id=org/u', CAST(user_id AS STRING), ' hf_revision=', substr(md5(CAST(event_id AS STRING)),1,7))
         WHEN 'error'    THEN concat(CAST(date_trunc('second', ts) AS STRING), CASE event_id % 4 WHEN 0 THEN ' HTTP 429' WHEN 1 THEN ' OutOfMemoryError' WHEN 2 THEN ' non-finite loss' ELSE ' No space left on device' END)
         WHEN 'view'     THEN concat('    at frame ', CAST(event_id AS STRING))
         ELSE concat(CAST(date_trunc('second', ts) AS STRING), ' peak_lr=', CASE event_id % 3 WHEN 0 THEN '3e-05' WHEN 1 THEN '5e-05' ELSE '0.0001' END, ' rank=', CAST(event_id % 4 AS STRING)) END AS line
FROM events""",
    "polls": """SELECT user_id AS uid, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS poll, ts,
       CAST(extract(day FROM ts) AS INT) AS round_id,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(floor(value/150) AS DOUBLE) END AS val_loss,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value*6 END AS log_age,
       event_type = 'error' AS crit, event_type AS msg
FROM events""",
    "curve": """SELECT user_id AS uid, event_type AS grp, 100 * row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step,
       value/100 AS loss, (event_id % 3 = 0) AS saved,
       concat('globalver_7_inneropt_', CAST(100 * row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS STRING)) AS name
FROM events""",
    "tensor": """SELECT CAST(vec_id % 4 AS INT) AS party, CAST(floor(vec_id/4) AS BIGINT) AS k,
       CASE WHEN floor(vec_id/4) % 7 = 0 THEN 'embed.weight'
            ELSE concat('model.layers.', CAST(CAST(floor(vec_id/4) AS BIGINT) % 10 AS STRING), '.mlp.', CAST(CAST(floor(vec_id/4) AS BIGINT) AS STRING)) END AS name,
       embedding AS vals
FROM embeddings WHERE NOT (vec_id % 4 = 3 AND CAST(floor(vec_id/4) AS BIGINT) % 5 = 0)""",
    "trials": """SELECT o_custkey % 50 AS uid, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS cycle,
       CAST(1 + o_orderkey % 10 AS DOUBLE)/100000 AS peak_lr,
       CASE WHEN o_orderstatus='P' THEN NULL ELSE o_totalprice/100000 END AS val_loss,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 300 AS DOUBLE)/10000 END AS drift,
       CAST(1 + o_orderkey % 3 AS DOUBLE)/100 AS warmup, CAST(1 + o_orderkey % 2 AS DOUBLE)/50 AS min_frac
FROM orders""",
    "cand": """SELECT s_suppkey AS uid, s_suppkey % 4 AS ver, substr(md5(CAST(s_suppkey AS STRING)),1,7) AS rev,
       CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE s_nationkey % 4 END AS grp,
       CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_acctbal END AS stake, s_suppkey % 3 AS n_files
FROM supplier""",
    "pubs": """SELECT o_custkey % 20 AS repo, substr(md5(CAST(o_orderkey AS STRING)),1,12) AS rev, o_orderdate AS t FROM orders""",
    "commits": """SELECT l_suppkey AS owner, l_orderkey % 20 AS repo,
       substr(md5(concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))),1,12) AS rev, l_shipdate AS t FROM lineitem""",
    "trainlog": """SELECT event_id AS pos, user_id AS uid, CAST(extract(day FROM ts) AS INT) AS cycle,
       CASE user_id % 3 WHEN 0 THEN '3e-05' WHEN 1 THEN '5e-05' ELSE '0.0001' END AS peak_lr,
       CAST(user_id % 4 AS STRING) AS data_rank, CAST(NULL AS STRING) AS dataset_class,
       CASE WHEN event_type='error' THEN NULL ELSE value/100 END AS validator_val_loss,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE value/120 END AS local_eval
FROM events""",
    "settings": """SELECT 'uid' AS scope, c_custkey AS uid, CAST(1 + c_custkey % 5 AS DOUBLE)/100000 AS peak_lr FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT 'shared', CAST(NULL AS BIGINT), CAST(0.00003 AS DOUBLE)""",
}

ORDER = list(VIEW_SQL)


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the named fixture views as CTEs (dependency order kept)."""
    wanted = [n for n in ORDER if n in names]
    if not wanted:
        return body
    ctes = ",\n".join(f"{n} AS (\n{VIEW_SQL[n]}\n)" for n in wanted)
    body = body.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
