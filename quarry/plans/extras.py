"""Remaining sources and scalar functions as queries (S1, S4, U3, X2, X3, X5, X7,
X8, X9, X10, X20, P1) and the drift measurement composition (C16)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import hashing as H
from quarry.functions import text as X
from quarry.functions.tokenize import token_ids
from quarry.operators import logs as L
from quarry.operators import vectors as VX
from quarry.plans.logs import ASOF_LOGS, EVENTS_SQL, PARSED_SQL, parsed, raw_series
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import fixtures as V
from quarry.sources.files import put_file, read_jsonl, read_sources, verify_corpus
from quarry.sources.tables import load

SEED = "5eed"
SPECS = [  # (table, text column, pinned revision)
    ("documents", "text", "r-docs"), ("benchmark", "text", "r-bench"),
    ("conversations", "text", "r-conv"), ("pages", "html", "r-pages")]


@register("s1_read_jsonl_gz", """
WITH l AS (SELECT doc_id, 0 AS k, coalesce(length(text), 0) AS n_chars FROM documents
           UNION ALL SELECT doc_id, k, 0 FROM documents, (VALUES (1), (2)) b(k) WHERE doc_id % 50 = 0),
n AS (SELECT CAST(doc_id % 16 AS INT) AS part, row_number() OVER (PARTITION BY doc_id % 16 ORDER BY doc_id, k) - 1 AS pos, k, n_chars FROM l)
SELECT part, pos, n_chars FROM n WHERE k <> 1""")
def s1_read_jsonl_gz(spark, sf):
    """The documents as 16 gzip files with broken and textless lines among them, read back with their line numbers."""
    d = load(spark, sf, "documents").select("doc_id", "text")
    bad = d.filter(F.col("doc_id") % 50 == 0)
    lines = (d.select("doc_id", F.lit(0).alias("k"), F.to_json(F.struct("text")).alias("value"))
             .unionByName(bad.select("doc_id", F.lit(1).alias("k"), F.lit("{broken").alias("value")))
             .unionByName(bad.select("doc_id", F.lit(2).alias("k"), F.lit('{"other": 1}').alias("value"))))
    path = scratch_path(spark, f"jsonl-{uuid.uuid4().hex[:10]}")
    (lines.withColumn("part", F.col("doc_id") % 16).repartition("part").sortWithinPartitions("part", "doc_id", "k")
     .select("part", "value").write.option("compression", "gzip").partitionBy("part").text(path))
    part = F.regexp_extract("file", r"/part=(\d+)/", 1).cast("int")
    return read_jsonl(spark, path).select(part.alias("part"), "pos", F.length("text").cast("long").alias("n_chars"))


_SRC_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS source, '{r}' AS revision, {c} AS text FROM {t}" for t, c, r in SPECS)


@register("s4_read_sources", f"""
SELECT source, revision, count(*) AS rows, CAST(sum(length(text)) AS BIGINT) AS chars FROM ({_SRC_SQL}) GROUP BY source, revision""")
def s4_read_sources(spark, sf):
    u = read_sources(spark, [dict(path=f"{sf}/{t}.parquet", name=t, text_column=c, revision=r) for t, c, r in SPECS])
    return u.groupBy("source", "revision").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("chars"))


@register("u3_union_sources", f"SELECT source, length(text) AS n_chars FROM ({_SRC_SQL})")
def u3_union_sources(spark, sf):
    u = read_sources(spark, [dict(path=f"{sf}/{t}.parquet", name=t, text_column=c, revision=r) for t, c, r in SPECS])
    return u.select("source", F.length("text").cast("long").alias("n_chars"))


@register("x2_line_timestamp", f"WITH {PARSED_SQL}\nSELECT uid, pos, ts FROM parsed")
def x2_line_timestamp(spark, sf):
    return parsed(spark, sf).select("uid", "pos", "ts")


@register("x3_strip_revision", r"""
WITH pl AS (SELECT uid, pos, regexp_replace(line, '\x1b\[[0-9;]*m', '', 'g') AS clean FROM logs),
r AS (SELECT uid, pos, regexp_extract(clean, 'hf_revision=(\S+)', 1) AS raw FROM pl)
SELECT uid, pos, raw, regexp_replace(raw, '[.,''"]+$', '') AS rev FROM r WHERE raw <> ''""")
def x3_strip_revision(spark, sf):
    p = parsed(spark, sf).withColumn("raw", F.regexp_extract("clean", r"hf_revision=(\S+)", 1))
    return p.filter(F.col("raw") != "").select("uid", "pos", "raw", X.strip_revision("raw").alias("rev"))


@register("x5_source_dir_name", """
SELECT DISTINCT shard, lang, replace(CASE WHEN lang = 'en' THEN concat('org/', shard)
                                          ELSE concat('org/', shard, '__', lang) END, '/', '__') AS dir FROM docs""")
def x5_source_dir_name(spark, sf):
    d = V.docs(spark, sf, numbered=False).select("shard", "lang").distinct()
    name = F.when(F.col("lang") != "en", F.col("lang"))
    return d.select("shard", "lang", X.source_dir_name(F.concat(F.lit("org/"), F.col("shard")), name).alias("dir"))


@register("x7_layer_of", """
SELECT DISTINCT name, CASE WHEN list_position(string_split(name, '.'), 'layers') > 0
                 AND list_position(string_split(name, '.'), 'layers') < len(string_split(name, '.'))
            THEN string_split(name, '.')[list_position(string_split(name, '.'), 'layers') + 1] ELSE 'other' END AS layer
FROM tensor""")
def x7_layer_of(spark, sf):
    return V.tensor(spark, sf).select("name", X.layer_of("name").alias("layer")).distinct()


@register("x8_lenient_json", """
SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), -1.0) AS k,
       coalesce(json_extract_string(props, '$.missing'), 'default') AS missing FROM events""")
def x8_lenient_json(spark, sf):
    e = load(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return e.select("event_id", F.coalesce(k, F.lit(-1.0)).alias("k"),
                    F.coalesce(F.get_json_object("props", "$.missing"), F.lit("default")).alias("missing"))


@register("x9_seeded_pick", f"""
SELECT DISTINCT shard, CAST(('0x' || substr(sha256(concat_ws(':', 'pick', shard, '{SEED}')), 1, 15)) AS BIGINT) AS h,
       CAST(('0x' || substr(sha256(concat_ws(':', 'pick', shard, '{SEED}')), 1, 15)) AS BIGINT) % 7 AS pick FROM docs""")
def x9_seeded_pick(spark, sf):
    d = V.docs(spark, sf, numbered=False).select("shard").distinct()
    return d.select("shard", H.seeded_int("pick", F.col("shard"), SEED).alias("h"),
                    H.seeded_pick(F.lit(7), "pick", F.col("shard"), SEED).alias("pick"))


@register("x10_seed_parse", """
SELECT DISTINCT shard, CAST(('0x' || left(md5(shard), 8)) AS BIGINT) AS seed FROM docs""")
def x10_seed_parse(spark, sf):
    d = V.docs(spark, sf, numbered=False).select("shard").distinct()
    return d.select("shard", H.seed_from_string(F.md5("shard")).alias("seed"))


@register("x20_split_colon", rf"""WITH {PARSED_SQL},{EVENTS_SQL},
s AS (SELECT uid, pos, CASE WHEN pos % 2 = 0 THEN concat(repo, ':', rev) ELSE repo END AS spec FROM up)
SELECT uid, pos, spec, CASE WHEN strpos(spec, ':') > 0 THEN split_part(spec, ':', 1) ELSE spec END AS repo,
       CASE WHEN strpos(spec, ':') > 0 THEN substr(spec, strpos(spec, ':') + 1) END AS rev FROM s""")
def x20_split_colon(spark, sf):
    up = L.log_events(parsed(spark, sf), L.UPLOAD_MARKER)
    s = up.select("uid", "pos", F.when(F.col("pos") % 2 == 0, F.concat("repo", F.lit(":"), "rev"))
                  .otherwise(F.col("repo")).alias("spec"))
    repo, rev = X.split_first_colon("spec")
    return s.select("uid", "pos", "spec", repo.alias("repo"), rev.alias("rev"))


@register("p1_tokenizer_hook", r"""
SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> '')) AS n_tokens,
       md5(array_to_string(list_transform(list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> ''),
           lambda t: CAST(CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) AS VARCHAR)), ',')) AS ids_md5
FROM documents""")
def p1_tokenizer_hook(spark, sf):
    """The default tokenizer, which stays in the JVM; a ``module:Class`` name would
    put another in its place (a pandas UDF)."""
    t = token_ids(load(spark, sf, "documents").select("doc_id", "text"))
    return t.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")).alias("ids_md5"))


# ------------------------------------------------------------------ C16
LEADERS = (1, 2)  # uids whose revision inside the window is looked up

_DRIFT_SQL = rf"""{PARSED_SQL},{EVENTS_SQL},
lu AS (SELECT uid, arg_max(pos, (ts, pos)) AS pos FROM up GROUP BY uid),
lup AS (SELECT u.* FROM up u JOIN lu USING (uid, pos)),
pr AS (SELECT u.uid, u.ts AS up_ts, u.rev AS up_rev, d.rev AS d_rev,
              row_number() OVER (PARTITION BY u.uid ORDER BY d.ts DESC, d.pos DESC) AS rn
       FROM lup u LEFT JOIN dl d ON d.uid = u.uid AND d.ts < u.ts),
g AS (SELECT rev, min(ts) AS t, min(pos) AS p FROM dl GROUP BY rev),
w AS (SELECT rev, t AS win_start, coalesce(lead(t) OVER (ORDER BY t, rev), TIMESTAMP '{ASOF_LOGS}') AS win_end FROM g),
tv AS (SELECT party, k, CAST(vals AS DOUBLE[]) AS v FROM tensor),
ck AS (SELECT k FROM tv GROUP BY k HAVING count(DISTINCT party) = (SELECT count(DISTINCT party) FROM tv)),
b AS (SELECT k, v AS b FROM tv WHERE party = 0 AND k IN (SELECT k FROM ck)),
dd AS (SELECT t.party, list_transform(range(1, len(t.v) + 1), lambda i: t.v[i] - b.b[i]) AS d FROM tv t JOIN b USING (k) WHERE t.party <> 0),
nr AS (SELECT party, sqrt(greatest(0, sum(list_reduce(list_transform(range(1, len(d) + 1), lambda i: d[i] * d[i]), lambda a, x: a + x)))) AS n FROM dd GROUP BY party),
bn AS (SELECT sqrt(sum(list_reduce(list_transform(range(1, len(b) + 1), lambda i: b[i] * b[i]), lambda a, x: a + x))) AS bn FROM b),
ld AS (SELECT w.rev, l.leader, arg_max(u.rev, (u.ts, u.rev)) AS leader_rev, max(u.ts) AS leader_at
       FROM w CROSS JOIN (VALUES {", ".join(f"(CAST({u} AS BIGINT))" for u in LEADERS)}) l(leader)
       LEFT JOIN up u ON u.uid = l.leader AND u.ts >= w.win_start AND u.ts < w.win_end GROUP BY w.rev, l.leader)"""


@register("c16_drift_measure", f"""WITH {_DRIFT_SQL}
SELECT p.uid, p.up_ts, p.up_rev, p.d_rev, w.win_start, w.win_end,
       coalesce(p.up_ts >= w.win_start AND p.up_ts < w.win_end, false) AS in_window, nr.n / bn.bn AS rel_drift,
       ld.leader, ld.leader_rev, ld.leader_at
FROM pr p LEFT JOIN w ON w.rev = p.d_rev LEFT JOIN nr ON nr.party = p.uid % 3 + 1 JOIN bn ON true LEFT JOIN ld ON ld.rev = p.d_rev
WHERE p.rn = 1""")
def c16_drift_measure(spark, sf):
    """Latest upload per uid, the global it was trained from (J1), that
    global's validity window (W3/J2), whether the upload fell inside it, the
    relative drift of the uid's update vector (V2 norms over the tensor chunks), and
    each leader's last upload inside the same window."""
    return _drift(spark, sf)


def _drift(spark, sf, leaders: bool = True):
    p = parsed(spark, sf)
    up = L.log_events(p, L.UPLOAD_MARKER)
    dl = L.log_events(p, L.DOWNLOAD_MARKER)
    latest = up.groupBy("uid").agg(F.max(F.struct("ts", "pos", "rev")).alias("_u")).select(
        "uid", F.col("_u.pos").alias("pos"), F.col("_u.ts").alias("ts"), F.col("_u.rev").alias("rev"))
    pair = L.asof_backward(latest, dl.select("uid", "pos", "ts", "rev"), like=raw_series(spark, sf))
    glob = (dl.groupBy("rev").agg(F.min("ts").alias("t")).withColumn("repo", F.lit("global")))
    windows = L.validity_windows(glob, ASOF_LOGS)
    win = windows.select(F.col("rev").alias("d_rev"), F.col("start").alias("win_start"),
                                                     F.col("end").alias("win_end"))
    t = V.tensor(spark, sf)
    t = t.join(VX.common_keys(t), "k", "left_semi")
    base = t.filter("party = 0").select(VX.as_double(F.col("vals")).alias("v")).agg(
        F.lit(0).alias("party"), F.sum(VX.dot(F.col("v"), F.col("v"))).alias("norm2"))
    norms = VX.update_norms(VX.with_base(t)).select("party", "norm2").unionByName(base)  # one row a party
    norms = norms.withColumn("base2", F.max(F.when(F.col("party") == 0, F.col("norm2"))).over(Window.partitionBy()))
    g = norms.filter("party <> 0").select("party", (F.sqrt("norm2") / F.sqrt("base2")).alias("rel_i"))
    out = (pair.select("uid", F.col("ts").alias("up_ts"), F.col("rev").alias("up_rev"), "d_rev")
           .join(win, "d_rev", "left")
           .withColumn("party", (F.pmod(F.col("uid"), F.lit(3)) + 1).cast("int"))
           .join(g, "party", "left"))
    inside = (F.col("up_ts") >= F.col("win_start")) & (F.col("up_ts") < F.col("win_end"))
    out = out.select("uid", "up_ts", "up_rev", "d_rev", "win_start", "win_end",
                     F.coalesce(inside, F.lit(False)).alias("in_window"), F.col("rel_i").alias("rel_drift"))
    if not leaders:
        return out
    each = windows.withColumn("leader", F.explode(F.array(*[F.lit(u).cast("long") for u in LEADERS])))
    sent = up.filter(F.col("uid").isin(*LEADERS)).select(F.col("uid").alias("leader"), "rev", F.col("uid").alias("owner"), F.col("ts").alias("t"))
    lead = L.commits_in_windows(each, sent, "leader").select(F.col("rev").alias("d_rev"), "leader", F.col("last_rev").alias("leader_rev"),
                                                             F.col("last_t").alias("leader_at"))
    return out.join(lead, "d_rev", "left")


@register("c16_drift_recorded", f"""WITH {_DRIFT_SQL},
m AS (SELECT p.uid, nr.n / bn.bn AS rel FROM pr p JOIN nr ON nr.party = p.uid % 3 + 1 JOIN bn ON true WHERE p.rn = 1),
newest AS (SELECT uid, max(cycle) AS cycle FROM trials GROUP BY uid)
SELECT t.uid, t.cycle, t.peak_lr, t.val_loss, CASE WHEN m.uid IS NOT NULL AND t.cycle = n.cycle THEN m.rel ELSE t.drift END AS drift
FROM trials t JOIN newest n USING (uid) LEFT JOIN m USING (uid)""")
def c16_drift_recorded(spark, sf):
    """C16 write-back: the measured drift set in the uid's newest trial (S15); uids without a trial change nothing."""
    from quarry.operators.trials import upsert_trials

    trials = V.trials(spark, sf).select("uid", "cycle", "peak_lr", "val_loss", "drift")
    newest = trials.groupBy("uid").agg(F.max("cycle").alias("cycle"))
    drift = _drift(spark, sf, leaders=False).filter(F.col("rel_drift").isNotNull()).select("uid", F.col("rel_drift").alias("drift"))
    return upsert_trials(trials, trials.limit(0), newest.join(drift, "uid"))




# ------------------------------------------------------------------ file sinks and readers
def write_corpus(d, root: str, rows_per_file: int = 97) -> None:
    """Write corpus rows as ``<root>/shard=<s>/part-*`` in line order.

    Range-partitioned on (shard, pos), so a large source is written by many
    tasks; part numbers follow the ranges, so file-name order is line order.
    """
    n = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    (d.repartitionByRange(n, "shard", "pos").sortWithinPartitions("shard", "pos").drop("pos")
      .write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(root))


ROWS_PER_FILE = 97


def _faulty_corpus(spark, sf) -> DataFrame:
    """A written corpus with known faults, verified against a manifest of the table.

    Expected: all rows of a source in files of ROWS_PER_FILE. Sources with
    ord % 7 = 1 lack their first file, the one with the largest ord has junk in
    its place, and the manifest counts a row too many where ord % 5 = 0.
    """
    root = scratch_path(spark, f"corpus-{uuid.uuid4().hex[:10]}")
    d = V.docs(spark, sf).select("shard", "ord", "pos", "text")
    per = (load(spark, sf, "documents").groupBy(F.col("source").alias("shard"), F.expr("CAST(substr(source, 4) AS INT)").alias("ord"))
           .agg(F.count(F.lit(1)).alias("_n")))
    newest = per.agg(F.max(F.struct("ord", "shard")).alias("m")).select("m.*").first()
    gone = (F.col("ord") % 7 == 1) | (F.col("ord") == F.lit(newest["ord"]))
    kept = d.filter(~gone | (F.col("pos") >= ROWS_PER_FILE))
    # rows of one file meet in one task, so every file but a source's last is full
    (kept.repartition("shard", F.floor(F.col("pos") / ROWS_PER_FILE)).sortWithinPartitions("shard", "pos").select("shard", "text")
     .write.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("shard").parquet(root))
    put_file(spark, f"{root}/shard={newest['shard']}/part-junk.parquet", b"not a table")
    manifest = per.select(F.concat(F.lit("shard="), "shard").alias("source"),
                          F.ceil(F.col("_n") / ROWS_PER_FILE).cast("int").alias("shards"),
                          (F.col("_n") + F.when(F.col("ord") % 5 == 0, 1).otherwise(0)).alias("rows"))
    return verify_corpus(spark, root, manifest)


_FAULTS_SQL = f"""
per AS (SELECT shard, ord, count(*) AS n, CAST(ceil(count(*) / {ROWS_PER_FILE}) AS BIGINT) AS files, max(ord) OVER () AS top
        FROM docs GROUP BY shard, ord),
found AS (SELECT concat('shard=', shard) AS source, files, n + CASE WHEN ord % 5 = 0 THEN 1 ELSE 0 END AS rows,
                 CASE WHEN ord % 7 = 1 OR ord = top THEN n - least(n, {ROWS_PER_FILE}) ELSE n END AS rows_on_disk,
                 CASE WHEN ord % 7 = 1 AND ord <> top THEN files - 1 ELSE files END AS files_on_disk, ord = top AS junk FROM per)"""


@register("s6_read_history", """
SELECT cycle, uid, row_number() OVER (PARTITION BY cycle, uid ORDER BY pos) - 1 AS slot_pos, slot, val_loss
FROM board""")
def s6_read_history(spark, sf):
    from quarry.sources.snapshots import flatten_snapshot, read_history, snapshots_to_json

    js = snapshots_to_json(V.board(spark, sf))
    lines = js.select(F.col("json").alias("value")).unionByName(js.select(F.lit("").alias("value")))
    path = scratch_path(spark, f"history-{uuid.uuid4().hex[:10]}")
    lines.write.text(path)  # history file with blank lines between records
    rows = flatten_snapshot(read_history(spark, path))
    return rows.select("cycle", "uid", F.col("slot_pos").cast("long").alias("slot_pos"), "slot", "val_loss")


@register("s10_write_shards", """
SELECT printf('part-%05d.parquet', g // 97) AS part, count(*) AS rows, CAST(sum(n) AS BIGINT) AS chars, min(n) AS shortest
FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS g, length(text) AS n FROM documents) GROUP BY g // 97""")
def s10_write_shards(spark, sf):
    """The corpus packed into files of exactly 97 rows, then names, rows and texts read back."""
    from quarry.operators.corpus import global_index
    from quarry.sources.files import read_corpus, write_shards

    path = scratch_path(spark, f"shards-{uuid.uuid4().hex[:10]}")
    write_shards(global_index(read_corpus(spark, f"{sf}/documents.parquet")), path, rows_per_file=97, index="gidx")
    n = F.length("text").cast("long")
    return (spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("part"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(n).alias("chars"), F.min(n).alias("shortest")))


@register("s13_publish", "SELECT length(text) AS n_chars FROM documents")
def s13_publish(spark, sf):
    from quarry.sources.files import current_version, publish

    root = scratch_path(spark, f"live-{uuid.uuid4().hex[:10]}")
    publish(load(spark, sf, "documents"), root)
    return spark.read.parquet(current_version(root, spark)).select(F.length("text").cast("long").alias("n_chars"))


@register("s14_append_events", "SELECT uid, count(*) AS n FROM board GROUP BY uid")
def s14_append_events(spark, sf):
    from quarry.sources.files import append_events

    path = scratch_path(spark, f"events-{uuid.uuid4().hex[:10]}")
    append_events(V.board(spark, sf), path)
    from quarry.sources.files import read_events

    return read_events(spark, path).groupBy("uid").agg(F.count(F.lit(1)).alias("n"))


@register("s17_verify_corpus", f"""WITH {_FAULTS_SQL}
SELECT source, rows_on_disk, CASE WHEN junk THEN 1 ELSE 0 END AS n_unreadable,
       files = files_on_disk AND rows = rows_on_disk AND NOT junk AS ok FROM found""")
def s17_verify_corpus(spark, sf):
    """Sources, one folder each, verified against the manifest; faults are found."""
    return _faulty_corpus(spark, sf).select("source", "rows_on_disk", F.coalesce(F.size("unreadable"), F.lit(0)).alias("n_unreadable"), "ok")


@register("j12_manifest_files", f"""WITH {_FAULTS_SQL}
SELECT source, files = files_on_disk AS files_match, rows, rows_on_disk,
       NOT (files = files_on_disk AND rows = rows_on_disk AND NOT junk) AS mismatch FROM found""")
def j12_manifest_files(spark, sf):
    """Manifest left-joined to the files found, with a mismatch flag."""
    return _faulty_corpus(spark, sf).select("source", (F.col("files_on_disk") == F.col("shards")).alias("files_match"),
                                            "rows", "rows_on_disk", (~F.col("ok")).alias("mismatch"))


@register("s3_read_shards", "SELECT shard, pos, doc_id FROM docs")
def s3_read_shards(spark, sf):
    """S3/W14 on real files: the corpus is written as ``<root>/<shard>/part-*``
    files in line order, and positions are read back from Parquet row indexes
    plus per-file offsets (no sort, no numbering shuffle)."""
    from quarry.sources.files import read_shards

    root = scratch_path(spark, f"shards-{uuid.uuid4().hex[:10]}")
    write_corpus(V.docs(spark, sf).select("shard", "pos", "doc_id", "text"), root)
    return read_shards(spark, root, extra=["doc_id"]).select("shard", "pos", "doc_id")



@register("s6_read_train_records", """
SELECT pos, uid, cycle, peak_lr, data_rank, dataset_class, validator_val_loss, local_eval FROM trainlog""")
def s6_read_train_records(spark, sf):
    """Train records written as JSON lines with every number as a string (as the
    log scraper stores them), read back with typed ``try_cast`` columns."""
    from quarry.sources.snapshots import TRAIN_FIELDS, parse_train_records, read_history

    t = V.trainlog(spark, sf)
    as_text = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in TRAIN_FIELDS]))
    path = scratch_path(spark, f"trainlog-{uuid.uuid4().hex[:10]}")
    t.select(as_text.alias("value")).write.text(path)
    return parse_train_records(read_history(spark, path))



@register("s11_manifest_roundtrip", """
SELECT lang AS path, count(*) AS rows, count(DISTINCT shard) AS shards FROM docs GROUP BY lang""")
def s11_manifest_roundtrip(spark, sf):
    """The manifest written as a JSON document with a ``sources`` array and read
    back with ``inline``."""
    from quarry.operators.corpus import build_manifest
    from quarry.sources.files import read_manifest, write_manifest

    m = build_manifest(V.docs(spark, sf, numbered=False), "lang", 200, "uniform-per-shard").select("path", "rows", "shards")
    path = scratch_path(spark, f"manifest-{uuid.uuid4().hex[:10]}")
    write_manifest(m, path, {"expert_group": "docs", "sequence_length": 1024})
    return read_manifest(spark, path, "path: string, rows: bigint, shards: bigint")



TAIL_SINCE = "2024-01-28 06:00:00"


@register("s7_log_tail", r"""
WITH pl AS (SELECT uid, pos, kind, regexp_replace(line, '\x1b\[[0-9;]*m', '', 'g') AS clean FROM logs),
p AS (SELECT *, try_strptime(left(clean, 19), '%Y-%m-%d %H:%M:%S') AS ts FROM pl),
f AS (SELECT *, last_value(ts IGNORE NULLS) OVER (PARTITION BY uid, kind ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ts_filled FROM p)
SELECT uid, pos, kind, ts, clean FROM f WHERE ts_filled >= TIMESTAMP '""" + TAIL_SINCE + """'""")
def s7_log_tail(spark, sf):
    """Log lines appended under day folders, continuation lines with the line they
    follow, then read back from a time onwards with partition pruning on the day."""
    from quarry.operators.logs import stamped_lines
    from quarry.sources.files import append_log_lines, read_log_tail

    path = scratch_path(spark, f"logdays-{uuid.uuid4().hex[:10]}")
    append_log_lines(stamped_lines(parsed(spark, sf).select("uid", "pos", "kind", "ts", "clean")), path, ts="ts_filled")
    return read_log_tail(spark, path, TAIL_SINCE, ts="ts_filled").select("uid", "pos", "kind", "ts", "clean")


@register("s7_raw_log_tail", """
SELECT uid, kind, CAST(coalesce(sum(strlen(line) + 1) OVER (PARTITION BY uid, kind ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS at,
       line FROM logs""")
def s7_raw_log_tail(spark, sf):
    """Raw log files tailed by byte offset: half of the lines lie there when the stream
    starts, the files grow, and a second run goes on from the checkpoint."""
    from quarry.sources.tail import tail_raw_logs, write_raw_logs
    from quarry.streaming.core import drain

    run = uuid.uuid4().hex[:10]
    root, base = scratch_path(spark, f"rawlogs-{run}"), scratch_path(spark, f"rawtail-{run}")
    lines = V.logs(spark, sf)
    half = load(spark, sf, "events").agg(F.max("event_id")).first()[0] or 0
    for upto in (half // 2, half):
        write_raw_logs(lines.filter(F.col("pos") <= upto), root)
        out = drain(tail_raw_logs(spark, root), "s7", path=base)
    return spark.read.schema("uid long, kind string, at long, line string").parquet(out)
