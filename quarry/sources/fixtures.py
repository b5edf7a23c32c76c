"""Domain views over the driver tables (FIXTURES.md §3), as DataFrames.

Each view maps a driver table onto one of the shapes the operators consume
(corpus shard rows, validator samples, log lines, polls, eval curves, tensor
chunks, trials, candidates, publishes, commits, train records, settings). They
are projections and filters over one table, so Catalyst prunes the scan to the
columns a query touches. Every ordered numbering inside a group (documents
per source, events per user, orders per ``custkey % 50``) uses the segmented
``sequence_within`` instead of a single-task window, so a group holding a third
of the rows is still numbered in parallel; ``numbered=False`` leaves it out.
``_seg_*`` columns are those segments, for later scans of the same series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.ordering import sequence_within
from quarry.operators.scan import Running
from quarry.sources.tables import load


def _day(ts: str = "ts"):
    return F.dayofmonth(F.col(ts)).cast("int")


def docs(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """Corpus rows: a source is a shard; ``pos`` is the physical line number."""
    d = load(spark, sf_dir, "documents").select(
        F.col("source").alias("shard"),
        F.expr("CAST(substr(source, 4) AS INT)").alias("ord"),
        "doc_id", "text", "lang", "n_chars",
        F.length("text").cast("long").alias("chars"))  # gate on this, so text can be pruned
    return sequence_within(d, ["shard"], ["doc_id"], "pos", keep=True) if numbered else d


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per validator sample of a miner in a cycle; ``pos`` breaks ties."""
    return board_from(load(spark, sf_dir, "events"))


def board_from(e: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``board`` projection of an events frame (batch or stream); ``keep``
    carries extra input columns through (e.g. a watermarked event time)."""
    eid, day = F.col("event_id"), _day()
    cohort = (F.when(eid % 5 == 0, "A").when(eid % 5 == 1, "B")
              .when(eid % 5 == 2, "C").when(eid % 5 == 3, "tail"))
    return e.select(
        day.alias("cycle"), F.col("user_id").alias("uid"), F.col("event_type").alias("slot"),
        eid.alias("pos"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
         .otherwise(F.col("value") / 100).alias("val_loss"),
        F.when(eid % 7 == 0, F.lit(None).cast("int"))
         .otherwise(day - (eid % 3).cast("int")).alias("sample_cycle"),
        F.when(eid % 5 == 0, "stale").otherwise("ok").alias("status"),
        F.when(eid % 6 == 0, F.lit(None).cast("long")).otherwise(eid % 1000).alias("age"),
        F.when(eid % 11 == 0, (eid % 100).cast("double") / 100)
         .otherwise(F.lit(0.0)).alias("incentive"),
        cohort.alias("cohort"),
        F.when(F.col("user_id") % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("org/u"), F.col("user_id").cast("string"))).alias("repo"),
        (F.lit(1.5) + day * F.lit(0.05)).alias("baseline"), *keep)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coloured, stamped log lines; 'view' events are unstamped continuations."""
    return logs_from(load(spark, sf_dir, "events"))


def logs_from(e: DataFrame, keep: tuple = ()) -> DataFrame:
    """The ``logs`` projection of an events frame (batch or stream); ``keep`` carries input columns through."""
    eid = F.col("event_id")
    stamp = F.date_trunc("second", F.col("ts")).cast("string")
    rev7 = F.substring(F.md5(eid.cast("string")), 1, 7)
    esc = F.lit("\x1b")
    et = F.col("event_type")
    line = (
        F.when(et == "signup", F.concat(stamp, F.lit(" "), esc, F.lit("[36mDownloaded checkpoint (verified)"),
                                        esc, F.lit("[0m hf_repo_id=org/base hf_revision="), rev7, F.lit(",")))
        .when(et == "purchase", F.concat(stamp, F.lit(" MinerCommit2> committing hf_repo_id=org/u"),
                                         F.col("user_id").cast("string"), F.lit(" hf_revision="), rev7))
        .when(et == "error", F.concat(stamp, F.when(eid % 4 == 0, " HTTP 429")
                                      .when(eid % 4 == 1, " OutOfMemoryError")
                                      .when(eid % 4 == 2, " non-finite loss")
                                      .otherwise(" No space left on device")))
        .when(et == "view", F.concat(F.lit("    at frame "), eid.cast("string")))
        .otherwise(F.concat(stamp, F.lit(" peak_lr="),
                            F.when(eid % 3 == 0, "3e-05").when(eid % 3 == 1, "5e-05").otherwise("0.0001"),
                            F.lit(" rank="), (eid % 4).cast("string"))))
    return e.select(
        F.col("user_id").alias("uid"), eid.alias("pos"),
        F.when(et.isin("signup", "purchase"), "commit").otherwise("train").alias("kind"),
        line.alias("line"), *keep)


POLL_ORDER = ("ts", "event_id")


def poll_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitor polls without a number; one miner's polls are ordered by POLL_ORDER."""
    return poll_rows_from(load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value", "event_type"))


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitor polls: one miner's gauge series, numbered per uid by POLL_ORDER."""
    return poll_series(spark, sf_dir).drop("event_id")


def poll_series(spark: SparkSession, sf_dir: str, *more) -> DataFrame:
    """Numbered polls with their event_id and other running columns (scan specs) of the same pass."""
    r = Running(poll_rows(spark, sf_dir), ["uid"], POLL_ORDER)
    r.add([("poll", "count", None), *more])
    return r.result()


def poll_rows_from(e: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``polls`` projection; a stream has no ``poll`` number and orders by (ts, event_id)."""
    eid = F.col("event_id")
    extra = [c for c in ("poll", *keep) if c in e.columns]
    return e.select(
        F.col("user_id").alias("uid"), *extra, "event_id", "ts",
        _day().alias("round_id"),
        F.when(eid % 13 == 0, F.lit(None).cast("double"))
         .otherwise(F.floor(F.col("value") / 150).cast("double")).alias("val_loss"),
        F.when(eid % 17 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") * 6).alias("log_age"),
        (F.col("event_type") == "error").alias("crit"), F.col("event_type").alias("msg"))


def curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eval points per uid; a checkpoint is saved every third step."""
    e = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    e = sequence_within(e, ["user_id"], ["event_id"], "_s0")
    step = ((F.col("_s0") + 1) * 100).cast("long")
    return (e.select(F.col("user_id").alias("uid"), F.col("event_type").alias("grp"), step.alias("step"),
                     (F.col("value") / 100).alias("loss"), (F.col("event_id") % 3 == 0).alias("saved"))
            .withColumn("name", F.concat(F.lit("globalver_7_inneropt_"), F.col("step").cast("string"))))


def last_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest eval point per uid, without numbering the curve."""
    e = load(spark, sf_dir, "events").groupBy(F.col("user_id").alias("uid"))
    return e.agg((F.count(F.lit(1)) * 100).alias("eval_step"), (F.max_by("value", "event_id") / 100).alias("eval_loss"))


def tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tensor chunks: party 0 is the base; party 3 lacks every fifth key."""
    v = load(spark, sf_dir, "embeddings")
    k = F.floor(F.col("vec_id") / 4).cast("long")
    name = (F.when(k % 7 == 0, F.lit("embed.weight"))
            .otherwise(F.concat(F.lit("model.layers."), (k % 10).cast("string"),
                                F.lit(".mlp."), k.cast("string"))))
    return (v.filter(~((F.col("vec_id") % 4 == 3) & (k % 5 == 0)))
             .select((F.col("vec_id") % 4).cast("int").alias("party"), k.alias("k"),
                     name.alias("name"), F.col("embedding").alias("vals")))


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials keyed (uid, cycle); only 50 uids, so cycles come from the range helper."""
    o = load(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 50).alias("uid"), "o_orderkey", "o_orderstatus", "o_totalprice")
    o = sequence_within(o, ["uid"], ["o_orderkey"], "_c0")
    key = F.col("o_orderkey")
    return o.select(
        "uid", (F.col("_c0") + 1).alias("cycle"),
        ((1 + key % 10).cast("double") / 100000).alias("peak_lr"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / 100000).alias("val_loss"),
        F.when(key % 4 == 0, (key % 300).cast("double") / 10000).alias("drift"),
        ((1 + key % 3).cast("double") / 100).alias("warmup"), ((1 + key % 2).cast("double") / 50).alias("min_frac"))


def cand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoint candidates published by miners."""
    s = load(spark, sf_dir, "supplier")
    sk = F.col("s_suppkey")
    return s.select(
        sk.alias("uid"), (sk % 4).alias("ver"), F.substring(F.md5(sk.cast("string")), 1, 7).alias("rev"),
        F.when(F.col("s_nationkey") % 4 == 0, F.lit(None).cast("int"))
         .otherwise(F.col("s_nationkey") % 4).alias("grp"),
        F.when(sk % 9 == 0, F.lit(None).cast("double")).otherwise(F.col("s_acctbal")).alias("stake"),
        (sk % 3).alias("n_files"))


def pubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkpoint publishes per repo."""
    o = load(spark, sf_dir, "orders")
    return o.select((F.col("o_custkey") % 20).alias("repo"),
                    F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 12).alias("rev"),
                    F.col("o_orderdate").alias("t"))


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chain commits naming a repo revision."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("owner"), (F.col("l_orderkey") % 20).alias("repo"),
        F.substring(F.md5(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                                   F.col("l_linenumber").cast("string"))), 1, 12).alias("rev"),
        F.col("l_shipdate").alias("t"))


def trainlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One train record per event with the setting in force."""
    e = load(spark, sf_dir, "events")
    uid = F.col("user_id")
    return e.select(
        F.col("event_id").alias("pos"), uid.alias("uid"), _day().alias("cycle"),
        F.when(uid % 3 == 0, "3e-05").when(uid % 3 == 1, "5e-05").otherwise("0.0001").alias("peak_lr"),
        (uid % 4).cast("string").alias("data_rank"), F.lit(None).cast("string").alias("dataset_class"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
         .otherwise(F.col("value") / 100).alias("validator_val_loss"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("value") / 120).alias("local_eval"))


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layered settings: a uid level for a third of the uids and one shared level."""
    c = load(spark, sf_dir, "customer")
    per_uid = c.filter(F.col("c_custkey") % 3 == 0).select(
        F.lit("uid").alias("scope"), F.col("c_custkey").alias("uid"),
        ((1 + F.col("c_custkey") % 5).cast("double") / 100000).alias("peak_lr"))
    shared = c.sparkSession.range(1).select(
        F.lit("shared").alias("scope"), F.lit(None).cast("long").alias("uid"),
        F.lit(0.00003).cast("double").alias("peak_lr"))
    return per_uid.unionByName(shared)


VIEWS = {
    "docs": docs, "board": board, "logs": logs, "polls": polls, "curve": curve,
    "tensor": tensor, "trials": trials, "cand": cand, "pubs": pubs, "commits": commits,
    "trainlog": trainlog, "settings": settings,
}
