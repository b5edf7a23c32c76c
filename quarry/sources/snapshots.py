"""Nested JSON sources: leaderboard snapshots, history, eval curves, settings.

(S5 flatten_snapshot, S6 read_history, S8 read_eval_curves, S9 read_settings.)
Everything is parsed with explicit schemas through ``from_json``; an
unparsable record becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = T.StructType([
    T.StructField("validator_slot", T.StringType()),
    T.StructField("val_loss", T.DoubleType()),
    T.StructField("eval_status_label", T.StringType()),
    T.StructField("sample_cycle", T.IntegerType()),
    T.StructField("sample_age_blocks", T.LongType()),
    T.StructField("sample_is_fresh", T.BooleanType()),
])
MINER = T.StructType([
    T.StructField("uid", T.LongType()),
    T.StructField("cohort_group", T.StringType()),
    T.StructField("incentive", T.DoubleType()),
    T.StructField("hf_repo_id", T.StringType()),
    T.StructField("validator_metrics", T.ArrayType(SAMPLE)),
])
_HEAD = [T.StructField("cycle", T.IntegerType()), T.StructField("baseline", T.DoubleType())]
SNAPSHOT_LIST = T.StructType(_HEAD + [T.StructField("leaderboard", T.ArrayType(MINER))])
SNAPSHOT_MAP = T.StructType(_HEAD + [T.StructField("leaderboard", T.MapType(T.StringType(), MINER))])


def snapshots_to_json(samples: DataFrame) -> DataFrame:
    """Nest ``board``-shaped samples into one snapshot record per (cycle, uid).

    Each record carries one miner with its validator samples in slot order; the
    per-miner sample list is bounded by the number of validators.
    """
    metric = F.struct(
        F.col("pos"),
        F.struct(F.col("slot").alias("validator_slot"), "val_loss",
                 F.col("status").alias("eval_status_label"), "sample_cycle",
                 F.col("age").alias("sample_age_blocks"),
                 (F.col("status") == "ok").alias("sample_is_fresh")).alias("m"))
    g = samples.groupBy("cycle", "uid").agg(
        F.max("baseline").alias("baseline"),
        F.min(F.struct("pos", "cohort", "incentive", "repo")).alias("_first"),
        F.array_sort(F.collect_list(metric)).alias("_metrics"))
    miner = F.struct(F.col("uid"), F.col("_first.cohort").alias("cohort_group"),
                     F.col("_first.incentive").alias("incentive"), F.col("_first.repo").alias("hf_repo_id"),
                     F.transform("_metrics", lambda x: x["m"]).alias("validator_metrics"))
    return g.select(F.to_json(F.struct("cycle", "baseline", F.array(miner).alias("leaderboard"))).alias("json"))


def parse_snapshot(col: str = "json") -> F.Column:
    """Leaderboard as a list, or as a map keyed by uid (its values are used)."""
    as_list = F.from_json(F.col(col), SNAPSHOT_LIST, {"mode": "PERMISSIVE"})
    as_map = F.from_json(F.col(col), SNAPSHOT_MAP, {"mode": "PERMISSIVE"})
    board = F.coalesce(as_list["leaderboard"], F.map_values(as_map["leaderboard"]))
    return F.struct(F.coalesce(as_list["cycle"], as_map["cycle"]).alias("cycle"),
                    F.coalesce(as_list["baseline"], as_map["baseline"]).alias("baseline"),
                    board.alias("leaderboard"))


def flatten_snapshot(records: DataFrame, col: str = "json") -> DataFrame:
    """One row per (snapshot, miner, validator sample); ``slot_pos`` is the
    sample's position in the list (the tie-break for W1)."""
    snap = records.select(parse_snapshot(col).alias("s")).filter(F.col("s.leaderboard").isNotNull())
    miners = snap.select("s.cycle", "s.baseline", F.explode("s.leaderboard").alias("m"))
    rows = miners.select("cycle", "baseline", F.col("m.uid").alias("uid"), F.col("m.cohort_group").alias("cohort"),
                         F.col("m.incentive").alias("incentive"), F.col("m.hf_repo_id").alias("repo"),
                         F.posexplode_outer("m.validator_metrics").alias("slot_pos", "v"))
    return rows.select("cycle", "uid", "slot_pos", F.col("v.validator_slot").alias("slot"),
                       F.col("v.val_loss").alias("val_loss"), F.col("v.eval_status_label").alias("status"),
                       F.col("v.sample_cycle").alias("sample_cycle"), F.col("v.sample_age_blocks").alias("age"),
                       "cohort", "incentive", "repo", "baseline")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot JSONL history; blank lines are dropped, bad lines become NULL."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.col("value").alias("json"))


EVAL_CURVE = T.MapType(T.StringType(), T.DoubleType())


def read_eval_curves(df: DataFrame, uid: str = "uid", col: str = "json") -> DataFrame:
    """``{"step": loss}`` JSON -> (uid, step long, loss); bad keys are dropped."""
    parsed = df.select(uid, F.explode(F.from_json(F.col(col), EVAL_CURVE)).alias("k", "loss"))
    return (parsed.select(uid, F.expr("try_cast(k AS BIGINT)").alias("step"), "loss")
            .filter(F.col("step").isNotNull()))


SETTINGS = T.StructType([
    T.StructField("peak_lr", T.DoubleType()),
    T.StructField("warmup", T.DoubleType()),
    T.StructField("min_frac", T.DoubleType()),
])


def read_settings(df: DataFrame, col: str = "json") -> DataFrame:
    """A malformed settings object is ignored (NULL struct), an absent one is absent."""
    ok = F.try_parse_json(F.col(col)).isNotNull()
    return df.withColumn("settings", F.when(ok, F.from_json(F.col(col), SETTINGS, {"mode": "PERMISSIVE"})))


# Train records: flat JSON whose numbers are often strings (regex captures).
TRAIN_FIELDS = {
    "pos": "bigint", "uid": "bigint", "cycle": "int", "peak_lr": "string", "data_rank": "string",
    "dataset_class": "string", "validator_val_loss": "double", "local_eval": "double",
}


def parse_train_records(df: DataFrame, col: str = "json", fields: dict[str, str] = TRAIN_FIELDS) -> DataFrame:
    """S6 for train records: every field is read as text, then typed with
    ``try_cast`` -- a number kept as a string becomes a number, a malformed one
    becomes NULL instead of failing the job."""
    raw = T.StructType([T.StructField(k, T.StringType()) for k in fields])
    parsed = df.select(F.from_json(F.col(col), raw, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.select(*[(F.col(f"r.{k}") if t == "string" else F.col(f"r.{k}").try_cast(t)).alias(k)
                           for k, t in fields.items()])
