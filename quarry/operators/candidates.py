"""Checkpoint candidates and layered settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordering import sequence_within


def eligible_candidates(cand: DataFrame, cur_ver: int, cur_rev: str | None, want_group: int | None) -> DataFrame:
    """newer version, or a different non-null revision; then, if more than one
    remains, keep those whose group is NULL or equal to ``want_group``; when none
    of them match, nothing is eligible."""
    newer = (F.col("ver") > cur_ver)
    if cur_rev is not None:
        newer = newer | (F.col("rev").isNotNull() & (F.col("rev") != F.lit(cur_rev)))
    step1 = cand.filter(newer)
    if step1.count() <= 1:  # one number; the guard of the group filter
        return step1
    grp_ok = F.col("grp").isNull() | (F.col("grp") == F.lit(want_group)) if want_group is not None else F.lit(True)
    return step1.filter(grp_ok)


def reject_empty_artifacts(cand: DataFrame, files: DataFrame, key: str = "uid") -> DataFrame:
    """an artifact whose listing has no visible file is dropped; one that could
    not be listed at all (no listing rows) is kept."""
    vis = files.groupBy(key).agg((F.count(F.when(~F.col("hidden"), 1)) > 0).alias("has_payload"))
    j = cand.join(vis, key, "left")
    return j.filter(F.coalesce(F.col("has_payload"), F.lit(True)))


def rank_by_stake(cand: DataFrame) -> DataFrame:
    """Candidates by stake descending (NULL stake counts as 0), uid breaks ties.

    A full ranking, numbered with the size-checked sequence (one task only
    while the candidate list fits the skew bound)."""
    c = cand.withColumn("_neg", -F.coalesce(F.col("stake"), F.lit(0.0)))
    r = sequence_within(c, [], ["_neg", "uid"], "_r")
    return r.withColumn("stake_rank", F.col("_r") + 1).drop("_neg", "_r")


def first_existing_suffix(files: DataFrame, preference: Sequence[str], key: str = "uid") -> DataFrame:
    """The first suffix in preference order among the files that exist."""
    pref = F.create_map(*[x for i, s in enumerate(preference) for x in (F.lit(s), F.lit(i))])
    f = files.withColumn("_p", F.try_element_at(pref, F.col("suffix"))).filter(F.col("_p").isNotNull())
    return f.groupBy(key).agg(F.min_by("suffix", "_p").alias("chosen_suffix"))


def layered_lookup(uids: DataFrame, settings: DataFrame, field: str, default: float) -> DataFrame:
    """Value from the uid level, else the shared level, else the default, and
    the level that won. Precedence is by object: a uid-level object without the
    field does not fall back to the shared one.

    The shared level is one settings object: it is aggregated to a single row
    (always exactly one, whatever the table size) and applied as a literal, so
    no join with it exists; the uid level is an equi-join on uid.
    """
    per_uid = settings.filter(F.col("scope") == "uid").select(
        "uid", F.col(field).alias("_u"), F.lit(True).alias("_has_u"))
    shared = settings.filter(F.col("scope") == "shared").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col(field)).alias("v")).first()
    has_shared, shared_value = shared["n"] > 0, shared["v"]
    j = uids.join(per_uid, "uid", "left")
    fallback = F.lit(shared_value) if has_shared else F.lit(default)
    level = F.when(F.col("_has_u"), "uid").otherwise("shared" if has_shared else "default")
    value = F.when(F.col("_has_u"), F.col("_u")).otherwise(fallback.cast(settings.schema[field].dataType))
    return j.select("uid", value.alias(field), level.alias("level"))
