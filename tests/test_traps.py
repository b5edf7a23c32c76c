"""Hand-made rows for the semantics the driver tables do not exercise."""

import datetime as dt
import gzip
import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.functions.numeric import finite, finite_recorder
from quarry.functions.text import layer_of, split_first_colon, strip_revision, line_timestamp, strip_ansi
from quarry.operators import board as B
from quarry.operators import candidates as CD
from quarry.operators import corpus as C
from quarry.operators import gauges as G
from quarry.operators import logs as L
from quarry.operators import trials as T
from quarry.operators import vectors as VX
from quarry.sources.files import read_jsonl


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_jsonl_gz_malformed_and_empty(spark, tmp_path):
    p = tmp_path / "shard.jsonl.gz"
    lines = [json.dumps({"text": "ok line"}), "{not json", json.dumps({"text": ""}),
             json.dumps({"other": 1}), json.dumps({"text": "é" * 3})]
    with gzip.open(p, "wt", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    rows = read_jsonl(spark, str(p)).select("text").collect()
    assert sorted(r.text for r in rows) == sorted(["ok line", "", "", "ééé"])


def test_xz_suffix_is_refused(spark):
    with pytest.raises(ValueError):
        read_jsonl(spark, "/nowhere/x.jsonl.xz")


def test_min_chars_counts_code_points(spark):
    df = spark.createDataFrame([("a" * 199 + "é",), ("a" * 199 + "\U0001F600",), ("a" * 199,)], "text string")
    kept = C.min_chars_gate(df, 200).count()
    assert kept == 2
    assert C.min_chars_gate(df, 0).count() == 2  # 0 means the default 200


def test_quota_zero_when_fewer_rows_than_shards(spark):
    cat = spark.createDataFrame([(i, f"s{i}", 10) for i in range(5)], "ord int, shard string, n_rows long")
    q = {r.shard: r.quota for r in C.allocate_quotas(cat, 3).collect()}
    assert q == {"s0": 1, "s1": 1, "s2": 1, "s3": 0, "s4": 0}
    docs = spark.createDataFrame([(f"s{i}", i, p, f"d{i}-{p}", "x" * 300) for i in range(5) for p in range(10)],
                                 "shard string, ord int, pos long, doc_id string, text string")
    out = C.uniform_shard_sample(docs, 3, 200).collect()
    assert sorted(r.shard for r in out) == ["s0", "s1", "s2"]


def test_rank_must_be_below_world(spark):
    df = spark.range(10).withColumnRenamed("id", "pos")
    with pytest.raises(ValueError):
        C.rank_stripe(df, 8, 3)
    with pytest.raises(ValueError):
        C.stripe_overlap(df, [(8, 3)])


def test_repack_file_count_rule():
    with pytest.raises(ValueError):
        C.check_repack(5, 4)  # ceil packing opens only 3 files
    C.check_repack(4, 3)      # exact fill: last file empty, still 3 opened
    assert C.repack_files_opened(4, 3) == 3


def test_repack_plan_last_file_empty(spark):
    rows = spark.range(4).withColumnRenamed("id", "gidx")
    ids = [r.file_id for r in C.repack_plan(rows, 3).orderBy("gidx").collect()]
    assert ids == [0, 0, 1, 1]


def test_finite_forms(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert df.filter(finite("x")).count() == 1
    assert df.filter(finite_recorder("x")).count() == 2  # keeps -inf


def test_stable_checkpoint_duplicate_step_last_wins(spark):
    curve = spark.createDataFrame([
        (1, "g", 100, 0.9, True, "n100", 0), (1, "g", 100, 0.1, True, "n100", 1),
        (1, "g", 200, 0.5, True, "n200", 2)], "uid long, grp string, step long, loss double, saved boolean, name string, loss_pos long")
    r = T.stable_checkpoint(curve).collect()[0]
    assert (r.step, r.raw, r.rule) == (100, 0.1, "best")


def test_stable_checkpoint_ties_go_to_lowest_step(spark):
    curve = spark.createDataFrame([(1, "g", s, 1.0, True, f"n{s}") for s in (300, 100, 200)],
                                  "uid long, grp string, step long, loss double, saved boolean, name string")
    r = T.stable_checkpoint(curve).collect()[0]
    assert (r.step, r.rule) == (100, "stable")


def test_exact_tie_zeroes_both(spark):
    m = spark.createDataFrame([(1, 1, 1.2, 2.0), (1, 2, 1.2, 2.0), (1, 3, 1.5, 2.0)],
                              "cycle int, uid long, val_loss double, baseline double")
    s = {r.uid: r for r in B.scoring(m).collect()}
    assert s[1].score == 0.0 and s[2].score == 0.0 and s[1].tied
    assert s[3].place == 1 and s[3].reward == 2.25
    assert math.isclose(s[3].score, 0.5 ** 1.2)


def _samples(spark, rows):
    return spark.createDataFrame(rows, "cycle int, uid long, slot string, pos long, val_loss double, sample_cycle int, "
                                       "status string, age long, incentive double, cohort string, repo string, baseline double")


def test_one_slot_spread_is_null_and_last_duplicate_wins(spark):
    rows = [(1, 7, "a", 1, 1.0, 5, "ok", 10, 0.0, "A", None, 2.0),
            (1, 8, "a", 2, 1.0, 5, "ok", 10, 0.0, "A", None, 2.0),
            (1, 8, "a", 3, 3.0, 5, "ok", 10, 0.0, "A", None, 2.0),
            (1, 8, "b", 4, 2.0, 5, "ok", 10, 0.0, "A", None, 2.0)]
    m = {r.uid: r for r in B.miner_rows(_samples(spark, rows)).collect()}
    assert m[7].slot_spread is None
    assert m[8].slot_spread == 1.0  # slot a -> 3.0 (last duplicate), slot b -> 2.0


def test_freshest_sample_rule(spark):
    rows = [(1, 9, "a", 1, 1.0, 5, "ok", 50, 0.0, "A", None, 2.0),
            (1, 9, "b", 2, 2.0, 6, "stale", 50, 0.0, "A", None, 2.0),
            (1, 9, "c", 3, 3.0, 6, "ok", None, 0.0, "A", None, 2.0),
            (1, 9, "d", 4, 4.0, 6, "ok", 10, 0.0, "A", None, 2.0),
            (1, 9, "e", 5, None, 9, "ok", 1, 0.0, "A", None, 2.0)]
    m = B.miner_rows(_samples(spark, rows)).collect()[0]
    assert m.val_loss == 4.0  # newest cycle, ok, youngest; NULL loss ignored


def test_unseen_cohort_and_promotion_from_absent(spark):
    m = spark.createDataFrame([(1, 1, "tail"), (2, 1, "A"), (2, 2, "weird"), (2, 3, "B")],
                              "cycle int, uid long, cohort string")
    moves = {r.uid: r for r in B.cohort_moves(m).collect()}
    assert moves[1].from_rank == 1 and moves[1].to_rank == 4 and moves[1].promoted
    assert moves[3].from_rank == 0 and moves[3].promoted   # absent from the first snapshot
    assert 2 not in moves                                   # unknown cohort ranks 0, like absent
    r = m.orderBy("cycle", "uid").select(B.cohort_rank("cohort").alias("r")).collect()
    assert [x.r for x in r] == [1, 4, 0, 3]


def test_asof_strict_and_unmatched(spark):
    up = spark.createDataFrame([(1, 10, ts("2024-01-01 00:00:05"), "u1"), (1, 11, ts("2024-01-01 00:00:10"), "u2"),
                                (2, 12, ts("2024-01-01 00:00:01"), "u3")], "uid long, pos long, ts timestamp_ntz, rev string")
    dl = spark.createDataFrame([(1, 1, ts("2024-01-01 00:00:05"), "d-same"), (1, 2, ts("2024-01-01 00:00:01"), "d-early")],
                               "uid long, pos long, ts timestamp_ntz, rev string")
    r = {x.rev: x for x in L.asof_backward(up, dl).collect()}
    assert r["u1"].d_rev == "d-early"     # equal time is not "before"
    assert r["u2"].d_rev == "d-same"
    assert r["u3"].matched is False


def test_open_window_ends_at_as_of(spark):
    pubs = spark.createDataFrame([(1, "a", ts("2024-01-01 00:00:00")), (1, "b", ts("2024-01-02 00:00:00"))],
                                 "repo long, rev string, t timestamp_ntz")
    w = {r.rev: r for r in L.validity_windows(pubs, "2024-01-05 00:00:00").collect()}
    assert w["a"].end == ts("2024-01-02 00:00:00")
    assert w["b"].end == ts("2024-01-05 00:00:00")
    commits = spark.createDataFrame([(7, 1, "c1", ts("2024-01-02 00:00:00")), (8, 1, "c0", ts("2024-01-01 12:00:00"))],
                                    "owner long, repo long, rev string, t timestamp_ntz")
    got = {r.rev: (r.n_commits, r.last_rev) for r in L.commits_in_windows(w and L.validity_windows(pubs, "2024-01-05 00:00:00"), commits).collect()}
    assert got == {"a": (1, "c0"), "b": (1, "c1")}  # half-open: the boundary commit belongs to b


def _tensor(spark, rows):
    return spark.createDataFrame(rows, "party int, k long, name string, vals array<float>")


def test_zero_norm_delta_and_shape_mismatch(spark):
    rows = [(0, 1, "model.layers.0.w", [1.0, 2.0]), (1, 1, "model.layers.0.w", [1.0, 2.0]),
            (2, 1, "model.layers.0.w", [2.0, 2.0]),
            (0, 2, "layers", [1.0, 1.0]), (1, 2, "layers", [1.0, 1.0, 1.0]), (2, 2, "layers", [1.0, 0.0])]
    t = _tensor(spark, rows)
    g = {(r.i, r.j): r for r in VX.gram(t).collect()}
    assert math.isnan(g[(1, 2)].cosine)       # party 1 has a zero delta
    wb = VX.with_base(t)
    assert VX.pair_cosine(wb, 1, 2).collect()[0].cosine is None
    d = {r.party: r for r in VX.distance(wb).collect()}
    assert d[1].shape_mismatch == 1 and d[1].identical == 1
    names = t.select(layer_of("name").alias("l")).distinct().collect()
    assert {r.l for r in names} == {"0", "other"}  # name ending in 'layers' has no layer token


def test_alert_repeat_boundary(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, i, base + dt.timedelta(seconds=s), "CRIT", "x log silent 40 min")
            for i, s in enumerate([0, 3599, 3600, 7199, 7200])]
    a = spark.createDataFrame(rows, "uid long, poll long, ts timestamp_ntz, severity string, message string")
    got = sorted(r.poll for r in G.suppress_alerts(a).collect())
    assert got == [0, 2, 4]


def test_stale_gauge_island_rules(spark):
    nan = float("nan")
    rows = [(1, 1, 10, 1.0), (1, 2, 10, 1.0), (1, 3, 11, 1.0), (1, 4, 12, 1.0), (1, 5, 12, None),
            (1, 6, 13, 1.0), (1, 7, 13, nan), (1, 8, 14, nan), (1, 9, 14, 0.0), (1, 10, 15, -0.0)]
    p = spark.createDataFrame(rows, "uid long, poll long, round_id int, val_loss double")
    r = {x.poll: x for x in G.stale_gauge(p).collect()}
    assert (r[2].stale, r[2].rounds) == (False, 0)
    assert (r[3].stale, r[3].rounds) == (True, 1)
    assert (r[4].stale, r[4].rounds) == (True, 2)
    assert r[5].stale is False and r[5].rounds is None   # NULL loss leaves state alone
    assert (r[6].stale, r[6].rounds) == (True, 3)
    assert (r[8].stale, r[8].first_round) == (True, 13)  # NaN equals NaN
    assert r[10].first_round == 15                       # -0.0 differs from 0.0


def test_settings_precedence_is_by_object(spark):
    s = spark.createDataFrame([("uid", 1, None), ("uid", 2, 5e-5), ("shared", None, 3e-5)],
                              "scope string, uid long, peak_lr double")
    uids = spark.createDataFrame([(1,), (2,), (3,)], "uid long")
    r = {x.uid: (x.peak_lr, x.level) for x in CD.layered_lookup(uids, s, "peak_lr", 3e-4).collect()}
    assert r == {1: (None, "uid"), 2: (5e-5, "uid"), 3: (3e-5, "shared")}


def test_factor_ties_and_zero_effect(spark):
    m = spark.createDataFrame([(1, 1, 1.0), (1, 2, 1.0), (1, 3, 1.2)], "cycle int, uid long, val_loss double")
    f = spark.createDataFrame([("LR", 1, 2), ("DATA", 1, 3)], "factor string, a long, b long")
    r = {x.factor: x for x in B.factor_verdicts(m, f).collect()}
    assert r["LR"].better == 1                 # equal values: the control is better
    assert r["LR"].verdict == "comparable"     # smaller effect is 0 -> comparable


def test_text_helpers(spark):
    df = spark.createDataFrame([("\x1b[36m2024-01-02 03:04:05\x1b[0m abc", "org/x:rev1:z", "abc1234.,'\"")],
                               "line string, spec string, rev string")
    r = df.select(line_timestamp(strip_ansi("line")).alias("t"), *split_first_colon("spec"),
                  strip_revision("rev").alias("r")).collect()[0]
    assert r.t == ts("2024-01-02 03:04:05")
    assert tuple(r)[1:3] == ("org/x", "rev1:z")
    assert r.r == "abc1234"


def test_train_record_strings_are_typed(spark):
    from quarry.sources.snapshots import parse_train_records

    df = spark.createDataFrame([('{"uid": "7", "cycle": "3", "local_eval": "1.25", "validator_val_loss": "1.5x"}',),
                                ("{not json",)], "json string")
    r = parse_train_records(df).collect()
    assert (r[0].uid, r[0].cycle, r[0].local_eval, r[0].validator_val_loss) == (7, 3, 1.25, None)
    assert r[1].uid is None


def test_slot_map_last_duplicate_wins(spark):
    rows = [(1, 8, "b", 1, 1.0, 5, "ok", 10, 0.0, "A", None, 2.0),
            (1, 8, "a", 2, 2.0, 5, "ok", 10, 0.0, "A", None, 2.0),
            (1, 8, "b", 3, None, 5, "ok", 10, 0.0, "A", None, 2.0)]
    m = B.slot_map(_samples(spark, rows)).collect()[0]
    assert list(m.slots.items()) == [("a", 2.0), ("b", None)]


def test_means_keep_small_terms_and_infinities(spark):
    rows = [(0, 3e-12), (0, 5e-12), (1, 1.0), (1, float("inf"))]
    points = spark.createDataFrame([(a, "pre", x) for a, x in rows], "arm int, phase string, loss double")
    assert {r.arm: r.pre for r in T.ab_verdict(points).collect()} == {0: 4e-12, 1: float("inf")}


def test_exploit_keeps_the_best_trials_settings(spark):
    rows = [(uid, c, 3e-5, 1.0 + abs(c - 7), None, 0.01 * c, 0.02 * c) for uid in range(1, 40) for c in range(1, 15)]
    t = spark.createDataFrame(rows, "uid long, cycle long, peak_lr double, val_loss double, drift double, warmup double, min_frac double")
    out = [r for r in T.next_trial(t, F.lit(1000)).collect() if r.source == "exploit"]
    assert out and all((r.warmup, r.min_frac) == (0.01 * 7, 0.02 * 7) for r in out)


def test_group_mismatch_is_reported(spark):
    seen = spark.createDataFrame([(1, "g1", "3"), (2, "g9", None), (3, None, "1")], "uid long, grp string, rank string")
    want = spark.createDataFrame([(u, "g1", 3) for u in (1, 2, 3, 4)], "uid long, want_group string, want_rank int")
    got = {r.uid: (r.group_severity, r.severity) for r in L.settings_drift(seen, want).collect()}
    assert got == {1: (None, None), 2: ("CRIT", "CRIT"), 3: (None, None), 4: (None, None)}


def test_all_six_status_notes(spark):
    m = spark.createDataFrame([(1, 1, None, 700, None), (2, 1, "tail", 5, "r"), (1, 2, "A", None, "r")],
                              "cycle int, uid long, cohort string, max_age long, repo string")
    uploads = spark.sql("""SELECT 1 AS cycle, 1L AS uid, TIMESTAMP'2024-01-01 00:00:00' AS uploaded_at, 'abcdef1' AS upload_rev, 'abcdef1234' AS chain_rev
                           UNION ALL SELECT 1, 3L, TIMESTAMP'2024-01-01 00:00:00', 'abcdef1', '9999999'""")
    clock = spark.sql("SELECT 1 AS cycle, TIMESTAMP'2024-01-01 03:30:00' AS now UNION ALL SELECT 2, TIMESTAMP'2024-01-01 03:31:00'")
    m = m.unionByName(spark.createDataFrame([(1, 3, "B", 600, "r")], m.schema))
    got = {(r.cycle, r.uid): r.notes for r in B.status_notes(B.carried_uploads(m, uploads, clock)).collect()}
    assert got == {
        (1, 1): ["cohort None has no weight", "score age 700 blocks", "no commit on chain"],
        (2, 1): ["cohort tail has no weight", "nothing committed this cycle", "last upload 211 minutes ago"],
        (1, 2): ["nothing committed this cycle"],
        (1, 3): ["revision on chain 9999999, uploaded abcdef1"]}


def test_repack_refuses_and_keeps_the_live_version(spark, tmp_path):
    from quarry.sources.files import current_version, repack

    rows = lambda n: spark.range(n).select(F.col("id").alias("gidx"), F.col("id").cast("string").alias("text"))
    live = repack(rows(10), str(tmp_path), 3)
    assert spark.read.parquet(live).inputFiles().__len__() == 3
    for n, files in ((5, 4), (4, 3), (0, 1)):  # refused at once, found short after writing, nothing to pack
        with pytest.raises((ValueError, RuntimeError)):
            repack(rows(n), str(tmp_path), files)
    assert current_version(str(tmp_path), spark).endswith(live.rsplit("/", 1)[1])


def test_mixture_repeats_a_short_source(spark):
    streams = spark.createDataFrame([("a", 0, 10), ("a", 1, 11), ("b", 0, 20)], "src string, k long, doc_id long")
    weights = spark.createDataFrame([("a", 0.5, 0), ("b", 0.5, 1), ("none", 0.0, 2)], "src string, weight double, sord int")
    got = [(r.src, r.doc_id) for r in C.weighted_mixture(streams, weights, 8).orderBy("mix_idx").collect()]
    assert got == [("a", 10), ("b", 20), ("a", 11), ("b", 20)] * 2
