"""File sources and sinks on temporary folders written from the driver tables."""

import lzma
import re
import json
import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import corpus as C
from quarry.sources import files as S
from quarry.sources.fixtures import docs
from quarry.sources.snapshots import flatten_snapshot, read_history

from conftest import SMALL


def test_xz_decoder_keeps_physical_lines(spark, tmp_path):
    d = docs(spark, SMALL).filter("shard in ('src0', 'src1')").select("shard", "pos", "text").collect()
    for shard in ("src0", "src1"):
        with lzma.open(tmp_path / f"{shard}.jsonl.xz", "wt", encoding="utf-8") as fh:
            for r in sorted((x for x in d if x.shard == shard), key=lambda x: x.pos):
                fh.write(json.dumps({"text": r.text}) + "\n")
                fh.write("not json\n")
    out = S.read_jsonl_xz(spark, str(tmp_path / "*.xz")).collect()
    assert len(out) == len(d)
    assert all(r.pos % 2 == 0 for r in out)  # malformed lines still count as physical lines


def test_write_shards_and_read_corpus(spark, tmp_path):
    d = docs(spark, SMALL).select("text")
    out = str(tmp_path / "corpus")
    S.write_shards(d, out, rows_per_file=37)
    rows = S.read_corpus(spark, out)
    per_file = rows.groupBy("file_name").count().collect()
    assert all(r["count"] <= 37 for r in per_file)
    g = C.global_index(rows).select("gidx").collect()
    assert sorted(r.gidx for r in g) == list(range(d.count()))


def test_publish_refuses_empty_and_keeps_previous(spark, tmp_path):
    root = str(tmp_path / "live")
    d = docs(spark, SMALL).select("text")
    first = S.publish(d.limit(10), root)
    with pytest.raises(RuntimeError):
        S.publish(d.filter("false"), root)
    assert S.current_version(root) == first
    second = S.publish(d, root)
    assert S.current_version(root) == second and os.path.isdir(first)


def test_verify_corpus_lists_unreadable(spark, tmp_path):
    base = tmp_path / "group"
    d = docs(spark, SMALL)
    S.write_shards(d.filter("shard = 'src0'").select("text"), str(base / "a"), rows_per_file=4)
    S.write_shards(d.filter("shard = 'src1'").select("text"), str(base / "b"), rows_per_file=100)
    (base / "b" / "part-99999-broken.parquet").write_bytes(b"not parquet")
    n_a = len([f for f in os.listdir(base / "a") if f.endswith(".parquet")])
    manifest = spark.createDataFrame([("a", n_a, 10), ("b", 1, 10)], "source string, shards int, rows long")
    r = {x.source: x for x in S.verify_corpus(spark, str(base), manifest).collect()}
    assert r["a"].ok and r["a"].rows_on_disk == 10
    assert not r["b"].ok and r["b"].unreadable == ["part-99999-broken.parquet"]


def test_logs_reader_and_history(spark, tmp_path):
    (tmp_path / "uid7-train.log").write_text("2024-01-01 00:00:00 peak_lr=3e-05\n  continuation\n")
    (tmp_path / "uid7-commit.log").write_text("2024-01-01 00:00:05 MinerCommit2> committing hf_repo_id=o/r hf_revision=abc,\n")
    (tmp_path / "notes.txt").write_text("ignored\n")
    lg = S.read_logs(spark, str(tmp_path / "*.log")).collect()
    assert {(r.uid, r.kind) for r in lg} == {(7, "train"), (7, "commit")}
    assert sum(1 for r in lg if r.ts is None) == 1
    hist = tmp_path / "snap.jsonl"
    hist.write_text('{"cycle": 3, "baseline": 2.0, "leaderboard": {"5": {"uid": 5, "validator_metrics": '
                    '[{"validator_slot": "2", "val_loss": 1.5}]}}}\n\n{broken\n')
    rows = flatten_snapshot(read_history(spark, str(hist))).collect()
    assert [(r.cycle, r.uid, r.slot, r.val_loss) for r in rows] == [(3, 5, "2", 1.5)]


def test_append_events_buckets_and_prunes(spark, tmp_path):
    from quarry.sources.fixtures import board

    path = str(tmp_path / "events")
    b = board(spark, SMALL)
    S.append_events(b, path, buckets=8)
    S.append_events(b, path, buckets=8)
    one = S.read_events(spark, path, uid=7, buckets=8)
    assert one.count() == 2 * b.filter("uid = 7").count()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(uid_bucket" in plan


def test_shard_files_give_physical_positions(spark, tmp_path):
    """C1 over shard files (positions from row_index + file offsets) equals C1
    over the fixture view (positions from doc_id order)."""
    from quarry.operators import corpus as CC

    root = str(tmp_path / "corpus")
    d = docs(spark, SMALL)
    (d.select("shard", "pos", "doc_id", "text").repartition(4, "shard").sortWithinPartitions("shard", "pos")
      .write.option("maxRecordsPerFile", 3).partitionBy("shard").parquet(root))
    rows = S.read_shards(spark, root, extra=["doc_id"])
    got = {(r.shard, r.pos, r.doc_id) for r in rows.select("shard", "pos", "doc_id").collect()}
    assert got == {(r.shard, r.pos, r.doc_id) for r in d.select("shard", "pos", "doc_id").collect()}
    # catalogue ordinals follow source names, so compare with ord re-derived the same way
    a = {r.doc_id for r in CC.uniform_shard_sample(rows, 60, 200).collect()}
    fx = d.drop("ord").join(rows.select("shard", "ord").distinct(), "shard")
    b = {r.doc_id for r in CC.uniform_shard_sample(fx, 60, 200).collect()}
    assert a == b and len(a) > 0


def test_log_tail_prunes_day_folders(spark, tmp_path):
    from quarry.operators.logs import parsed_lines
    from quarry.sources.fixtures import logs

    path = str(tmp_path / "logdays")
    S.append_log_lines(parsed_lines(logs(spark, SMALL)).select("uid", "pos", "kind", "ts"), path)
    tail = S.read_log_tail(spark, path, "2024-01-29 00:00:00")
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan)
    assert tail.filter("ts < timestamp_ntz'2024-01-29 00:00:00'").count() == 0


def test_line_numbers_are_per_file(spark, tmp_path):
    """Several files, one read in many blocks: positions are line numbers, malformed lines counted."""
    for name, n in (("a", 7), ("b", 4000)):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"text": f"{name}{i}"}) + "\n" if i % 3 else "{broken\n" for i in range(n)))
    (tmp_path / "uid3-train.log").write_text("".join(f"2024-01-01 00:00:00 line {i}\n" for i in range(4000)))
    (tmp_path / "uid4-train.log").write_text("one\ntwo\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = S.read_jsonl(spark, str(tmp_path / "*.jsonl")).collect()
        logs = S.read_logs(spark, str(tmp_path / "*.log")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.file_name, r.pos, r.text) for r in rows) == sorted(
        (f"{n}.jsonl", i, f"{n}{i}") for n, k in (("a", 7), ("b", 4000)) for i in range(k) if i % 3)
    assert sorted((r.uid, r.pos, r.line) for r in logs) == sorted(
        [(3, i, f"2024-01-01 00:00:00 line {i}") for i in range(4000)] + [(4, 0, "one"), (4, 1, "two")])


def test_xz_of_several_streams(spark, tmp_path):
    parts = [b'{"text": "a"}\n{"te', b'xt": "b"}\n', b'not json\n{"text": "c"}']
    (tmp_path / "s.jsonl.xz").write_bytes(lzma.compress(parts[0]) + lzma.compress(parts[1]) + b"\0" * 4 + lzma.compress(parts[2]))
    rows = S.read_jsonl_xz(spark, str(tmp_path / "s.jsonl.xz")).collect()
    assert sorted((r.pos, r.text) for r in rows) == [(0, "a"), (1, "b"), (3, "c")]
    data = lzma.compress(parts[0]) + lzma.compress(parts[1])
    assert list(S._xz_lines(data, step=5)) == (parts[0] + parts[1]).splitlines()


def test_tokenizer_hook_equals_default(spark):
    from quarry.functions.tokenize import token_ids

    d = docs(spark, SMALL).select("doc_id", "text").limit(20)
    ids = lambda t: {r.doc_id: r.ids for r in t.select("doc_id", "ids").collect()}
    assert ids(token_ids(d)) == ids(token_ids(d, tokenizer="quarry.functions.tokenize:WhitespaceMd5"))


def test_raw_log_tail_ranges(tmp_path, monkeypatch):
    """Lines of byte ranges of every size: each line once, at its byte, the unfinished last one left for later."""
    import random

    import pyarrow as pa
    from quarry.sources import tail as T

    rng = random.Random(4)
    lines = ["".join(rng.choices("ab \xe9", k=rng.choice([0, 1, 5, 40]))).encode() for _ in range(300)]
    data = b"".join(x + b"\n" for x in lines)
    (tmp_path / "uid7-train.log").write_bytes(data + b"half a li")
    (tmp_path / "notes.txt").write_bytes(b"no log\n")
    starts = [sum(len(x) + 1 for x in lines[:i]) for i in range(300)]
    for block, size in ((1 << 20, 1 << 20), (7, 50), (64, 1), (3, 17)):
        monkeypatch.setattr(T, "BLOCK", block)
        monkeypatch.setattr(T, "TASK_BYTES", size)
        r = T._TailReader(str(tmp_path))
        end = r.latestOffset()
        assert end == {"uid7-train.log": len(data)}
        cut = starts[100]
        got = [x for a, b in (({}, {"uid7-train.log": cut}), ({"uid7-train.log": cut}, end)) for p in r.partitions(a, b)
               for t in r.read(p) for x in zip(t["at"].to_pylist(), t["line"].to_pylist(), strict=True)]
        assert got == [(s, x.decode()) for s, x in zip(starts, lines, strict=True)]
    assert r.partitions(end, end) == []
    (tmp_path / "uid7-train.log").write_bytes(b"anew\n")  # rotated
    got = pa.Table.from_batches([t for p in r.partitions(end, r.latestOffset()) for t in r.read(p)])
    assert got["line"].to_pylist() == ["anew"] and got["at"].to_pylist() == [0]
