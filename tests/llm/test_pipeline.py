"""The pipeline, stage by stage, against brute force; its registration and the guard of the entry."""

import importlib.util
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from quarry.llm import quality
from quarry.sources.tables import load
from test_ngram_join import slow_join
from test_texts import check_places, direct_ids, slow_counts

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"
sys.path.insert(0, ROOT)

import corpus_pipeline as cp  # noqa: E402


def entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_registered():
    q, o = entry().queries(), entry().oracle_sql()
    assert {n for n in range(1, 14)} == {int(m[1]) for k in q if (m := re.match(r"op(\d+)_", k))}
    assert q["pipeline"] is cp.run and "pipeline" not in o and len(cp.STAGES) == 5


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = load(spark, SMALL, "documents"), []
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append([r.asDict() for r in docs.collect()])
    return out


def test_quality_stage(spark, stages):
    docs = {r["doc_id"]: r["text"] for r in load(spark, SMALL, "documents").collect()}
    labels = {r["doc_id"]: r["quality"] for r in load(spark, SMALL, "labels").collect()}
    kept = {r["doc_id"]: r["text"] for r in stages[0]}
    assert all(docs[i] == t for i, t in kept.items())
    for i, t in docs.items():
        n = slow_counts(t)
        passes = n[0] >= 50 and 100 * n[4] <= 50 * n[0]
        assert passes or i not in kept
        if passes and labels.get(i) == 1:
            assert i in kept


def test_duplicate_stage(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[0]]
    want = {d for (d, _), (c, _) in zip(rows, slow_join(rows)) if d == c}
    assert {r["doc_id"] for r in stages[1]} == want and len(stages[1]) == len(want)


def test_secret_stage(stages):
    before = {r["doc_id"]: r["text"] for r in stages[1]}
    finds = re.compile(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}")
    changed = 0
    for r in stages[2]:
        assert not finds.search(r["text"]) and r["n_chars"] == len(r["text"])
        changed += r["text"] != before[r["doc_id"]]
        if "[SECRET]" not in r["text"]:
            assert r["text"] == before[r["doc_id"]]
    assert len(stages[2]) == len(stages[1]) and changed <= len(stages[1])


def test_mixing_stage(stages):
    from quarry.llm.mixing import TEMPERATURE

    def topic(t, n):
        return "table" if " | " in t else "note" if n < 100 else "article" if n < 1000 else "book"

    rows = []
    for r in stages[2]:
        n = len(quality.WORDS_RE.findall(r["text"]))
        rows.append((r["doc_id"], n, {"source": r["source"], "lang": r["lang"], "topic": topic(r["text"], n)}))
    cells = Counter()
    for _, n, k in rows:
        cells[tuple(k.values())] += n
    names, w = list(cells), np.array([float(x) for x in cells.values()])
    tokens = w.copy()
    targets = []
    for d, (dim, a) in enumerate(TEMPERATURE.items()):
        sums = Counter()
        for k, x in cells.items():
            sums[k[d]] += x
        total = sum(x ** a for x in sums.values())
        targets.append([sums[k[d]] ** a / total for k in names])
    for _ in range(300):
        for d in range(3):
            here = Counter()
            for k, x in zip(names, w):
                here[k[d]] += x
            w = np.array([x * t / here[k[d]] for k, x, t in zip(names, w, targets[d])])
    rate = dict(zip(names, w / tokens / (w / tokens).max()))
    import hashlib
    chance = lambda i: int(hashlib.sha256(f"mix:{i}".encode()).hexdigest()[:15], 16) / (1 << 60)
    want = {i for i, _, k in rows if chance(i) < rate[tuple(k.values())]}
    assert {r["doc_id"] for r in stages[3]} == want


def test_packing_stage(stages):
    want = Counter()
    for r in stages[3]:
        ids = direct_ids(r["text"])
        want.update((r["doc_id"], zlib.crc32(np.array(ids[a:a + 4096], dtype="<u4").tobytes())) for a in range(0, len(ids), 4096))
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in stages[4]) == want
    assert check_places([type("R", (dict,), {})(r) for r in stages[4]]) <= -(-sum(r["length"] for r in stages[4]) // 4096) + 1


def test_run_equals_stages(spark, stages):
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(key(r) for r in cp.run(spark, SMALL).collect()) == sorted(map(key, stages[4]))


def test_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, rate int"
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "s", 0, "x", 1), (3, good, None, None, 1, "x", 1), (3, good, None, None, 1, "x", 1),
            (None, good + " password=abcdef1", "en", "s", 1, "x", 1), (5, "v " * 60_000 + good, "en", "s", 2, "x", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema).coalesce(1)
        for k, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, docs, SMALL)
            if k < 4:
                assert tuple(out.columns) == cp.COLUMNS
            out.collect()


def tasks_of(spark, job):
    """Tasks that ran for ``job``."""
    tracker, name = spark.sparkContext.statusTracker(), f"tasks-{id(job)}"
    spark.sparkContext.setJobGroup(name, "")
    job()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))


@pytest.fixture
def sixty(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield 60
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_of_components_take_few_tasks(spark, sixty):
    """The driver keeps every task of a session, and a round has no more than the work asks for."""
    from quarry.llm.components import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(5, 3), (3, 5), (40, 41), (41, 41), (None, 7)], "a long, b long")
    got = []
    used = tasks_of(spark, lambda: got.extend(map(tuple, components(edges).collect())))
    assert sorted(got) == [(i, 0) for i in range(21)] + [(40, 40), (41, 40)]
    assert used < 6 * 6 * sixty


def test_small_cells_are_raked_without_shuffles(spark, sixty):
    from quarry.llm import mixing

    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 30), ("b", "x", 60), ("b", "y", 5)], "p string, q string, tokens long")
    targets = {"p": {"a": 1, "b": 1}, "q": {"x": 3, "y": 1}}
    got = []
    used = tasks_of(spark, lambda: got.extend(map(tuple, mixing.fitted_rates(cells, targets).collect())))
    n = {("a", "x"): 10, ("a", "y"): 30, ("b", "x"): 60, ("b", "y"): 5}
    w = {(p, q): rate * n[p, q] for p, q, rate in got}
    total = sum(w.values())
    assert max(rate for *_, rate in got) == pytest.approx(1)
    assert sum(v for (p, _), v in w.items() if p == "a") == pytest.approx(total / 2)
    assert sum(v for (_, q), v in w.items() if q == "x") == pytest.approx(total * 3 / 4)
    assert used < 2 * sixty
