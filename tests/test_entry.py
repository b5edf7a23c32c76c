"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_stable_schema(spark):
    m = _entry_module()
    df = m.entry(spark)
    assert df.schema.simpleString() == "struct<shard:string,pos:bigint,doc_id:bigint,n_chars:bigint,quota:bigint>"
    assert df.count() > 0
    assert df.schema == m.entry(spark).schema


def test_queries_and_oracles_share_keys():
    m = _entry_module()
    q, o = m.queries(), m.oracle_sql()
    # queries of the optional subpackage may go without SQL; all others have it
    optional = {k for k in q if k == "pipeline" or k.startswith("op")}
    assert q and set(o) <= set(q) and set(q) - optional <= set(o)
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s.strip() for s in o.values())
