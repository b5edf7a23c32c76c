"""Side-by-side check of a Spark query against its DuckDB text.

Mirrors the driver's gate: same column names, same row count, and the same
multiset of rows after normalising values (doubles rounded, NaN and -0.0
folded, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os

from quarry.sources.tables import TABLES, table_path


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, places: int = 6):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        if math.isinf(f):
            return "inf" if f > 0 else "-inf"
        r = round(f, places)
        if r == 0:
            r = 0.0
        if r == int(r) and abs(r) < 2 ** 53:
            return int(r)
        return r
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x, places)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, places) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x, places) for x in v)
    return v


def normalise_rows(columns, rows, places: int = 6):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], places) for i in order) for r in rows]
    out.sort(key=repr)
    return [columns[i] for i in order], out


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT", "date": "DATE"}


def duck_type(spark_type) -> str:
    """DuckDB spelling of a Spark type (arrays as ``T[]``)."""
    s = spark_type.simpleString()
    depth = 0
    while s.startswith("array<"):
        s, depth = s[6:-1], depth + 1
    return _TYPES.get(s, s) + "[]" * depth


def compare(spark_df, con, sql: str, places: int = 6) -> dict:
    s_cols = list(spark_df.columns)
    s_types = {f.name: duck_type(f.dataType) for f in spark_df.schema.fields}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sc, sr = normalise_rows(s_cols, s_rows, places)
    dc, dr = normalise_rows(d_cols, d_rows, places)
    out = {"spark_rows": len(sr), "oracle_rows": len(dr), "columns_match": sc == dc,
           "spark_cols": sc, "oracle_cols": dc, "values_match": sr == dr}
    if not out["values_match"]:
        s_set, d_set = set(map(repr, sr)), set(map(repr, dr))
        out["only_spark"] = sorted(s_set - d_set)[:5]
        out["only_oracle"] = sorted(d_set - s_set)[:5]
    out["types_match"] = s_types == d_types
    if not out["types_match"]:
        out["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_types) | set(d_types)
                            if s_types.get(c) != d_types.get(c)}
    out["ok"] = out["columns_match"] and out["values_match"] and out["types_match"]
    return out
