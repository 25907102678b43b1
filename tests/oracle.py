"""Local twin of the driver's correctness check: Spark query vs DuckDB SQL.

Compares column names, row count and the multiset of normalised rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN"}


def compare(spark, con, q, sf_dir: str) -> dict:
    sdf = q.build(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_types = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in sdf.schema.fields}
    s_rows = sdf.collect()
    rel = con.sql(q.sql)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    cur = con.execute(q.sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out = {"name": q.name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols), "spark_cols": s_cols, "oracle_cols": d_cols,
           "types_match": s_types == d_types, "spark_types": s_types, "oracle_types": d_types}
    if out["cols_match"]:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
        dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
        out["values_match"] = sc == dc
        if sc != dc:
            out["only_spark"] = list((sc - dc).elements())[:3]
            out["only_oracle"] = list((dc - sc).elements())[:3]
    else:
        out["values_match"] = False
    out["ok"] = out["values_match"] and out["types_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
