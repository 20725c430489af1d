"""Compare registered Spark queries with their DuckDB oracle SQL.

Same policy as the driver: row count, column names, and an order-insensitive
comparison of values with columns sorted by name.  Usable as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = [
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES[0].split():
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        # exact: both sides round their doubles with the same IEEE formula
        return None if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    try:
        import numpy as np

        if isinstance(v, np.generic):
            return _norm(v.item())
    except Exception:
        pass
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


SPARK_TO_DUCK = {
    "IntegerType()": "INTEGER",
    "BooleanType()": "BOOLEAN",
    "LongType()": "BIGINT",
    "DoubleType()": "DOUBLE",
    "StringType()": "VARCHAR",
    "DateType()": "DATE",
    "TimestampNTZType()": "TIMESTAMP",
}


def type_mismatches(spark_schema, duck_rel) -> dict:
    s = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in spark_schema.fields}
    d = {c: str(t) for c, t in zip(duck_rel.columns, duck_rel.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return False, f"columns differ: {sorted(spark_df.columns)} vs {sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return False, f"row count {len(spark_df)} vs {len(oracle_df)}"
    a, b = canon(spark_df), canon(oracle_df)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"row {i}: spark {x} vs oracle {y} (cols {sorted(spark_df.columns)})"
    return True, f"{len(a)} rows"


def run(sf_dir: str, names: list[str] | None = None) -> dict[str, tuple[bool, str]]:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from feedlens.session import local_session

    spark = local_session(8)
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sq = qs[name](spark, sf_dir)
            sdf = sq.toPandas()
        except Exception as e:  # noqa: BLE001
            out[name] = (False, f"spark error: {str(e)[:400]}")
            print(name, out[name], flush=True)
            continue
        t1 = time.time()
        if name not in sql:
            out[name] = (True, f"{len(sdf)} rows (no oracle)")
        else:
            try:
                odf = con.execute(sql[name]).df()
                out[name] = compare(sdf, odf)
                bad_types = type_mismatches(sq.schema, con.sql(sql[name]))
                if out[name][0] and bad_types:
                    out[name] = (False, f"types differ: {bad_types}")
            except Exception as e:  # noqa: BLE001
                out[name] = (False, f"oracle error: {str(e)[:400]}")
        print(f"{name:28s} {'OK ' if out[name][0] else 'BAD'} spark {t1 - t0:5.2f}s  {out[name][1]}", flush=True)
    return out


if __name__ == "__main__":
    res = run(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v[0]]
    print("FAILED:", bad)
