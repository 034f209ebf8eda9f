"""Run every registered query at a scale factor and compare with its DuckDB oracle (rows, schema, values)."""
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from tests.conftest import make_spark  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else
                          (round(float(v), 6) if isinstance(v, float) else (str(v) if not isinstance(v, (int, bool, str)) else v)))
    return df.astype(str).sort_values(list(df.columns)).reset_index(drop=True)


def main(sf_dir: str, only: list[str]):
    spark = make_spark()
    con = duckdb.connect()
    con.execute("SET memory_limit = '6GB'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sp = fn(spark, sf_dir).toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}")
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"{name}: rows-only {len(sp)} rows ({dt:.1f}s)")
            continue
        try:
            db = con.execute(sqls[name]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"{name}: SQL ERROR {str(exc)[:300]}")
            continue
        ok_cols = sorted(sp.columns) == sorted(db.columns)
        same = ok_cols and len(sp) == len(db) and canon(sp).equals(canon(db))
        print(f"{name}: {'MATCH' if same else 'DIFF'} spark={len(sp)} sql={len(db)} cols_ok={ok_cols} ({dt:.1f}s)")
        if not same and ok_cols and len(sp) == len(db):
            a, b = canon(sp), canon(db)
            diff = (a != b).any(axis=1)
            print(a[diff].head(3).to_string()); print(b[diff].head(3).to_string())
        elif not ok_cols:
            print("  spark cols", list(sp.columns), "sql cols", list(db.columns))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
