"""Run registered Spark queries and their DuckDB oracles side by side.

usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
Prints one line per query: rows, schema and value agreement.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            df[c] = s.astype("datetime64[us]").astype("int64").where(s.notna(), None)
        elif pd.api.types.is_float_dtype(s):
            df[c] = s.round(6)
        df[c] = df[c].map(lambda x: None if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and pd.isna(x)) else
                          (pd.Timestamp(x).value // 1000 if hasattr(x, "isoformat") and not isinstance(x, str)
                           else str(x)))
    df = df.astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    pats = [a for a in args if a != sf]
    from keepsake.session import get_session
    from keepsake.registry import queries, oracle_sql
    spark = get_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            spd = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: spark rows={len(spd)} ({ts:.1f}s) no oracle")
            continue
        try:
            opd = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(spd.columns) != sorted(opd.columns):
            print(f"FAIL {name}: columns spark={sorted(spd.columns)} oracle={sorted(opd.columns)}")
            bad += 1
            continue
        a, b = normalise(spd), normalise(opd)
        if len(a) != len(b):
            print(f"FAIL {name}: rows spark={len(a)} oracle={len(b)}")
            bad += 1
            continue
        if not a.equals(b):
            diff = (a != b).any(axis=1)
            i = int(diff.idxmax())
            print(f"FAIL {name}: values differ at row {i}: spark={a.iloc[i].to_dict()} oracle={b.iloc[i].to_dict()}")
            bad += 1
            continue
        print(f"OK   {name}: rows={len(a)} ({ts:.1f}s)")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
