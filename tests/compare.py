"""Run registered queries against their check SQL: python tests/compare.py SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable", na_position="first").reset_index(
        drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both hold the same rows with the same columns and types."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    got, want = normal(got), normal(want)
    for name in got.columns:
        a, b = got[name], want[name]
        both = a.isna() & b.isna()
        wrong = ~((a == b) | both)
        if wrong.any():
            i = wrong.idxmax()
            return f"{name}: {int(wrong.sum())} values, e.g. {a[i]!r} != {b[i]!r}"
        if a.dtype != b.dtype and not (a.isna().any() or b.isna().any()):
            return f"{name}: type {a.dtype} != {b.dtype}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    spark, con = make_session(), connect(sf_dir)
    checks, failed = oracle_sql(), []
    for name, run in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            took = time.time() - began
            if name in checks:
                problem = differences(got, con.sql(checks[name]).df())
            else:
                problem = None if len(got) else "no rows"
            mark = "same" if name in checks else "rows"
        except Exception as error:  # noqa: BLE001
            problem, took, got, mark = f"{type(error).__name__}: {str(error)[:600]}", 0, (), ""
        print(f"{name:28} {took:6.2f}s {len(got):8} {problem or mark}", flush=True)
        if problem:
            failed.append(name)
    print("FAILED:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
