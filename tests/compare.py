"""Run registered queries against their SQL counterparts: python -m tests.compare SF_DIR [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def oracle_frame(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con.execute(sql).fetchdf()


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows by column name, in an order of their own."""
    frame = frame[sorted(frame.columns)].astype(object).where(frame[sorted(frame.columns)].notna(), None)
    rows = [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)) if isinstance(v, str) else "", str(v)) for v in r))


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = normal(got), normal(want)
    if a == b:
        return None
    extra = [r for r in a if r not in set(b)][:2]
    missing = [r for r in b if r not in set(a)][:2]
    return f"rows {len(a)} != {len(b)}; spark only {extra}; sql only {missing}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, sql, bad = make_session(), oracle_sql(), []
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir)
            types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
            problem = differences(got.toPandas(), oracle_frame(sf_dir, sql[name])) if name in sql else "no SQL"
        except Exception as error:  # report every query
            types, problem = {}, f"{type(error).__name__}: {str(error)[:600]}"
        bad += [name] if problem else []
        print(f"\n{'FAIL' if problem else 'ok'} {name} {time.time() - start:.1f}s {types} {problem or ''}", flush=True)
    print(f"\n{len(bad)} failing: {bad}")


if __name__ == "__main__":
    main()
