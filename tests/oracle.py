"""Run a registered query and its SQL equivalent side by side.

Usage: python tests/oracle.py [sf_dir] [key prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, bool):
        return x
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    if isinstance(x, int):
        return float(x)
    if isinstance(x, (datetime.datetime, datetime.date)):
        return x.isoformat()
    return x


def sort_key(row):
    return tuple((x is not None, str(type(x)), round(x, 4) if isinstance(x, float) and math.isfinite(x) else str(x)) for x in row)


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names = sorted(df.columns)
    mine = sorted(([plain(r[n]) for n in names] for r in df.select(*[f"`{n}`" for n in names]).collect()), key=sort_key)
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    if sorted(cols) != names:
        return f"columns {names} vs {sorted(cols)}"
    order = [cols.index(n) for n in names]
    theirs = sorted(([plain(r[i]) for i in order] for r in cur.fetchall()), key=sort_key)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if not all(close(x, y) for x, y in zip(a, b))]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ ({names}), first: {bad[0]}"[:900]
    return None


def main(argv: list[str]) -> int:
    from tenderlens.session import build_session

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for key, fn in entry.queries().items():
        if wanted and not any(key.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if key in oracles:
                verdict = compare(df, con, oracles[key])
            else:
                verdict = None
                print(f"   {key}: {df.count()} rows, no SQL")
        except Exception as e:  # keep going over the other queries
            verdict = f"{type(e).__name__}: {str(e)[:600]}"
        failed += verdict is not None
        print(f"{'FAIL' if verdict else 'ok':4} {key} {time.time() - t:.2f}s {verdict or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
