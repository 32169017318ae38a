"""Row-by-row comparison of a query with its SQL, order left aside."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()  # fmt: skip


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, dt.datetime):
        return ("time", value.replace(tzinfo=None).isoformat())
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, name: str, fn, sql: str, sf_dir: str) -> str | None:
    df = fn(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        only, missing = ours - theirs, theirs - ours
        lines = [f"{sum(ours.values())} rows / {sum(theirs.values())}, {sum(only.values())} differ",
                 str(sorted(names))]
        lines += [f"  spark {r}" for r in sorted(only, key=str)[:2]]
        lines += [f"  sql   {r}" for r in sorted(missing, key=str)[:2]]
        return "\n".join(lines)
    return None if ours else "no rows"


def main(sf_dir: str, *wanted: str) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    spark = make_session()
    con = connect(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in sql:
                found = differences(spark, con, name, fn, sql[name], sf_dir)
            else:
                found = None if fn(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:900]}"
        bad += found is not None
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}",
              flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
