"""Run queries against their SQL: ``python -m tests.oracle /root/testdata/sf0.01 [names...]``."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return "decimal " + str(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


FAMILY = {
    "BIGINT": "bigint", "HUGEINT": "huge", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def compare(df, con, sql: str) -> str | None:
    """None when columns and rows agree; else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if set(names) != set(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    order = sorted(names)
    want = Counter(tuple(_plain(row[names.index(c)]) for c in order) for row in result.fetchall())
    got = Counter(tuple(_plain(row[c]) for c in order) for row in df.select(*[f"`{c}`" for c in order]).collect())
    if want != got:
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; only in Spark {list((got - want))[:3]}; "
            f"only in SQL {list((want - got))[:3]}; columns {order}"
        )
    return None


def describe_types(con, sql):
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}


def compare_types(df, con, sql) -> str | None:
    want = describe_types(con, sql)
    got = dict(df.dtypes)
    other = {c: (got[c], want[c]) for c in want if FAMILY.get(want[c], want[c]) != got[c]}
    return f"types (Spark, SQL) {other}" if other else None


def main() -> int:
    import __spark_entry__ as entry
    from attestra.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8, 8)
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = compare(df, con, oracle[name]) or compare_types(df, con, oracle[name])
            if problem is None and df.isEmpty():
                print("note: no rows at this scale", name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
