"""Compare registered queries with their SQL twins: ``python tests/check.py [scale] [name or module ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ROOT = "/root/testdata"


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, int):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (int(v) if v == int(v) and abs(v) < 1e15 else v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(sql: str, path: str):
    con = duckdb.connect()
    con.execute("SET threads=4")
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{path}/{n}.parquet'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], [str(d[1]) for d in cur.description], cur.fetchall()


KIND = {
    "long": "BIGINT", "integer": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, name, query, sql, path):
    """Empty string when equal, else what differs."""
    df = query(spark, path)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if df.columns else "no columns"
    cols, types, want = oracle_rows(sql, path)
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(cols)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} differ, columns {sorted(cols)}:\n   {str(bad[0][0])[:600]}\n   {str(bad[0][1])[:600]}"
    return ""


def type_notes(df, sql, path):
    """Columns whose type differs; asks the query again, so only with ``types`` on the command line."""
    cols, types, _ = oracle_rows(f"SELECT * FROM ({sql}) LIMIT 0", path)
    want = dict(zip(cols, types))
    have = {f.name: KIND.get(f.dataType.typeName(), f.dataType.typeName()) for f in df.schema}
    return [f"{c}:{have[c]}/{want[c]}" for c in cols if have.get(c) != want[c]]


if __name__ == "__main__":
    import __spark_entry__ as entry

    from docsynth.session import local_session

    scale, wanted = (sys.argv[1] if len(sys.argv) > 1 else "0.001"), sys.argv[2:]
    types = "types" in wanted
    wanted = [w for w in wanted if w != "types"]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    qs, oracle = entry.queries(), entry.oracle_sql()
    from docsynth.catalog import base

    fails = 0
    for name, q in qs.items():
        if wanted and name not in wanted and base.MODULE_OF.get(name) not in wanted:
            continue
        start = time.time()
        try:
            diff = compare(spark, name, q, oracle.get(name), f"{ROOT}/sf{scale}")
            notes = type_notes(q(spark, f"{ROOT}/sf{scale}"), oracle[name], f"{ROOT}/sf{scale}") if types and name in oracle else ([] if name in oracle else ["no sql"])
        except Exception as e:  # noqa: BLE001 - report and go on
            diff, notes = f"{type(e).__name__}: {str(e)[:1500]}", []
        fails += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - start:.1f}s {' '.join(notes)} {diff}", flush=True)
    print(f"{fails} failed")
